"""Merging located spellings into agencies (units)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regwise import rules as R
from regwise.functions.agency import is_proper, may_be_truncated, role_of

AREA = ("prov_code", "city", "area")
GROUP = ("prov_code", "city", "area", "function")


def zone_parts(area: Column) -> tuple[Column, Column]:
    """(kind, head) of a zone label; kind is null for other areas."""
    kinds = sorted(set(R.ZONE_KIND.values()), key=lambda k: (-len(k), k))
    kind = F.coalesce(*[F.when(area.endswith(k), F.lit(k)) for k in kinds])
    return kind, F.substring(area, F.lit(1), F.length(area) - F.length(kind))


def canonical_zones(area_counts: DataFrame) -> DataFrame:
    """Zones that are another spelling of a larger zone: (prov_code, city, area, canonical).

    Within one city and kind, a head that contains or is contained in the head
    of exactly one zone with strictly more records follows that zone; one hop
    only. Containment is found by joining each head to the other heads' own
    substrings on equality, so no pairs are formed that are not a match.
    """
    kind, head = zone_parts(F.col("area"))
    zones = (area_counts.select(*AREA, "n", kind.alias("kind"), head.alias("head"))
             .filter(F.col("kind").isNotNull() & (F.col("head") != "") & (F.col("head") != R.OWN_LEVEL)))
    length = F.length("head")
    pieces = F.array_distinct(F.flatten(F.transform(
        F.sequence(F.lit(1), length),
        lambda start: F.transform(F.sequence(F.lit(1), length - start + 1),
                                  lambda size: F.substring(F.col("head"), start, size)))))
    keys = ("prov_code", "city", "kind")
    long = zones.select(*keys, F.col("area").alias("long_area"), F.col("n").alias("long_n"), F.col("head").alias("long_head"),
                        F.explode(pieces).alias("head"))
    touching = (long.join(zones.select(*keys, "head", F.col("area").alias("short_area"), F.col("n").alias("short_n")),
                          [*keys, "head"])
                .filter(F.col("head") != F.col("long_head")))
    larger = touching.select(
        "prov_code", "city",
        F.when(F.col("long_n") > F.col("short_n"), F.col("short_area")).otherwise(F.col("long_area")).alias("area"),
        F.when(F.col("long_n") > F.col("short_n"), F.col("long_area")).otherwise(F.col("short_area")).alias("partner"),
        (F.col("long_n") != F.col("short_n")).alias("strict")).filter("strict")
    return (larger.groupBy(*AREA).agg(F.count(F.lit(1)).alias("k"), F.min("partner").alias("canonical"))
            .filter("k = 1").drop("k"))


def apply_canonical(kept: DataFrame) -> DataFrame:
    """Move each spelling to the canonical area of its zone."""
    counts = kept.groupBy(*AREA).agg(F.sum("n").alias("n"))
    return (kept.join(canonical_zones(counts), list(AREA), "left")
            .withColumn("area", F.coalesce("canonical", "area")).drop("canonical"))


def recover_truncated(kept: DataFrame, dropped: DataFrame) -> DataFrame:
    """Dropped spellings that are the beginning or end of one kept group's spellings.

    Evidence must agree on queried city and modal county, and point to exactly
    one group. Survivors are indexed by their own proper prefixes and suffixes
    and reduced to the smallest and largest group per fragment before the
    join, so that a hot county never forms survivor-by-dropped pairs. Only the
    groups present before recovery count.
    """
    name = F.col("name")
    sizes = F.sequence(F.lit(3), F.length(name) - 1)
    fragments = F.when(F.length(name) > 3, F.array_distinct(F.concat(
        F.transform(sizes, lambda k: F.substring(name, F.lit(1), k)),
        F.transform(sizes, lambda k: F.substring(name, F.length(name) - k + 1, k)))))
    keys = ("prov_code", "city_code", "county")
    target = F.struct("city", "area", "function")
    index = (kept.filter(F.col("county") != "")
             .select(*keys, target.alias("target"), F.explode(fragments).alias("name"))
             .groupBy(*keys, "name").agg(F.min("target").alias("target"), F.max("target").alias("other"))
             .filter(F.col("target") == F.col("other")).drop("other"))
    candidates = dropped.filter((F.col("county") != "") & may_be_truncated(name))
    hits = candidates.drop("city", "area", "function").join(index, [*keys, "name"])
    return hits.select("*", "target.city", "target.area", "target.function", F.lit(True).alias("recovered")).drop("target")


def representative_key(name: Column, with_suffix_flag: bool = True) -> Column:
    """Sort key of the representative: larger is better, ties go to the first seen."""
    parts = [F.col("last_date"), F.col("n"), F.length(name)]
    if with_suffix_flag:
        parts = [is_proper(name), *parts]
    return F.struct(*[p.alias(f"k{i}") for i, p in enumerate(parts)], (~F.col("recovered")).alias("own"),
                    (-F.col("first")).alias("a"))


def merge_units(spellings: DataFrame, group=GROUP, with_suffix_flag: bool = True) -> DataFrame:
    """One row per group: representative, newest date, record sum and other spellings.

    Sums, dates and the representative come from one aggregation. The list of
    other spellings is the deliverable's own cell; it holds distinct spellings
    of one agency, not records.
    """
    ranked = spellings.withColumn("_k", representative_key(F.col("name"), with_suffix_flag))
    one = ranked.groupBy(*group, "name").agg(  # a spelling asked for by several cities is one entry
        F.sum("n").alias("n"), F.max("last_date").alias("last_date"), F.max("_k").alias("_k"))
    merged = one.groupBy(*group).agg(
        F.max_by("name", "_k").alias("unit"), F.max("last_date").alias("last_date"), F.sum("n").alias("record_count"),
        F.sort_array(F.collect_list(F.struct(F.col("_k").alias("k"), "name")), asc=False).alias("_all"))  # best first
    others = F.filter(F.transform("_all", lambda s: s["name"]), lambda v: v != F.col("unit"))
    return merged.withColumn("variants", others).drop("_all")


def with_role(units: DataFrame) -> DataFrame:
    return units.withColumn("role", F.when(F.col("function") == R.ECO_FUNCTION, R.ECO_FUNCTION)
                            .otherwise(role_of(F.col("unit"))))


def spelling_rows(units: DataFrame) -> DataFrame:
    """Every spelling of every unit with its position (0 is the representative)."""
    keys = [c for c in units.columns if c != "variants"]
    return units.select(*keys, F.posexplode(F.concat(F.array("unit"), F.col("variants"))).alias("pos", "name"))


def flag_seen_in(units: DataFrame, other: DataFrame, to: str = "seen") -> DataFrame:
    """Add 是/否: does any spelling of the unit occur among ``other``'s spellings of the province."""
    known = spelling_rows(other).select("prov_code", "name").distinct()
    hit = spelling_rows(units).join(known, ["prov_code", "name"], "left_semi").select(*GROUP).distinct().withColumn("_hit", F.lit(True))
    return (units.join(hit, list(GROUP), "left")
            .withColumn(to, F.when(F.col("_hit"), R.YES).otherwise(R.NO)).drop("_hit"))


def approvers(units: DataFrame) -> DataFrame:
    return units.filter(F.col("role") != R.OTHER_ROLE)


def removed_by_role(units: DataFrame) -> DataFrame:
    other = F.col("role") == R.OTHER_ROLE
    return units.groupBy("prov_code").agg(
        F.count_if(~other).alias("approvers"), F.count_if(other).alias("removed_units"),
        F.coalesce(F.sum(F.when(other, F.col("record_count"))), F.lit(0)).alias("removed_records"))


def unit_table(units: DataFrame, label: str = "单位", seen: str | None = None) -> DataFrame:
    """The deliverable columns; ``label`` names the unit column, ``seen`` adds the comparison flag."""
    cols = [F.col("city").alias("城市"), F.col("area").alias("地区"), F.col("unit").alias(label), F.col("role").alias("职能"),
            F.col("last_date").alias("最新公告日期"), F.col("record_count").alias("记录数"),
            F.array_join("variants", R.VARIANT_SEP).alias("合并的其他写法")]
    if seen:
        cols.insert(5, F.col(seen).alias(R.SEEN_COLUMN))
    return units.select("prov_code", *cols)


def top_units(units: DataFrame, keys, n: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("record_count"), "unit")
    return units.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)
