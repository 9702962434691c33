"""Evidence about units from the raw records: aliases, co-occurrence, statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regwise import rules as R
from regwise.functions.collections import counted
from regwise.functions.text import normalize, split_units, strip
from regwise.operators.spellings import iso_date
from regwise.session import durable, once

UNIT = ("prov_code", "city", "area", "unit")


def alias_table(units: DataFrame) -> DataFrame:
    """(prov_code, city, name) to the unit it stands for.

    A representative beats a variant. Among representatives the smallest unit
    wins, among variants the first in list order of the largest unit.
    """
    target = F.struct("area", "unit").alias("target")
    own = units.select("prov_code", "city", F.col("unit").alias("name"), target,
                       F.struct(F.lit(0).alias("tier"), F.col("record_count").alias("a"), F.col("area").alias("b"),
                                F.lit(0).alias("pos")).alias("rank"))
    others = units.select("prov_code", "city", "area", "unit", "record_count", F.posexplode("variants").alias("pos", "name"))
    other = others.select("prov_code", "city", "name", target,
                          F.struct(F.lit(1).alias("tier"), (-F.col("record_count")).alias("a"), F.col("unit").alias("b"),
                                   "pos").alias("rank"))
    return (own.unionByName(other).groupBy("prov_code", "city", "name").agg(F.min_by("target", "rank").alias("target"))
            .select("prov_code", "city", "name", "target.area", "target.unit"))


def match_first(df: DataFrame, table: DataFrame, keys: list[list], on: list[str], values: list[str]) -> DataFrame:
    """Left-join ``table`` under several key expressions; the first that hits wins.

    ``keys`` lists, per attempt, the expressions for the columns ``on``. Each
    distinct combination is tried once: its attempts meet the table in one
    join, and the earliest hit goes back to the rows.
    """
    tries = [[f"_k{i}_{c}" for c in on] for i in range(len(keys))]
    names = [n for one in tries for n in one]
    asked = df.select("*", *[e.alias(n) for exprs, one in zip(keys, tries) for e, n in zip(exprs, one)])
    each = F.array(*[F.struct(F.lit(i).alias("_try"), *[F.col(n).alias(c) for n, c in zip(one, on)]) for i, one in enumerate(tries)])
    found = (asked.select(*names).distinct().select(*names, F.inline(each)).join(table.select(*on, F.struct(*values).alias("_hit")), on)
             .groupBy(*names).agg(F.min_by("_hit", "_try").alias("_best")))
    same = None
    for n in names:
        one = F.col(f"a.{n}").eqNullSafe(F.col(f"b.{n}"))
        same = one if same is None else same & one
    return asked.alias("a").join(found.alias("b"), same, "left").select(
        *[F.col(f"a.{c}") for c in df.columns], *[F.col(f"b._best.{v}").alias(v) for v in values])


def matched_records(records: DataFrame, units: DataFrame) -> DataFrame:
    """Records counted per raw department and county, matched to units.

    Tried in order: city field plus 市, city field, city of the file. Counting
    comes before the joins, so each distinct text is matched once.
    """
    raw = records.groupBy("prov_code", "city_name", "city_field", "process_department", "county").agg(
        F.count(F.lit(1)).alias("n"), F.min(iso_date(F.col("notice_date"))).alias("first"),
        F.max(iso_date(F.col("notice_date"))).alias("last"), F.min("ord").alias("ord"))
    named = once(raw, name=normalize(F.col("process_department")))
    p, field, name = F.col("prov_code"), F.coalesce("city_field", F.lit("")), F.col("name")
    aliases = alias_table(units).select("prov_code", "city", "name", F.col("city").alias("unit_city"), "area", "unit")
    hit = match_first(named, aliases, [[p, F.concat(field, F.lit("市")), name], [p, field, name], [p, F.col("city_name"), name]],
                      ["prov_code", "city", "name"], ["unit_city", "area", "unit"])
    return hit.filter(F.col("unit").isNotNull()).withColumnRenamed("unit_city", "city")


def raw_evidence(records: DataFrame, units: DataFrame, top: int = 4) -> DataFrame:
    """Per unit: matched rows, first and last notice date, top county histogram."""
    by_county = durable(
        matched_records(records, units)
        .withColumn("county", F.coalesce(F.nullif(F.col("county"), F.lit("")), F.lit(R.EMPTY_COUNTY)))
        .groupBy(*UNIT, "county").agg(F.sum("n").alias("n"), F.min("first").alias("first"),
                                      F.max("last").alias("last"), F.min("ord").alias("ord")), "counties")
    order = Window.partitionBy(*UNIT).orderBy(F.desc("n"), "ord")
    best = by_county.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= top)
    shown = best.groupBy(*UNIT).agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("_rank", "county", "n"))), lambda x: F.concat(x["county"], F.lit(":"), x["n"].cast("string"))),
        R.VARIANT_SEP).alias("county_field_dist"))
    text = lambda d: F.coalesce(F.date_format(d, "yyyy-MM-dd"), F.lit(""))
    sums = by_county.groupBy(*UNIT).agg(F.sum("n").alias("raw_matched"), text(F.min("first")).alias("first_notice_date"),
                                        text(F.max("last")).alias("last_notice_date"))
    return sums.join(shown, list(UNIT))


def co_occurrence(records: DataFrame) -> DataFrame:
    """(prov_code, publisher, other, n): agencies named together with the publisher.

    Distinct (publisher, cell) pairs are counted before the cells are split.
    """
    cells = records.groupBy("prov_code", "process_department", "combined_units").agg(F.count(F.lit(1)).alias("n"))
    parts = once(cells, publisher=strip(F.coalesce("process_department", F.lit(""))), parts=split_units(F.col("combined_units")))
    pairs = (parts.filter((F.col("publisher") != "") & (F.size("parts") >= 2))
             .select("prov_code", "publisher", F.explode("parts").alias("other"), "n")
             .filter(F.col("other") != F.col("publisher")))
    return pairs.groupBy("prov_code", "publisher", "other").agg(F.sum("n").alias("n"))


def co_occurrence_top(pairs: DataFrame, top: int = 3) -> DataFrame:
    """Per publisher the ``top`` agencies named most often with it, as text."""
    order = Window.partitionBy("prov_code", "publisher").orderBy(F.desc("n"), "other")
    best = pairs.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= top)
    return best.groupBy("prov_code", "publisher").agg(
        counted(F.collect_list(F.struct(F.col("other").alias("key"), "n"))).alias("co_occurrence_top"))


def merge_candidates(units: DataFrame, confirmed: DataFrame | None = None) -> DataFrame:
    """Units of one (city, area, role) that may be the same agency as its largest unit."""
    group = ("prov_code", "city", "area", "role")
    largest = units.groupBy(*group).agg(
        F.count(F.lit(1)).alias("_k"),
        F.min_by(F.struct("unit", "record_count"), F.struct((-F.col("record_count")).alias("a"), F.col("unit"))).alias("_top"))
    rows = (units.join(largest.filter("_k >= 2"), list(group)).filter(F.col("unit") != F.col("_top.unit"))
            .select(*group, "unit", "record_count", F.col("_top.unit").alias("merge_into"),
                    F.col("_top.record_count").alias("merge_into_count")))
    if confirmed is None:
        return rows.withColumn("confirmed", F.lit(""))
    yes = confirmed.filter(F.col("confirmed") == R.YES).select("prov_code", "city", "area", "unit", F.lit(True).alias("_yes")).distinct()
    return (rows.join(yes, ["prov_code", "city", "area", "unit"], "left")
            .withColumn("confirmed", F.when(F.col("_yes"), R.YES).otherwise("")).drop("_yes"))
