"""Units to the master table: ids, codes, zones, evidence, entries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regwise import rules as R
from regwise.functions.text import core, first_filled, function_key, padded_id, split_badges
from regwise.operators.evidence import co_occurrence, co_occurrence_top, raw_evidence
from regwise.operators.places import with_function
from regwise.operators.sequence import global_index, index_within
from regwise.session import durable


def area_codes(area: DataFrame) -> DataFrame:
    """(prov_code, city, area) to the district, under its three spellings.

    The short name wins over the short name without suffix, which wins over
    the core of the full name; within one spelling the first district wins.
    """
    short = F.col("district_short")
    spellings = F.array(short, F.regexp_replace(short, "(市|区|县)$", ""), core(F.col("district_name")))
    rows = area.select("prov_code", F.col("city_name").alias("city"), "district_ord",
                       F.struct("district_code", "district_name", "district_short").alias("d"),
                       F.posexplode(spellings).alias("tier", "area"))
    return (rows.groupBy("prov_code", "city", "area").agg(F.min_by("d", F.struct("tier", "district_ord")).alias("d"))
            .select("prov_code", "city", "area", "d.*"))


def admin_level(area: Column, district_code: Column) -> Column:
    return (F.when(area.isin(*R.LEVEL_PLACEHOLDERS), area).when(district_code.isNotNull(), "区县").otherwise("开发区/园区"))


def with_admin(units: DataFrame, area: DataFrame) -> DataFrame:
    """Level, codes and names of the area each unit belongs to."""
    cities = area.select("prov_code", F.col("city_name").alias("city"), "city_code").distinct()
    provinces = area.select("prov_code", "prov_name", "prov_short").distinct()
    level = F.col("admin_level")
    by_level = lambda prov, city, dist: (
        F.when(level == R.PROVINCIAL, prov).when(level == R.CITY_LEVEL, city).when(level == "区县", dist).otherwise(""))
    return (units.join(cities, ["prov_code", "city"], "left").join(area_codes(area), ["prov_code", "city", "area"], "left")
            .join(provinces, "prov_code", "left")
            .withColumn("city_code", F.coalesce("city_code", F.lit("")))
            .withColumn("admin_level", admin_level(F.col("area"), F.col("district_code")))
            .withColumn("admin_code", by_level(F.lit(""), F.lit(""), F.col("district_code")))
            .withColumn("admin_name", by_level(F.col("prov_name"), F.col("city"), F.col("district_name")))
            .withColumn("admin_short", by_level(F.col("prov_short"), F.regexp_replace("city", "市+$", ""), F.col("district_short")))
            .drop("district_code", "district_name", "district_short", "prov_name", "prov_short"))


def with_zone(units: DataFrame, zones: DataFrame) -> DataFrame:
    """Zone columns and the relation of the unit to its government."""
    cols = ["zone_id", "zone_name", "zone_short", "zone_level", "zone_admin_code", "admin_relation", "evidence", "confirmed"]
    dim = zones.select("prov_code", "city", F.col("source_label").alias("area"), F.struct(*cols).alias("_z"))
    z = F.col("_z")
    own = z.isNull() & F.col("admin_level").isin(R.CITY_LEVEL, "区县", R.PROVINCIAL, R.NATIONAL)
    relation = F.when(own, "本级政府部门").otherwise(first_filled(z["admin_relation"]))
    return (units.join(dim, ["prov_code", "city", "area"], "left")
            .select("*", *[first_filled(z[c]).alias(c) for c in ("zone_id", "zone_short", "zone_level", "zone_admin_code")],
                    F.when(z.isNull(), "").otherwise(first_filled(z["zone_name"], F.col("area"))).alias("zone_name"),
                    relation.alias("admin_relation"), first_filled(z["evidence"]).alias("relation_evidence"),
                    F.when(z.isNotNull(), F.coalesce(z["confirmed"], F.lit(""))).when(own, R.YES).otherwise(R.NO).alias("relation_confirmed"))
            .withColumn("parent_admin_code", F.when(F.col("admin_relation") == "合署", F.col("city_code"))
                        .when(F.col("admin_relation") == "下属部门", first_filled(F.col("zone_admin_code"), F.col("admin_code")))
                        .otherwise("")).drop("_z"))


def allocate_uids(rows: DataFrame, previous: DataFrame) -> DataFrame:
    """Keep the uid of rows seen before, number the others after the largest known uid.

    ``rows`` has prov_code, function_key, unit. New rows are numbered in the
    order city, records (largest first), unit.
    """
    known = (previous.select("prov_code", "function_key", F.col("name_from_source").alias("unit"), F.col("unit_uid"))
             .groupBy("prov_code", "function_key", "unit").agg(F.max("unit_uid").alias("unit_uid")))
    joined = durable(rows.join(known, ["prov_code", "function_key", "unit"], "left"), "matched")
    prefix = F.coalesce(*[F.when(F.col("prov_code") == p, F.lit(x)) for p, x in R.UID_PREFIX.items()],
                        F.substring("prov_code", 1, 2))
    digits = F.substring(F.col("unit_uid"), F.length(prefix) + 1, F.length("unit_uid"))
    number = F.when(digits.rlike("^[0-9]+$"), digits).cast("long")
    top = previous.groupBy("prov_code").agg(F.max(number).alias("_max"))
    fresh = index_within(joined.filter("unit_uid IS NULL"), ["prov_code"],
                         [F.col("city"), F.desc("record_count"), F.col("unit"), F.col("area"), F.col("function")])
    minted = (fresh.join(top, "prov_code", "left")
              .withColumn("unit_uid", padded_id(prefix, F.col("seq") + F.coalesce("_max", F.lit(0)), 4)).drop("seq", "_max"))
    return joined.filter("unit_uid IS NOT NULL").unionByName(minted)


def with_org(rows: DataFrame, merges: DataFrame) -> DataFrame:
    """``org_id``: the uid of the confirmed merge target in the same city, else the own uid."""
    confirmed = (merges.filter(F.col("confirmed") == R.YES).groupBy("prov_code", "city", "area", "unit")
                 .agg(F.max("merge_into").alias("merge_into")))
    targets = rows.groupBy("prov_code", "city", F.col("unit").alias("merge_into")).agg(
        F.min_by("unit_uid", F.struct((-F.col("record_count")).alias("a"), F.col("area"))).alias("_target"))
    return (rows.join(confirmed, ["prov_code", "city", "area", "unit"], "left")
            .join(targets, ["prov_code", "city", "merge_into"], "left")
            .withColumn("org_id", F.coalesce("_target", "unit_uid")).drop("_target", "merge_into"))


def with_entity(rows: DataFrame) -> DataFrame:
    """``entity_id``: a confirmed co-located zone unit shares the district unit's organisation."""
    key = ["prov_code", "city_code", "zone_admin_code", "role"]
    peers = (rows.filter(F.col("admin_code") != "")
             .groupBy("prov_code", "city_code", F.col("admin_code").alias("zone_admin_code"), "role")
             .agg(F.max_by("org_id", F.struct((-F.col("record_count")).alias("a"), F.col("unit"))).alias("_peer")))
    shared = (F.col("admin_relation") == "合署") & (F.col("zone_admin_code") != "") & (F.col("relation_confirmed") == R.YES)
    return (rows.join(peers, key, "left")
            .withColumn("entity_id", F.coalesce(F.when(shared, F.col("_peer")), F.col("org_id"))).drop("_peer"))


def with_entry(rows: DataFrame, entries: DataFrame, registry: DataFrame) -> DataFrame:
    """Entry columns: the unit's own line, then the registry row of its address.

    Registry category and rule replace, a filled path replaces, verification is
    inherited unless the unit's own line is only inferred.
    """
    own = entries.select("prov_code", "city", "unit", F.trim("entry_url").alias("entry_url"),
                         F.col("entry_path").alias("_path"), F.col("verify_status").alias("_status"), F.col("verify_date").alias("_date"))
    reg = registry.select("prov_code", "entry_url", F.struct("entry_id", "entry_category", "filter_rule", "entry_path",
                                                             "verify_status", "verify_date").alias("_r"))
    r = F.col("_r")
    inherit = lambda c, mine: F.when(F.col("_status") == R.INFERRED, F.coalesce(mine, F.lit("")))\
        .otherwise(first_filled(r[c], mine))
    return (rows.join(own, ["prov_code", "city", "unit"], "left").withColumn("entry_url", F.coalesce("entry_url", F.lit("")))
            .join(reg, ["prov_code", "entry_url"], "left")
            .withColumn("entry_id", first_filled(r["entry_id"])).withColumn("entry_category", first_filled(r["entry_category"]))
            .withColumn("filter_rule", first_filled(r["filter_rule"])).withColumn("entry_path", first_filled(r["entry_path"], F.col("_path")))
            .withColumn("verify_status", inherit("verify_status", F.col("_status")))
            .withColumn("verify_date", inherit("verify_date", F.col("_date")))
            .drop("_r", "_path", "_status", "_date"))


def retire_missing(rows: DataFrame, previous: DataFrame) -> DataFrame:
    """Rows of the previous run whose uid is gone come back with status 已停用."""
    gone = previous.join(rows.select("unit_uid"), "unit_uid", "left_anti").withColumn("name_status", F.lit(R.RETIRED))
    return rows.unionByName(gone, allowMissingColumns=True)


def carry_over(rows: DataFrame, previous: DataFrame) -> DataFrame:
    """Human values and columns of later steps, taken from the previous run by uid."""
    extra = [c for c in previous.columns if c not in R.MASTER_COLUMNS]
    held = ["name_canonical", "name_status", "group_id"]
    old = previous.select("unit_uid", F.struct(*[(F.col(c) if c in previous.columns else F.lit("")).alias(c)
                                                 for c in [*held, *extra]]).alias("_old"))
    o = F.col("_old")
    return (rows.join(old, "unit_uid", "left")
            .withColumn("name_canonical", first_filled(o["name_canonical"]))
            .withColumn("name_status", first_filled(o["name_status"], F.lit(R.IN_USE)))
            .withColumn("group_id", first_filled(o["group_id"]))
            .select("*", *[first_filled(o[c]).alias(c) for c in extra if c not in rows.columns]).drop("_old"))


def keyed_units(units: DataFrame, places: DataFrame) -> DataFrame:
    """Units with the key that identifies them between runs."""
    return (with_function(units, places, "unit", "_f")
            .withColumn("function_key", function_key(F.col("city"), F.col("area"), F.col("_f"))).drop("_f"))


def upsert_units(units: DataFrame, previous: DataFrame, places: DataFrame) -> DataFrame:
    """Units against the table of an earlier run: known ones keep their uid, new ones get one, missing ones are retired.

    Human values and the columns of later steps are carried over by uid. Both
    frames hold whole provinces.
    """
    rows = durable(allocate_uids(keyed_units(units, places), previous), "uids")
    named = carry_over(rows, previous).withColumn("name_from_source", F.col("unit"))
    fixed = named.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in previous.columns if c in named.columns])
    return retire_missing(durable(fixed, "upsert"), previous).na.fill("")


def build_master(units: DataFrame, records: DataFrame, places: DataFrame, area: DataFrame, zones: DataFrame,
                 entries: DataFrame, registry: DataFrame, merges: DataFrame, previous: DataFrame) -> DataFrame:
    """The master table: 39 columns plus the previous run's extra columns, all text."""
    rows = durable(allocate_uids(keyed_units(units, places), previous), "uids")
    rows = with_zone(with_admin(rows, area), zones)
    rows = with_entity(durable(with_org(rows, merges), "org"))
    rows = with_entry(rows, entries, registry)
    rows = rows.join(raw_evidence(records, units), ["prov_code", "city", "area", "unit"], "left")
    top = co_occurrence_top(co_occurrence(records)).withColumnRenamed("publisher", "unit")
    rows = rows.join(top, ["prov_code", "unit"], "left")
    rows = carry_over(rows, previous)
    made = {
        "name_from_source": F.col("unit"), "name_variants": F.array_join("variants", R.VARIANT_SEP),
        "badges": split_badges(F.col("unit")),
        "last_notice_date": first_filled(F.col("last_notice_date"), F.col("last_date")),
        "raw_matched": F.coalesce("raw_matched", F.lit(0)),
    }
    extra = [c for c in previous.columns if c not in R.MASTER_COLUMNS]
    fixed = rows.select(*[F.coalesce(made.get(c, F.col(c)).cast("string"), F.lit("")).alias(c) for c in [*R.MASTER_COLUMNS, *extra]])
    return retire_missing(durable(fixed, "master"), previous).na.fill("")


def master_order() -> list[Column]:
    """City code, admin code (blank last), records descending."""
    admin = F.coalesce(F.nullif(F.col("admin_code"), F.lit("")), F.lit("zzz"))
    count = F.coalesce(F.nullif(F.col("record_count"), F.lit("")).cast("long"), F.lit(0))
    return [F.col("city_code"), admin, count.desc()]


def master_position(master: DataFrame) -> DataFrame:
    return global_index(master, [*master_order(), F.col("unit_uid")], "position")
