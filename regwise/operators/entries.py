"""Entry pages: the per-unit log and the registry of distinct addresses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regwise import rules as R
from regwise.functions.agency import tier
from regwise.functions.text import first_filled, padded_id, strip
from regwise.functions.url import domain
from regwise.operators.sequence import index_within


def latest_entries(log: DataFrame) -> DataFrame:
    """One row per (prov_code, city, unit): the last line wins, its first position is kept as ``ord``.

    ``log`` has file_stem and ord (line order); lines without a unit are skipped.
    """
    value = [c for c in log.columns if c not in ("prov_code", "city", "unit", "ord")]
    named = log.withColumn("unit", strip(F.col("unit"))).filter(F.col("unit") != "")
    return (named.groupBy("prov_code", "city", "unit")
            .agg(F.max_by(F.struct(*value), F.struct("file_stem", "ord")).alias("_v"), F.min(F.struct("file_stem", "ord")).alias("ord"))
            .select("prov_code", "city", "unit", "_v.*", "ord"))


def own_entries(entries: DataFrame, units: DataFrame, area: DataFrame) -> DataFrame:
    """Entries of the province's cities; shared ones only for units the province lists."""
    cities = area.select("prov_code", F.col("city_name").alias("city")).distinct()
    shared = units.filter(F.col("city") == R.NO_CITY).select("prov_code", "city", "unit").distinct()
    return (entries.join(cities, ["prov_code", "city"], "left_semi")
            .unionByName(entries.filter(F.col("city") == R.NO_CITY).join(shared, ["prov_code", "city", "unit"], "left_semi")))


def entry_registry(entries: DataFrame, curated: DataFrame) -> DataFrame:
    """One row per entry address, curated values first.

    The representative line is the first one, unless it is only inferred and a
    line that is not exists. New ids continue after the largest known number of
    the province, the most used address first.
    """
    used = entries.withColumn("entry_url", strip(F.col("entry_url"))).filter(F.col("entry_url") != "")
    inferred = (F.col("verify_status") == R.INFERRED).cast("int")
    per_url = used.groupBy("prov_code", "entry_url").agg(
        F.array_join(F.sort_array(F.collect_set("city")), R.VARIANT_SEP).alias("cities"),
        F.count(F.lit(1)).alias("unit_count"), F.min("ord").alias("_pos"),
        F.min_by(F.struct("entry_path", "verify_status", "verify_date"), F.struct(inferred.alias("i"), "ord")).alias("_row"))
    keep = curated.select("prov_code", "entry_url", F.struct(
        *[c for c in curated.columns if c not in ("prov_code", "entry_url")]).alias("_keep"))
    joined = per_url.join(keep, ["prov_code", "entry_url"], "left")
    known = joined.filter("_keep IS NOT NULL").withColumn("entry_id", F.col("_keep.entry_id"))
    top = curated.groupBy("prov_code").agg(F.max(F.regexp_extract("entry_id", "E(\\d+)$", 1).cast("int")).alias("_max"))
    fresh = index_within(joined.filter("_keep IS NULL"), ["prov_code"], [F.desc("unit_count"), F.col("_pos"), F.col("entry_url")])
    minted = (fresh.join(top, "prov_code", "left").withColumn("entry_id", padded_id(
        F.concat(F.substring("prov_code", 1, 4), F.lit("-E")), F.col("seq") + F.coalesce("_max", F.lit(0)), 3)).drop("seq", "_max"))
    k, row = F.col("_keep"), F.col("_row")
    return known.unionByName(minted).select(
        "prov_code", "entry_id", "entry_url", domain(F.col("entry_url")).alias("domain"), "cities", "unit_count",
        first_filled(k["entry_category"]).alias("entry_category"), first_filled(k["entry_path"], row["entry_path"]).alias("entry_path"),
        first_filled(k["filter_rule"]).alias("filter_rule"), first_filled(k["title_bracket_meaning"]).alias("title_bracket_meaning"),
        first_filled(k["verify_status"], row["verify_status"]).alias("verify_status"),
        first_filled(k["verify_date"], row["verify_date"]).alias("verify_date"))


def units_with_entries(units: DataFrame, entries: DataFrame) -> DataFrame:
    """Every unit with its entry line; units without one are marked unchecked with their tier."""
    cols = ["home_url", "entry_url", "entry_path", "note", "verify_status", "verify_date"]
    hit = entries.select("prov_code", "city", "unit", F.struct(*cols).alias("_e"))
    e = F.col("_e")
    missing = {"verify_status": F.lit(R.UNCHECKED), "note": tier(F.col("unit"))}
    return (units.join(hit, ["prov_code", "city", "unit"], "left")
            .select("prov_code", "city", "area", "unit", "record_count", *[
                F.when(e.isNull(), missing.get(c, F.lit(""))).otherwise(F.coalesce(e[c], F.lit(""))).alias(c) for c in cols]))
