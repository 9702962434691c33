"""Candidates for the zone dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regwise import rules as R
from regwise.functions.text import core, padded_id
from regwise.operators.sequence import index_within

D7_WIDTH = 2


def district_labels(area: DataFrame) -> DataFrame:
    """All ways (prov_code, city, area) in which a district appears as an area."""
    short = F.col("district_short")
    labels = F.array(short, core(F.col("district_name")), F.regexp_replace(short, "(市|区|县)$", ""))
    return area.select("prov_code", F.col("city_name").alias("city"), F.explode(labels).alias("area")).distinct()


def zone_labels(units: DataFrame, area: DataFrame, words_only: bool = True) -> DataFrame:
    """Unit rows whose area is neither a level nor a district (and holds a zone word)."""
    rest = units.filter(~F.col("area").isin(*R.LEVEL_PLACEHOLDERS)).join(
        district_labels(area), ["prov_code", "city", "area"], "left_anti")
    return rest.filter(F.col("area").rlike(R.ZONE)) if words_only else rest


def zone_kind(label: Column) -> Column:
    kinds = F.create_map(*[F.lit(x) for pair in R.ZONE_KIND.items() for x in pair])
    return F.coalesce(F.element_at(kinds, F.regexp_extract(label, R.ZONE, 2)), F.lit(""))


def zone_candidates(units: DataFrame, area: DataFrame, existing: DataFrame, suspects: list[tuple[str, str]] = ()) -> DataFrame:
    """New zone rows: counts, sample unit, kind and the next free number of the city.

    Numbers continue after the largest suffix in use (not after the number of
    rows, which collides once rows were removed).
    """
    grouped = zone_labels(units, area).groupBy("prov_code", "city", F.col("area").alias("source_label")).agg(
        F.count(F.lit(1)).alias("unit_count"), F.sum("record_count").alias("record_count"),
        F.max_by("unit", F.struct("record_count", "unit")).alias("sample_unit"))
    fresh = grouped.join(existing.select("prov_code", "city", "source_label"), ["prov_code", "city", "source_label"], "left_anti")
    codes = area.select("prov_code", F.col("city_name").alias("city"), "city_code").distinct()
    used = existing.groupBy("city_code").agg(F.max(F.regexp_extract("zone_id", "Z(\\d+)$", 1).cast("int")).alias("_used"))
    numbered = index_within(fresh.join(codes, ["prov_code", "city"]), ["city_code"], [F.col("source_label")])
    suspect = F.lit(False)
    for city, label in suspects:
        suspect = suspect | ((F.col("city") == city) & (F.col("source_label") == label))
    return (numbered.join(used, "city_code", "left")
            .withColumn("zone_id", padded_id(F.concat("city_code", F.lit("-Z")), F.col("seq") + F.coalesce("_used", F.lit(0)), D7_WIDTH))
            .withColumn("kind", zone_kind(F.col("source_label"))).withColumn("confirmed", F.lit(R.NO))
            .withColumn("evidence", F.when(suspect, R.SUSPECT_NOTE).otherwise("")).drop("seq", "_used"))


def extend_zones(existing: DataFrame, fresh: DataFrame) -> DataFrame:
    """Existing rows as they are plus the new ones, on the dimension's columns."""
    shape = lambda df: df.select("prov_code", *[
        (F.col(x) if x in df.columns else F.lit("")).cast("string").alias(x) for x in R.ZONE_COLUMNS])
    return shape(existing).unionByName(shape(fresh))
