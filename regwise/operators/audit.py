"""Completeness and coverage reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regwise import rules as R


def run_summary(rows: DataFrame, units: DataFrame) -> DataFrame:
    """Per province: raw rows, kept records, units and cities."""
    raw = rows.groupBy("prov_code").agg(F.count(F.lit(1)).alias("raw_rows"))
    kept = units.groupBy("prov_code").agg(F.sum("record_count").alias("kept_records"), F.count(F.lit(1)).alias("units"),
                                          F.count_distinct("city").alias("cities"))
    return raw.join(kept, "prov_code", "left").na.fill(0, ["kept_records", "units", "cities"])


def city_subtotals(units: DataFrame) -> DataFrame:
    """Units and records per city with a province subtotal (city is null there)."""
    return units.rollup("prov_code", "city").agg(
        F.count(F.lit(1)).alias("units"), F.sum("record_count").alias("records")).filter(F.col("prov_code").isNotNull())


def missing_pairs(wanted: DataFrame, done: DataFrame, keys) -> DataFrame:
    """Keys that should have data and have none."""
    return wanted.select(*keys).distinct().join(done.select(*keys).distinct(), list(keys), "left_anti")


def city_mismatch(records: DataFrame) -> DataFrame:
    """Per queried city: rows whose own city field names another city."""
    other = ~F.col("city_field").isin("") & ~F.col("_known")
    known = (F.col("city_field") == F.col("city_name")) | (F.col("city_field") == F.col("city_short"))
    return (records.withColumn("_known", known).groupBy("city_code")
            .agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(~F.col("_known")).alias("mismatched"),
                 F.count_if(other).alias("named_other")))


def stage_summary(probes: DataFrame) -> DataFrame:
    """Attachment counts per (prov, city, stage) with (prov, stage) subtotals.

    Rows whose counter is not a number are left out. Subtotal rows have a null
    city; ``share`` is the percentage with an official report.
    """
    order = F.coalesce(*[F.when(F.col("stage") == s, i) for i, s in enumerate(R.STAGES)], F.lit(9))
    some = lambda c: F.col(c).rlike("^[0-9]*[1-9][0-9]*$")  # noqa: E731 - above zero, at any length
    kept = probes.filter(F.col("n_all").rlike("^[0-9]+$"))
    sums = kept.groupingSets([("prov", "city", "stage"), ("prov", "stage")], "prov", "city", "stage").agg(
        F.grouping("city").alias("_sub"), F.count(F.lit(1)).alias("sampled"),
        F.count_if(some("n_official")).alias("official"), F.count_if(some("n_external")).alias("external"),
        F.count_if(some("n_all")).alias("any_attachment"), F.count_if(F.col("error") != "").alias("errors"))
    return sums.select("prov", "city", "stage", order.cast("long").alias("stage_order"), "sampled", "official", "external",
                       "any_attachment", "errors",
                       F.when(F.col("_sub") == 1, F.round(F.try_divide(F.col("official") * 100.0, "sampled"))).alias("share"))


def reject_corrupt(probes: DataFrame, column: str = "n_all") -> DataFrame:
    return probes.filter(F.coalesce(F.col(column), F.lit("")).rlike("^[0-9]+$"))


def entry_progress(units: DataFrame, entries: DataFrame) -> DataFrame:
    """Per city: units and units with an entry."""
    known = entries.select("prov_code", "city", "unit", F.lit(True).alias("_has")).distinct()
    return (units.join(known, ["prov_code", "city", "unit"], "left").groupBy("prov_code", "city")
            .agg(F.count(F.lit(1)).alias("units"), F.count_if(F.col("_has")).alias("with_entry")))


def distinct_metrics(units: DataFrame, registry: DataFrame) -> DataFrame:
    """Distinct units, cities and (city, unit) pairs, and entries shared by several units."""
    a = units.agg(F.count_distinct("unit").alias("unit_names"), F.count_distinct("prov_code", "city").alias("cities"),
                  F.count_distinct("prov_code", "city", "unit").alias("city_units"))
    b = registry.agg(F.count(F.lit(1)).alias("entries"), F.count_if(F.col("unit_count") > 1).alias("shared_entries"))
    both = a.unionByName(b, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


def same_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows present on one side only (duplicates count), marked with the side."""
    return (left.exceptAll(right).withColumn("side", F.lit("left"))
            .unionByName(right.exceptAll(left).withColumn("side", F.lit("right"))))
