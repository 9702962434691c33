"""Evidence samples and stratified samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regwise import rules as R
from regwise.functions.text import strip, variants_of
from regwise.operators.spellings import iso_date


def target_units(master: DataFrame, statuses: list[str]) -> DataFrame:
    """Master rows of the given verification states with a city and a last notice."""
    wanted = [R.STATUS_ALIASES.get(s, s) for s in statuses]
    return master.filter(F.col("verify_status").isin(*wanted) & (F.col("city_code") != "") & (F.col("last_notice_date") != ""))


def evidence_samples(units: DataFrame, records: DataFrame, days: int = 20, per_unit: int = 5) -> DataFrame:
    """The first ``per_unit`` notices of each unit in the ``days`` before its last notice.

    Days are cut into buckets as long as a window, so a window lies in two of
    them at most. Units ask for their buckets, and join on equality of city,
    spelling and bucket: of a spelling's history only the days around the
    window are met, less than three windows' worth. The ranking keeps only the
    best rows before its shuffle (``row_number() <= k``).
    """
    bucket = lambda day: F.floor(F.unix_date(day) / (days + 1))
    end, day = F.col("_end"), F.col("_day")
    names = units.select("unit_uid", "city_code", iso_date(F.col("last_notice_date")).alias("_end"),
                         F.explode(F.array_distinct(F.concat(F.array("name_from_source"), variants_of(F.col("name_variants"))))).alias("name"))
    asked = names.filter(end.isNotNull()).withColumn("_bucket", F.explode(F.array_distinct(F.array(bucket(F.date_sub(end, days)), bucket(end)))))
    notices = records.select("city_code", strip(F.col("process_department")).alias("name"), "ord", iso_date(F.col("notice_date")).alias("_day"))
    notices = notices.filter(day.isNotNull()).withColumn("_bucket", bucket(day))
    hit = asked.join(notices, ["city_code", "name", "_bucket"]).filter((day <= end) & (day >= F.date_sub(end, days)))
    order = Window.partitionBy("unit_uid").orderBy("ord")
    return (hit.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= per_unit)
            .select("unit_uid", "city_code", "name", "ord", "rank"))


def stratified_sample(df: DataFrame, strata: list, key: Column, n: int, seed: int = 7) -> DataFrame:
    """Up to ``n`` rows per stratum, the same ones on every run and partitioning."""
    draw = F.md5(F.concat(F.lit(f"{seed}|"), key))
    order = Window.partitionBy(*strata).orderBy(draw, key)
    return df.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= n)


def first_seen(df: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """First row per key; Spark keeps one row of each key in every task before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
    rest = [c for c in df.columns if c not in keys]
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= 1).select(*keys, *rest)
