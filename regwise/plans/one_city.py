"""The narrower clean-up of a single city, driven by its own rule set."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regwise import rules as R
from regwise.functions import agency as A
from regwise.operators.spellings import iso_date
from regwise.operators.units import merge_units
from regwise.session import once


def one_city_spellings(records: DataFrame, rules: R.CityRules = R.ONE_CITY) -> DataFrame:
    """Counts, dates, area, function and drop reason per spelling of the city."""
    raw = records.groupBy("process_department").agg(
        F.count(F.lit(1)).alias("n"), F.max(iso_date(F.col("notice_date"))).alias("last"), F.min("ord").alias("ord"))
    name = F.col("name")
    return (once(raw, name=A.one_city_name(F.col("process_department"), rules)).filter(name != "")
            .groupBy("name").agg(F.sum("n").alias("n"), F.min("ord").alias("ord"),
                                 F.coalesce(F.date_format(F.max("last"), "yyyy-MM-dd"), F.lit("")).alias("last_date"))
            .withColumn("area", A.one_city_area(name, rules)).withColumn("function", A.one_city_function(name, rules))
            .withColumn("drop_reason", A.one_city_drop_reason(name, rules)))


def clean_one_city(records: DataFrame, rules: R.CityRules = R.ONE_CITY) -> DataFrame:
    """Units of the city; the representative is the newest spelling, without a suffix preference."""
    kept = one_city_spellings(records, rules).filter(F.col("drop_reason").isNull())
    keyed = (kept.withColumnRenamed("ord", "first").withColumn("recovered", F.lit(False)))
    return merge_units(keyed, group=("area", "function"), with_suffix_flag=False)
