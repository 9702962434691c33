"""From notice records to located spellings.

Records are counted per distinct raw spelling first; every rule then runs on
the (far smaller) spelling table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regwise.functions.text import normalize, split_units
from regwise.operators.places import judge
from regwise.session import durable, once

KEY = ("prov_code", "city_code", "name")
ORD = "decimal(38,0)"
PARTS = 1_000_000  # a cell with more parts is refused


def select_module(records: DataFrame, module: int | None) -> DataFrame:
    """Records of one module; all records when ``module`` is None."""
    return records if module is None else records.filter(F.col("module") == module)


def select_field(records: DataFrame, field: str = "proc") -> DataFrame:
    """One raw agency name per row.

    ``proc`` takes the publishing agency, ``export`` splits the combined cell.
    ``ord`` becomes one wide number (record, part), so that parts keep their
    order and first-seen ties still aggregate in fixed-width buffers.
    """
    base = ("prov_code", "city_code", "notice_date", "county")
    place = lambda part: (F.col("ord").cast("decimal(28,0)") * PARTS + part).cast(ORD).alias("ord")
    if field == "proc":
        return records.select(*base, F.col("process_department").alias("raw"), place(F.lit(0)))
    if field == "export":
        return (records.select(*base, "ord", F.posexplode(split_units(F.col("combined_units"))).alias("part", "raw"))
                .select(*base, "raw", place(F.when(F.col("part") < PARTS, F.col("part")).otherwise(F.raise_error(F.lit("a cell with too many parts"))))))
    raise ValueError(f"unknown field {field!r}")


def iso_date(c: Column) -> Column:
    """Date of an ISO text, null for blanks (fixed-width, so it aggregates in hash tables)."""
    return F.nullif(c, F.lit("")).try_cast("date")


def count_blank(rows: DataFrame) -> DataFrame:
    blank = normalize(F.col("raw")) == ""
    return rows.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(blank).alias("n_blank"))


def spelling_stats(rows: DataFrame) -> DataFrame:
    """Per (prov_code, city_code, name): n, last_date, first ord and modal county.

    The modal county is the most frequent non-blank one, ties go to the first
    seen. Counting starts on raw spellings, so that the clean-up expressions
    run once per distinct text; counts combine before each shuffle.
    """
    raw = rows.groupBy("prov_code", "city_code", "raw", "county").agg(
        F.count(F.lit(1)).alias("n"), F.max(iso_date(F.col("notice_date"))).alias("last"),
        F.min("ord").alias("ord"))
    # behind ``once`` the blank filter cannot drag the clean-up below the counting
    named = (once(raw, name=normalize(F.col("raw"))).filter(F.col("name") != "")
             .withColumn("county", F.coalesce("county", F.lit(""))))
    # one exchange serves both aggregations below
    by_county = (named.repartition(*[F.col(k) for k in KEY]).groupBy(*KEY, "county")
                 .agg(F.sum("n").alias("n"), F.max("last").alias("last"), F.min("ord").alias("first")))
    filled = F.col("county") != ""
    modal = F.max_by(F.when(filled, F.col("county")),
                     F.when(filled, F.struct("n", (-F.col("first")).alias("a"))))
    return by_county.groupBy(*KEY).agg(
        F.sum("n").alias("n"), F.coalesce(F.date_format(F.max("last"), "yyyy-MM-dd"), F.lit("")).alias("last_date"),
        F.min("first").alias("first"), F.coalesce(modal, F.lit("")).alias("county"))


def judged_spellings(rows: DataFrame, places: DataFrame, misplaced: DataFrame | None = None) -> DataFrame:
    """Spelling statistics with city, area, function and drop reason.

    The result is a written table: every later step filters on the drop
    reason, and pushing that filter below the rules would repeat them.
    """
    return durable(judge(spelling_stats(rows), places, misplaced), "spellings")


def drop_report(dropped: DataFrame, top: int = 15) -> DataFrame:
    """Per drop reason: records, distinct spellings, and the ``top`` most frequent spellings.

    A spelling that several cities asked for counts once, with its sum.
    """
    per_name = dropped.groupBy("prov_code", "drop_reason", "name").agg(
        F.sum("n").alias("n"), F.min("first").alias("first"))
    totals = per_name.groupBy("prov_code", "drop_reason").agg(
        F.sum("n").alias("records"), F.count(F.lit(1)).alias("spellings"))
    order = Window.partitionBy("prov_code", "drop_reason").orderBy(F.desc("n"), "first", "name")
    best = (per_name.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
            .select("prov_code", "drop_reason", "rank", "name", "n"))
    return best.join(totals, ["prov_code", "drop_reason"])
