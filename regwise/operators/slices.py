"""Matching target rows to slices of crawled project rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regwise import rules as R
from regwise.functions.text import strip
from regwise.functions.url import host
from regwise.operators.sequence import forward_fill
from regwise.session import durable


# reported columns and how many values a cell shows
REPORTED = {"publisher": 6, "approval_district": 6, "project_district": 10, "radiation": 2}


def scope_names(scope: Column) -> Column:
    parts = F.transform(F.split(F.translate(scope, "｜", "|"), "\\|"), strip)
    return F.filter(parts, lambda p: p != "")


def whole_entry(scope: Column) -> Column:
    """The row stands for the whole entry, not for one district."""
    return (F.size(scope_names(scope)) > 1) | scope.isin("", R.CITY_LEVEL)


def tally(df: DataFrame, keys: list[str], column: str, top: int = 6, to: str | None = None) -> DataFrame:
    """Per key ``value(n)｜…`` of the ``top`` values, blanks ignored, with the number of values when cut."""
    n = df.filter(F.coalesce(column, F.lit("")) != "").groupBy(*keys, F.col(column).alias("_v")).agg(F.sum("n").alias("_n"))
    order = Window.partitionBy(*keys).orderBy(F.desc("_n"), "_v")
    kinds = n.groupBy(*keys).agg(F.count(F.lit(1)).alias("_kinds"))
    best = (n.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= top).groupBy(*keys).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_rank", "_v", "_n"))),
                                 lambda x: F.concat(x["_v"], F.lit("("), x["_n"].cast("string"), F.lit(")"))), "｜").alias("_text")))
    more = F.when(F.col("_kinds") > top, F.concat(F.lit("｜…共"), F.col("_kinds").cast("string"), F.lit("种"))).otherwise("")
    return best.join(kinds, keys).select(*keys, F.concat("_text", more).alias(to or column))


def slice_counts(projects: DataFrame) -> DataFrame:
    """Project rows reduced to their distinct reported values with a count."""
    return projects.groupBy("city", "entry_url", host(F.col("notice_url")).alias("host"), "publisher", "approval_district",
                            "project_district", "location", "radiation").agg(F.count(F.lit(1)).alias("n"))


def match_slices(targets: DataFrame, projects: DataFrame) -> DataFrame:
    """Project value groups that belong to each target row.

    ``targets`` has row_id, city, scope, entry_url and zone_name. The pool is
    the exact entry, else the same host and city. Inside the pool the first
    tier with a hit counts: whole entry, approval district, project district,
    zone name in the address, or the whole pool of an entry that only this row
    uses and that only its own host fed.

    Every tier is a join of its own: the district tiers on pool and district,
    the whole-pool tiers on totals without addresses. Only rows that no
    district settles look at addresses, each distinct one once per zone.
    ``projects`` may be their written counts (``slice_counts``), to match more
    than once.
    """
    values = projects if "n" in projects.columns else durable(slice_counts(projects), "slices")
    rows = targets.filter(F.col("entry_url") != "").withColumn("_whole", whole_entry(F.col("scope")))
    key = F.regexp_replace(F.coalesce(F.get(scope_names(F.col("scope")), F.lit(0)), F.lit("")), "区$", "")
    key = F.regexp_replace(F.regexp_replace(key, "县$", ""), "市$", "")
    bare_city = F.regexp_replace("city", "市$", "")
    zone = F.when(F.col("zone_name").startswith(bare_city), F.substring("zone_name", F.length(bare_city) + 1, F.length("zone_name"))).otherwise(
        F.col("zone_name"))
    uses = rows.groupBy("entry_url").agg(F.count(F.lit(1)).alias("_uses"))
    rows = (rows.withColumn("_key", key).withColumn("_zone", zone).withColumn("_host", host(F.col("entry_url"))).join(uses, "entry_url")
            .select("row_id", "city", "entry_url", "_whole", "_key", "_zone", "_host", "_uses"))
    exact_urls = values.select("entry_url").distinct().withColumn("_exact", F.lit(True))
    pool = lambda exact, near: F.when(exact, F.concat(F.lit("="), F.col("entry_url"))).otherwise(F.concat_ws("|", F.lit("~"), "city", near))
    rows = durable(rows.join(exact_urls, "entry_url", "left")
                   .withColumn("pool", pool(F.coalesce("_exact", F.lit(False)), F.col("_host"))).drop("_exact", "city", "entry_url"), "targets")
    wanted = rows.select("pool").distinct()
    facts = ["publisher", "approval_district", "project_district", "radiation"]
    placed = values.select(F.explode(F.array(pool(F.lit(True), F.col("host")), pool(F.lit(False), F.col("host")))).alias("pool"),
                           "host", *facts, "location", "n").join(wanted, "pool", "left_semi")
    placed = durable(placed.groupBy("pool", "host", *facts, "location").agg(F.sum("n").alias("n")), "pools")
    totals = durable(placed.groupBy("pool", "host", *facts).agg(F.sum("n").alias("n")), "totals")

    def tier(number: int, who: DataFrame, what: DataFrame, on: list[str]) -> DataFrame:
        return (who.join(what, on).groupBy("row_id", *facts).agg(F.sum("n").alias("n"))
                .select("row_id", F.lit(number).alias("tier"), *facts, "n"))

    whole, parts = rows.filter("_whole"), rows.filter("NOT _whole").select("row_id", "pool", "_key")
    by = lambda column: totals.withColumn("_key", F.col(column))
    easy = durable(tier(0, whole.select("row_id", "pool"), totals, ["pool"])
                   .unionByName(tier(1, parts, by("approval_district"), ["pool", "_key"]))
                   .unionByName(tier(2, parts, by("project_district"), ["pool", "_key"])), "districts")
    first = easy.groupBy("row_id").agg(F.min("tier").alias("tier"))
    left = durable(rows.filter("NOT _whole").join(first, "row_id", "left_anti"), "left")
    zones = left.filter(F.length("_zone") >= 4).select("pool", "_zone").distinct()
    spots = placed.select("pool", "location").distinct().join(zones, "pool").filter(F.col("location").contains(F.col("_zone")))
    named = durable(tier(3, left.select("row_id", "pool", "_zone"), placed.join(spots, ["pool", "location"]), ["pool", "_zone"]), "zones")
    hosts = totals.groupBy("pool").agg(F.min("host").alias("_low"), F.max("host").alias("_high"))
    pure = (left.filter("_uses = 1").join(named.select("row_id").distinct(), "row_id", "left_anti").join(hosts, "pool")
            .filter((F.col("_low") == F.col("_host")) & (F.col("_high") == F.col("_host"))).select("row_id", "pool"))
    return (easy.join(first, ["row_id", "tier"], "left_semi").unionByName(named).unionByName(tier(4, pure, totals, ["pool"])))


def extract_columns(targets: DataFrame, projects: DataFrame) -> DataFrame:
    """The four reported columns of each target row as tallies."""
    hit = durable(match_slices(targets, projects), "matched")
    out = hit.select("row_id").distinct()
    for column, top in REPORTED.items():
        out = out.join(tally(hit, ["row_id"], column, top), "row_id", "left")
    return out.na.fill("")


def cells_to_fill(sheet: DataFrame, projects: DataFrame) -> DataFrame:
    """(row_id, column, value): tallies for the blank cells of a sheet.

    ``sheet`` has row_id, city (blank cells continue the one above), scope,
    entry_url, zone_name and the four reported columns. Cells that hold
    something are never touched.
    """
    rows = durable(forward_fill(sheet, [F.col("row_id")], "city"), "sheet")
    made = extract_columns(rows.select("row_id", "city", "scope", "entry_url", "zone_name"), projects)
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    both = made.select("row_id", *[F.col(c).alias(f"_{c}") for c in REPORTED]).join(rows, "row_id")
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.when(blank(F.col(c)), F.col(f"_{c}")).alias("value")) for c in REPORTED])
    return both.select("row_id", F.inline(cells)).filter(F.coalesce("value", F.lit("")) != "")


def fill_summary(sheet: DataFrame, cells: DataFrame, matched: DataFrame) -> DataFrame:
    """Cells to fill per column, and under a blank column the rows with an entry but without data."""
    lacking = sheet.filter(F.coalesce(F.trim("entry_url"), F.lit("")) != "").join(matched.select("row_id").distinct(), "row_id", "left_anti")
    per = cells.groupBy("column").agg(F.count(F.lit(1)).alias("n"))
    return per.unionByName(lacking.agg(F.count(F.lit(1)).alias("n")).select(F.lit("").alias("column"), "n"))
