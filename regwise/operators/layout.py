"""Laying units out on an administrative-code sheet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regwise import rules as R
from regwise.functions.text import core
from regwise.operators.sequence import global_index, index_within
from regwise.session import durable


def confirmed_zone_map(zones: DataFrame) -> DataFrame:
    """(prov_code, city, area) of confirmed zones and the district they belong to."""
    return (zones.filter((F.col("confirmed") == R.YES) & (F.col("district_short") != ""))
            .select("prov_code", "city", F.col("source_label").alias("area"), "district_short"))


def sheet_codes(area: DataFrame) -> DataFrame:
    """Every code of the tree with its short names: province, cities, districts."""
    blank = F.lit("")
    one = lambda code, *names: area.select(F.col(code).alias("code"), *[
        x.alias(n) for x, n in zip(names, ("prov_short", "city_short", "district_short"))]).distinct()
    p, c, d = F.col("prov_short"), F.col("city_short"), F.col("district_short")
    return one("prov_code", p, blank, blank).unionByName(one("city_code", p, c, blank)).unionByName(one("district_code", p, c, d))


def code_lookup(area: DataFrame) -> DataFrame:
    """(prov_code, city, area) to the code it stands for: levels, cores and short names."""
    row = lambda city, a, code: area.select("prov_code", city.alias("city"), a.alias("area"), F.col(code).alias("code"))
    name = F.col("city_name")
    return (row(F.lit(R.NO_CITY), F.lit(R.PROVINCIAL), "prov_code").unionByName(row(name, F.lit(R.CITY_LEVEL), "city_code"))
            .unionByName(row(name, core(F.col("district_name")), "district_code")).unionByName(row(name, F.col("district_short"), "district_code"))
            .distinct().groupBy("prov_code", "city", "area").agg(F.max("code").alias("code")))


def with_code(units: DataFrame, area: DataFrame, zones: DataFrame) -> DataFrame:
    """Code of each unit, confirmed zones standing for their district; null when there is none."""
    mapped = units.join(confirmed_zone_map(zones), ["prov_code", "city", "area"], "left")
    lookup = code_lookup(area).withColumnRenamed("area", "_area")
    return (mapped.withColumn("_area", F.coalesce("district_short", "area")).drop("district_short")
            .join(lookup, ["prov_code", "city", "_area"], "left").drop("_area"))


def sheet_layout(sheet: DataFrame, units: DataFrame, area: DataFrame, entries: DataFrame) -> DataFrame:
    """The sheet's rows: each code once, its further units below it by record count.

    ``sheet`` has code and ord. ``is_new`` marks inserted rows; a code without
    units keeps one blank row. ``row_no`` is the position below the header.
    """
    codes = sheet.filter(F.col("code") != "").groupBy("code").agg(F.min("ord").alias("ord"))
    url = entries.select("prov_code", "city", "unit", F.struct("home_url", "entry_url").alias("_e"))
    placed = units.filter(F.col("code").isNotNull()).select("prov_code", "city", "unit", "area", "record_count", "code").join(
        url, ["prov_code", "city", "unit"], "left")
    ranked = index_within(placed, ["code"], [F.desc("record_count"), F.col("city"), F.col("unit"), F.col("area")], "pos")
    blank = lambda c: F.coalesce(c, F.lit(""))
    rows = (codes.join(ranked, "code", "left").join(sheet_codes(area), "code", "left")
            .select("ord", "code", F.coalesce("pos", F.lit(1)).alias("pos"), blank(F.col("prov_short")).alias("prov_short"),
                    blank(F.col("city_short")).alias("city_short"), blank(F.col("district_short")).alias("district_short"),
                    blank(F.col("unit")).alias("unit"), blank(F.col("_e.home_url")).alias("home_url"), blank(F.col("_e.entry_url")).alias("entry_url")))
    return (global_index(rows.withColumn("is_new", F.col("pos") > 1), [F.col("ord"), F.col("code"), F.col("pos")], "row_no")
            .drop("ord", "pos"))


def layout_issues(sheet: DataFrame, units: DataFrame, area: DataFrame) -> DataFrame:
    """Codes without units, codes outside the tree, units without a code on the sheet."""
    codes = sheet.filter(F.col("code") != "").select("code").distinct()
    coded = units.filter(F.col("code").isNotNull())
    kind = lambda df, k, key: df.select(F.lit(k).alias("kind"), key.alias("key"))
    unit_key = F.concat_ws("|", "prov_code", "city", "area", "unit")
    return (kind(codes.join(coded, "code", "left_anti"), "no_unit", F.col("code"))
            .unionByName(kind(codes.join(sheet_codes(area), "code", "left_anti"), "not_in_tree", F.col("code")))
            .unionByName(kind(units.filter(F.col("code").isNull()), "unmatched", unit_key))
            .unionByName(kind(coded.join(codes, "code", "left_anti"), "unmatched", unit_key)))


def capped_windows(daily: DataFrame, keys: list[str], start: Column, end: Column, cap: int) -> DataFrame:
    """Split date ranges in half until each holds fewer than ``cap`` rows.

    ``daily`` has the keys, ``day`` and ``n``. A running total per key and day
    answers a range by the totals at its two ends. A range carries these, so
    a split asks for one more, that of its middle: the total of the last day
    up to it, found by one pass over the key's days in order. Rounds end when
    no range is split, after log2(days) of them, since a day cannot be split;
    keys without a full range are not read again. A single day at the cap
    stays and is flagged ``over_cap``.
    """
    by_day = Window.partitionBy(*keys).orderBy("day")
    totals = daily.groupBy(*keys, "day").agg(F.sum("n").alias("n")).select(*keys, "day", F.sum("n").over(by_day).alias("total"))
    totals = durable(totals, "totals")  # one row per key and day
    upto = lambda bound: F.coalesce(F.max(F.when(F.col("day") <= bound, F.col("total"))), F.lit(0))
    rows = durable(totals.groupBy(*keys).agg(upto(F.date_sub(start, 1)).alias("t0"), upto(end).alias("t1"))
                   .select(*keys, start.alias("d0"), end.alias("d1"), "t0", "t1"), "windows")
    done = None
    while True:
        n = F.col("t1") - F.col("t0")
        full = (n >= cap) & (F.col("d0") < F.col("d1"))
        kept = rows.filter(~full).select(*keys, "d0", "d1", n.alias("n"), (n >= cap).alias("over_cap"))
        done = kept if done is None else done.unionByName(kept)
        split = rows.filter(full).withColumn("day", F.date_add("d0", F.floor(F.datediff("d1", "d0") / 2).cast("int")))
        known = totals.join(split.select(*keys).distinct(), keys, "left_semi")
        # a day's own total stands before the questions for it
        ordered = Window.partitionBy(*keys).orderBy("day", F.col("d0").isNotNull())
        met = known.unionByName(split, allowMissingColumns=True).withColumn("tm", F.coalesce(F.last("total", ignorenulls=True).over(ordered), F.lit(0)))
        halves = F.array(F.struct("d0", F.col("day").alias("d1"), "t0", F.col("tm").alias("t1")),
                         F.struct(F.date_add("day", 1).alias("d0"), "d1", F.col("tm").alias("t0"), "t1"))
        rows = durable(met.filter("d0 IS NOT NULL").select(*keys, F.inline(halves)), "windows")
        if rows.isEmpty():
            return done
