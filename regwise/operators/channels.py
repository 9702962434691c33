"""Attributing channel notices to agencies.

``titles`` frames have prov_code, city (— for channels of the whole province),
city_code, url and title; ``units`` carry function_key and record_count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regwise import rules as R
from regwise.functions.collections import counted
from regwise.functions.notice import publisher_of, stage_of
from regwise.functions.text import function_key, half_width_brackets, normalize
from regwise.operators.places import locate, with_function
from regwise.operators.units import spelling_rows
from regwise.session import durable, once, small


def found_note(day: Column, n: Column) -> Column:
    return F.concat(day, F.lit(" 拉栏目标题核实：该单位在此栏目发布受理公告 "), n.cast("string"), F.lit(" 条"))


def missing_note(day: Column, pages: int) -> Column:
    return F.concat(day, F.lit(f"：市局受理栏目近 {pages} 页里没有该单位发布的受理公告，"
                               "可能在区县门户单独发布，未定位，不填地址"))


def accepted(titles: DataFrame) -> DataFrame:
    """Notices of the first stage only."""
    return titles.filter(stage_of(F.col("title")) == R.STAGES[0])


def published(titles: DataFrame) -> DataFrame:
    """Notices counted per channel and publisher, so that publishers are resolved on counts."""
    return (titles.groupBy("prov_code", "city", "city_code", "url", publisher_of(F.col("title")).alias("publisher"))
            .agg(F.count(F.lit(1)).alias("n")))


def publisher_keys(named: DataFrame, places: DataFrame) -> DataFrame:
    """Distinct (prov_code, city, city_code, publisher) with the key its wording leads to."""
    names = (named.select("prov_code", "city", "city_code", "publisher").distinct()
             .filter(F.col("publisher") != "").withColumn("name", normalize(F.col("publisher"))))
    placed = locate(names.withColumnRenamed("city", "channel_city"), places, county=None)
    keyed = with_function(placed, places).withColumn("key", F.when(F.col("area").isNotNull(), function_key(
        F.col("city"), F.col("area"), F.col("function"))))
    return keyed.select("prov_code", F.col("channel_city").alias("city"), "city_code", "publisher", "name", "key")


def names_to_keys(units: DataFrame) -> DataFrame:
    """(prov_code, city, plain spelling) to the function key of the largest unit using it."""
    rows = spelling_rows(units).withColumn("plain", half_width_brackets(normalize(F.col("name"))))
    return rows.groupBy("prov_code", "city", "plain").agg(
        F.min_by("function_key", F.struct((-F.col("record_count")).alias("a"), F.col("unit"), F.col("pos"))).alias("named_key"))


def resolve_publishers(named: DataFrame, units: DataFrame, places: DataFrame) -> DataFrame:
    """``named`` rows with the function key of their publisher, null where the channel's owner takes it.

    The key from the wording wins when the unit list knows it, then the
    (city, spelling) pair. Publishers are resolved once per distinct text, and
    rows without a publisher, often the most, take no part in the join.
    ``named`` is read twice: pass counts or a written table.
    """
    known = units.select("prov_code", F.col("function_key").alias("key"), F.lit(True).alias("_known")).distinct()
    resolved = durable(
        publisher_keys(named, places).join(known, ["prov_code", "key"], "left")
        .withColumn("plain", half_width_brackets(F.col("name")))
        .join(names_to_keys(units), ["prov_code", "city", "plain"], "left")
        .select("prov_code", "city", "city_code", "publisher",
                F.when(F.col("_known"), F.col("key")).otherwise(F.col("named_key")).alias("unit_key")), "publishers")
    told = named.filter(F.col("publisher") != "").join(small(resolved), ["prov_code", "city", "city_code", "publisher"], "left")
    silent = named.filter(F.coalesce("publisher", F.lit("")) == "").withColumn("unit_key", F.lit(None).cast("string"))
    return told.unionByName(silent)


def attribute(titles: DataFrame, units: DataFrame, places: DataFrame) -> DataFrame:
    """Each title with its publisher and the publisher's function key."""
    return resolve_publishers(durable(titles.withColumn("publisher", publisher_of(F.col("title"))), "told"), units, places)


def owners(units: DataFrame) -> DataFrame:
    """Owner of a city's channels: its largest city-level environment unit (of the province: provincial level)."""
    level = F.when(F.col("city") == R.NO_CITY, R.PROVINCIAL).otherwise(R.CITY_LEVEL)
    return (units.filter((F.col("area") == level) & (F.col("role") == R.ECO_FUNCTION)).groupBy("prov_code", "city")
            .agg(F.min_by(F.struct("area", "unit"), F.struct((-F.col("record_count")).alias("a"), F.col("unit"))).alias("o"))
            .select("prov_code", "city", function_key(F.col("city"), F.col("o.area"), F.lit(R.ECO_FUNCTION)).alias("owner_key"),
                    F.col("o.unit").alias("owner")))


def channel_hits(titles: DataFrame, units: DataFrame, places: DataFrame) -> DataFrame:
    """(prov_code, unit_key, url, n): notices per unit and channel, the unnamed rest counted for the owner."""
    counts = resolve_publishers(durable(published(accepted(titles)), "published"), units, places)
    credited = (counts.join(owners(units).select("prov_code", "city", "owner_key"), ["prov_code", "city"], "left")
                .withColumn("unit_key", F.coalesce("unit_key", "owner_key")).filter(F.col("unit_key").isNotNull()))
    return credited.groupBy("prov_code", "unit_key", "url").agg(F.sum("n").alias("n"))


def channel_table(channels: DataFrame) -> DataFrame:
    """Per city the address of each stage (a mixed channel stands in) and the home page."""
    wide = channels.groupBy("prov_code", "city").pivot("stage", [*R.STAGES, R.MIXED_STAGE]).agg(F.first("url"))
    home = channels.groupBy("prov_code", "city").agg(F.min_by("home", "url").alias("home"))
    pick = lambda s: F.coalesce(F.col(s), F.col(R.MIXED_STAGE))
    a, b, d = R.STAGES
    return wide.join(home, ["prov_code", "city"]).select(
        "prov_code", "city", pick(a).alias("accept_url"), pick(b).alias("proposal_url"), pick(d).alias("decision_url"), "home")


def unit_entries(units: DataFrame, hits: DataFrame, channels: DataFrame, day: str, pages: int = 40) -> DataFrame:
    """Entry line of every unit: verified in its busiest channel, a mere publisher, or not found."""
    best = hits.groupBy("prov_code", F.col("unit_key").alias("function_key")).agg(
        F.max_by("url", F.struct("n", "url")).alias("_url"), F.max("n").alias("_n"))
    joined = (units.join(best, ["prov_code", "function_key"], "left")
              .join(channel_table(channels), ["prov_code", "city"], "left"))
    other, found = F.col("role") == R.OTHER_ROLE, F.col("_url").isNotNull()
    on = lambda value: F.when(~other & found, F.coalesce(value, F.lit(""))).otherwise("")
    d = F.lit(day)
    return joined.select(
        "prov_code", "city", "area", "unit", on(F.col("home")).alias("home_url"), on(F.col("_url")).alias("entry_url"),
        on(F.col("proposal_url")).alias("proposal_url"), on(F.col("decision_url")).alias("decision_url"),
        F.when(other, "其他部门只是公告发布渠道；本单位官网未查，不填").when(found, found_note(d, F.col("_n")))
        .otherwise(missing_note(d, pages)).alias("note"),
        F.when(other, R.NO_CHANNEL).when(found, R.VERIFIED).otherwise(R.UNVERIFIED).alias("verify_status"), d.alias("verify_date"))


def publisher_tally(titles: DataFrame, units: DataFrame, places: DataFrame) -> DataFrame:
    """Per function key the wordings under which the unit publishes, as ``name(n) / …``."""
    counts = resolve_publishers(durable(published(accepted(titles)), "published"), units, places)
    n = counts.filter(F.col("unit_key").isNotNull()).groupBy("prov_code", "unit_key", "publisher").agg(F.sum("n").alias("n"))
    return n.groupBy("prov_code", "unit_key").agg(
        counted(F.collect_list(F.struct(F.col("publisher").alias("key"), "n")), form="%s(%d)").alias("portal_publisher"))


def district_counts(projects: DataFrame) -> DataFrame:
    """Projects per (city, publisher, district) with their first ``ord``; wordings are cleaned once per distinct text."""
    raw = (projects.filter(F.col("publisher") != "").groupBy("prov_code", "city", "city_code", "publisher", "project_district")
           .agg(F.count(F.lit(1)).alias("n"), F.min("ord").alias("ord")))
    # behind ``once`` the clean-up is not dragged below the counting
    return (once(raw, name=normalize(F.col("publisher"))).groupBy("prov_code", "city", "city_code", "name", "project_district")
            .agg(F.sum("n").alias("n"), F.min("ord").alias("ord")))


def location_hints(projects: DataFrame, top: int = 3) -> DataFrame:
    """Per (city, publisher) the most frequent project districts, in order."""
    return usual_districts(district_counts(projects), top)


def usual_districts(counts: DataFrame, top: int = 3) -> DataFrame:
    """The ``top`` districts of each (city, publisher) in ``district_counts``; blank districts are no hint."""
    n = counts.filter(F.col("project_district") != "")
    order = Window.partitionBy("prov_code", "city", "name").orderBy(F.desc("n"), "ord")
    return n.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top).drop("ord")


def attribute_with_hints(projects: DataFrame, units: DataFrame, places: DataFrame) -> DataFrame:
    """Unit key of each (city, publisher): without a hint first, then with its usual project districts.

    ``tried`` lists the keys that its wording led to, in the order of trying.
    """
    counts = durable(district_counts(projects), "districts")
    seen = counts.groupBy("prov_code", "city", "city_code", "name").agg(F.sum("n").alias("n"))
    bare = seen.select("prov_code", "city", "city_code", "name", F.lit("").alias("county"), F.lit(0).cast("long").alias("rank"))
    hinted = usual_districts(counts).select("prov_code", "city", "city_code", "name", F.col("project_district").alias("county"), "rank")
    tries = locate(bare.unionByName(hinted).withColumnRenamed("city", "channel_city"), places)
    keyed = (with_function(tries, places).filter(F.col("area").isNotNull())
             .withColumn("function_key", function_key(F.col("city"), F.col("area"), F.col("function"))))
    known = units.select("prov_code", "function_key", F.lit(True).alias("_known")).distinct()
    # at most one try and three hints a publisher
    best = keyed.join(known, ["prov_code", "function_key"], "left").groupBy("prov_code", F.col("channel_city").alias("city"), "name").agg(
        F.min_by("function_key", F.when(F.col("_known"), F.col("rank"))).alias("_key"), F.bool_or("_known").alias("_known"),
        F.array_distinct(F.transform(F.sort_array(F.collect_list(F.struct("rank", "function_key"))), lambda x: x["function_key"])).alias("tried"))
    return seen.join(best, ["prov_code", "city", "name"], "left").select(
        *seen.columns, F.when(F.col("_known"), F.col("_key")).alias("unit_key"), F.coalesce("tried", F.array().cast("array<string>")).alias("tried"))


def with_portal_publisher(master: DataFrame, attributed: DataFrame, to: str = "portal_publisher") -> DataFrame:
    """``master`` with the wordings under which its units publish, as ``name(n) / …``.

    Of several units with one function key the largest takes the cell. Units
    without a wording keep what they had, blank where the column is new.
    """
    n = attributed.filter(F.col("unit_key").isNotNull()).groupBy("prov_code", F.col("unit_key").alias("function_key"), "name").agg(F.sum("n").alias("n"))
    cells = n.groupBy("prov_code", "function_key").agg(
        counted(F.collect_list(F.struct(F.col("name").alias("key"), "n")), form="%s(%d)").alias("_cell"))
    owner = master.groupBy("prov_code", "function_key").agg(
        F.min_by(F.struct("city", "area", "unit"), F.struct((-F.col("record_count").cast("long")).alias("a"), F.col("unit"))).alias("_o"))
    placed = cells.join(owner, ["prov_code", "function_key"]).select("prov_code", "function_key", "_o.*", "_cell")
    had = F.col(to) if to in master.columns else F.lit("")
    return (master.join(placed, ["prov_code", "function_key", "city", "area", "unit"], "left")
            .withColumn(to, F.coalesce("_cell", had, F.lit(""))).drop("_cell"))


def unattached(attributed: DataFrame) -> DataFrame:
    """(prov_code, city, name, n, reason): wordings that no unit of the master stands for."""
    keys = F.array_join("tried", " 或 ")
    reason = F.when(F.size("tried") > 0, F.concat(F.lit("主数据里没有这些键："), keys)).otherwise("认不出地区")
    return attributed.filter(F.col("unit_key").isNull()).select("prov_code", "city", "name", "n", reason.alias("reason"))


def portal_marks(titles: DataFrame) -> DataFrame:
    """What the hits of county portals need of each title; the first ``ord`` is sorted for, so rows leave their texts behind."""
    short, page = F.col("district_short"), F.col("page_text")
    staged = titles.withColumn("accept", stage_of(F.col("title")) == R.STAGES[0])
    return staged.select(
        "prov_code", "city", "district_short", "url", "city_code", "ord", "accept", publisher_of(F.col("title")).alias("publisher"),
        (F.col("column_title").contains(short) | (F.col("accept") & F.col("title").contains(short))).alias("names_county"),
        (F.concat("column_title", "link_text", "source_title").rlike(R.ECO_PAGE) | page.contains(F.concat(short, F.lit("分局")))
         | page.contains(F.concat(F.lit("生态环境局"), short))).alias("eco_page"))


def county_channel_hits(titles: DataFrame, units: DataFrame, places: DataFrame) -> DataFrame:
    """Hits of county portals: (prov_code, unit_key, url, n).

    ``titles`` also has district_short, column_title, link_text, source_title
    and page_text of the channel. A city-level publisher on a county portal
    that names the county stands for the county unit; unnamed notices go to the
    channel's owner: its most frequent publisher, else the county's environment
    unit when the page points to it.
    """
    per_key = ["prov_code", "city", "district_short", "url"]
    # one pass over the titles, sorted by the keys that differ soonest; everything below works on counts per publisher
    counted = durable(portal_marks(titles).groupBy("district_short", "publisher", "url", "city", "prov_code", "city_code").agg(
        F.count(F.lit(1)).alias("all"), F.count_if("accept").alias("n"), F.min("ord").alias("ord"),
        F.bool_or("names_county").alias("names_county"), F.bool_or("eco_page").alias("eco_page")), "published")
    keys = publisher_keys(counted, places).select("prov_code", "city", "city_code", "publisher", "key")
    by_key = (counted.join(keys, ["prov_code", "city", "city_code", "publisher"], "left").groupBy(*per_key, "key")
              .agg(F.sum("all").alias("all"), F.sum("n").alias("n"), F.min("ord").alias("ord")))
    facts = counted.groupBy(*per_key).agg(F.bool_or("names_county").alias("names_county"), F.bool_or("eco_page").alias("eco_page"))
    main = (by_key.filter(F.col("key").isNotNull()).groupBy(*per_key)
            .agg(F.min_by("key", F.struct((-F.col("all")).alias("a"), "ord")).alias("main_key")))
    eco = F.lit(R.ECO_FUNCTION)
    staged = (by_key.join(facts, per_key).join(main, per_key, "left")
              .withColumn("city_key", function_key(F.col("city"), F.lit(R.CITY_LEVEL), eco))
              .withColumn("county_key", function_key(F.col("city"), F.col("district_short"), eco))
              .withColumn("_key", F.coalesce("key", "main_key", F.when(F.col("eco_page"), F.col("county_key")))))
    known = units.select("prov_code", "function_key").distinct()
    has_county = known.select("prov_code", F.col("function_key").alias("county_key"), F.lit(True).alias("_county"))
    owned = staged.join(has_county, ["prov_code", "county_key"], "left").withColumn(
        "function_key", F.when((F.col("_key") == F.col("city_key")) & F.col("_county") & F.col("names_county"), F.col("county_key"))
        .otherwise(F.col("_key")))
    return (owned.filter(F.col("n") > 0).join(known, ["prov_code", "function_key"], "left_semi")
            .groupBy("prov_code", "city", "district_short", F.col("function_key").alias("unit_key"), "url").agg(F.sum("n").alias("n")))


def with_silent_portals(jobs: DataFrame, hits: DataFrame) -> DataFrame:
    """Every (city, district, portal) job keeps at least one row, blank where nothing was found."""
    return jobs.join(hits, ["prov_code", "city", "district_short"], "left").na.fill("", ["unit_key", "url"]).na.fill(0, ["n"])
