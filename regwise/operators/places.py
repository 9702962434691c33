"""Place dictionary of each province and the rules that locate a name in it.

The area dimension (one row per district) is folded into one row per province.
Names meet it through an equi-join on ``prov_code``; all containment tests run
inside that row with array functions, so no name-by-place product is built.
Run these rules on distinct spellings, never on raw records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regwise import rules as R
from regwise.functions.agency import function_of, is_irregular_text, is_national, is_window, town_of, without_station
from regwise.functions.text import core, let, normalize
from regwise.session import small


def places_dim(area: DataFrame, extra_zones: dict = R.EXTRA_ZONES) -> DataFrame:
    """One row per province: ``prov_code`` and the struct ``place``.

    ``area`` holds prov_code/name/short, city_code/name/short, city_ord and
    district_code/name/short, district_ord (district columns may be null).
    """
    place_core = lambda c: core(F.col(c))
    districts = (
        area.filter(F.col("district_name").isNotNull() & (place_core("district_name") != ""))
        .select("prov_code", "city_code",
                F.struct((-F.length("district_name")).alias("rank"), F.col("district_ord").alias("ord"),
                         place_core("district_name").alias("core"),
                         place_core("district_short").alias("short"),
                         # a one-character core counts only together with its suffix
                         F.when(F.length(place_core("district_name")) == 1,
                                F.transform(F.array(*map(F.lit, "县区市")),
                                            lambda s: F.concat(place_core("district_name"), s)))
                         .otherwise(F.array(place_core("district_name"))).alias("needles")).alias("d"))
        .groupBy("prov_code", "city_code").agg(F.sort_array(F.collect_list("d")).alias("districts")))
    by_length = lambda a, b: (F.when(F.length(a) > F.length(b), -1).when(F.length(a) < F.length(b), 1)
                              .when(a < b, -1).when(a > b, 1).otherwise(0))
    longest_first = lambda c: F.array_sort(F.filter(c, lambda w: w != ""), by_length)
    cities = (
        area.select("prov_code", "prov_name", "prov_short", "city_code", "city_name", "city_short", "city_ord").distinct()
        .join(districts, ["prov_code", "city_code"], "left")
        .select("prov_code", "prov_name", "prov_short",
                F.struct(F.col("city_ord").alias("ord"), F.col("city_code").alias("code"),
                         F.col("city_name").alias("name"), place_core("city_name").alias("core"),
                         place_core("city_short").alias("short"),
                         longest_first(F.array_distinct(F.array(place_core("city_name"), place_core("city_short"))))
                         .alias("prefixes"),
                         F.coalesce("districts", F.filter("districts", lambda d: F.lit(False)),
                                    F.array()).alias("districts")).alias("c"))
        .groupBy("prov_code", "prov_name", "prov_short")
        .agg(F.sort_array(F.collect_list("c")).alias("cities")))
    place_words = lambda *cols: F.array(*[place_core(c) for c in cols])
    words = (
        area.select("prov_code", F.explode(place_words("prov_name", "prov_short", "city_name", "city_short",
                                                       "district_name", "district_short")).alias("w"))
        .groupBy("prov_code").agg(longest_first(F.collect_set("w")).alias("allowed")))
    city_words = (
        area.select("prov_code", F.explode(place_words("prov_name", "prov_short", "city_name", "city_short")).alias("w"))
        .groupBy("prov_code").agg(longest_first(F.collect_set("w")).alias("city_words")))
    zones = F.create_map(*[x for code, z in extra_zones.items()
                           for x in (F.lit(code), F.array(*map(F.lit, z)))]) if extra_zones else None
    own_zones = F.array().cast("array<string>")
    if zones is not None:
        own_zones = F.coalesce(F.element_at(zones, F.col("prov_code")), own_zones)
    city_cores = F.array_join(F.filter(F.transform("cities", lambda c: c["core"]), lambda w: w != ""), "|")
    return (
        cities.join(words, "prov_code").join(city_words, "prov_code")
        .select("prov_code", F.struct(
            F.col("prov_name").alias("name"), core(F.col("prov_name")).alias("core"),
            core(F.col("prov_short")).alias("short"), F.col("cities"), F.col("allowed"), F.col("city_words"),
            own_zones.alias("extra_zones"),
            # leftmost city name that is not the name of a bay
            F.concat(F.lit("("), city_cores, F.lit(")(?!湾)")).alias("city_pattern"),
            F.concat(F.lit("(?:"), F.array_join("allowed", "|"), F.lit(")[省市区县]?")).alias("strip_pattern"),
        ).alias("place")))


def with_place(df: DataFrame, places: DataFrame) -> DataFrame:
    """Attach the province's dictionary row as column ``place``."""
    return df.join(small(places, 1_000), "prov_code", "left")


def first_where(items: Column, test) -> Column:
    return F.get(F.filter(items, test), F.lit(0))


def city_in(name: Column, place: Column) -> Column:
    """City written in the name; the earliest position wins."""
    named = F.call_function("regexp_extract", name, place["city_pattern"], F.lit(1))
    return let(named, lambda w: first_where(place["cities"], lambda c: (w != "") & (c["core"] == w)))


def city_by_code(code: Column, place: Column) -> Column:
    return first_where(place["cities"], lambda c: c["code"] == code)


def city_by_name(name: Column, place: Column) -> Column:
    return first_where(place["cities"], lambda c: c["name"] == name)


def without_city(name: Column, city: Column) -> Column:
    """Name without its leading city, so that same-named districts are not read into it."""
    prefix = first_where(city["prefixes"], lambda w: name.startswith(w))
    cut = lambda w: F.substring(name, F.length(w) + 1, F.length(name))
    return let(prefix, lambda w: F.when(w.isNull(), name)
               .when(name.startswith(F.concat(w, F.lit("市"))), cut(F.concat(w, F.lit("市"))))
               .otherwise(cut(w)))


def district_in(name: Column, city: Column) -> Column:
    """District of ``city`` written in the name, longest full name first; null when none."""
    return let(without_city(name, city), lambda rest: first_where(
        city["districts"], lambda d: F.exists(d["needles"], lambda n: rest.contains(n)))["core"])


def unique_district(name: Column, place: Column) -> Column:
    """``struct<city, district>`` when exactly one city of the province has a hit."""
    hits = F.filter(
        F.transform(place["cities"], lambda c: F.struct(c["name"].alias("city"), district_in(name, c).alias("district"))),
        lambda h: h["district"].isNotNull())
    return F.when(F.size(hits) == 1, F.get(hits, F.lit(0)))


def zone_in(name: Column, county: Column, place: Column) -> Column:
    """Zone label (head plus kind) written in the name; null when there is no zone word."""
    extra = first_where(place["extra_zones"], lambda z: name.contains(z))
    kinds = F.create_map(*[F.lit(x) for pair in R.ZONE_KIND.items() for x in pair])

    def labelled(z: Column) -> Column:
        return let(F.regexp_replace(z["head"], "^.*" + R.AGENCY_CHARS, ""), lambda tail: placed(z, tail))

    def placed(z: Column, tail: Column) -> Column:
        leftover = (F.length(tail) == 1) & (tail != z["head"])
        bare = F.aggregate(place["city_words"], F.when(leftover, F.lit("")).otherwise(tail), lambda acc, w: F.replace(acc, w, F.lit("")))
        head = F.regexp_replace(F.regexp_replace(bare, "^[省市]+", ""), "[市区县]$", "")
        named = lambda h: (
            F.when(F.length(h) > 1, h)
            .when((z["head"] != "") & (h == "") & ~leftover, R.OWN_LEVEL)
            .otherwise(F.coalesce(F.nullif(core(county), F.lit("")), F.nullif(h, F.lit("")), F.lit(R.OWN_LEVEL))))
        return F.concat(let(head, named), F.element_at(kinds, z["word"]))

    found = F.struct(F.regexp_extract(name, R.ZONE, 1).alias("head"), F.regexp_extract(name, R.ZONE, 2).alias("word"))
    # the cheap test first: most names and addresses hold no zone word
    return F.coalesce(extra, F.when(name.rlike(R.ZONE_WORDS), let(found, labelled)))


def is_misplaced(name: Column, place: Column, listed: Column | None = None) -> Column:
    """Name opens with a place outside the province, or is on the curated list."""
    prefix = core(F.regexp_extract(without_station(name), R.PLACE_PREFIX, 1))
    foreign = ((F.regexp_extract(without_station(name), R.PLACE_PREFIX, 1) != "")
               & ~F.array_contains(place["allowed"], prefix))
    return foreign if listed is None else foreign | F.coalesce(listed, F.lit(False))


def _area_columns(df: DataFrame, name: Column, city_code: Column, county: Column) -> DataFrame:
    """Working columns of the area rules, staged so that each is computed once."""
    p = F.col("place")
    return (
        df.withColumn("_named", city_in(name, p))
        .withColumn("_elsewhere", unique_district(name, p))
        .withColumn("_asked", F.coalesce(F.col("_named"), city_by_code(city_code, p)))
        # a district found in one other city only moves an unnamed record there
        .withColumn("_city", F.when(F.col("_named").isNull() & F.col("_asked").isNotNull()
                                    & (F.col("_elsewhere.city") != F.col("_asked.name")),
                                    city_by_name(F.col("_elsewhere.city"), p)).otherwise(F.col("_asked")))
        .withColumn("_zone", zone_in(name, county, p))
        .withColumn("_district", district_in(name, F.col("_city"))))


def locate(df: DataFrame, places: DataFrame, name: str = "name", city_code: str = "city_code",
           county: str | None = "county", keep: tuple = ()) -> DataFrame:
    """Add ``city`` and ``area`` of each name; both null when the place is unknown.

    The precedence is: national, zone, district, province-unique district,
    named city, province, queried city, town, window with a county of the city.
    """
    n, code = F.col(name), F.col(city_code)
    c = F.col(county) if county else F.lit("")
    p, city = F.col("place"), F.col("_city")
    staged = _area_columns(with_place(df, places), n, code, c)
    found = lambda where, area: F.struct(where.alias("city"), area.alias("area"))
    at_city = lambda area: found(city["name"], area)
    county_core = core(c)
    own_county = let(county_core, lambda w: F.exists(city["districts"], lambda d: (d["core"] == w) | (d["short"] == w)))
    names_city = n.contains(city["core"]) | (n.contains(city["short"]) & (city["short"] != ""))
    where = (
        F.when(is_national(n), found(F.lit(R.NO_CITY), F.lit(R.NATIONAL)))
        .when(city.isNull(), F.lit(None))
        .when(F.col("_zone").isNotNull(), at_city(F.col("_zone")))
        .when(F.col("_district").isNotNull(), at_city(F.col("_district")))
        .when(F.col("_elsewhere").isNotNull(), found(F.col("_elsewhere.city"), F.col("_elsewhere.district")))
        .when(F.col("_named").isNotNull(), found(F.col("_named.name"), F.lit(R.CITY_LEVEL)))
        .when(n.contains(p["core"]), found(F.lit(R.NO_CITY), F.lit(R.PROVINCIAL)))
        .when(names_city, at_city(F.lit(R.CITY_LEVEL)))
        .when(town_of(n) != "", at_city(town_of(n)))
        .when(is_window(n) & (c != "") & own_county, at_city(county_core)))
    return (staged.withColumn("_where", where)
            .select(*[x for x in df.columns], *keep, F.col("_where.city").alias("city"), F.col("_where.area").alias("area")))


def judge(df: DataFrame, places: DataFrame, misplaced: DataFrame | None = None) -> DataFrame:
    """Add city, area, function and ``drop_reason`` (null when the name is usable).

    ``misplaced`` is the curated list (prov_code, name) of exact spellings.
    """
    listed = None
    if misplaced is not None:
        marked = misplaced.select("prov_code", normalize(F.col("name")).alias("name"), F.lit(True).alias("_listed")).distinct()
        df = df.join(marked, ["prov_code", "name"], "left")
        listed = F.col("_listed")
    out = locate(df, places, keep=("place",))
    name = F.col("name")
    reason = (F.when(is_misplaced(name, F.col("place"), listed), R.MISPLACED)
              .when(is_irregular_text(name) | F.col("area").isNull(), R.IRREGULAR))
    return (out.withColumn("drop_reason", reason)
            .withColumn("function", function_of(name, F.col("place.strip_pattern")))
            .drop("place", "_listed"))


def with_function(df: DataFrame, places: DataFrame, name: str = "name", to: str = "function") -> DataFrame:
    return (with_place(df, places)
            .withColumn(to, function_of(F.col(name), F.col("place.strip_pattern"))).drop("place"))
