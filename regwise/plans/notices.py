"""Notices to classified project rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regwise import rules as R
from regwise.functions import notice as N
from regwise.functions.text import let, normalize, notice_date, percent, strip
from regwise.operators.places import (city_by_code, city_in, district_in, locate, unique_district, with_place, zone_in)
from regwise.session import durable, once, small


def district_of_address(address: Column, city: Column, place: Column) -> Column:
    """District or zone of an address; blank when neither is known.

    Without a city (a channel of the whole province) only a district that is
    unique in the province counts.
    """
    bare = let(strip(address), lambda a: F.when(
        a.startswith(place["core"]), F.regexp_replace(F.substring(a, F.length(place["core"]) + 1, F.length(a)), "^省", "")).otherwise(a))
    found = lambda a: F.coalesce(
        F.when(city.isNull(), unique_district(a, place)["district"]).otherwise(district_in(a, city)),
        zone_in(a, F.lit(""), place), F.lit(""))
    return F.when(F.coalesce(address, F.lit("")) == "", "").otherwise(let(bare, found))


def approval_areas(names: DataFrame, places: DataFrame) -> DataFrame:
    """Area of publishing agencies: ``names(prov_code, city_code, org)`` gain city and area.

    A blank ``city_code`` stands for a channel of the whole province. Any city
    then serves as context, and an area that rests on that loan alone is void.
    """
    borrowed = with_place(names.withColumn("name", normalize(F.col("org"))), places)
    first_city = F.get(F.col("place.cities"), F.lit(0))
    staged = borrowed.select(*names.columns, "name", (F.col("city_code") == "").alias("_loan"), first_city["name"].alias("_lender"),
                             city_in(F.col("name"), F.col("place")).isNotNull().alias("_spoken"),
                             F.when(F.col("city_code") == "", first_city["code"]).otherwise(F.col("city_code")).alias("_code"))
    placed = locate(staged, places, city_code="_code", county=None)
    void = F.col("_loan") & (F.col("city") == F.col("_lender")) & ~F.col("_spoken")
    return placed.select(*names.columns, "name", F.when(~F.coalesce(void, F.lit(False)), F.col("city")).alias("city"),
                         F.when(~F.coalesce(void, F.lit(False)), F.col("area")).alias("area"))


def address_districts(addresses: DataFrame, places: DataFrame) -> DataFrame:
    """Distinct ``(prov_code, city_code, addr)`` with the district or zone of the address; other columns stay."""
    p = F.col("place")
    return with_place(addresses.distinct(), places).select(
        *addresses.columns, district_of_address(F.col("addr"), city_by_code(F.col("city_code"), p), p).alias("district"))


def bracket_districts(brackets: DataFrame, places: DataFrame) -> DataFrame:
    """Distinct ``(prov_code, city_code, bracket)`` with the district of the channel's city that the bracket names; other columns stay."""
    p = F.col("place")
    return with_place(brackets.filter(F.col("bracket") != "").distinct(), places).select(
        *brackets.columns, district_in(F.col("bracket"), city_by_code(F.col("city_code"), p)).alias("_at"))


def _at(df: DataFrame, answers: DataFrame, on: dict[str, str], gain: dict[str, str]) -> DataFrame:
    """``df`` left-joined to the few ``answers``; ``on`` and ``gain`` give the columns of ``answers`` new names, nulls are equal."""
    told = small(answers.select(*[F.col(x).alias(f"_k{i}") for i, x in enumerate(on)], *[F.col(x).alias(to) for x, to in gain.items()]))
    same = [F.col(mine).eqNullSafe(F.col(f"_k{i}")) for i, mine in enumerate(on.values())]
    return df.join(told, reduce(Column.__and__, same), "left").drop(*[f"_k{i}" for i in range(len(on))])


# what the classification of a notice depends on, once its title is read
WORDING = ("prov_code", "city_code", "source", "channel_org", "bracket", "radiation", "locations")


def read_titles(notices: DataFrame) -> DataFrame:
    read = notices.withColumn("bracket", N.bracket_of(F.col("title")))
    return read.withColumn("radiation", N.is_radiation(F.col("title"), F.col("bracket")))


def classify(notices: DataFrame, places: DataFrame) -> DataFrame:
    """Add bracket, meaning, radiation, approval agency and districts to each notice.

    ``notices`` has prov_code, city_code, title, source, locations (array) and
    channel_org.
    """
    out = classify_wordings(read_titles(notices), places)
    return out.select(*notices.columns, "bracket", "bracket_meaning", "radiation", "approval_org", "approval_district", "project_districts", "n_projects")


def classify_counts(notices: DataFrame, places: DataFrame) -> DataFrame:
    """The classification of each distinct wording of notices, with ``n``, their number; for totals."""
    counted = read_titles(notices).groupBy(*WORDING).agg(F.count(F.lit(1)).alias("n"))
    return classify_wordings(durable(counted, "wordings"), places)


def classify_wordings(read: DataFrame, places: DataFrame) -> DataFrame:
    """Add meaning, approval agency and districts to rows with the columns ``WORDING``; ``read`` is read twice.

    Agencies and brackets are few: they are located once each and joined back
    as small tables. Addresses are many and mostly distinct: they are
    located where they stand, next to what their city needs of the places, so
    that no notice is shuffled. The source decides, the channel's agency fills
    in where it cannot.
    """
    where = ["prov_code", "city_code"]
    told = durable(read.select(*where, "source", "channel_org", "bracket").distinct(), "told")
    orgs = told.select(*where, F.explode(F.array("source", "channel_org")).alias("org")).filter(F.coalesce("org", F.lit("")) != "")
    named = approval_areas(orgs.distinct(), places).filter(F.col("name") != "")
    known = durable(named.select(*where, "org", F.struct("name", "area").alias("answer")), "approval")
    brackets = durable(bracket_districts(told.select(*where, "bracket"), places), "brackets")
    cities = durable(address_contexts(told.select(*where).distinct(), places), "contexts")
    same = {x: x for x in where}
    joined = _at(read, known, {**same, "org": "source"}, {"answer": "_s"})
    joined = _at(joined, known, {**same, "org": "channel_org"}, {"answer": "_c"})
    joined = _at(joined, brackets, {**same, "bracket": "bracket"}, {"_at": "_at"})
    joined = _at(joined, cities, same, {"city": "_city", "place": "_place"})
    own = F.col("_s.area").isNotNull()
    fallback = ~own & (F.coalesce("channel_org", F.lit("")) != "")
    org = F.when(fallback, F.col("_c.name")).otherwise(F.col("_s.name"))
    district = F.when(own, F.col("_s.area")).otherwise(F.col("_c.area"))
    addresses = F.filter("locations", lambda a: a.isNotNull())
    districts = F.transform(addresses, lambda a: district_of_address(a, F.col("_city"), F.col("_place")))
    staged = (once(joined, project_districts=F.coalesce(districts, F.array().cast("array<string>")))
              .withColumn("approval_org", F.coalesce(org, F.lit("")))
              .withColumn("approval_district", F.coalesce(district, F.lit(""))))
    meaning = N.bracket_meaning(F.col("bracket"), F.col("radiation"), F.col("_at"), F.col("approval_district"))
    return staged.select(*read.columns, meaning.alias("bracket_meaning"), "approval_org", "approval_district",
                         "project_districts", F.size("locations").cast("long").alias("n_projects"))


def address_contexts(where: DataFrame, places: DataFrame) -> DataFrame:
    """Distinct ``(prov_code, city_code)`` with what their addresses need of the places: the city, or all cities where none is known."""
    city, p = city_by_code(F.col("city_code"), F.col("place")), F.col("place")
    staged = with_place(where, places).withColumn("city", city)
    return staged.select(*where.columns, "city", F.struct(p["core"].alias("core"), F.when(F.col("city").isNull(), p["cities"]).alias("cities"),
                                                          p["extra_zones"].alias("extra_zones"), p["city_words"].alias("city_words")).alias("place"))


def project_rows(classified: DataFrame) -> DataFrame:
    """One row per project: the i-th record, address and district side by side, at least one row per notice.

    ``classified`` may carry ``recs``, the records read from the page.
    """
    with_recs = "recs" in classified.columns
    n = F.greatest(F.size("project_districts"), F.lit(1))
    at = lambda arr, i: F.coalesce(F.get(arr, i), F.lit(""))
    out = classified.withColumn("i", F.explode(F.sequence(F.lit(0), n - 1)))
    rec = lambda k: F.coalesce(F.get(F.col("recs"), F.col("i"))[k], F.lit("")) if with_recs else F.lit("")
    values = [F.col("city_name"), F.col("entry_url"), F.col("url"), F.col("title"), notice_date(F.col("title")), F.col("approval_org"),
              F.col("approval_district"), rec("项目名称"), at(F.col("locations"), F.col("i")), at(F.col("project_districts"), F.col("i")),
              rec("建设单位"), rec("环评机构"), F.when(F.col("radiation"), R.YES).otherwise(R.NO), F.col("bracket_meaning")]
    return out.select(*[v.alias(name) for v, name in zip(values, R.PROJECT_COLUMNS)])


def _weight(classified: DataFrame) -> Column:
    """How many notices a row stands for: ``n`` of counted wordings, else one."""
    return F.col("n") if "n" in classified.columns else F.lit(1).cast("long")


def meanings(classified: DataFrame) -> DataFrame:
    """Number of notices per meaning of the closing bracket."""
    return classified.groupBy("bracket_meaning").agg(F.sum(_weight(classified)).alias("n"))


def parse_coverage(classified: DataFrame) -> DataFrame:
    """How many notices could be read: totals and shares."""
    n = _weight(classified)
    filled = F.filter("project_districts", lambda d: d != "")
    count = lambda test: F.coalesce(F.sum(F.when(test, n)), F.lit(0).cast("long"))
    sums = classified.agg(
        F.coalesce(F.sum(n), F.lit(0).cast("long")).alias("notices"), count(F.col("approval_org") != "").alias("with_org"),
        count(F.col("approval_district") != "").alias("with_district"), count(F.col("n_projects") > 0).alias("with_locations"),
        F.sum(F.col("n_projects") * n).alias("projects"), F.sum(F.size("project_districts") * n).cast("long").alias("addresses"),
        F.sum(F.size(filled) * n).cast("long").alias("resolved"), count(F.col("radiation")).alias("radiation"))
    share = lambda a, b: percent(F.col(a), F.col(b))
    return sums.select("*", share("with_org", "notices").alias("org_share"), share("with_district", "notices").alias("district_share"),
                       share("with_locations", "notices").alias("location_share"), share("resolved", "addresses").alias("resolved_share"))


def approval_agreement(classified: DataFrame) -> DataFrame:
    """Approval district against project districts: same, different, share of different."""
    each = classified.select("approval_district", F.explode("project_districts").alias("d"), _weight(classified).alias("n"))
    usable = each.filter((F.col("d") != "") & (F.col("approval_district") != ""))
    same = F.col("d") == F.col("approval_district")
    count = lambda test: F.coalesce(F.sum(F.when(test, F.col("n"))), F.lit(0).cast("long"))
    return usable.agg(count(same).alias("same"), count(~same).alias("different")).select(
        "*", percent(F.col("different"), F.col("same") + F.col("different")).alias("different_share"))
