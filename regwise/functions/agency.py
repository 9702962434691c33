"""Classification of agency names by their wording alone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from regwise import rules as R


def is_national(name: Column) -> Column:
    return name.rlike(R.NATION)


def town_of(name: Column) -> Column:
    """Town or street named in the text, blank when there is none."""
    return F.regexp_extract(name, R.TOWN, 0)


def is_window(name: Column) -> Column:
    return name.rlike(R.WINDOW)


def without_station(name: Column) -> Column:
    return F.regexp_replace(name, R.STATION, "")


def role_of(name: Column) -> Column:
    """Reporting role of an agency; the order of the cases matters."""
    named_zone = name.rlike(R.ROLE_ZONE) | name.rlike(R.WHOLE_ZONE)
    return (F.when(name.rlike(R.ROLE_ECO) | name.rlike(R.BARE_ZONE_BRANCH) | name.rlike(R.ECO_TRUNCATED),
                   R.ECO_FUNCTION)
            .when(name.rlike(R.ROLE_ADMIN), R.ADMIN_FUNCTION)
            .when(named_zone, R.ZONE_ROLE)
            .otherwise(R.OTHER_ROLE))


def function_of(name: Column, place_words: Column) -> Column:
    """Grouping function of an agency.

    ``place_words`` is the alternation of the province's place words; what
    stays after removing them names the department.
    """
    rest = F.regexp_replace(name, place_words, "")
    unbracketed = F.regexp_replace(rest, "[（(].*?[）)]", "")
    only_zone = F.regexp_replace(F.regexp_replace(unbracketed, R.ZONE, ""), r"(?U)\s+", "") == ""
    return (F.when(name.rlike(R.ECO) | name.rlike(R.ECO_TRUNCATED), R.ECO_FUNCTION)
            .when(name.rlike(R.ADMIN), F.when(name.rlike(R.ROLE_ECO), R.ECO_FUNCTION)
                  .otherwise(R.ADMIN_FUNCTION))
            .when(rest.rlike("^[一-龥]?分局$"), R.ECO_FUNCTION)
            .when(only_zone, R.ADMIN_FUNCTION)
            .otherwise(rest))


def is_irregular_text(name: Column) -> Column:
    """Wording that cannot be an agency: blanks, self references, companies, typos."""
    return ((name == "") | name.isin(*R.BLANK_NAMES) | name.contains(R.SELF_REFERENCE)
            | name.rlike(R.SEPARATOR_LEFT) | ~name.rlike(R.LEGAL_SUFFIX)
            | name.rlike(R.COMPANY) | name.rlike(R.TYPO))


def is_proper(name: Column) -> Column:
    return name.rlike(R.PROPER_SUFFIX)


def may_be_truncated(name: Column) -> Column:
    return (F.length(name) >= 3) & name.rlike(R.TRUNCATABLE)


def tier(name: Column) -> Column:
    eco, admin, other = R.TIERS
    return F.when(name.rlike(R.TIER_ECO), eco).when(name.rlike(R.TIER_ADMIN), admin).otherwise(other)


# --- the single-city rule set ----------------------------------------------

def one_city_name(unit: Column, rules: R.CityRules = R.ONE_CITY) -> Column:
    from regwise.functions.text import strip
    return F.regexp_replace(strip(F.coalesce(unit, F.lit(""))), rules.section, "")


def one_city_area(name: Column, rules: R.CityRules = R.ONE_CITY) -> Column:
    """First matching area of the ordered list, null when none matches."""
    ordered = [*rules.area_before, *[(d, d) for d in rules.districts], *rules.area_after]
    return F.coalesce(*[F.when(name.rlike(p), F.lit(area)) for p, area in ordered])


def one_city_function(name: Column, rules: R.CityRules = R.ONE_CITY) -> Column:
    tokens = (f"{rules.country}|({rules.zones}|"
              f"({'|'.join(rules.districts)})(区|县)?)")
    rest = F.regexp_replace(F.regexp_replace(name, tokens, ""), tokens, "")
    return (F.when(name.rlike(rules.eco), R.ECO_FUNCTION)
            .when(name.rlike(rules.admin), R.ADMIN_FUNCTION)
            .when(rest == "", name).otherwise(rest))


def one_city_drop_reason(name: Column, rules: R.CityRules = R.ONE_CITY) -> Column:
    place = F.regexp_extract(name, rules.prefix, 1)
    own = [*rules.own, *rules.districts]
    misplaced = (place != "") & ~F.regexp_replace(place, "[区县]$", "").isin(*own)
    irregular = ((name == "") | name.isin(*R.BLANK_NAMES) | name.contains(R.SELF_REFERENCE)
                 | name.rlike(R.SEPARATOR_LEFT) | ~name.rlike(rules.suffix)
                 | one_city_area(name, rules).isNull() | name.rlike(rules.typo))
    return F.when(misplaced, R.MISPLACED).when(irregular, R.IRREGULAR)
