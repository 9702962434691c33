"""Queries over the clean-up of agency spellings."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from regwise import rules as R
from regwise.functions import agency as A
from regwise.functions.text import normalize, strip
from regwise.operators import audit, spellings as S, units as UN
from regwise.operators.places import (city_in, city_by_code, district_in, is_misplaced, judge, unique_district, with_place)
from regwise.sources import readers
from regwise.plans.clean import clean
from workload import oracle as O
from workload.frames import Frames
from workload.q_scalar import distinct_names, one_area_sql, one_function_sql, one_name_sql, one_reason_sql
from workload.registry import query

c = F.col
UNIT_COLS = """prov_code, city AS "城市", area AS "地区", unit AS "单位", role AS "职能", last_date AS "最新公告日期",
record_count AS "记录数", array_to_string(variants, ' / ') AS "合并的其他写法" """


@query("agg_03_merge_units", f"SELECT {UNIT_COLS} FROM proc_units")
def merge_units_q(f: Frames):
    return UN.unit_table(f.units)


@query("flt_01_module", "SELECT * FROM records WHERE module = 2")
def module_q(f: Frames):
    return S.select_module(f.records, 2)


@query("flt_02_field_selector", "SELECT prov_code, city_code, notice_date, county, raw, CAST(ord AS BIGINT) AS ord, CAST(part AS BIGINT) AS part FROM export_rows")
def field_q(f: Frames):
    return (S.select_field(f.records, "export")
            .select("prov_code", "city_code", "notice_date", "county", "raw", F.floor(c("ord") / S.PARTS).cast("long").alias("ord"),
                    (c("ord") % S.PARTS).cast("long").alias("part")))


@query("flt_03_blank_names", "SELECT count(*) AS n_rows, count(*) FILTER (name = '') AS n_blank FROM proc_norm")
def blank_q(f: Frames):
    return S.count_blank(S.select_field(f.records))


# the curated list: one office of one province, one office of every second city
O.relation("listed", "area", """SELECT DISTINCT prov_code, '国家东中西区域合作示范区环境保护局' AS name FROM area WHERE prov_code = '320000'
  UNION ALL SELECT DISTINCT prov_code, city_name || '行政审批局' FROM area WHERE city_ord % 2 = 0""")


def curated(f: Frames):
    one = f.area.filter("prov_code = '320000'").select("prov_code", F.lit("国家东中西区域合作示范区环境保护局").alias("name"))
    return one.unionByName(f.area.filter("city_ord % 2 = 0").select("prov_code", F.concat("city_name", F.lit("行政审批局")).alias("name"))).distinct()


O.clean_up("cur", "proc_rows", "listed")


def cleaned_with_list(f: Frames):
    if "listed" not in f._made:
        f._made["listed"] = clean(f.records, f.places, misplaced=curated(f))
    return f._made["listed"]


@query("flt_04_clean_with_list", f"SELECT {UNIT_COLS} FROM cur_units")
def clean_with_list_q(f: Frames):
    """The whole clean-up with a curated list of misplaced spellings."""
    return UN.unit_table(cleaned_with_list(f).units)


@query("flt_04_listed_dropped", "SELECT prov_code, city_code, name, n, drop_reason FROM cur_dropped WHERE drop_reason = '标错地区'")
def listed_dropped_q(f: Frames):
    return cleaned_with_list(f).dropped.filter(c("drop_reason") == "标错地区").select("prov_code", "city_code", "name", "n", "drop_reason")


@query("flt_04_is_misplaced", f"""SELECT n.prov_code, n.name, (x.prefix <> '' AND w.w IS NULL)
    OR (n.prov_code, n.name) IN (SELECT prov_code, name FROM listed) AS misplaced
  FROM (SELECT DISTINCT prov_code, name FROM all_names) n
  JOIN (SELECT DISTINCT prov_code, name, {O.first("regexp_replace(name, '^驻', '')", R.PLACE_PREFIX, 1)} AS prefix FROM all_names) x USING (prov_code, name)
  LEFT JOIN p_words w ON w.prov_code = n.prov_code AND w.w = {O.core('x.prefix')}""")
def misplaced_q(f: Frames):
    names = distinct_names(f).select("prov_code", "name").distinct()
    marked = names.join(curated(f).withColumn("_l", F.lit(True)), ["prov_code", "name"], "left")
    return with_place(marked, f.places).select("prov_code", "name", is_misplaced(c("name"), c("place"), c("_l")).alias("misplaced"))


@query("flt_05_is_irregular", f"SELECT prov_code, city_code, county, name, {O.irregular('name')} OR area IS NULL AS irregular FROM all_located")
def irregular_q(f: Frames):
    judged = judge(distinct_names(f), f.places)
    return judged.select("prov_code", "city_code", "county", "name", (A.is_irregular_text(c("name")) | c("area").isNull()).alias("irregular"))


@query("flt_06_drop_reason", "SELECT prov_code, city_code, name, county, drop_reason, n FROM proc_judged")
def drop_reason_q(f: Frames):
    return S.judged_spellings(S.select_field(f.records), f.places).select("prov_code", "city_code", "name", "county", "drop_reason", "n")


@query("flt_07_truncation_gate", f"""SELECT prov_code, city_code, name FROM proc_judged WHERE drop_reason IS NOT NULL AND length(name) >= 3
  AND county <> '' AND {O.has('name', R.TRUNCATABLE)}""")
def truncation_gate_q(f: Frames):
    judged = f.judged
    return judged.filter(c("drop_reason").isNotNull() & (c("county") != "") & A.may_be_truncated(c("name"))).select("prov_code", "city_code", "name")


@query("flt_08_approvers", """SELECT prov_code, count(*) FILTER (role <> '其他部门') AS approvers, count(*) FILTER (role = '其他部门') AS removed_units,
  coalesce(sum(record_count) FILTER (role = '其他部门'), 0)::BIGINT AS removed_records FROM proc_units GROUP BY 1""")
def approvers_q(f: Frames):
    return UN.removed_by_role(f.units)


@query("flt_09_confirmed_zones", "SELECT city, source_label, district_short FROM zones WHERE confirmed = '是' AND district_short <> ''")
def confirmed_q(f: Frames):
    from regwise.operators.layout import confirmed_zone_map
    return confirmed_zone_map(f.zones).select("city", c("area").alias("source_label"), "district_short")


@query("flt_21_city_mismatch", """SELECT city_code, count(*) AS n_rows, count(*) FILTER (city_field NOT IN (r.city_name, a.city_short)) AS mismatched,
  count(*) FILTER (city_field NOT IN (r.city_name, a.city_short, '')) AS named_other
  FROM records r JOIN p_city a USING (city_code) GROUP BY 1""")
def mismatch_q(f: Frames):
    short = f.area.select("city_code", "city_short").distinct()
    return audit.city_mismatch(f.records.join(short, "city_code"))


# --- place joins ---------------------------------------------------------------

@query("jon_01_city_in", """SELECT n.prov_code, n.name, p.city_name AS city FROM (SELECT DISTINCT prov_code, name FROM all_names) n
  LEFT JOIN all_located_named d USING (prov_code, name) LEFT JOIN p_city p ON p.city_code = d.named_code""")
def city_in_q(f: Frames):
    names = distinct_names(f).select("prov_code", "name").distinct()
    return with_place(names, f.places).select("prov_code", "name", city_in(c("name"), c("place"))["name"].alias("city"))


@query("jon_02_district_in", """SELECT n.prov_code, n.city_code, n.name, h.dcore AS district FROM
  (SELECT DISTINCT prov_code, city_code, name FROM all_names) n LEFT JOIN all_located_hits h USING (prov_code, city_code, name)""")
def district_in_q(f: Frames):
    names = distinct_names(f).select("prov_code", "city_code", "name").distinct()
    return with_place(names, f.places).select(
        "prov_code", "city_code", "name", district_in(c("name"), city_by_code(c("city_code"), c("place"))).alias("district"))


@query("jon_03_unique_district", """SELECT n.prov_code, n.name, u.u_city AS city, u.u_core AS district FROM
  (SELECT DISTINCT prov_code, name FROM all_names) n LEFT JOIN all_located_uniq u USING (prov_code, name)""")
def unique_district_q(f: Frames):
    names = distinct_names(f).select("prov_code", "name").distinct()
    hit = unique_district(c("name"), c("place"))
    return with_place(names, f.places).select("prov_code", "name", hit["city"].alias("city"), hit["district"].alias("district"))


@query("jon_04_canonical_zones", "SELECT prov_code, city, area, canonical FROM proc_canon")
def canonical_q(f: Frames):
    kept = f.judged.filter("drop_reason IS NULL")
    return UN.canonical_zones(kept.groupBy("prov_code", "city", "area").agg(F.sum("n").alias("n")))


@query("jon_05_truncation_recovery", "SELECT prov_code, city_code, name, city, area, function FROM proc_found")
def recovery_q(f: Frames):
    judged = f.judged
    kept = UN.apply_canonical(judged.filter("drop_reason IS NULL"))
    return (UN.recover_truncated(kept, judged.filter("drop_reason IS NOT NULL"))
            .select("prov_code", "city_code", "name", "city", "area", "function"))


O.relation("proc_names", "proc_units", "SELECT DISTINCT prov_code, unnest(list_append(variants, unit)) AS name FROM proc_units")


@query("jon_06_flag_seen_in", """SELECT u.prov_code, u.city, u.area, u.unit, u.record_count, CASE WHEN EXISTS (SELECT 1 FROM proc_names p
  WHERE p.prov_code = u.prov_code AND list_contains(list_append(u.variants, u.unit), p.name)) THEN '是' ELSE '否' END AS seen FROM export_units u""")
def seen_q(f: Frames):
    flagged = UN.flag_seen_in(f.cleaned("export").units, f.units)
    return flagged.select("prov_code", "city", "area", "unit", "record_count", "seen")


# --- aggregations --------------------------------------------------------------

@query("agg_01_spelling_stats", "SELECT prov_code, city_code, name, n, last_date FROM proc_spell")
def stats_q(f: Frames):
    return S.spelling_stats(S.select_field(f.records)).select("prov_code", "city_code", "name", "n", "last_date")


@query("agg_02_modal_county", "SELECT prov_code, city_code, name, county FROM proc_spell")
def modal_q(f: Frames):
    return S.spelling_stats(S.select_field(f.records)).select("prov_code", "city_code", "name", "county")


O.relation("proc_dropped_names", "proc_dropped", """SELECT prov_code, drop_reason, name, sum(n)::BIGINT AS n, min(ord) AS ord FROM proc_dropped GROUP BY 1, 2, 3""")


@query("agg_18_drop_report", """SELECT prov_code, drop_reason, rank, name, n, records, spellings FROM (
  SELECT *, row_number() OVER (PARTITION BY prov_code, drop_reason ORDER BY n DESC, ord, name) AS rank,
    (sum(n) OVER (PARTITION BY prov_code, drop_reason))::BIGINT AS records, count(*) OVER (PARTITION BY prov_code, drop_reason) AS spellings
  FROM proc_dropped_names) WHERE rank <= 15""")
def drop_report_q(f: Frames):
    return S.drop_report(f.cleaned().dropped, 15)


@query("agg_19_run_summary", """SELECT r.prov_code, r.raw_rows, u.kept_records, u.units, u.cities FROM
  (SELECT prov_code, count(*) AS raw_rows FROM records GROUP BY 1) r JOIN
  (SELECT prov_code, sum(record_count)::BIGINT AS kept_records, count(*) AS units, count(DISTINCT city) AS cities FROM proc_units GROUP BY 1) u USING (prov_code)""")
def summary_q(f: Frames):
    return audit.run_summary(f.records, f.units)


@query("agg_19_city_subtotals", """SELECT prov_code, city, count(*) AS units, sum(record_count)::BIGINT AS records FROM proc_units
  GROUP BY GROUPING SETS ((prov_code, city), (prov_code))""")
def subtotals_q(f: Frames):
    return audit.city_subtotals(f.units)


# --- ranking and order -----------------------------------------------------------

@query("win_01_representative", "SELECT prov_code, city, area, function, arg_min(name, rk) AS unit FROM proc_ranked GROUP BY 1, 2, 3, 4")
def representative_q(f: Frames):
    key = UN.representative_key(c("name"))
    return f.cleaned().spellings.groupBy(*UN.GROUP).agg(F.max_by("name", key).alias("unit"))


@query("win_02_output_order", """SELECT prov_code, city, unit, area, record_count, row_number() OVER (ORDER BY prov_code, city, record_count DESC, unit, area, function) AS position FROM proc_units""")
def order_q(f: Frames):
    from regwise.operators.sequence import global_index
    ordered = global_index(f.units, [c("prov_code"), c("city"), F.desc("record_count"), c("unit"), c("area"), c("function")])
    return ordered.select("prov_code", "city", "unit", "area", "record_count", (c("idx") + 1).alias("position"))


@query("win_03_top_n", """SELECT prov_code, city, unit, record_count, row_number() OVER (PARTITION BY prov_code, city ORDER BY record_count DESC, unit) AS rank
  FROM proc_units QUALIFY rank <= 4""")
def top_n_q(f: Frames):
    return UN.top_units(f.units, ["prov_code", "city"], 4).select("prov_code", "city", "unit", "record_count", c("rank").cast("long").alias("rank"))


@query("win_04_argmax", """SELECT prov_code, city, area, arg_max(unit, (record_count, unit)) AS unit, max(record_count) AS record_count FROM proc_units GROUP BY 1, 2, 3""")
def argmax_q(f: Frames):
    return f.units.groupBy("prov_code", "city", "area").agg(
        F.max_by("unit", F.struct("record_count", "unit")).alias("unit"), F.max("record_count").alias("record_count"))


# --- sets ------------------------------------------------------------------------

@query("set_01_union_then_clean", f"SELECT {UNIT_COLS} FROM proc_units")
def union_q(f: Frames):
    """Two halves of the records are put together before one clean-up."""
    from regwise.plans.clean import clean
    halves = f.records.filter("module <= 2").unionByName(f.records.filter("module > 2"))
    return UN.unit_table(clean(halves, f.places).units)


@query("set_03_variants_overlap", """SELECT a.prov_code, a.city, a.area, a.function, list_has_any(list_append(a.variants, a.unit), list_append(b.variants, b.unit)) AS overlap
  FROM export_units a JOIN proc_units b USING (prov_code, city, area, function)""")
def overlap_q(f: Frames):
    both = lambda df, to: df.select(*UN.GROUP, F.concat(F.array("unit"), c("variants")).alias(to))
    return (both(f.cleaned("export").units, "x").join(both(f.units, "y"), list(UN.GROUP))
            .select(*UN.GROUP, F.arrays_overlap("x", "y").alias("overlap")))


@query("set_04_ordered_variants", "SELECT prov_code, city, area, function, array_to_string(variants, ' / ') AS variants FROM export_units")
def ordered_variants_q(f: Frames):
    return f.cleaned("export").units.select(*UN.GROUP, F.array_join("variants", R.VARIANT_SEP).alias("variants"))


@query("set_05_key_difference", "SELECT DISTINCT city, source_label AS area FROM zones EXCEPT SELECT DISTINCT city, area FROM proc_units")
def key_difference_q(f: Frames):
    return f.zones.select("city", c("source_label").alias("area")).subtract(f.units.select("city", "area"))


@query("jon_31_completeness", """SELECT 'module' AS kind, CAST(m AS VARCHAR) || '|' || city_code AS key FROM p_city, (SELECT unnest([1, 2, 3, 5]) AS m)
  WHERE NOT EXISTS (SELECT 1 FROM records r WHERE r.module = m AND r.city_code = p_city.city_code)
  UNION ALL SELECT 'zone', z.city || '|' || z.source_label FROM zones z ANTI JOIN proc_units u ON u.city = z.city AND u.area = z.source_label
  UNION ALL SELECT DISTINCT 'unlisted', u.city || '|' || u.area FROM proc_units u
    ANTI JOIN zones z ON u.city = z.city AND u.area = z.source_label
    WHERE u.area NOT IN ('国家', '省级', '市本级') AND NOT EXISTS (SELECT 1 FROM p_dist d WHERE d.city_name = u.city AND (d.dcore = u.area OR d.dshort = u.area))""")
def completeness_q(f: Frames):
    from regwise.operators.zones import zone_labels
    modules = F.array(*[F.lit(m) for m in R.MODULES])
    wanted = f.area.select("city_code").distinct().select(F.explode(modules).alias("module"), "city_code")
    key = lambda *cols: F.concat_ws("|", *[c(x).cast("string") for x in cols])
    kind = lambda df, k, *cols: df.select(F.lit(k).alias("kind"), key(*cols).alias("key"))
    zones = f.zones.select("city", c("source_label").alias("area"))
    return (kind(audit.missing_pairs(wanted, f.records, ["module", "city_code"]), "module", "module", "city_code")
            .unionByName(kind(audit.missing_pairs(zones, f.units, ["city", "area"]), "zone", "city", "area"))
            .unionByName(kind(audit.missing_pairs(zone_labels(f.units, f.area, words_only=False), zones, ["city", "area"]), "unlisted", "city", "area")))


O.relation("one_spell", "records", f"""SELECT *, {one_area_sql('name')} AS area, {one_function_sql('name')} AS function, {one_reason_sql('name')} AS reason FROM (
  SELECT name, count(*) AS n, max(notice_date) AS last_date, min(ord) AS ord FROM
    (SELECT {one_name_sql('process_department')} AS name, ord, notice_date FROM records) WHERE name <> '' GROUP BY 1)""")


@query("agg_03_one_city_units", """SELECT names[1] AS unit, last_date, record_count, array_to_string(names[2:], ' / ') AS variants FROM (
  SELECT list(name ORDER BY last_date DESC, n DESC, length(name) DESC, ord) AS names, max(last_date) AS last_date, sum(n)::BIGINT AS record_count
  FROM one_spell WHERE reason IS NULL GROUP BY area, function)""")
def one_city_q(f: Frames):
    from regwise.plans.one_city import clean_one_city
    return clean_one_city(f.records).select("unit", "last_date", "record_count", F.array_join("variants", R.VARIANT_SEP).alias("variants"))
