"""Queries over the master table and its parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from regwise import rules as R
from regwise.operators import audit, entries as E, evidence as V, zones as Z
from regwise.plans import master as M
from workload import oracle as O
from workload.frames import Frames
from workload.registry import query

c = F.col
UNIT = ["prov_code", "city", "area", "unit"]

O.relation("aliases", "proc_units", """SELECT prov_code, city, name, arg_min(area, rank) AS area, arg_min(unit, rank) AS unit FROM (
  SELECT prov_code, city, unit AS name, area, unit, (0, record_count, area, 0) AS rank FROM proc_units
  UNION ALL SELECT prov_code, city, v, area, unit, (1, -record_count, unit, i) FROM (
    SELECT prov_code, city, area, unit, record_count, unnest(variants) AS v, unnest(range(1, len(variants) + 1)) AS i FROM proc_units))
  GROUP BY 1, 2, 3""")


@query("jon_07_alias_lookup", """SELECT r.ord, coalesce(a.unit, b.unit, d.unit) AS unit, CASE WHEN a.unit IS NOT NULL THEN a.area WHEN b.unit IS NOT NULL THEN b.area ELSE d.area END AS area
  FROM (SELECT ord, prov_code, city_name, city_field, name FROM (SELECT r.*, {norm} AS name FROM records r)) r
  LEFT JOIN aliases a ON a.prov_code = r.prov_code AND a.city = r.city_field || '市' AND a.name = r.name
  LEFT JOIN aliases b ON b.prov_code = r.prov_code AND b.city = r.city_field AND b.name = r.name
  LEFT JOIN aliases d ON d.prov_code = r.prov_code AND d.city = r.city_name AND d.name = r.name""".replace("{norm}", O.normalize("r.process_department")))
def alias_q(f: Frames):
    from regwise.functions.text import normalize
    r = f.records.select("ord", "prov_code", "city_name", "city_field", normalize(c("process_department")).alias("name"))
    p, n = c("prov_code"), c("name")
    hit = V.match_first(r, V.alias_table(f.units), [[p, F.concat("city_field", F.lit("市")), n], [p, c("city_field"), n], [p, c("city_name"), n]],
                        ["prov_code", "city", "name"], ["unit", "area"])
    return hit.select("ord", "unit", "area")


O.relation("matched", "records aliases", f"""SELECT r.*, coalesce(a.city, b.city, d.city) AS city, coalesce(a.area, b.area, d.area) AS area, coalesce(a.unit, b.unit, d.unit) AS unit
  FROM (SELECT ord, prov_code, city_name, city_field, county, notice_date, {O.normalize('process_department')} AS name FROM records) r
  LEFT JOIN aliases a ON a.prov_code = r.prov_code AND a.city = r.city_field || '市' AND a.name = r.name
  LEFT JOIN aliases b ON b.prov_code = r.prov_code AND b.city = r.city_field AND b.name = r.name
  LEFT JOIN aliases d ON d.prov_code = r.prov_code AND d.city = r.city_name AND d.name = r.name
  WHERE coalesce(a.unit, b.unit, d.unit) IS NOT NULL""")
O.relation("evidence", "matched", """SELECT s.*, h.county_field_dist FROM (
  SELECT prov_code, city, area, unit, count(*) AS raw_matched, coalesce(min(nullif(notice_date, '')), '') AS first_notice_date,
    max(notice_date) AS last_notice_date FROM matched GROUP BY 1, 2, 3, 4) s
  JOIN (SELECT prov_code, city, area, unit, string_agg(county || ':' || n, ' / ' ORDER BY n DESC, o) AS county_field_dist FROM (
    SELECT prov_code, city, area, unit, CASE WHEN county = '' THEN '(空)' ELSE county END AS county, count(*) AS n, min(ord) AS o
    FROM matched GROUP BY 1, 2, 3, 4, 5 QUALIFY row_number() OVER (PARTITION BY prov_code, city, area, unit ORDER BY n DESC, o) <= 4)
    GROUP BY 1, 2, 3, 4) h USING (prov_code, city, area, unit)""")


@query("agg_05_raw_evidence", "SELECT prov_code, city, area, unit, raw_matched, first_notice_date, last_notice_date FROM evidence")
def evidence_q(f: Frames):
    return V.raw_evidence(f.records, f.units).drop("county_field_dist")


@query("agg_06_county_histogram", "SELECT prov_code, city, area, unit, county_field_dist FROM evidence")
def histogram_q(f: Frames):
    return V.raw_evidence(f.records, f.units).select(*UNIT, "county_field_dist")


O.relation("pairs", "records", f"""SELECT prov_code, publisher, other, count(*) AS n FROM (
  SELECT prov_code, {O.strip('process_department')} AS publisher, unnest(parts) AS other, len(parts) AS k FROM
    (SELECT prov_code, process_department, {O.split_units('combined_units')} AS parts FROM records))
  WHERE publisher <> '' AND k >= 2 AND other <> publisher GROUP BY 1, 2, 3""")
O.relation("pairs_top", "pairs", """SELECT prov_code, publisher, string_agg(other || ':' || n, ' / ' ORDER BY n DESC, other) AS co_occurrence_top FROM (
  SELECT * FROM pairs QUALIFY row_number() OVER (PARTITION BY prov_code, publisher ORDER BY n DESC, other) <= 3) GROUP BY 1, 2""")


@query("agg_04_co_occurrence", "SELECT * FROM pairs")
def pairs_q(f: Frames):
    return V.co_occurrence(f.records)


@query("agg_06_co_occurrence_top", "SELECT * FROM pairs_top")
def pairs_top_q(f: Frames):
    return V.co_occurrence_top(V.co_occurrence(f.records))


O.relation("entries", "entry_log", f"""SELECT * EXCLUDE (pos, unit, ord), unit, pos AS ord FROM (
  SELECT * EXCLUDE (unit), {O.strip('unit')} AS unit, min((file_stem, ord)) OVER (PARTITION BY prov_code, city, {O.strip('unit')}) AS pos FROM entry_log)
  WHERE unit <> '' QUALIFY row_number() OVER (PARTITION BY prov_code, city, unit ORDER BY file_stem DESC, ord DESC) = 1""")


@query("src_07_latest_entries", "SELECT prov_code, city, unit, entry_url, entry_path, verify_status, note FROM entries")
def entries_q(f: Frames):
    return E.latest_entries(f.entry_log).select("prov_code", "city", "unit", "entry_url", "entry_path", "verify_status", "note")


@query("flt_10_own_entries", """SELECT prov_code, city, unit, entry_url FROM entries""")
def own_entries_q(f: Frames):
    return E.own_entries(E.latest_entries(f.entry_log), f.units, f.area).select("prov_code", "city", "unit", "entry_url")


O.relation("reg_rows", "entries", """SELECT prov_code, trim(entry_url) AS entry_url, string_agg(DISTINCT city, ' / ' ORDER BY city) AS cities, count(*) AS unit_count,
  min(ord) AS pos, arg_min({'p': entry_path, 's': verify_status, 'd': verify_date}, (CASE WHEN verify_status = '推断' THEN 1 ELSE 0 END, ord)) AS best
  FROM entries WHERE trim(entry_url) <> '' GROUP BY 1, 2""")
O.relation("registry", "reg_rows curated", """SELECT r.prov_code, r.entry_url, coalesce(k.entry_id, substr(r.prov_code, 1, 4) || '-E' || lpad(CAST(coalesce(m.mx, 0) +
    row_number() OVER (PARTITION BY r.prov_code, k.entry_id IS NULL ORDER BY r.unit_count DESC, r.pos, r.entry_url) AS VARCHAR), 3, '0')) AS entry_id,
  regexp_replace(r.entry_url, '^https?://([^/]+).*$', '\\1') AS domain, r.cities, r.unit_count, coalesce(k.entry_category, '') AS entry_category,
  coalesce(nullif(k.entry_path, ''), best.p, '') AS entry_path, coalesce(k.filter_rule, '') AS filter_rule, coalesce(k.title_bracket_meaning, '') AS title_bracket_meaning,
  coalesce(nullif(k.verify_status, ''), best.s, '') AS verify_status, coalesce(nullif(k.verify_date, ''), best.d, '') AS verify_date
  FROM reg_rows r LEFT JOIN curated k USING (prov_code, entry_url)
  LEFT JOIN (SELECT prov_code, max(CAST(regexp_extract(entry_id, 'E(\\d+)$', 1) AS INT)) AS mx FROM curated GROUP BY 1) m ON m.prov_code = r.prov_code""")


@query("agg_07_entry_registry", "SELECT * FROM registry")
def registry_q(f: Frames):
    return registry_of(f)


def registry_of(f: Frames):
    return E.entry_registry(E.own_entries(E.latest_entries(f.entry_log), f.units, f.area), f.curated)


@query("win_07_entry_ids", "SELECT prov_code, entry_url, entry_id FROM registry")
def entry_ids_q(f: Frames):
    return registry_of(f).select("prov_code", "entry_url", "entry_id")


O.relation("candidates", "proc_units merges", """SELECT u.prov_code, u.city, u.area, u.role, u.unit, u.record_count, t.unit AS merge_into, t.record_count AS merge_into_count,
  CASE WHEN m.unit IS NOT NULL THEN '是' ELSE '' END AS confirmed FROM proc_units u
  JOIN (SELECT prov_code, city, area, role, unit, record_count FROM proc_units
        QUALIFY row_number() OVER (PARTITION BY prov_code, city, area, role ORDER BY record_count DESC, unit) = 1) t
    ON t.prov_code = u.prov_code AND t.city = u.city AND t.area = u.area AND t.role = u.role AND t.unit <> u.unit
  LEFT JOIN (SELECT * FROM merges WHERE confirmed = '是') m ON m.prov_code = u.prov_code AND m.city = u.city AND m.area = u.area AND m.unit = u.unit""")


@query("agg_08_merge_candidates", "SELECT * FROM candidates")
def candidates_q(f: Frames):
    return V.merge_candidates(f.units, f.merges)


O.relation("d_labels", "p_dist", """SELECT DISTINCT prov_code, city_name AS city, unnest([district_short, dcore, regexp_replace(district_short, '[市区县]$', '')]) AS area FROM p_dist""")
_kind = "CASE " + " ".join(f"WHEN {O.first('area', R.ZONE, 2)} = '{w}' THEN '{k}'" for w, k in R.ZONE_KIND.items()) + " ELSE '' END"
O.relation("zone_new", "proc_units d_labels zones p_city", f"""SELECT g.*, city_code || '-Z' || lpad(CAST(coalesce(mx, 0) + row_number() OVER (PARTITION BY city_code ORDER BY source_label) AS VARCHAR),
    greatest(2, length(CAST(coalesce(mx, 0) + row_number() OVER (PARTITION BY city_code ORDER BY source_label) AS VARCHAR)))::INT, '0') AS zone_id FROM (
  SELECT u.prov_code, u.city, p.city_code, u.area AS source_label, {_kind} AS kind, count(*) AS unit_count, sum(record_count)::BIGINT AS record_count,
    arg_max(unit, (record_count, unit)) AS sample_unit FROM proc_units u
  JOIN p_city p ON p.prov_code = u.prov_code AND p.city_name = u.city
  ANTI JOIN d_labels d ON d.prov_code = u.prov_code AND d.city = u.city AND d.area = u.area
  WHERE u.area NOT IN ('国家', '省级', '市本级') AND {O.has('u.area', R.ZONE)} GROUP BY 1, 2, 3, 4) g
  ANTI JOIN zones z ON z.prov_code = g.prov_code AND z.city = g.city AND z.source_label = g.source_label
  LEFT JOIN (SELECT city_code, max(CAST(regexp_extract(zone_id, 'Z(\\d+)$', 1) AS INT)) AS mx FROM zones GROUP BY 1) m USING (city_code)""")


@query("agg_09_zone_candidates", "SELECT prov_code, city, city_code, source_label, kind, unit_count, record_count, sample_unit FROM zone_new")
def zone_candidates_q(f: Frames):
    return Z.zone_candidates(f.units, f.area, f.zones).select("prov_code", "city", "city_code", "source_label", "kind", "unit_count", "record_count", "sample_unit")


@query("win_05_zone_ids", "SELECT city, source_label, zone_id FROM zone_new")
def zone_ids_q(f: Frames):
    return Z.zone_candidates(f.units, f.area, f.zones).select("city", "source_label", "zone_id")


@query("flt_16_zone_labels", f"""SELECT u.prov_code, u.city, u.area, u.unit FROM proc_units u ANTI JOIN d_labels d ON d.prov_code = u.prov_code AND d.city = u.city AND d.area = u.area
  WHERE u.area NOT IN ('国家', '省级', '市本级') AND {O.has('u.area', R.ZONE)}""")
def zone_labels_q(f: Frames):
    return Z.zone_labels(f.units, f.area).select(*UNIT)


@query("flt_23_suspect_labels", f"SELECT city, source_label, CASE WHEN city = '南京市' AND source_label = '国家东中西区域示范区' THEN '{R.SUSPECT_NOTE}' ELSE '' END AS evidence FROM zone_new")
def suspects_q(f: Frames):
    return Z.zone_candidates(f.units, f.area, f.zones, [("南京市", "国家东中西区域示范区")]).select("city", "source_label", "evidence")


@query("set_02_extend_zones", """SELECT prov_code, zone_id, city, source_label, confirmed FROM zones UNION ALL SELECT prov_code, zone_id, city, source_label, '否' FROM zone_new""")
def extend_zones_q(f: Frames):
    return Z.extend_zones(f.zones, Z.zone_candidates(f.units, f.area, f.zones)).select("prov_code", "zone_id", "city", "source_label", "confirmed")


O.relation("codes", "p_dist", """SELECT prov_code, city, area, arg_min(district_code, rank) AS district_code, arg_min(district_name, rank) AS district_name,
    arg_min(district_short, rank) AS district_short FROM (
  SELECT prov_code, city_name AS city, unnest([district_short, regexp_replace(district_short, '[市区县]$', ''), dcore]) AS area,
    unnest([0, 1, 2]) * 1000 + district_ord AS rank, district_code, district_name, district_short FROM p_dist) GROUP BY 1, 2, 3""")


@query("jon_09_area_codes", "SELECT * FROM codes")
def codes_q(f: Frames):
    return M.area_codes(f.area)


O.relation("adm", "proc_units p_city codes p_prov", """SELECT *, CASE admin_level WHEN '区县' THEN district_code ELSE '' END AS admin_code,
  CASE admin_level WHEN '省级' THEN prov_name WHEN '市本级' THEN city WHEN '区县' THEN district_name ELSE '' END AS admin_name,
  CASE admin_level WHEN '省级' THEN prov_short WHEN '市本级' THEN regexp_replace(city, '市+$', '') WHEN '区县' THEN district_short ELSE '' END AS admin_short FROM (
  SELECT u.*, coalesce(p.city_code, '') AS city_code, d.district_code, d.district_name, d.district_short, v.prov_name, v.prov_short,
    CASE WHEN u.area IN ('国家', '省级', '市本级') THEN u.area WHEN d.district_code IS NOT NULL THEN '区县' ELSE '开发区/园区' END AS admin_level
  FROM proc_units u LEFT JOIN p_city p ON p.prov_code = u.prov_code AND p.city_name = u.city
  LEFT JOIN codes d ON d.prov_code = u.prov_code AND d.city = u.city AND d.area = u.area JOIN p_prov v ON v.prov_code = u.prov_code)""")


@query("scl_28_admin_level", "SELECT prov_code, city, area, unit, admin_level, city_code, admin_code, admin_name, admin_short FROM adm")
def admin_q(f: Frames):
    return M.with_admin(f.units, f.area).select(*UNIT, "admin_level", "city_code", "admin_code", "admin_name", "admin_short")


O.relation("adz", "adm zones", """SELECT a.*, coalesce(z.zone_id, '') AS zone_id, CASE WHEN z.zone_id IS NULL THEN '' ELSE coalesce(nullif(z.zone_name, ''), a.area) END AS zone_name,
  coalesce(z.zone_short, '') AS zone_short, coalesce(z.zone_level, '') AS zone_level, coalesce(z.zone_admin_code, '') AS zone_admin_code,
  CASE WHEN z.zone_id IS NULL THEN CASE WHEN a.admin_level <> '开发区/园区' THEN '本级政府部门' ELSE '' END ELSE z.admin_relation END AS admin_relation,
  coalesce(z.evidence, '') AS relation_evidence, CASE WHEN z.zone_id IS NOT NULL THEN z.confirmed WHEN a.admin_level <> '开发区/园区' THEN '是' ELSE '否' END AS relation_confirmed,
  CASE z.admin_relation WHEN '合署' THEN a.city_code WHEN '下属部门' THEN coalesce(nullif(z.zone_admin_code, ''), a.admin_code) ELSE '' END AS parent_admin_code
  FROM adm a LEFT JOIN zones z ON z.prov_code = a.prov_code AND z.city = a.city AND z.source_label = a.area""")


@query("jon_08_zone_join", "SELECT prov_code, city, area, unit, zone_id, zone_name, zone_short, zone_level, zone_admin_code FROM adz")
def zone_join_q(f: Frames):
    return M.with_zone(M.with_admin(f.units, f.area), f.zones).select(*UNIT, "zone_id", "zone_name", "zone_short", "zone_level", "zone_admin_code")


@query("scl_29_admin_relation", "SELECT prov_code, city, area, unit, admin_relation, relation_evidence, relation_confirmed, parent_admin_code FROM adz")
def relation_q(f: Frames):
    return M.with_zone(M.with_admin(f.units, f.area), f.zones).select(*UNIT, "admin_relation", "relation_evidence", "relation_confirmed", "parent_admin_code")


@query("jon_10_unit_entries", f"""SELECT u.prov_code, u.city, u.area, u.unit, u.record_count, coalesce(e.home_url, '') AS home_url, coalesce(e.entry_url, '') AS entry_url,
  coalesce(e.entry_path, '') AS entry_path, CASE WHEN e.unit IS NULL THEN CASE WHEN {O.has('u.unit', R.TIER_ECO)} THEN '生态环境系统' WHEN {O.has('u.unit', R.TIER_ADMIN)} THEN '开发区/行政审批' ELSE '其他部门' END ELSE e.note END AS note,
  CASE WHEN e.unit IS NULL THEN '未查' ELSE e.verify_status END AS verify_status, coalesce(e.verify_date, '') AS verify_date
  FROM proc_units u LEFT JOIN entries e ON e.prov_code = u.prov_code AND e.city = u.city AND e.unit = u.unit""")
def unit_entries_q(f: Frames):
    return E.units_with_entries(f.units, E.latest_entries(f.entry_log))


@query("agg_20_entry_progress", """SELECT u.prov_code, u.city, count(*) AS units, count(e.unit) AS with_entry FROM proc_units u
  LEFT JOIN entries e ON e.prov_code = u.prov_code AND e.city = u.city AND e.unit = u.unit GROUP BY 1, 2""")
def progress_q(f: Frames):
    return audit.entry_progress(f.units, E.latest_entries(f.entry_log))


@query("agg_22_distinct_metrics", """SELECT count(DISTINCT unit) AS unit_names, count(DISTINCT (prov_code, city)) AS cities, count(DISTINCT (prov_code, city, unit)) AS city_units,
  (SELECT count(*) FROM registry) AS entries, (SELECT count(*) FROM registry WHERE unit_count > 1) AS shared_entries FROM proc_units""")
def metrics_q(f: Frames):
    return audit.distinct_metrics(f.units, registry_of(f))


O.relation("keyed", "proc_units p_pattern", f"""SELECT u.*, city || '|' || area || '|' || {O.function('unit', 'place_words')} AS function_key FROM proc_units u JOIN p_pattern USING (prov_code)""")
O.relation("uids", "keyed previous", """SELECT k.*, coalesce(p.unit_uid, pre || CASE WHEN length(CAST(no AS VARCHAR)) >= 4 THEN CAST(no AS VARCHAR) ELSE lpad(CAST(no AS VARCHAR), 4, '0') END) AS unit_uid
  FROM (SELECT k.*, coalesce(mx, 0) + row_number() OVER (PARTITION BY k.prov_code, q.function_key IS NULL ORDER BY city, record_count DESC, unit, area, function) AS no,
      CASE k.prov_code WHEN '320000' THEN 'JS' WHEN '330000' THEN 'ZJ' WHEN '340000' THEN 'AH' ELSE substr(k.prov_code, 1, 2) END AS pre
    FROM keyed k LEFT JOIN (SELECT DISTINCT prov_code, function_key, name_from_source FROM previous) q
      ON q.prov_code = k.prov_code AND q.function_key = k.function_key AND q.name_from_source = k.unit
    LEFT JOIN (SELECT prov_code, max(CAST(substr(unit_uid, 3) AS BIGINT)) AS mx FROM previous GROUP BY 1) m ON m.prov_code = k.prov_code) k
  LEFT JOIN previous p ON p.prov_code = k.prov_code AND p.function_key = k.function_key AND p.name_from_source = k.unit""")


@query("jon_14_previous_match", "SELECT prov_code, city, area, unit, function_key, unit_uid FROM uids")
def previous_q(f: Frames):
    return uid_rows(f).select(*UNIT, "function_key", "unit_uid")


def uid_rows(f: Frames):
    return M.allocate_uids(M.keyed_units(f.units, f.places), f.previous)


@query("win_06_surrogate_ids", """SELECT prov_code, count(*) AS n, count(DISTINCT unit_uid) AS uids, min(unit_uid) AS low, max(unit_uid) AS high FROM uids GROUP BY 1""")
def surrogate_q(f: Frames):
    return uid_rows(f).groupBy("prov_code").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("unit_uid").alias("uids"),
                                                F.min("unit_uid").alias("low"), F.max("unit_uid").alias("high"))


O.relation("orgs", "uids merges", """SELECT u.*, coalesce(t.unit_uid, u.unit_uid) AS org_id FROM uids u
  LEFT JOIN (SELECT * FROM merges WHERE confirmed = '是') m ON m.prov_code = u.prov_code AND m.city = u.city AND m.area = u.area AND m.unit = u.unit
  LEFT JOIN (SELECT prov_code, city, unit, arg_min(unit_uid, (-record_count, area)) AS unit_uid FROM uids GROUP BY 1, 2, 3) t
    ON t.prov_code = u.prov_code AND t.city = u.city AND t.unit = m.merge_into""")


@query("jon_12_org_id", "SELECT prov_code, city, area, unit, unit_uid, org_id FROM orgs")
def org_q(f: Frames):
    return M.with_org(uid_rows(f), f.merges).select(*UNIT, "unit_uid", "org_id")


O.relation("entities", "orgs adz", """SELECT a.*, coalesce(CASE WHEN admin_relation = '合署' AND zone_admin_code <> '' AND relation_confirmed = '是' THEN
    (SELECT arg_max(b.org_id, (-b.record_count, b.unit)) FROM (SELECT o.org_id, z.* FROM orgs o JOIN adz z USING (prov_code, city, area, unit, function)) b
     WHERE b.admin_code <> '' AND b.prov_code = a.prov_code AND b.city_code = a.city_code AND b.admin_code = a.zone_admin_code AND b.role = a.role) END, org_id) AS entity_id
  FROM (SELECT o.org_id, o.unit_uid, o.function_key, z.* FROM orgs o JOIN adz z USING (prov_code, city, area, unit, function)) a""")


@query("jon_13_entity_id", "SELECT prov_code, city, area, unit, org_id, entity_id FROM entities")
def entity_q(f: Frames):
    rows = M.with_org(uid_rows(f), f.merges)
    return M.with_entity(M.with_zone(M.with_admin(rows, f.area), f.zones)).select(*UNIT, "org_id", "entity_id")


O.relation("with_entry", "entities entries registry", """SELECT a.*, coalesce(trim(e.entry_url), '') AS entry_url, coalesce(r.entry_id, '') AS entry_id, coalesce(r.entry_category, '') AS entry_category,
  coalesce(r.filter_rule, '') AS filter_rule, coalesce(nullif(r.entry_path, ''), e.entry_path, '') AS entry_path,
  CASE WHEN e.verify_status = '推断' THEN e.verify_status ELSE coalesce(nullif(r.verify_status, ''), nullif(e.verify_status, ''), '') END AS verify_status,
  CASE WHEN e.verify_status = '推断' THEN e.verify_date ELSE coalesce(nullif(r.verify_date, ''), nullif(e.verify_date, ''), '') END AS verify_date
  FROM entities a LEFT JOIN entries e ON e.prov_code = a.prov_code AND e.city = a.city AND e.unit = a.unit
  LEFT JOIN registry r ON r.prov_code = a.prov_code AND r.entry_url = trim(e.entry_url)""")


@query("jon_11_registry_columns", "SELECT prov_code, city, area, unit, entry_url, entry_id, entry_category, filter_rule, entry_path, verify_status, verify_date FROM with_entry")
def registry_columns_q(f: Frames):
    return M.with_entry(f.units, E.latest_entries(f.entry_log), registry_of(f)).select(
        *UNIT, "entry_url", "entry_id", "entry_category", "filter_rule", "entry_path", "verify_status", "verify_date")


def master_of(f: Frames):
    if "master" not in f._made:
        f._made["master"] = M.build_master(f.units, f.records, f.places, f.area, f.zones, E.latest_entries(f.entry_log),
                                           registry_of(f), f.merges, f.previous)
    return f._made["master"]


_inner = "regexp_extract(a.unit, '[(（]([^()（）]+)[)）][\\s　]*$', 1)"
O.relation("live", "with_entry evidence pairs_top previous", f"""SELECT a.unit_uid, a.org_id, a.entity_id, coalesce(p.name_canonical, '') AS name_canonical, a.unit AS name_from_source,
  array_to_string(a.variants, ' / ') AS name_variants,
  array_to_string(list_filter(list_transform(string_split_regex({_inner}, '[、,，]'), lambda p: {O.strip('p')}), lambda p: p <> ''), ' / ') AS badges,
  coalesce(nullif(p.name_status, ''), '在用') AS name_status, a.admin_level, a.prov_code, a.city_code, a.admin_code, a.admin_name, a.admin_short,
  a.zone_id, a.zone_name, a.zone_short, a.zone_level, a.zone_admin_code, a.admin_relation, a.relation_evidence, a.relation_confirmed, a.parent_admin_code,
  coalesce(p.group_id, '') AS group_id, coalesce(t.co_occurrence_top, '') AS co_occurrence_top, a.role, a.function_key, a.entry_id, a.entry_category, a.entry_url,
  a.entry_path, a.filter_rule, a.verify_status, a.verify_date, CAST(a.record_count AS VARCHAR) AS record_count, CAST(coalesce(v.raw_matched, 0) AS VARCHAR) AS raw_matched,
  coalesce(v.first_notice_date, '') AS first_notice_date, coalesce(nullif(v.last_notice_date, ''), a.last_date) AS last_notice_date,
  coalesce(v.county_field_dist, '') AS county_field_dist, coalesce(p.crawl_note, '') AS crawl_note
  FROM with_entry a LEFT JOIN evidence v USING (prov_code, city, area, unit)
  LEFT JOIN pairs_top t ON t.prov_code = a.prov_code AND t.publisher = a.unit LEFT JOIN previous p ON p.unit_uid = a.unit_uid""")
_old = {"unit_uid", "prov_code", "city_code", "function_key", "name_from_source", "name_canonical", "group_id", "record_count", "role", "crawl_note"}
_retired = ", ".join(x if x in _old else ("'已停用' AS name_status" if x == "name_status" else f"'' AS {x}") for x in [*R.MASTER_COLUMNS, "crawl_note"])
_all = ", ".join([*R.MASTER_COLUMNS, "crawl_note"])
O.relation("full_master", "live previous", f"SELECT {_all} FROM live UNION ALL SELECT {_retired} FROM previous p ANTI JOIN live l USING (unit_uid)")


@query("snk_03_master_table", f"SELECT {_all} FROM full_master")
def master_q(f: Frames):
    return master_of(f)


@query("jon_15_retired_rows", "SELECT unit_uid, name_from_source, name_status, crawl_note FROM full_master WHERE name_status = '已停用'")
def retired_q(f: Frames):
    return master_of(f).filter(c("name_status") == R.RETIRED).select("unit_uid", "name_from_source", "name_status", "crawl_note")


@query("flt_22_carry_over", "SELECT unit_uid, name_canonical, name_status, group_id, crawl_note FROM full_master")
def carry_q(f: Frames):
    return master_of(f).select("unit_uid", "name_canonical", "name_status", "group_id", "crawl_note")


@query("win_02_master_order", """SELECT unit_uid, row_number() OVER (ORDER BY city_code, CASE WHEN admin_code = '' THEN 'zzz' ELSE admin_code END,
  CAST(record_count AS BIGINT) DESC, unit_uid) - 1 AS position FROM full_master""")
def master_order_q(f: Frames):
    return M.master_position(master_of(f)).select("unit_uid", "position")


@query("flt_18_target_units", "SELECT unit_uid, verify_status, last_notice_date FROM full_master WHERE verify_status IN ('未核实', '推断') AND city_code <> '' AND last_notice_date <> ''")
def targets_q(f: Frames):
    from regwise.operators.samples import target_units
    return target_units(master_of(f), ["unverified", "推断"]).select("unit_uid", "verify_status", "last_notice_date")


@query("jon_25_evidence_window", f"""SELECT unit_uid, ord, rank FROM (
  SELECT t.unit_uid, r.ord, row_number() OVER (PARTITION BY t.unit_uid ORDER BY r.ord) AS rank FROM full_master t JOIN records r
    ON r.city_code = t.city_code AND {O.strip('r.process_department')} IN (SELECT unnest(list_append(string_split(t.name_variants, ' / '), t.name_from_source)))
    AND r.notice_date <> '' AND CAST(nullif(r.notice_date, '') AS DATE) BETWEEN CAST(nullif(t.last_notice_date, '') AS DATE) - 20 AND CAST(nullif(t.last_notice_date, '') AS DATE)
  WHERE t.verify_status IN ('未核实', '推断', '已核实') AND t.city_code <> '' AND t.last_notice_date <> '' AND {O.strip('r.process_department')} <> '') WHERE rank <= 5""")
def window_q(f: Frames):
    from regwise.operators.samples import evidence_samples, target_units
    units = target_units(master_of(f), ["未核实", "推断", "已核实"])
    return evidence_samples(units, f.records, days=20, per_unit=5).select("unit_uid", "ord", "rank")


@query("win_13_samples_per_unit", f"""SELECT unit_uid, count(*) AS n FROM (
  SELECT t.unit_uid, row_number() OVER (PARTITION BY t.unit_uid ORDER BY r.ord) AS rank FROM full_master t JOIN records r
    ON r.city_code = t.city_code AND {O.strip('r.process_department')} IN (SELECT unnest(list_append(string_split(t.name_variants, ' / '), t.name_from_source)))
    AND r.notice_date <> '' AND CAST(nullif(r.notice_date, '') AS DATE) BETWEEN CAST(nullif(t.last_notice_date, '') AS DATE) - 90 AND CAST(nullif(t.last_notice_date, '') AS DATE)
  WHERE t.verify_status = '已核实' AND t.city_code <> '' AND t.last_notice_date <> '' AND {O.strip('r.process_department')} <> '') WHERE rank <= 3 GROUP BY 1""")
def samples_q(f: Frames):
    from regwise.operators.samples import evidence_samples, target_units
    hits = evidence_samples(target_units(master_of(f), ["verified"]), f.records, days=90, per_unit=3)
    return hits.groupBy("unit_uid").agg(F.count(F.lit(1)).alias("n"))
