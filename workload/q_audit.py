"""Queries over audits, layouts, reconciliation, windows of dates."""

from __future__ import annotations

from pyspark.sql import functions as F

from regwise.operators import audit, layout as L, reconcile as RC, sequence as SQ
from workload import oracle as O
from workload.frames import Frames
from workload.q_master import master_of, registry_of
from workload.registry import query

c = F.col

REMAPS = [RC.Remap("320300.gov.cn/col/col1", "http://new.320300.gov.cn/list.html", "辐射类环评项目", "旧栏目是空壳"),
          RC.Remap("www.3301", "", "", "原栏目无受理"), RC.Remap("340100.gov.cn/sthj", "http://moved.gov.cn/", "", "栏目已迁移")]
BLOCKED = [RC.Blocked("10.0.0.4", "访问受限", "连抓被封"), RC.Blocked("shared.gov.cn", "未核实", "内页失效")]


def decisions(f: Frames):
    return RC.decide(f.entry_log, RC.crawl_counts(f.projects), REMAPS, BLOCKED, "2024-06-01", "2024-05-31")


_nu = O.norm_url("entry_url")
_remap_sql = """CASE WHEN contains(norm, '320300.gov.cn/col/col1') THEN {'new_url': 'http://new.320300.gov.cn/list.html', 'category': '辐射类环评项目', 'status': '', 'note': '旧栏目是空壳', 'kind': 'remap'}
  WHEN contains(norm, '3301') AND contains(norm, 'www.3301') THEN {'new_url': entry_url, 'category': '', 'status': '', 'note': '原栏目无受理', 'kind': 'remap'}
  WHEN contains(norm, '340100.gov.cn/sthj') THEN {'new_url': 'http://moved.gov.cn/', 'category': '', 'status': '', 'note': '栏目已迁移', 'kind': 'remap'}
  WHEN string_split(norm, '/')[1] = '10.0.0.4' THEN {'new_url': '', 'category': '', 'status': '访问受限', 'note': '连抓被封', 'kind': 'blocked'}
  WHEN string_split(norm, '/')[1] = 'shared.gov.cn' THEN {'new_url': '', 'category': '', 'status': '未核实', 'note': '内页失效', 'kind': 'blocked'}
  WHEN crawled > 0 THEN {'new_url': '', 'category': '', 'status': '已核实', 'note': '2024-05-31 实爬：该入口抓到 ' || crawled || ' 条受理公告明细', 'kind': 'crawled'}
  ELSE {'new_url': '', 'category': '', 'status': '', 'note': '', 'kind': ''} END"""
O.relation("crawl_counts", "projects", f"SELECT {_nu} AS norm, count(*) AS crawled FROM projects GROUP BY 1")
O.relation("decisions", "entry_log crawl_counts", f"""SELECT entry_url, d.new_url, d.category, d.status, d.note, d.kind, '2024-06-01' AS decided_on FROM (
  SELECT entry_url, {_remap_sql} AS d FROM (SELECT DISTINCT entry_url, {_nu} AS norm FROM entry_log WHERE entry_url <> '') LEFT JOIN crawl_counts USING (norm))""")


@query("jon_20_remap", "SELECT entry_url, new_url, category, note FROM decisions WHERE kind = 'remap'")
def remap_q(f: Frames):
    return decisions(f).filter("kind = 'remap'").select("entry_url", "new_url", "category", "note")


@query("jon_21_blocked_hosts", "SELECT entry_url, status, note FROM decisions WHERE kind = 'blocked'")
def blocked_q(f: Frames):
    return decisions(f).filter("kind = 'blocked'").select("entry_url", "status", "note")


@query("jon_22_crawl_evidence", "SELECT entry_url, status, note FROM decisions WHERE kind = 'crawled'")
def crawled_q(f: Frames):
    return decisions(f).filter("kind = 'crawled'").select("entry_url", "status", "note")


_touch = """CASE WHEN kind = 'remap' AND new_url <> '' THEN new_url ELSE entry_url END AS entry_url, CASE WHEN kind = 'remap' AND category <> '' THEN category ELSE entry_category END AS entry_category,
  CASE WHEN coalesce(status, '') <> '' THEN status ELSE verify_status END AS verify_status,
  CASE WHEN kind IN ('remap', 'blocked') OR (kind = 'crawled' AND status <> verify_status) THEN decided_on ELSE verify_date END AS verify_date"""
O.relation("reconciled", "full_master decisions", f"""SELECT unit_uid, {_touch}, CASE WHEN coalesce(kind, '') <> '' THEN note ELSE crawl_note END AS crawl_note FROM full_master LEFT JOIN decisions USING (entry_url)""")
ENTRY_COLS = ["entry_url", "entry_category", "verify_status", "verify_date", "crawl_note"]


@query("jon_32_reconcile_master", "SELECT * FROM reconciled")
def reconcile_q(f: Frames):
    return RC.reconcile_master(master_of(f), decisions(f)).select("unit_uid", *ENTRY_COLS)


@query("jon_32_reconcile_registry", f"SELECT entry_id, {_touch}, regexp_replace(CASE WHEN kind = 'remap' AND new_url <> '' THEN new_url ELSE entry_url END, '^https?://([^/]+).*$', '\\1') AS domain FROM registry LEFT JOIN decisions USING (entry_url)")
def reconcile_registry_q(f: Frames):
    return RC.reconcile_registry(registry_of(f), decisions(f)).select("entry_id", "entry_url", "entry_category", "verify_status", "verify_date", "domain")


@query("jon_32_reconcile_log", """SELECT ord, CASE WHEN kind = 'remap' AND new_url <> entry_url THEN new_url ELSE entry_url END AS entry_url,
  CASE WHEN kind = 'remap' AND new_url <> entry_url THEN decided_on ELSE verify_date END AS verify_date FROM entry_log LEFT JOIN decisions USING (entry_url)""")
def reconcile_log_q(f: Frames):
    return RC.reconcile_log(f.entry_log, decisions(f)).select("ord", "entry_url", "verify_date")


_long = lambda rel: " UNION ALL ".join(f"SELECT unit_uid, '{x}' AS col, {x} AS v FROM {rel}" for x in ENTRY_COLS)


@query("snk_07_change_log", f"""SELECT unit_uid, col AS "column", a.v AS old_value, b.v AS new_value FROM ({_long('full_master')}) a JOIN ({_long('reconciled')}) b USING (unit_uid, col) WHERE a.v IS DISTINCT FROM b.v""")
def change_log_q(f: Frames):
    master = master_of(f)
    return RC.change_log(master, RC.reconcile_master(master, decisions(f)), "unit_uid", ENTRY_COLS)


@query("snk_07_change_counts", f"""SELECT col AS "column", count(*) AS changes, count(DISTINCT unit_uid) AS touched FROM ({_long('full_master')}) a JOIN ({_long('reconciled')}) b USING (unit_uid, col) WHERE a.v IS DISTINCT FROM b.v GROUP BY 1""")
def change_counts_q(f: Frames):
    master = master_of(f)
    return RC.change_counts(RC.change_log(master, RC.reconcile_master(master, decisions(f)), "unit_uid", ENTRY_COLS), "unit_uid")


@query("snk_06_fill_blanks", """SELECT m.unit_uid, coalesce(nullif(m.verify_status, ''), r.verify_status) AS verify_status, coalesce(nullif(m.crawl_note, ''), r.crawl_note) AS crawl_note
  FROM full_master m JOIN reconciled r USING (unit_uid)""")
def fill_q(f: Frames):
    master = master_of(f)
    new = RC.reconcile_master(master, decisions(f))
    return RC.fill_blanks(master.select("unit_uid", "verify_status", "crawl_note"), new, "unit_uid", ["verify_status", "crawl_note"])


@query("snk_06_fill_conflicts", """SELECT unit_uid, 'verify_status' AS "column", m.verify_status AS old_value, r.verify_status AS new_value FROM full_master m JOIN reconciled r USING (unit_uid)
  WHERE m.verify_status <> '' AND m.verify_status <> r.verify_status""")
def conflicts_q(f: Frames):
    master = master_of(f)
    return RC.fill_conflicts(master, RC.reconcile_master(master, decisions(f)), "unit_uid", ["verify_status"])


# --- sheet layout -------------------------------------------------------------

O.relation("sheet", "area", """SELECT code, row_number() OVER (ORDER BY code) AS ord FROM (SELECT DISTINCT prov_code AS code FROM area UNION SELECT DISTINCT city_code FROM area UNION SELECT district_code FROM area WHERE district_ord < 3 UNION SELECT '999999' FROM region)""")


def sheet(f: Frames):
    one = lambda col, df=f.area: df.select(c(col).alias("code"))
    codes = (one("prov_code").union(one("city_code")).union(one("district_code", f.area.filter("district_ord < 3")))
             .union(f.region.select((c("r_regionkey") * 0 + 999999).cast("string"))).distinct())
    return codes.withColumn("ord", c("code").cast("long"))


O.relation("sheet_units", "proc_units zones area p_dist", """SELECT u.*, k.code FROM (SELECT u.*, coalesce(z.district_short, u.area) AS a FROM proc_units u
    LEFT JOIN (SELECT * FROM zones WHERE confirmed = '是' AND district_short <> '') z ON z.prov_code = u.prov_code AND z.city = u.city AND z.source_label = u.area WHERE u.role <> '其他部门') u
  LEFT JOIN (SELECT prov_code, city, area, max(code) AS code FROM (SELECT DISTINCT prov_code, '—' AS city, '省级' AS area, prov_code AS code FROM area UNION SELECT prov_code, city_name, '市本级', city_code FROM area
    UNION SELECT prov_code, city_name, dcore, district_code FROM p_dist UNION SELECT prov_code, city_name, district_short, district_code FROM p_dist) GROUP BY 1, 2, 3) k
    ON k.prov_code = u.prov_code AND k.city = u.city AND k.area = u.a""")


def sheet_units(f: Frames):
    from regwise.operators.units import approvers
    return L.with_code(approvers(f.units), f.area, f.zones)


@query("jon_16_area_to_code", "SELECT prov_code, city, area, unit, code FROM sheet_units")
def code_q(f: Frames):
    return sheet_units(f).select("prov_code", "city", "area", "unit", "code")


O.relation("code_names", "area", """SELECT DISTINCT prov_code AS code, prov_short, '' AS city_short, '' AS district_short FROM area UNION SELECT city_code, prov_short, city_short, '' FROM area
  UNION SELECT district_code, prov_short, city_short, district_short FROM area""")
O.relation("layout", "sheet sheet_units code_names entries", """SELECT s.ord, s.code, coalesce(n.prov_short, '') AS prov_short, coalesce(n.city_short, '') AS city_short, coalesce(n.district_short, '') AS district_short,
  coalesce(u.unit, '') AS unit, coalesce(e.home_url, '') AS home_url, coalesce(e.entry_url, '') AS entry_url, coalesce(u.pos, 1) AS pos FROM sheet s
  LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY code ORDER BY record_count DESC, city, unit, area) AS pos FROM sheet_units WHERE code IS NOT NULL) u ON u.code = s.code
  LEFT JOIN code_names n ON n.code = s.code LEFT JOIN entries e ON e.prov_code = u.prov_code AND e.city = u.city AND e.unit = u.unit""")


@query("jon_17_sheet_layout", "SELECT code, prov_short, city_short, district_short, unit, home_url, entry_url, pos > 1 AS is_new FROM layout")
def layout_q(f: Frames):
    from regwise.operators.entries import latest_entries
    return L.sheet_layout(sheet(f), sheet_units(f), f.area, latest_entries(f.entry_log)).drop("row_no")


@query("win_10_layout_rows", "SELECT code, unit, pos > 1 AS is_new, row_number() OVER (ORDER BY ord, code, pos) - 1 AS row_no FROM layout")
def layout_rows_q(f: Frames):
    from regwise.operators.entries import latest_entries
    return L.sheet_layout(sheet(f), sheet_units(f), f.area, latest_entries(f.entry_log)).select("code", "unit", "is_new", "row_no")


@query("jon_17_layout_issues", """SELECT 'no_unit' AS kind, code AS key FROM sheet WHERE code NOT IN (SELECT code FROM sheet_units WHERE code IS NOT NULL)
  UNION ALL SELECT 'not_in_tree', code FROM sheet WHERE code NOT IN (SELECT code FROM code_names)
  UNION ALL SELECT 'unmatched', prov_code || '|' || city || '|' || area || '|' || unit FROM sheet_units WHERE code IS NULL OR code NOT IN (SELECT code FROM sheet)""")
def issues_q(f: Frames):
    return L.layout_issues(sheet(f), sheet_units(f), f.area)


# --- order-dependent cells ---------------------------------------------------------

O.relation("cells", "orders", "SELECT o_orderkey AS n, CASE WHEN o_orderkey % 9 = 0 OR (o_orderkey % 1000) > 700 THEN '' ELSE 'C' || o_custkey END AS city, o_orderstatus FROM orders")


def sheet_cells(f: Frames):
    blank = (c("o_orderkey") % 9 == 0) | (c("o_orderkey") % 1000 > 700)
    return f.orders.select(c("o_orderkey").alias("n"), F.when(blank, "").otherwise(F.concat(F.lit("C"), c("o_custkey").cast("string"))).alias("city"), "o_orderstatus")


@query("win_08_forward_fill", "SELECT n, coalesce(last_value(nullif(city, '') IGNORE NULLS) OVER (ORDER BY n ROWS UNBOUNDED PRECEDING), '') AS city FROM cells")
def fill_forward_q(f: Frames):
    return SQ.forward_fill(sheet_cells(f), [c("n")], "city").select("n", "city")


@query("win_09_runs", """SELECT min(n) AS first, max(n) AS last, count(*) AS size FROM (SELECT n, n - row_number() OVER (ORDER BY n) AS g FROM cells WHERE o_orderstatus <> 'F') GROUP BY g""")
def runs_q(f: Frames):
    return SQ.runs(sheet_cells(f).filter("o_orderstatus <> 'F'").select("n"), "n")


@query("win_14_capped_windows", """WITH RECURSIVE w AS (SELECT event_type, d0, d1 FROM (SELECT DISTINCT event_type FROM events), (SELECT min(CAST(ts AS DATE)) AS d0, max(CAST(ts AS DATE)) AS d1 FROM events)
  UNION ALL SELECT event_type, CASE h WHEN 0 THEN d0 ELSE d0 + CAST((d1 - d0) // 2 AS INT) + 1 END, CASE h WHEN 0 THEN d0 + CAST((d1 - d0) // 2 AS INT) ELSE d1 END
    FROM w, (VALUES (0), (1)) t(h) WHERE d0 < d1 AND (SELECT count(*) FROM events e WHERE e.event_type = w.event_type AND CAST(e.ts AS DATE) BETWEEN w.d0 AND w.d1) >= 150)
  SELECT event_type, CAST(d0 AS VARCHAR) AS d0, CAST(d1 AS VARCHAR) AS d1, n, n >= 150 AS over_cap FROM (
    SELECT *, (SELECT count(*) FROM events e WHERE e.event_type = w.event_type AND CAST(e.ts AS DATE) BETWEEN w.d0 AND w.d1) AS n FROM w) WHERE NOT (n >= 150 AND d0 < d1)""")
def windows_q(f: Frames):
    daily = f.events.groupBy("event_type", F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    first, last = f.events.agg(F.min(F.to_date("ts")), F.max(F.to_date("ts"))).first()
    out = L.capped_windows(daily, ["event_type"], F.lit(first), F.lit(last), 150)
    return out.select("event_type", c("d0").cast("string").alias("d0"), c("d1").cast("string").alias("d1"), "n", "over_cap")


# --- probes ----------------------------------------------------------------------

_probe = """SELECT x.prov_code AS prov, x.city_name AS city, x.stage, x.n_official, x.n_external, x.n_all, x.error FROM (
  SELECT n.prov_code, n.city_name, CASE CAST(n.seq % 4 AS INT) WHEN 0 THEN '受理' WHEN 1 THEN '拟审批' WHEN 2 THEN '审批决定' ELSE '其他' END AS stage,
    CASE WHEN n.seq % 23 = 0 THEN '123456789012' WHEN n.seq % 29 = 0 THEN lpad('7', 50, '0') ELSE CAST(n.seq % 3 AS STRING) END AS n_official, CAST(n.seq % 2 AS STRING) AS n_external,
    CASE WHEN n.seq % 17 = 0 THEN '附件' WHEN n.seq % 19 = 0 THEN '' ELSE CAST(n.seq % 5 AS STRING) END AS n_all,
    CASE WHEN n.seq % 13 = 0 THEN 'Timeout' ELSE '' END AS error FROM {notices} n) x"""
O.relation("probes", "notices", _probe.format(notices="notices"))


def probes(f: Frames):
    return f.spark.sql(_probe, notices=f.notices)


@query("flt_19_reject_corrupt", "SELECT prov, city, stage, count(*) AS n FROM probes WHERE regexp_matches(n_all, '^[0-9]+$') GROUP BY 1, 2, 3")
def corrupt_q(f: Frames):
    return audit.reject_corrupt(probes(f)).groupBy("prov", "city", "stage").agg(F.count(F.lit(1)).alias("n"))


@query("agg_16_stage_summary", """SELECT prov, city, stage, CAST(CASE stage WHEN '受理' THEN 0 WHEN '拟审批' THEN 1 WHEN '审批决定' THEN 2 ELSE 9 END AS BIGINT) AS stage_order, count(*) AS sampled,
  count(*) FILTER (regexp_full_match(n_official, '[0-9]*[1-9][0-9]*')) AS official, count(*) FILTER (regexp_full_match(n_external, '[0-9]*[1-9][0-9]*')) AS external, count(*) FILTER (regexp_full_match(n_all, '[0-9]*[1-9][0-9]*')) AS any_attachment,
  count(*) FILTER (error <> '') AS errors, CASE WHEN grouping(city) = 1 THEN round(count(*) FILTER (regexp_full_match(n_official, '[0-9]*[1-9][0-9]*')) * 100.0 / count(*)) END AS share
  FROM (SELECT * FROM probes WHERE regexp_matches(n_all, '^[0-9]+$')) GROUP BY GROUPING SETS ((prov, city, stage), (prov, stage))""")
def stage_summary_q(f: Frames):
    return audit.stage_summary(probes(f))
