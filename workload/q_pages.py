"""Queries over page tables: the provided pages and the agency pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from regwise import rules as R
from regwise.functions import page as P
from regwise.functions import url as U
from regwise.operators import pages as PG
from regwise.plans import notices as NP
from workload import oracle as O
from workload.frames import Frames
from workload.q_notices import classification
from workload.registry import query

c = F.col


def dec(x):
    return f"replace(replace(replace(replace({x}, '&lt;', '<'), '&gt;', '>'), '&copy;', '©'), '&amp;', '&')"


def site(x):
    return f"regexp_extract({x}, '^[A-Za-z]+://[^/?#]*', 0)"


def join_sql(base, href):
    """Absolute address for the hrefs of the tables: absolute, rooted, one level up, relative."""
    folder = f"regexp_replace(regexp_extract({base}, '^[^?#]*', 0), '[^/]*$', '')"
    return (f"CASE WHEN {href} LIKE 'http%' THEN {href} WHEN starts_with({href}, '/') THEN {site(base)} || {href} "
            f"WHEN starts_with({href}, '../') THEN regexp_replace({folder}, '[^/]+/$', '') || substr({href}, 4) ELSE {folder} || {href} END")


O.relation("all_pages", "pages notice_pages", """SELECT 'p' || page_id AS page_id, url, html FROM pages UNION ALL SELECT 'n' || page_id, url, html FROM notice_pages""")


def both(f: Frames):
    tag = lambda df, p: df.select(F.concat(F.lit(p), c("page_id").cast("string")).alias("page_id"), "url", "html")
    return tag(f.pages, "p").unionByName(tag(f.notice_pages, "n"))


O.relation("a_raw", "all_pages", r"""SELECT page_id, page_url, pos, regexp_extract(a, '^(<a\b[^>]*>)', 1) AS tag, regexp_extract(a, '(?s)^<a\b[^>]*>(.*?)</a>', 1) AS inner_html FROM (
  SELECT page_id, url AS page_url, unnest(regexp_extract_all(html, '(?s)<a\b[^>]*>.*?</a>')) AS a, generate_subscripts(regexp_extract_all(html, '(?s)<a\b[^>]*>.*?</a>'), 1) - 1 AS pos FROM all_pages)""")
_href1 = dec("""regexp_extract(tag, 'href=["'']([^"'']*)["'']', 1)""")
O.relation("links", "a_raw", f"""SELECT page_id, page_url, pos, CASE WHEN href LIKE 'http%' THEN href WHEN starts_with(href, '/') THEN {site('page_url')} || href
    ELSE {site('page_url')} || '/' || regexp_replace(href, '^(\\.\\./)+', '') END AS url, {O.strip(dec('txt'))} AS title FROM (
  SELECT *, {_href1} AS href, CASE WHEN trim(regexp_extract(tag, 'title=["'']([^"'']*)["'']', 1)) <> '' THEN regexp_extract(tag, 'title=["'']([^"'']*)["'']', 1)
    ELSE regexp_replace(inner_html, '<[^>]+>', '', 'g') END AS txt FROM a_raw)
  WHERE href <> '' AND NOT {O.has('href', R.LIST_LINK)} AND {O.has('href', R.ARTICLE_LINK)}""")


@query("htm_01_extract_links", "SELECT page_id, page_url, CAST(pos AS BIGINT) AS pos, url, title FROM links")
def links_q(f: Frames):
    return PG.extract_links(both(f))


_text = "regexp_replace(inner_html, '<[^>]+>|[\\s　]+', '', 'g')"
O.relation("anchors", "a_raw", f"""SELECT page_id, page_url, pos, CASE WHEN att <> '' AND (length(txt) < 2 OR ends_with(txt, '...') OR ends_with(txt, '…')) THEN att ELSE txt END AS text,
    regexp_replace({join_sql('page_url', 'href')}, '\\?t=_blank.*$', '') AS url FROM (SELECT *, trim(regexp_extract(tag, 'href=["'']([^"''#]+)', 1)) AS href,
  regexp_extract(tag, 'title=["'']([^"'']+)', 1) AS att, {_text} AS txt FROM a_raw) WHERE href <> ''""")


@query("htm_02_extract_anchors", "SELECT page_id, page_url, CAST(pos AS BIGINT) AS pos, text, url FROM anchors")
def anchors_q(f: Frames):
    return PG.extract_anchors(both(f))


_cands = """[regexp_extract(html, '<meta\\b[^>]*name=["'']ArticleTitle["''][^>]*content=["'']([^"'']*)["'']', 1),
  regexp_extract(html, '<h1\\b[^>]*>(?:\\s*<[^>]*>)*([^<]+)', 1), regexp_extract(html, '<title\\b[^>]*>([^<]*)', 1)]"""
_pick = f"list_filter(list_transform({_cands}, lambda t: {O.strip(f'''string_split_regex({O.strip(f'''regexp_replace({dec('t')}, '[{chr(92)}s　]+', ' ', 'g')''')}, '[{chr(92)}s　]*[|_][{chr(92)}s　]*')[1]''')}), lambda t: length(t) > 8)"


@query("htm_03_page_title", f"SELECT page_id, coalesce({_pick}[1], '') AS title FROM all_pages")
def title_q(f: Frames):
    return PG.page_titles(both(f))


def cell_list(x):
    return (f"list_transform(regexp_extract_all({x}, '(?is)<t[dh]\\b[^>]*>(.*?)</t[dh]>', 1), "
            f"lambda z: {O.strip(f'''regexp_replace(regexp_replace(z, '<[^>]+>', '', 'g'), '[{chr(92)}s　]+', ' ', 'g')''')})")


O.relation("inner_tables", "notice_pages", r"""SELECT page_id, t, regexp_extract(part, '(?is)^(.*?)</table', 1) AS body FROM (
  SELECT page_id, unnest(parts[2:]) AS part, generate_subscripts(parts[2:], 1) AS t FROM (SELECT page_id, string_split_regex(html, '(?i)<table\b') AS parts FROM notice_pages)) WHERE contains(part, '</table')""")
O.relation("inner_rows", "inner_tables", f"""SELECT page_id, t, r, {cell_list('row_html')} AS cells FROM (
  SELECT page_id, t, unnest(rows) AS row_html, generate_subscripts(rows, 1) - 1 AS r FROM (SELECT page_id, t, string_split_regex(body, '(?i)<tr\\b')[2:] AS rows FROM inner_tables))""")
O.relation("inner_heads", "inner_rows", f"""SELECT page_id, t, min(r) AS head, arg_min(fields, r) AS fields FROM (
  SELECT *, list_transform(cells, lambda z: {O.field("regexp_replace(z, '[{0}s　]+', '', 'g')".format(chr(92)))}) AS fields FROM inner_rows WHERE r < 3 AND len(cells) >= 4) WHERE list_contains(fields, '建设地点') GROUP BY 1, 2""")


def hval(f):
    return f"CASE WHEN list_contains(fields, '{f}') THEN coalesce(cells[len(fields) + 1 - list_position(list_reverse(fields), '{f}')], '') ELSE '' END"


O.relation("horizontal", "inner_rows inner_heads", f"""SELECT page_id, name, location, builder, i FROM (
  SELECT *, row_number() OVER (PARTITION BY page_id, t ORDER BY r) AS i, count(*) OVER (PARTITION BY page_id, t) AS k FROM (
    SELECT r.page_id, r.t, r.r, {hval('项目名称')} AS name, {hval('建设地点')} AS location, {hval('建设单位')} AS builder FROM inner_rows r JOIN inner_heads h ON r.page_id = h.page_id AND r.t = h.t AND r.r > h.head)
  WHERE location <> '' AND NOT contains(location, '建设地点')) QUALIFY dense_rank() OVER (PARTITION BY page_id ORDER BY k DESC, t) = 1""")


def flat(df, column):
    rec = lambda k: c("r")[k]
    return df.select("page_id", F.posexplode(column).alias("i", "r")).select(
        "page_id", (c("i") + 1).cast("long").alias("i"), rec("项目名称").alias("name"), rec("建设地点").alias("location"), rec("建设单位").alias("builder"))


@query("htm_04_horizontal_tables", "SELECT page_id, i, name, location, builder FROM horizontal")
def horizontal_q(f: Frames):
    return flat(PG.page_records(f.notice_pages), "horizontal")


O.relation("all_rows", "notice_pages", f"""SELECT page_id, r, {cell_list('row_html')} AS cells FROM (
  SELECT page_id, unnest(rows) AS row_html, generate_subscripts(rows, 1) AS r FROM (SELECT page_id, string_split_regex(html, '(?i)<tr\\b')[2:] AS rows FROM notice_pages))""")
_lab = "regexp_replace(cells[1], '[\\s　]+', '', 'g')"
O.relation("vertical", "all_rows", f"""SELECT page_id, coalesce(max(v) FILTER (f = '项目名称'), '') AS name, max(v) FILTER (f = '建设地点') AS location, coalesce(max(v) FILTER (f = '建设单位'), '') AS builder, coalesce(max(v) FILTER (f = '环评机构'), '') AS agency FROM (
  SELECT page_id, f, arg_min(v, r) AS v FROM (SELECT page_id, r, {O.field(_lab)} AS f, cells[2] AS v FROM all_rows WHERE len(cells) >= 2) WHERE f <> '' AND v <> '' GROUP BY 1, 2)
  GROUP BY 1 HAVING max(v) FILTER (f = '建设地点') IS NOT NULL""")


@query("htm_05_vertical_tables", "SELECT page_id, 1::BIGINT AS i, name, location, builder FROM vertical")
def vertical_q(f: Frames):
    return flat(PG.page_records(f.notice_pages), "vertical")


_in = "'(项目名称|建设地点|建设地址|建设单位|环境影响评价机构|环评机构|受理日期)[：:]\\s*([^；;]{1,120}?)\\s*(?:[；;]|$)'"
_body = "regexp_replace(regexp_replace(html, '<[^>]+>', '', 'g'), '[\\s　]+', ' ', 'g')"
O.relation("inline_rows", "notice_pages", f"""SELECT page_id, coalesce(max(v) FILTER (f = '项目名称'), '') AS name, max(v) FILTER (f = '建设地点') AS location, coalesce(max(v) FILTER (f = '建设单位'), '') AS builder FROM (
  SELECT page_id, f, arg_min(v, r) AS v FROM (SELECT page_id, r, {O.field('lab')} AS f, v FROM (
    SELECT page_id, unnest(regexp_extract_all({_body}, {_in}, 1)) AS lab, unnest(regexp_extract_all({_body}, {_in}, 2)) AS v, generate_subscripts(regexp_extract_all({_body}, {_in}, 2), 1) AS r FROM notice_pages))
  WHERE f <> '' AND v <> '' GROUP BY 1, 2) GROUP BY 1 HAVING max(v) FILTER (f = '建设地点') IS NOT NULL""")


@query("htm_06_inline_fields", "SELECT page_id, 1::BIGINT AS i, name, location, builder FROM inline_rows")
def inline_q(f: Frames):
    return flat(PG.page_records(f.notice_pages), "inline")


O.relation("page_rows", "horizontal vertical inline_rows", """SELECT page_id, i, name, location, builder, '' AS agency FROM horizontal
  UNION ALL SELECT page_id, 1, name, location, builder, agency FROM vertical v ANTI JOIN horizontal h USING (page_id)
  UNION ALL SELECT page_id, 1, name, location, builder, '' FROM inline_rows n ANTI JOIN horizontal h USING (page_id) ANTI JOIN vertical v USING (page_id)""")


@query("htm_07_parse_notice_page", f"""SELECT p.page_id, {O.source(_body)} AS source, coalesce({_pick}[1], '') AS title, r.i, coalesce(r.name, '') AS name, coalesce(r.location, '') AS location
  FROM notice_pages p LEFT JOIN page_rows r USING (page_id)""")
def parse_q(f: Frames):
    parsed = PG.parse_notice_pages(f.notice_pages)
    out = parsed.select("page_id", "source", "title", F.posexplode_outer("recs").alias("i", "r"))
    blank = lambda k: F.coalesce(c("r")[k], F.lit(""))
    return out.select("page_id", "source", "title", (c("i") + 1).cast("long").alias("i"), blank("项目名称").alias("name"), blank("建设地点").alias("location"))


O.relation("pg_n_in", "notice_pages page_rows p_city", f"""SELECT *, {O.bracket('title')} AS bracket FROM (SELECT p.page_id AS ord, c.prov_code, c.city_name, c.city_code,
  regexp_extract(p.url, '^(https?://[^/]+)/', 1) || '/col/col1/index.html' AS entry_url, p.url, coalesce({_pick}[1], '') AS title, {O.source(_body)} AS source,
  coalesce(r.locations, []) AS locations, '' AS channel_org, r.names, r.builders, r.agencies FROM notice_pages p JOIN p_city c ON c.city_code = regexp_extract(p.url, 'sthj(\\d+)', 1)
  LEFT JOIN (SELECT page_id, list(location ORDER BY i) AS locations, list(name ORDER BY i) AS names, list(builder ORDER BY i) AS builders, list(agency ORDER BY i) AS agencies
    FROM page_rows GROUP BY 1) r USING (page_id))""")
classification("pg_")


@query("htm_07_pages_to_projects", f"""SELECT city_name AS "城市", entry_url AS "入口URL", url AS "公告URL", title AS "标题", {O.first('title', R.NOTICE_DATE)} AS "发布日期", approval_org AS "发文机关",
  approval_district AS "审批地区", coalesce(names[i], '') AS "项目名称", coalesce(locations[i], '') AS "建设地点", coalesce(project_districts[i], '') AS "项目地区",
  coalesce(builders[i], '') AS "建设单位", coalesce(agencies[i], '') AS "环评机构", CASE WHEN radiation THEN '是' ELSE '否' END AS "是否辐射", bracket_meaning AS "括号语义"
  FROM (SELECT *, unnest(range(1, greatest(len(project_districts), 1) + 1)) AS i FROM pg_cls)""")
def pages_to_projects_q(f: Frames):
    """Page parsing, classification and project rows in one plan."""
    parsed = PG.parse_notice_pages(f.notice_pages)
    where = f.area.select("prov_code", "city_code", "city_name").distinct()
    notices = (parsed.withColumn("city_code", F.regexp_extract("url", "sthj(\\d+)", 1)).join(where, "city_code")
               .withColumn("channel_org", F.lit("")).withColumn("entry_url", U.column_of(c("url"))))
    return NP.project_rows(NP.classify(notices, f.places))


_jp = lambda k: f"regexp_extract(html, '{k}[\"'']?\\s*[:=]\\s*[\"'']([^\"'']+)', 1)"


_proxy = "regexp_extract(html, 'proxyUrl:''([^'']+)''', 1)"
_area = """regexp_extract(html, 'tree\\.jsp\\?area=([^&"'']+)', 1)"""
_col = "regexp_extract(url, 'col(\\d+)', 1)"
_column = "regexp_extract(html, 'columnId:''([^'']+)''', 1)"
_data = """replace(regexp_extract(html, 'dataproxy\\.jsp\\?([^''"]+)', 1), '&amp;', '&')"""
_search = "CASE WHEN contains(url, '?') THEN regexp_replace(url, '^[^?]*[?]', '') ELSE '' END"
# the pairs of an address, sorted
_pairs = lambda x: f"""array_to_string(list_sort(list_filter(string_split({x}, '&'), lambda p: p <> '')), '&')"""
_families = f"""SELECT page_id, url, html, CASE WHEN contains(html, 'dataproxy.jsp') THEN 'dahan' WHEN contains(html, 'module/xxgk/') AND {_area} <> '' THEN 'xxgk'
    WHEN contains(html, 'messageController/getMessage.do') AND {_column} <> '' THEN 'truecms'
    WHEN contains(html, 'jpaas-publish-server') AND {_jp('webId')} <> '' AND {_jp('pageId')} <> '' AND {_jp('tplSetId')} <> '' THEN 'jpaas'
    WHEN contains(url, 'govInfoPub') OR contains(html, 'EWB-FRONT') THEN 'ewb' ELSE 'static' END AS family FROM all_pages"""


@query("htm_08_classify_cms", f"""SELECT page_id, url, family, CASE family
    WHEN 'dahan' THEN 'api=' || {site('url')} || CASE WHEN {_proxy} <> '' THEN {_proxy} ELSE '/module/web/jpage/dataproxy.jsp' END || '&' || {_pairs(_data)}
    WHEN 'xxgk' THEN 'api=' || {site('url')} || '/module/xxgk/search.jsp&area=' || {_area} || '&only=' || CASE WHEN {_col} <> '' THEN 'art_' || {_col} || '_' ELSE '' END
    WHEN 'truecms' THEN 'api=' || {site('url')} || {_proxy} || '&column_id=' || {_column}
    WHEN 'jpaas' THEN 'api=' || {site('url')} || '/api-gateway/jpaas-publish-server/front/page/build/unit&pageId=' || {_jp('pageId')} || '&tagId=' || {_jp('tagId')} || '&tplSetId=' || {_jp('tplSetId')} || '&webId=' || {_jp('webId')}
    WHEN 'ewb' THEN {_pairs(_search)} ELSE '' END AS params FROM ({_families})""")
def cms_q(f: Frames):
    pairs = F.transform(F.array_sort(F.map_entries("params")), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return PG.cms_families(both(f)).select("page_id", "url", "family", F.array_join(pairs, "&").alias("params"))


@query("htm_09_block_tags", """SELECT page_id, array_to_string(list_distinct_ordered, ',') AS tags FROM (SELECT page_id, list_filter(t, lambda x, i: list_position(t, x) = i) AS list_distinct_ordered FROM (
  SELECT page_id, regexp_extract_all(html, 'tag[Ii]d["'']?\\s*[:=]\\s*["'']([^"'']+)', 1) AS t FROM all_pages))""")
def tags_q(f: Frames):
    return both(f).select("page_id", F.array_join(P.block_tags(c("html")), ",").alias("tags"))


@query("htm_10_inner_frame", f"""SELECT page_id, coalesce(list_filter(list_transform(regexp_extract_all(html, '<iframe[^>]*src=["'']([^"'']+)', 1), lambda s: {join_sql('url', "replace(s, '&amp;', '&')")}),
  lambda u: {site('u')} = {site('url')} AND NOT {O.has('u', R.FRAME_SKIP)})[1], '') AS frame FROM all_pages""")
def frame_q(f: Frames):
    return both(f).select("page_id", P.inner_frame(c("html"), c("url")).alias("frame"))


@query("htm_11_js_redirect", f"""SELECT page_id, CASE WHEN t <> '' AND length(html) <= 4000 THEN {site('url')} || t ELSE '' END AS target FROM (
  SELECT *, regexp_extract(html, 'location\\.href\\s*=\\s*["'']([^"'']+)["'']', 1) AS t FROM all_pages)""")
def redirect_q(f: Frames):
    return both(f).select("page_id", P.js_redirect(c("html"), c("url")).alias("target"))


_base, _q = "string_split(url, '?')[1]", "CASE WHEN contains(url, '?') THEN nullif(regexp_replace(url, '^[^?]*', ''), '?') ELSE '' END"


@query("htm_12_page_url_candidates", f"""SELECT url, i, x AS candidate FROM (SELECT url, unnest(l) AS x, generate_subscripts(l, 1)::BIGINT AS i FROM (
  SELECT url, CASE WHEN contains(b, '.') THEN [regexp_extract(b, '^(.*)\\.[^.]*$', 1) || '_1.' || regexp_extract(b, '\\.([^.]*)$', 1) || q, regexp_extract(b, '^(.*)\\.[^.]*$', 1) || '_2.' || regexp_extract(b, '\\.([^.]*)$', 1) || q,
    regexp_extract(b, '^(.*)/[^/]*$', 1) || '/index_1.html' || q, regexp_extract(b, '^(.*)/[^/]*$', 1) || '/index_2.html' || q]
    ELSE [regexp_replace(b, '/+$', '') || '/2' || q, regexp_replace(b, '/+$', '') || '/index_1.html' || q, regexp_replace(b, '/+$', '') || '/index_2.html' || q] END AS l
  FROM (SELECT url, {_base} AS b, coalesce({_q}, '') AS q FROM (SELECT url FROM pages UNION SELECT entry_url FROM entry_log UNION SELECT 'http://a/class/XY/' FROM region))))""")
def candidates_q(f: Frames):
    urls = f.pages.select("url").union(f.entry_log.select("entry_url")).union(f.region.select(F.lit("http://a/class/XY/"))).distinct()
    each = urls.select("url", F.posexplode(U.page_url_candidates(c("url"), F.lit(2))).alias("i", "candidate"))
    return each.select("url", (c("i") + 1).cast("long").alias("i"), "candidate")


O.relation("own_anchors", "anchors", f"SELECT * FROM anchors WHERE text <> '' AND {O.host('url')} = {O.host('page_url')}")
_colu = "CASE WHEN regexp_extract(url, '^(.*?/col/col\\d+)/', 1) <> '' THEN regexp_extract(url, '^(.*?/col/col\\d+)/', 1) || '/index.html' WHEN regexp_matches(url, {a}) THEN regexp_extract(url, {a}, 1) || '/col/col' || regexp_extract(url, {a}, 2) || '/index.html' END".replace("{a}", "'^(https?://[^/]+)/art/\\d{4}/\\d+/\\d+/art_(\\d+)_\\d+\\.html'")


@query("htm_13_candidate_columns", f"""SELECT page_url AS site, col AS column_url, arg_min(ev, (page_id, pos)) AS evidence FROM (SELECT *, CASE WHEN {O.has('text', R.NOTICE_TEXT)} THEN {_colu}
    WHEN length(text) <= 24 AND NOT {O.has('url', R.SKIP_LINK)} AND {O.has('text', R.CHANNEL_TEXT)} THEN url END AS col,
  CASE WHEN {O.has('text', R.NOTICE_TEXT)} THEN '公告：' || substr(text, 1, 30) ELSE text END AS ev FROM own_anchors) WHERE col IS NOT NULL GROUP BY 1, 2""")
def columns_q(f: Frames):
    return PG.candidate_columns(PG.extract_anchors(both(f)))


O.relation("web", "orders lineitem", """SELECT 'c' || o_custkey AS src, 'o' || o_orderkey AS dst, o_orderkey AS pos FROM orders
  UNION ALL SELECT 'o' || l_orderkey, 'p' || l_partkey, l_linenumber * 100000 + l_partkey FROM lineitem
  UNION ALL SELECT 'p' || l_partkey, 's' || l_suppkey, l_suppkey FROM lineitem""")


def web(f: Frames):
    name = lambda p, x: F.concat(F.lit(p), c(x).cast("string"))
    edge = lambda df, a, b, pos: df.select(a.alias("src"), b.alias("dst"), pos.cast("long").alias("pos"))
    return (edge(f.orders, name("c", "o_custkey"), name("o", "o_orderkey"), c("o_orderkey"))
            .unionByName(edge(f.lineitem, name("o", "l_orderkey"), name("p", "l_partkey"), c("l_linenumber") * 100000 + c("l_partkey")))
            .unionByName(edge(f.lineitem, name("p", "l_partkey"), name("s", "l_suppkey"), c("l_suppkey"))))


def _level(prev, k):
    return f"""l{k} AS (SELECT site, dst AS url, {k} AS depth, visit FROM (SELECT site, dst, mx + row_number() OVER (PARTITION BY site ORDER BY spot, dst) AS visit FROM (
    SELECT f.site, w.dst, min((f.visit, w.pos)) AS spot FROM {prev} f JOIN web w ON w.src = f.url GROUP BY 1, 2) JOIN (SELECT site, max(visit) AS mx FROM r{k - 1} GROUP BY 1) USING (site)) WHERE visit <= 40),
  r{k} AS (SELECT * FROM r{k - 1} UNION ALL SELECT * FROM l{k})"""


@query("htm_14_bounded_reach", f"""WITH r0 AS (SELECT 'c' || c_custkey AS site, 'c' || c_custkey AS url, 0 AS depth, 1 AS visit FROM customer), {_level('r0', 1)}, {_level('l1', 2)}, {_level('l2', 3)}
  SELECT site, url, CAST(depth AS BIGINT) AS depth, CAST(visit AS BIGINT) AS visit FROM r3""")
def reach_q(f: Frames):
    url = F.concat(F.lit("c"), c("c_custkey").cast("string"))
    return PG.bounded_reach(f.customer.select(url.alias("site"), url.alias("url")), web(f)).select("site", "url", c("depth").cast("long").alias("depth"), "visit")


O.relation("files", "notice_pages", f"""SELECT DISTINCT {site('url')} || '/files/report' || CAST(page_id % 10 AS VARCHAR) || '.pdf' AS url, CAST(page_id % 10 AS BIGINT) * 400000 AS size, CAST(page_id % 10 AS INT) * 8 AS pages FROM notice_pages""")


def files(f: Frames):
    n = c("page_id") % 10
    return f.notice_pages.select(F.concat(P.origin(c("url")), F.lit("/files/report"), n.cast("string"), F.lit(".pdf")).alias("url"),
                                 (n * 400000).alias("size"), (n * 8).cast("int").alias("pages")).distinct()


_lab2 = "regexp_replace(inner_html, '<[^>]+>|[\\s　]+', '', 'g') || ' ' || regexp_extract(tag, 'title=[\"'']([^\"'']*)', 1) || ' ' || url_decode(regexp_extract(full_url, '([^/]*)$', 1))"


@query("htm_15_attachments", f"""WITH a AS (SELECT page_id, pos, full_url, {_lab2} AS label FROM (SELECT *, {join_sql('page_url', 'href')} AS full_url FROM (
    SELECT *, trim(regexp_extract(tag, 'href=["'']([^"'']+)["'']', 1)) AS href FROM a_raw) WHERE href <> '')),
  s AS (SELECT a.*, coalesce(f.size, 0) AS size, f.pages, ends_with(regexp_extract(full_url, '^[A-Za-z]+://([^/?#]*)', 1), '.gov.cn') AS official FROM a LEFT JOIN files f ON f.url = a.full_url
    WHERE {O.has('full_url', R.ATTACHMENT_EXT)} OR {O.has('label', R.ATTACHMENT_EXT)}),
  v AS (SELECT *, {O.is_report('label', 'size', 'pages')} AS report, substr(trim(label), 1, 50) AS shown FROM s)
  SELECT p.page_id, p.url, count(*) FILTER (report AND official) AS n_official, count(*) FILTER (report AND NOT official) AS n_external, count(v.page_id) AS n_all,
    coalesce(array_to_string(list(shown || ' [' || printf('%.1f', size / 1e6) || 'MB]' ORDER BY pos) FILTER (report AND official)[1:2], ' | '), '') AS samples,
    coalesce(array_to_string(list(shown ORDER BY pos) FILTER (v.page_id IS NOT NULL)[1:4], ' | '), '') AS labels FROM all_pages p LEFT JOIN v USING (page_id) GROUP BY 1, 2""")
def attachments_q(f: Frames):
    return PG.attachments(both(f), files(f))


@query("htm_16_page_text", "SELECT page_id, md5(regexp_replace(html, '<[^>]+>|[\\s　\\x{a0}]+', '', 'g')) AS text FROM all_pages")
def page_text_q(f: Frames):
    return both(f).select("page_id", F.md5(P.page_text(c("html"))).alias("text"))


@query("flt_13_notice_links", f"SELECT page_id, CAST(pos AS BIGINT) AS pos, url, title FROM links WHERE length(title) > 12 AND contains(title, '受理') AND {O.has('url', R.NOTICE_HREF)}")
def notice_links_q(f: Frames):
    return PG.notice_links(PG.extract_links(both(f)), "受理").select("page_id", "pos", "url", "title")


def pre(x):
    return f"array_to_string(string_split(regexp_extract({x}, '^https?://[^/?#]*([^?#]*)', 1), '/')[1:3], '/')"


O.relation("majority_prefix", "links", f"""SELECT page_id, arg_min(p, (-n, o)) AS prefix FROM (SELECT page_id, {pre('url')} AS p, count(*) AS n, min(pos) AS o FROM links GROUP BY 1, 2) GROUP BY 1""")


@query("agg_17_majority_prefix", "SELECT * FROM majority_prefix")
def majority_q(f: Frames):
    return PG.majority(PG.extract_links(both(f)), ["page_id"], U.url_prefix(c("url")), c("pos"), "prefix")


@query("flt_14_same_column", f"""SELECT page_id, CAST(pos AS BIGINT) AS pos, url FROM (SELECT l.*, m.prefix, bool_or({pre('url')} = {pre('page_url')}) OVER (PARTITION BY l.page_id) AS has
  FROM links l JOIN majority_prefix m USING (page_id)) WHERE {pre('url')} = CASE WHEN has THEN {pre('page_url')} ELSE prefix END""")
def same_column_q(f: Frames):
    return PG.same_column(PG.extract_links(both(f))).select("page_id", "pos", "url")


@query("flt_15_hosts", f"""SELECT page_id, CAST(pos AS BIGINT) AS pos, url, {O.host('url')} = {O.host('page_url')} AS same_host,
  ends_with({O.host('url')}, '.gov.cn') OR regexp_matches({O.host('url')}, '^\\d+\\.\\d+\\.\\d+\\.\\d+') AS government FROM anchors""")
def hosts_q(f: Frames):
    return PG.extract_anchors(both(f)).select("page_id", "pos", "url", (U.host(c("url")) == U.host(c("page_url"))).alias("same_host"),
                                              U.is_government(U.host(c("url"))).alias("government"))
