"""Scalar functions over whole frames, reported per distinct value with counts."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Window, functions as F

from regwise import rules as R
from regwise.functions import agency as A
from regwise.functions import collections as C
from regwise.functions import notice as N
from regwise.functions import text as T
from regwise.functions import url as U
from regwise.operators.places import locate, with_function, with_place, zone_in
from workload import oracle as O
from workload.frames import Frames
from workload.registry import query

c = F.col


def per_value(name, frame, cols, spark_cols, sql_cols, source=None):
    """Register: distinct input columns with the computed ones and the row count.

    ``spark_cols`` is called when the query runs, so that importing needs no session.
    """
    source = source or frame
    select = ", ".join([*cols, *[f"{expr} AS {alias}" for alias, expr in sql_cols.items()], "count(*) AS n_rows"])
    width = len(cols) + len(sql_cols)
    check = f"SELECT {select} FROM {source} GROUP BY {', '.join(str(i + 1) for i in range(width))}"

    @query(name, check)
    def run(f: Frames):
        # values are computed once per distinct input, after the counts are combined
        counted = getattr(f, frame).groupBy(*cols).agg(F.count(F.lit(1)).alias("n_rows"))
        return counted.select(*cols, *[e.alias(a) for a, e in spark_cols().items()], "n_rows")

    return run


per_value("scl_01_core", "area", ["city_name", "district_name"],
          lambda: {"city_core": T.core(c("city_name")), "district_core": T.core(c("district_name"))},
          {"city_core": O.core("city_name"), "district_core": O.core("district_name")})
per_value("scl_02_normalize", "records", ["process_department"], lambda: {"name": T.normalize(c("process_department"))},
          {"name": O.normalize("process_department")})
per_value("scl_03_half_width_brackets", "attachments", ["label"], lambda: {"plain": T.half_width_brackets(c("label"))},
          {"plain": "replace(replace(label, '（', '('), '）', ')')"})
per_value("scl_04_split_units", "records", ["combined_units"],
          lambda: {"parts": F.array_join(T.split_units(c("combined_units")), "|"),
           "n_parts": F.size(T.split_units(c("combined_units"))).cast("long")},
          {"parts": f"array_to_string({O.split_units('combined_units')}, '|')",
           "n_parts": f"CAST(len({O.split_units('combined_units')}) AS BIGINT)"})
per_value("scl_05_clean_title", "notices", ["title"], lambda: {"cleaned": T.clean_title(c("title"))},
          {"cleaned": O.clean_title("title")})
per_value("scl_06_publisher_of", "notices", ["title"], lambda: {"publisher": N.publisher_of(c("title"))},
          {"publisher": O.publisher("title")})
per_value("scl_07_stage_of", "notices", ["title"], lambda: {"stage": N.stage_of(c("title"))}, {"stage": O.stage("title")})
per_value("scl_08_role_of", "records", ["process_department"], lambda: {"role": A.role_of(T.normalize(c("process_department")))},
          {"role": O.role(O.normalize("process_department"))})
per_value("scl_12_place_tests", "records", ["process_department"],
          lambda: {"national": A.is_national(c("process_department")), "town": A.town_of(c("process_department")),
           "window_style": A.is_window(c("process_department")),
           "bare": A.without_station(c("process_department"))},
          {"national": O.has("process_department", O.NATION), "town": O.first("process_department", O.TOWN),
           "window_style": O.has("process_department", R.WINDOW),
           "bare": "regexp_replace(process_department, '^驻', '')"})

ONE = R.ONE_CITY


def one_area_sql(x):
    ordered = [*ONE.area_before, *[(d, d) for d in ONE.districts], *ONE.area_after]
    return "CASE " + " ".join(f"WHEN {O.has(x, p)} THEN '{a}'" for p, a in ordered) + " END"


def one_name_sql(x):
    return f"regexp_replace({O.strip(x)}, {O.q(ONE.section)}, '')"


def one_function_sql(x):
    tokens = O.q(f"{ONE.country}|({ONE.zones}|({'|'.join(ONE.districts)})(区|县)?)")
    rest = f"regexp_replace(regexp_replace({x}, {tokens}, '', 'g'), {tokens}, '', 'g')"
    return (f"CASE WHEN {O.has(x, ONE.eco)} THEN '生态环境' WHEN {O.has(x, ONE.admin)} THEN '行政审批' "
            f"WHEN {rest} = '' THEN {x} ELSE {rest} END")


def one_reason_sql(x):
    own = ",".join(O.q(w) for w in [*ONE.own, *ONE.districts])
    blanks = ",".join(O.q(b) for b in R.BLANK_NAMES)
    place = O.first(x, ONE.prefix, 1)
    return (f"CASE WHEN {place} <> '' AND regexp_replace({place}, '[区县]$', '') NOT IN ({own}) THEN '标错地区' "
            f"WHEN {x} = '' OR {x} IN ({blanks}) OR contains({x}, '我局') OR {O.has(x, '[;；]')} OR NOT {O.has(x, ONE.suffix)} "
            f"OR {one_area_sql(x)} IS NULL OR {O.has(x, ONE.typo)} THEN '不规范' END")


def _one():
    return A.one_city_name(c("process_department"))


per_value("scl_13_one_city_area", "records", ["process_department"], lambda: {"area": A.one_city_area(_one())},
          {"area": one_area_sql(one_name_sql("process_department"))})
per_value("scl_14_one_city_function", "records", ["process_department"], lambda: {"function": A.one_city_function(_one())},
          {"function": one_function_sql(one_name_sql("process_department"))})
per_value("flt_20_one_city_rules", "records", ["process_department"],
          lambda: {"name": _one(), "drop_reason": A.one_city_drop_reason(_one())},
          {"name": one_name_sql("process_department"), "drop_reason": one_reason_sql(one_name_sql("process_department"))})

@query("udf_01_rule_set", """SELECT process_department, CASE WHEN contains(process_department, '开发区') THEN '开发区' WHEN contains(process_department, '姑苏') THEN '姑苏'
  WHEN contains(process_department, '吴中') THEN '吴中' WHEN contains(process_department, '苏州') THEN '苏州市' END AS area, count(*) AS n FROM records GROUP BY 1, 2""")
def rule_set_q(f: Frames):
    """The same operator under another city's rules."""
    rules = replace(R.ONE_CITY, districts=("姑苏", "吴中"), area_before=(("开发区", "开发区"),), area_after=(("苏州", "苏州市"),))
    n = f.records.groupBy("process_department").agg(F.count(F.lit(1)).alias("n"))
    return n.select("process_department", A.one_city_area(c("process_department"), rules).alias("area"), "n")


_inner = "regexp_extract(process_department, '[(（]([^()（）]+)[)）][\\s　]*$', 1)"
per_value("scl_15_split_badges", "records", ["process_department"], lambda: {"badges": T.split_badges(c("process_department"))},
          {"badges": f"array_to_string(list_filter(list_transform(string_split_regex({_inner}, '[、,，]'), lambda p: {O.strip('p')}), lambda p: p <> ''), ' / ')"})
per_value("scl_16_bracket_of", "notices", ["title"], lambda: {"bracket": N.bracket_of(c("title"))}, {"bracket": O.bracket("title")})
per_value("scl_17_parse_source", "notices", ["body"], lambda: {"source": N.parse_source(c("body"))}, {"source": O.source("body")})
per_value("scl_18_is_radiation", "notices", ["title"], lambda: {"radiation": N.is_radiation(c("title"), N.bracket_of(c("title")))},
          {"radiation": f"{O.has('title', R.RADIATION)} OR {O.has(O.bracket('title'), R.RADIATION)}"})
per_value("scl_21_is_report", "attachments", ["label", "size", "pages"],
          lambda: {"report": N.is_report(c("label"), c("size"), c("pages"))},
          {"report": O.is_report("label", "size", "pages")})
per_value("scl_22_norm_url", "entry_log", ["entry_url"],
          lambda: {"normal": U.norm_url(c("entry_url")), "host": U.host(c("entry_url")), "domain": U.domain(c("entry_url"))},
          {"normal": O.norm_url("entry_url"), "host": O.host("entry_url"),
           "domain": "regexp_replace(entry_url, '^https?://([^/]+).*$', '\\1')"})
_col1 = "regexp_extract(url, '^(.*?/col/col\\d+)/', 1)"
_art = "'^(https?://[^/]+)/art/\\d{4}/\\d+/\\d+/art_(\\d+)_\\d+\\.html'"


@query("scl_23_column_of", f"""SELECT url, CASE WHEN {_col1} <> '' THEN {_col1} || '/index.html'
  WHEN regexp_extract(url, {_art}, 1) <> '' THEN regexp_extract(url, {_art}, 1) || '/col/col' || regexp_extract(url, {_art}, 2) || '/index.html'
  ELSE '' END AS column_url FROM (SELECT url FROM notices UNION SELECT channel_url FROM notices UNION SELECT url FROM pages)""")
def column_of_q(f: Frames):
    urls = (f.notices.select("url").union(f.notices.select("channel_url")).union(f.pages.select("url"))).distinct()
    return urls.select("url", U.column_of(c("url")).alias("column_url"))


per_value("scl_24_url_prefix", "pages", ["url"], lambda: {"prefix": U.url_prefix(c("url"))},
          {"prefix": "array_to_string(string_split(regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1), '/')[1:3], '/')"})
per_value("scl_25_notice_date", "notices", ["title"],
          lambda: {"date_text": T.notice_date(c("title")), "date_value": T.notice_date_value(c("title")).cast("string")},
          {"date_text": O.first("title", R.NOTICE_DATE),
           "date_value": f"CASE WHEN {O.first('title', R.NOTICE_DATE)} <> '' THEN CAST(make_date("
                         + ", ".join(f"CAST({O.first('title', R.NOTICE_DATE, i)} AS INT)" for i in (1, 2, 3)) + ") AS VARCHAR) END"})
per_value("scl_27_tier", "records", ["process_department"], lambda: {"tier": A.tier(c("process_department"))},
          {"tier": f"CASE WHEN {O.has('process_department', R.TIER_ECO)} THEN '生态环境系统' "
                   f"WHEN {O.has('process_department', R.TIER_ADMIN)} THEN '开发区/行政审批' ELSE '其他部门' END"})


@query("scl_09_function_of", f"""SELECT prov_code, name, {O.function('name', 'place_words')} AS function, sum(n)::BIGINT AS n_rows
  FROM proc_spell JOIN p_pattern USING (prov_code) GROUP BY 1, 2, 3""")
def function_of_q(f: Frames):
    names = (f.records.groupBy("prov_code", T.normalize(c("process_department")).alias("name"))
             .agg(F.count(F.lit(1)).alias("n_rows")).filter("name <> ''"))
    return with_function(names, f.places).select("prov_code", "name", "function", "n_rows")


def distinct_names(f: Frames):
    return (f.records.select("prov_code", "city_code", "county", T.normalize(c("process_department")).alias("name"))
            .filter("name <> ''").distinct())


O.relation("all_names", "records", f"""SELECT DISTINCT prov_code, city_code, county, name FROM
  (SELECT prov_code, city_code, county, {O.normalize('process_department')} AS name FROM records) WHERE name <> ''""")
O.locate("all_located", "all_names")


@query("scl_10_zone_in", "SELECT prov_code, name, county, zone FROM all_located_zone")
def zone_in_q(f: Frames):
    names = distinct_names(f).select("prov_code", "name", "county").distinct()
    return with_place(names, f.places).select("prov_code", "name", "county", zone_in(c("name"), c("county"), c("place")).alias("zone"))


@query("scl_11_area_of", "SELECT prov_code, city_code, county, name, city, area FROM all_located")
def area_of_q(f: Frames):
    return locate(distinct_names(f), f.places).select("prov_code", "city_code", "county", "name", "city", "area")


@query("scl_26_strip_annotation", r"""SELECT org, trim(regexp_replace(org, '[（(](?:[^）)]*)(?:含|另有|旧名|\d+\s*条)[^）)]*[）)]\s*$', ''), '【】 ') AS plain FROM
  (SELECT DISTINCT '【' || city || '生态环境局' || CASE ord % 4 WHEN 0 THEN '（含甲局' || CAST(ord AS VARCHAR) || '条）' WHEN 1 THEN '(太湖办)'
   WHEN 2 THEN '（旧名：环保局）' ELSE '】' END AS org FROM entry_log)""")
def strip_annotation_q(f: Frames):
    org = F.concat(F.lit("【"), c("city"), F.lit("生态环境局"),
                   F.when(c("ord") % 4 == 0, F.concat(F.lit("（含甲局"), c("ord").cast("string"), F.lit("条）")))
                   .when(c("ord") % 4 == 1, "(太湖办)").when(c("ord") % 4 == 2, "（旧名：环保局）").otherwise("】"))
    return f.entry_log.select(org.alias("org")).distinct().select("org", T.strip_annotation(c("org")).alias("plain"))


@query("scl_30_function_key", "SELECT city || '|' || area || '|' || function AS function_key, record_count FROM proc_units")
def function_key_q(f: Frames):
    return f.units.select(T.function_key(c("city"), c("area"), c("function")).alias("function_key"), "record_count")


per_value("scl_31_field_of", "part", ["p_type"],
          lambda: {"field": N.field_of(F.when(c("p_type") == "ECONOMY", "建设地址").when(c("p_type") == "SMALL", "申请单位").otherwise(c("p_type")))},
          {"field": O.field("CASE p_type WHEN 'ECONOMY' THEN '建设地址' WHEN 'SMALL' THEN '申请单位' ELSE p_type END")})
_scope = "CASE WHEN seq % 3 = 0 THEN '市本级' WHEN seq % 3 = 1 THEN project_district || '｜ ' || approval_district ELSE project_district || '区' END"
O.relation("scopes", "projects", f"SELECT DISTINCT {_scope} AS scope FROM projects")


def scope_of(df):
    return df.select(F.expr(_scope).alias("scope")).distinct()


@query("scl_32_expand_scope", """SELECT scope, array_to_string(list_transform(names, lambda p: regexp_replace(p, '[区县市]$', '')), ',') AS names,
  len(names) > 1 OR scope IN ('', '市本级') AS whole FROM (
  SELECT scope, list_filter(list_transform(string_split(replace(scope, '｜', '|'), '|'), lambda p: trim(p)), lambda p: p <> '') AS names FROM scopes)""")
def expand_scope_q(f: Frames):
    from regwise.operators.slices import scope_names, whole_entry
    return scope_of(f.projects).select("scope", F.array_join(F.transform(
        scope_names(c("scope")), lambda p: F.regexp_replace(p, "[区县市]$", "")), ",").alias("names"),
        whole_entry(c("scope")).alias("whole"))


per_value("scl_33_attachment_label", "attachments", ["label"],
          lambda: {"full": N.attachment_label(c("label"), F.lit("题"), F.concat(F.lit("http://a/b/%E9%99%84/"), F.replace(c("label"), F.lit("件"), F.lit("%E4%BB%B6")))),
           "attached": N.is_attachment(F.lit("x"), c("label"))},
          {"full": "label || ' 题 ' || regexp_extract(label, '([^/]*)$', 1)", "attached": f"regexp_matches(label, {O.q(R.ATTACHMENT_EXT)})"})
per_value("scl_34_squash", "documents", ["doc_id", "text"], lambda: {"flat": F.md5(T.squash(c("text"))), "tight": F.md5(T.squash(c("text"), ""))},
          {"flat": "md5(regexp_replace(text, '[\\s\\x{0b}\\x{85}\\x{a0}\\x{2028}\\x{2029}　]+', ' ', 'g'))",
           "tight": "md5(regexp_replace(text, '[\\s\\x{0b}\\x{85}\\x{a0}\\x{2028}\\x{2029}　]+', '', 'g'))"})
per_value("scl_35_date_arithmetic", "orders", ["o_orderdate"],
          lambda: {"start": F.date_sub(F.to_date("o_orderdate"), 20).cast("string"),
           "midpoint": F.date_add(F.lit("1995-01-01").cast("date"),
                                  F.floor(F.datediff(F.to_date("o_orderdate"), F.lit("1995-01-01")) / 2).cast("int")).cast("string")},
          {"start": "CAST(CAST(o_orderdate AS DATE) - 20 AS VARCHAR)",
           "midpoint": "CAST(DATE '1995-01-01' + CAST(floor((CAST(o_orderdate AS DATE) - DATE '1995-01-01') / 2) AS INT) AS VARCHAR)"})


@query("scl_36_notes", """SELECT entry_url, n, CASE WHEN n > 2 THEN '2024-05-01 拉栏目标题核实：该单位在此栏目发布受理公告 ' || n || ' 条'
  ELSE '2024-05-01：市局受理栏目近 40 页里没有该单位发布的受理公告，可能在区县门户单独发布，未定位，不填地址' END AS note FROM
  (SELECT entry_url, count(*) AS n FROM entry_log GROUP BY 1)""")
def notes_q(f: Frames):
    from regwise.operators.channels import found_note, missing_note
    n = f.entry_log.groupBy("entry_url").agg(F.count(F.lit(1)).alias("n"))
    return n.withColumn("note", F.when(c("n") > 2, found_note(F.lit("2024-05-01"), c("n"))).otherwise(missing_note(F.lit("2024-05-01"), 40)))


per_value("scl_37_sanitize_cell", "conversations", ["conv_id", "turn", "text"], lambda: {"cell": F.md5(T.sanitize_cell(c("text")))},
          {"cell": "md5(replace(replace(text, chr(9), ' '), chr(10), ' '))"})


@query("scl_38_percent", """SELECT city_code, n, with_county, coalesce(round(with_county * 100.0 / nullif(n, 0), 1), 0) AS share,
  coalesce(round(with_county * 100.0 / nullif(0, 0), 1), 0.0) AS none FROM
  (SELECT city_code, count(*) AS n, count(*) FILTER (county <> '') AS with_county FROM records GROUP BY 1)""")
def percent_q(f: Frames):
    n = f.records.groupBy("city_code").agg(F.count(F.lit(1)).alias("n"), F.count_if(c("county") != "").alias("with_county"))
    return n.select("*", T.percent(c("with_county"), c("n")).alias("share"), T.percent(c("with_county"), F.lit(0)).alias("none"))


per_value("scl_39_padded_id", "supplier", ["s_suppkey"],
          lambda: {"uid": T.padded_id(F.lit("JS"), c("s_suppkey") * 37, 4), "zone": T.padded_id(F.lit("320100-Z"), c("s_suppkey") + 1, 2)},
          {"uid": "'JS' || CASE WHEN length(CAST(s_suppkey * 37 AS VARCHAR)) >= 4 THEN CAST(s_suppkey * 37 AS VARCHAR) ELSE lpad(CAST(s_suppkey * 37 AS VARCHAR), 4, '0') END",
           "zone": "'320100-Z' || CASE WHEN s_suppkey + 1 >= 10 THEN CAST(s_suppkey + 1 AS VARCHAR) ELSE lpad(CAST(s_suppkey + 1 AS VARCHAR), 2, '0') END"})

# --- arrays, maps, JSON --------------------------------------------------------


@query("arr_01_variants", """SELECT unit, city, area, array_to_string(variants, ' / ') AS joined, CAST(len(variants) AS BIGINT) AS n FROM proc_units""")
def variants_q(f: Frames):
    joined = F.array_join("variants", R.VARIANT_SEP)
    return f.units.select("unit", "city", "area", joined.alias("joined"), F.size(T.variants_of(joined)).cast("long").alias("n"))


O.relation("city_counts", "records", "SELECT prov_code, city_name AS key, count(*) AS n FROM records GROUP BY 1, 2")


@query("arr_02_top_of_array", """SELECT prov_code, string_agg(key || ':' || n, ' / ' ORDER BY n DESC, key) AS top FROM
  (SELECT * FROM city_counts QUALIFY row_number() OVER (PARTITION BY prov_code ORDER BY n DESC, key) <= 3) GROUP BY 1""")
def top_array_q(f: Frames):
    n = f.records.groupBy("prov_code", c("city_name").alias("key")).agg(F.count(F.lit(1)).alias("n"))
    # ranked first, so that only three rows a province are gathered
    rank = F.row_number().over(Window.partitionBy("prov_code").orderBy(F.desc("n"), "key"))
    best = n.withColumn("_rank", rank).filter("_rank <= 3")
    return best.groupBy("prov_code").agg(C.counted(F.collect_list(F.struct("key", "n")), 3).alias("top"))


@query("arr_03_map_text", "SELECT prov_code, string_agg(key || ':' || n, ' / ' ORDER BY n DESC, key) AS histogram FROM city_counts GROUP BY 1")
def map_text_q(f: Frames):
    n = f.records.groupBy("prov_code", "city_name").agg(F.count(F.lit(1)).alias("n"))
    return n.groupBy("prov_code").agg(C.map_text(F.map_from_entries(F.collect_list(F.struct("city_name", "n")))).alias("histogram"))


@query("arr_04_json_access", """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
  coalesce(json_extract_string(props, '$.name.first'), '') AS first_name FROM events""")
def json_access_q(f: Frames):
    j = F.from_json("props", "k long, name struct<first:string>")
    return f.events.select("event_id", j["k"].alias("k"), F.coalesce(j["name"]["first"], F.lit("")).alias("first_name"))


@query("arr_05_jsonp", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def jsonp_q(f: Frames):
    text = F.concat(F.lit("/**/ cb("), c("props"), F.lit(");\n"))
    return f.events.select("event_id", F.from_json(C.jsonp_body(text), "k long")["k"].alias("k"))


@query("arr_06_script_object", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def script_object_q(f: Frames):
    text = F.concat(F.lit("<script>var siteInfo = "), c("props"), F.lit("; var b = {};</script>"))
    return f.events.select("event_id", F.from_json(C.script_object(text, "siteInfo"), "k long")["k"].alias("k"))


@query("arr_07_query_map", """SELECT url, coalesce(nullif(regexp_extract(url, '[?&]page=([^&#]+)', 1), ''), '') AS page,
  coalesce(nullif(regexp_extract(url, '[?&]ref=([^&#]+)', 1), ''), '') AS ref FROM pages""")
def query_map_q(f: Frames):
    m = U.query_map(c("url"))
    return f.pages.select("url", *[F.coalesce(m[k], F.lit("")).alias(k) for k in ("page", "ref")])


@query("arr_08_ragged_rows", """SELECT ord, coalesce(parts[1], '') AS a, coalesce(parts[2], '') AS b, coalesce(parts[3], '') AS c FROM
  (SELECT ord, string_split(combined_units, '、') AS parts FROM records)""")
def ragged_q(f: Frames):
    parts = F.split("combined_units", "、")
    return f.records.select("ord", *[C.item(parts, i).alias(n) for i, n in enumerate("abc")])
