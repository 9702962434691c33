"""Queries over readers, writers and streaming jobs; they write to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from regwise import rules as R, schema as S
from regwise.operators import entries as E, evidence as V
from regwise.operators.sequence import global_index
from regwise.operators.units import flag_seen_in
from regwise.plans import notices as NP
from regwise.plans.master import master_order, upsert_units
from regwise.session import durable, scratch_path
from regwise.sources import readers as RD, writers as WR
from regwise.streaming import jobs as ST
from workload import oracle as O
from workload.files import in_file_order, name_files
from workload.frames import Frames
from workload.q_clean import UNIT_COLS
from workload.q_master import _all as master_columns, master_of
from workload.q_notices import classified, notice_input
from workload.registry import query

c = F.col
# ranges in which record files are written: as many files, and one more for each province, whatever the data
FILES = 32


def tree_json(f: Frames):
    """The area dimension as nested trees, one per province."""
    node = lambda code, name, short, *more: F.struct(c(code).alias("编码"), c(name).alias("名称"), c(short).alias("简称"), *more)
    by_city = f.area.groupBy("prov_code", "prov_name", "prov_short", "city_code", "city_name", "city_short", "city_ord").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("district_ord", node("district_code", "district_name", "district_short").alias("d")))),
                    lambda x: x["d"]).alias("ds"))
    return by_city.groupBy("prov_code", "prov_name", "prov_short").agg(F.transform(F.sort_array(F.collect_list(F.struct(
        "city_ord", node("city_code", "city_name", "city_short", c("ds").alias("区县")).alias("x")))), lambda x: x["x"]).alias("cs")).select(
        c("prov_code").alias("省编码"), F.lit("2024-01-01").alias("快照日期"), F.lit("").alias("来源"),
        node("prov_code", "prov_name", "prov_short", c("cs").alias("市")).alias("地区树"))


def envelope_files(f: Frames) -> str:
    """Record files of all provinces: several envelopes to a file, one per line; a large province has several files."""
    if "envelopes" not in f._made:
        path = scratch_path(f.spark, "envelopes")
        r = f.records
        cells = F.when(c("ord") % 13 == 0, F.array(*[c(x).cast("string") for x in ("module", "city_code", "process_department", "combined_units", "notice_date", "county")])
                       ).otherwise(F.array(*[c(x).cast("string") for x in ("module", "city_code", "process_department", "combined_units", "notice_date", "county", "city_field")]))
        # an envelope holds one city's share of a thousand orders, the size one crawl leaves behind
        files = (r.groupBy("prov_code", "city_code", F.floor(c("ord") / 1000).alias("part")).agg(
            F.transform(F.sort_array(F.collect_list(F.struct("ord", cells.alias("r")))), lambda x: x["r"]).alias("记录")))
        in_order = files.repartitionByRange(FILES, "prov_code", "city_code", "part").sortWithinPartitions("prov_code", "city_code", "part")
        made = in_order.select(c("prov_code").alias("省编码"), F.lit("2024-01-01").alias("抓取日期"), F.expr("array(1, 2, 3, 5)").alias("模块"),
                               F.array(F.array(F.lit("1"), c("city_code")), F.array(F.lit("2"), c("city_code"))).alias("已完成"), "记录", c("prov_code").alias("p"))
        made.write.partitionBy("p").json(f"{path}-parts")
        f._made["envelopes"] = name_files(f.spark, f"{path}-parts", path, lambda prov, i: f"{prov}_{i:06d}.json")
    return f._made["envelopes"]


# the order of the files is the order of province, city and envelope in which they were written
_places = """row_number() OVER (ORDER BY prov_code, city_code, ord // 1000, ord) - 1 AS position,
  row_number() OVER (PARTITION BY city_code, ord // 1000 ORDER BY ord) - 1 AS pos"""


@query("src_01_read_records", f"""SELECT prov_code, module, city_code, process_department, combined_units, notice_date, county, CASE WHEN ord % 13 = 0 THEN '' ELSE city_field END AS city_field, {_places}
  FROM records""")
def read_records_q(f: Frames):
    rows = global_index(RD.read_records(f.spark, envelope_files(f), lines=True), [c("ord")], "position")
    return rows.select("prov_code", "module", "city_code", "process_department", "combined_units", "notice_date", "county", "city_field", "position",
                       c("pos").cast("long").alias("pos"))


@query("src_01_one_city_form", f"""SELECT prov_code, process_department, combined_units, notice_date, {_places} FROM records WHERE city_code = '320100'""")
def one_city_form_q(f: Frames):
    """The files of one city hold three-element records."""
    path = scratch_path(f.spark, "one-city")
    rows = f.records.filter("city_code = '320100'")
    cells = F.array("process_department", "combined_units", "notice_date")
    files = rows.groupBy("prov_code", F.floor(c("ord") / 1000).alias("part")).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("ord", cells.alias("r")))), lambda x: x["r"]).alias("记录"))
    # the folder column sorts first, as the writer wants it, or it would sort anew and lose the order of the envelopes
    in_order = files.repartitionByRange(FILES, "part").sortWithinPartitions("prov_code", "part").select(c("prov_code").alias("省编码"), "记录", c("prov_code").alias("p"))
    in_order.write.partitionBy("p").json(f"{path}-parts")
    name_files(f.spark, f"{path}-parts", path, lambda prov, i: f"{i:06d}_南京市.json")
    back = RD.read_records(f.spark, path, lines=True, fields=S.ONE_CITY_FIELDS)
    return global_index(back, [c("ord")], "position").select("prov_code", "process_department", "combined_units", "notice_date", "position",
                                                             c("pos").cast("long").alias("pos"))


@query("src_02_read_province", "SELECT city_code, module, count(*) AS n FROM records WHERE prov_code = '320000' AND module = 1 GROUP BY 1, 2")
def read_province_q(f: Frames):
    """The files of one province, one module of them."""
    back = RD.read_province(f.spark, envelope_files(f), "320000", module=1, lines=True)
    return back.groupBy("city_code", "module").agg(F.count(F.lit(1)).alias("n"))


@query("src_02_unfinished_files", "SELECT city_code, module, count(*) AS n FROM (SELECT DISTINCT city_code, ord // 1000 AS part FROM records), (SELECT unnest([3, 5]) AS module) GROUP BY 1, 2")
def unfinished_q(f: Frames):
    env = RD.read_envelopes(f.spark, envelope_files(f), lines=True)
    env = env.withColumn("file_stem", F.concat_ws("|", RD.item(F.get(c("记录"), F.lit(0)), 1), F.xxhash64(F.to_json("记录")).cast("string")))
    return RD.unfinished(env).groupBy(F.substring_index("file_stem", "|", 1).alias("city_code"), "module").agg(F.count(F.lit(1)).alias("n"))


@query("src_03_area_tree", "SELECT prov_code, prov_name, city_code, city_name, district_code, district_name, district_short FROM area")
def tree_q(f: Frames):
    path = scratch_path(f.spark, "tree")
    tree_json(f).write.json(path)
    return RD.read_area_tree(f.spark, path, lines=True).select("prov_code", "prov_name", "city_code", "city_name", "district_code", "district_name", "district_short")


@query("src_04_municipality", """SELECT district_code AS code, prov_code || CASE WHEN prov_code IN ('320000', '350000') THEN '#' ELSE '' END AS parent, 3::BIGINT AS level FROM area
  UNION ALL SELECT DISTINCT prov_code, '', 1 FROM area UNION ALL SELECT DISTINCT prov_code || '#', prov_code, 2 FROM area WHERE prov_code IN ('320000', '350000')
  UNION ALL SELECT DISTINCT city_code, prov_code, 2 FROM area WHERE prov_code NOT IN ('320000', '350000')""")
def municipality_q(f: Frames):
    """Two provinces have their districts directly below them."""
    flat = c("prov_code").isin("320000", "350000")
    node = lambda df, code, name, level, parent: df.select(c(code).alias("code"), c(name).alias("name"), c(name).alias("short"),
                                                           F.lit(level).alias("level"), parent.alias("parent")).distinct()
    nodes = (node(f.area, "prov_code", "prov_name", 1, F.lit("")).unionByName(node(f.area.filter(~flat), "city_code", "city_name", 2, c("prov_code")))
             .unionByName(node(f.area, "district_code", "district_name", 3, c("prov_code"))))
    return RD.normalise_municipality(nodes).select("code", "parent", c("level").cast("long").alias("level"))


@query("src_05_read_csv", f"SELECT {UNIT_COLS} FROM proc_units")
def read_csv_q(f: Frames):
    path = scratch_path(f.spark, "units-csv")
    WR.write_units(f.units, path)
    back = RD.read_table(f.spark, path, ["prov_code", *R.UNIT_COLUMNS])
    return back.withColumn("记录数", c("记录数").cast("long"))


@query("src_06_read_tsv_comments", "SELECT city, stage, url, home FROM channels")
def read_tsv_q(f: Frames):
    path = scratch_path(f.spark, "channels-tsv")
    lines = f.channels.select(F.concat_ws("\t", "city", "stage", "url", "home").alias("value"))
    lines.union(f.region.select(F.concat(F.lit("# "), c("r_name")))).union(f.region.select(F.lit(""))).write.text(path)
    return RD.read_channels(f.spark, path)


@query("src_08_first_available", "SELECT code, tier FROM (SELECT district_code AS code, 'live' AS tier FROM area WHERE district_ord = 1 UNION ALL SELECT district_code, 'snapshot' FROM area WHERE district_ord <> 1)")
def first_available_q(f: Frames):
    row = lambda df, tier: df.select(c("district_code").alias("code"), F.lit(tier).alias("tier"))
    return RD.first_available(["code"], row(f.area.filter("district_ord = 1"), "live"), row(f.area, "snapshot"))


@query("src_09_read_links", "SELECT url, CASE WHEN seq % 4 = 0 THEN '' ELSE trim(title, ' 　') END AS title FROM notices")
def read_links_q(f: Frames):
    path = scratch_path(f.spark, "links")
    f.notices.select(F.when(c("seq") % 4 == 0, c("url")).otherwise(F.concat_ws("\t", "url", "title")).alias("value")).union(
        f.region.select(F.lit("  "))).write.text(path)
    return RD.read_links(f.spark, path)


@query("src_10_portal_map", "SELECT city_name AS city, district_name AS district, 'http://' || district_code AS home FROM area WHERE district_name IN ('鼓楼区', '和县')")
def portal_map_q(f: Frames):
    path = scratch_path(f.spark, "portals")
    inner = f.area.groupBy("city_name").agg(F.map_from_entries(F.collect_list(F.struct(
        "district_name", F.concat(F.lit("http://"), c("district_code"))))).alias("m"))
    # the map is one document; it holds the districts of the area dimension
    whole = inner.agg(F.map_from_entries(F.collect_list(F.struct("city_name", "m"))).alias("m"))
    whole.select(F.to_json("m").alias("value")).write.text(path)
    return RD.read_portals(f.spark, path, ["鼓楼区", "和县"])


@query("src_11_read_pages", "SELECT page_id, url, length(html) AS n FROM pages")
def read_pages_q(f: Frames):
    return RD.read_pages(f.spark, f"{f.sf_dir}/pages.parquet").select("page_id", "url", F.length("html").cast("long").alias("n"))


@query("src_12_stored_samples", "SELECT CAST(c_custkey AS VARCHAR) AS unit_uid FROM customer ANTI JOIN orders ON o_custkey = c_custkey AND o_orderstatus = 'F'")
def stored_samples_q(f: Frames):
    """Units whose samples are already stored are left out of the next run."""
    samples = F.create_map(c("o_custkey").cast("string"), F.struct(F.lit("u").alias("单位"), F.lit("c").alias("城市"), F.array(F.create_map(
        F.lit("k"), c("o_orderkey").cast("string"))).alias("样本")))
    path = scratch_path(f.spark, "samples")
    f.orders.filter("o_orderstatus = 'F'").select(F.to_json(samples).alias("value")).write.text(path)
    from regwise.schema import SAMPLES
    done = RD.samples_of(f.spark.read.text(path).select(F.from_json("value", SAMPLES).alias("m")))
    return RD.pending(f.customer.select(c("c_custkey").cast("string").alias("unit_uid")), done)


# --- writers -------------------------------------------------------------------

EXPORT_COLS = UNIT_COLS.replace('"单位"', '"受理/监督单位"')


_unit_place = 'row_number() OVER (ORDER BY prov_code, city, record_count DESC, unit, area) - 1 AS position'


def written_units(f: Frames, path: str, columns: list[str]):
    back = in_file_order(RD.read_table(f.spark, path, ["prov_code", *columns]))
    return back.withColumn("记录数", c("记录数").cast("long"))


@query("snk_01_write_units", f"""SELECT {EXPORT_COLS}, CASE WHEN EXISTS (SELECT 1 FROM proc_names p WHERE p.prov_code = u.prov_code AND list_contains(list_append(u.variants, u.unit), p.name)) THEN '是' ELSE '否' END AS "单位列是否出现",
  {_unit_place} FROM export_units u""")
def write_units_q(f: Frames):
    path = scratch_path(f.spark, "export-csv")
    WR.write_units(flag_seen_in(f.cleaned("export").units, f.units), path, "export")
    cols = ["受理/监督单位" if x == "单位" else x for x in R.UNIT_COLUMNS]
    cols.insert(5, R.SEEN_COLUMN)
    return written_units(f, path, cols)


@query("snk_02_deliverables", f"SELECT {UNIT_COLS}, {_unit_place} FROM proc_units WHERE role <> '其他部门'")
def deliverables_q(f: Frames):
    full, short = scratch_path(f.spark, "full-csv"), scratch_path(f.spark, "approver-csv")
    WR.write_deliverables(f.units, full, short)
    return written_units(f, short, R.UNIT_COLUMNS)


@query("snk_03_write_master", f"""SELECT {master_columns}, row_number() OVER (ORDER BY city_code, CASE WHEN admin_code = '' THEN 'zzz' ELSE admin_code END, CAST(record_count AS BIGINT) DESC, unit_uid) - 1 AS position
  FROM full_master""")
def write_master_q(f: Frames):
    """The master table as a file, in its order."""
    path = scratch_path(f.spark, "master-csv")
    master = master_of(f)
    WR.write_master(master, path, [*master_order(), c("unit_uid")])
    extra = [x for x in master.columns if x not in R.MASTER_COLUMNS]
    return in_file_order(RD.read_table(f.spark, path, [*R.MASTER_COLUMNS, *extra]))


@query("src_07_read_entry_logs", """SELECT city, unit, "首页入口", "备注", row_number() OVER (ORDER BY file_stem, ord) - 1 AS position FROM (
  SELECT file_stem, city, """ + O.strip("unit") + """ AS unit, home_url AS "首页入口", note || CASE WHEN ord % 3 = 0 THEN chr(10) || '第"二"行, x' ELSE '' END AS "备注", ord
  FROM entry_log) WHERE unit <> ''""")
def read_entry_logs_q(f: Frames):
    """One file per city; notes hold line breaks, quotes and commas."""
    path = scratch_path(f.spark, "entry-log")
    note = F.concat("note", F.when(c("ord") % 3 == 0, F.lit('\n第"二"行, x')).otherwise(""))
    cells = {"单位": c("unit"), "首页入口": c("home_url"), "受理公示入口": c("entry_url"), "入口（点击路径）": c("entry_path"), "备注": note,
             "核验情况": c("verify_status"), "核验日期": c("verify_date")}
    rows = f.entry_log.select(*[cells.get(x, F.lit("")).alias(x) for x in R.ENTRY_LOG_COLUMNS], "file_stem", "ord")
    rows = rows.repartition("file_stem").sortWithinPartitions("file_stem", "ord").drop("ord")
    rows.write.partitionBy("file_stem").csv(f"{path}-parts", header=True, quoteAll=True, escape='"', emptyValue="")
    name_files(f.spark, f"{path}-parts", path, lambda stem, i: f"{stem}.csv")
    back = RD.read_entry_logs(f.spark, path)
    return global_index(back, [c("ord")], "position").select("city", "unit", "首页入口", "备注", "position")


@query("snk_04_append_projects", """SELECT url AS "公告URL", location AS "建设地点", district AS "项目地区", 2::BIGINT * count(*) AS n FROM project_rows GROUP BY 1, 2, 3""")
def append_q(f: Frames):
    path = scratch_path(f.spark, "projects")
    rows = NP.project_rows(classified(f))
    WR.append_projects(rows, path)
    # the same rows once more, as they stand in the data set, so that they are classified once
    WR.append_projects(f.spark.read.schema(rows.schema).parquet(path), path)
    return f.spark.read.schema(rows.schema).parquet(path).groupBy("公告URL", "建设地点", "项目地区").agg(F.count(F.lit(1)).alias("n"))


@query("snk_05_append_missing", "SELECT prov_code, city, unit FROM entries")
def append_missing_q(f: Frames):
    """A shared table gains only the units it lacks; creating it twice fails."""
    path = scratch_path(f.spark, "entries")
    rows = E.latest_entries(f.entry_log).select("prov_code", "city", "unit", "entry_url")
    WR.create_only(rows.filter(c("prov_code") == "320000"), path)
    WR.append_missing(rows, path, ["prov_code", "city", "unit"])
    WR.append_missing(rows, path, ["prov_code", "city", "unit"])
    return f.spark.read.schema(rows.schema).parquet(path).select("prov_code", "city", "unit")


@query("snk_08_readback", "SELECT unit_uid, 'right' AS side FROM full_master WHERE name_status = '已停用'")
def readback_q(f: Frames):
    """What a readback reports when rows were written that were not expected."""
    path = scratch_path(f.spark, "readback")
    master = master_of(f).select("unit_uid", "name_status")
    WR.create_only(master, path)
    return WR.readback_differences(master.filter(c("name_status") != R.RETIRED), path).select("unit_uid", "side")


@query("snk_09_candidates", "SELECT prov_code, publisher, other, n FROM pairs")
def candidates_q(f: Frames):
    path = scratch_path(f.spark, "co-occurrence")
    WR.write_candidates(V.co_occurrence(f.records), path, [F.desc("n"), c("publisher"), c("other")])
    back = RD.read_table(f.spark, path, ["prov_code", "publisher", "other", "n"])
    return back.withColumn("n", c("n").cast("long"))


# --- streaming -------------------------------------------------------------------

@query("str_01_resumable_ingest", """SELECT prov_code, city_code, process_department, count(*) AS n FROM records GROUP BY 1, 2, 3""")
def ingest_q(f: Frames):
    """Files arrive as a stream; running the ingest twice reads each file once."""
    table, mark = scratch_path(f.spark, "ingested"), scratch_path(f.spark, "ingest-mark")
    stream = ST.stream_records(f.spark, f"{envelope_files(f)}/*", lines=True)
    for _ in range(2):
        ST.ingest(stream, table, mark).awaitTermination()
    rows = f.spark.read.schema(stream.schema).parquet(table)
    return rows.groupBy("prov_code", "city_code", "process_department").agg(F.count(F.lit(1)).alias("n"))


@query("str_01_grown_files", """SELECT prov_code, city_code, process_department, CASE WHEN ord % 3 <> 0 THEN 0 ELSE 1 END AS run, count(*) AS n
  FROM records GROUP BY 1, 2, 3, 4""")
def grown_files_q(f: Frames):
    """State files, one a province, are saved again with more records: the second run takes in those only, a third one nothing."""
    path, log = scratch_path(f.spark, "state-files"), ST.RecordLog(f.spark, scratch_path(f.spark, "record-log"))
    cells = F.array(*[c(x).cast("string") for x in ("module", "city_code", "process_department", "combined_units", "notice_date", "county", "city_field")])
    for rows in (f.records.filter("ord % 3 <> 0"), f.records):
        envelopes = rows.groupBy("prov_code", "city_code", F.floor(c("ord") / 1000).alias("part")).agg(F.collect_list(cells).alias("记录"))
        parts = scratch_path(f.spark, "state-parts")
        envelopes.repartition("prov_code").select(c("prov_code").alias("省编码"), "记录", c("prov_code").alias("p")).write.partitionBy("p").json(parts)
        name_files(f.spark, parts, path, lambda prov, i: f"{prov}_{i}.json")
        log.ingest(path, lines=True)
    if log.ingest(path, lines=True) is not None:
        raise AssertionError("files that did not change were read again")
    return log.read().groupBy("prov_code", "city_code", "process_department", "run").agg(F.count(F.lit(1)).alias("n"))


def event_stream(f: Frames):
    schema = f.spark.read.parquet(f"{f.sf_dir}/events.parquet").schema
    return f.spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(f.sf_dir).withColumn("ts", c("ts").cast("timestamp"))


@query("str_02_first_seen_stream", "SELECT DISTINCT user_id, event_type FROM events")
def first_seen_stream_q(f: Frames):
    """One row per key while the watermark (longer than the table) holds the state."""
    table, mark = scratch_path(f.spark, "seen"), scratch_path(f.spark, "seen-mark")
    first = ST.first_seen_stream(event_stream(f), ["user_id", "event_type"], "ts", "60 days")
    ST.ingest(first.select("user_id", "event_type", "ts"), table, mark).awaitTermination()
    return f.spark.read.schema("user_id long, event_type string, ts timestamp").parquet(table).select("user_id", "event_type")


_later = "CASE WHEN user_id % 7 = 0 THEN concat(event_type, '+') ELSE event_type END"


@query("str_02_first_seen_ever", f"""SELECT user_id, event_type, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS ts FROM (
  SELECT user_id, event_type, ts FROM events UNION ALL SELECT user_id, {_later}, ts + INTERVAL 365 DAY FROM events) GROUP BY 1, 2""")
def first_seen_ever_q(f: Frames):
    """Events arrive in three files, the last one a year after the others; every batch comes twice."""
    source, mark = scratch_path(f.spark, "event-files"), scratch_path(f.spark, "event-mark")
    events = f.spark.read.parquet(f"{f.sf_dir}/events.parquet").select("user_id", "event_type", c("ts").cast("timestamp_ntz").alias("ts"))
    middle = events.agg(F.percentile_approx(F.unix_micros(c("ts").cast("timestamp")), 0.5).alias("m")).first()["m"]
    early = F.unix_micros(c("ts").cast("timestamp")) < middle
    later = events.select("user_id", F.expr(_later).alias("event_type"), (c("ts") + F.expr("INTERVAL 365 DAY")).alias("ts"))
    seen = ST.FirstSeen(f.spark, scratch_path(f.spark, "seen-ever"), ["user_id", "event_type"], "user_id long, event_type string, ts timestamp_ntz")

    def merge(batch, batch_id):
        seen.merge(batch, batch_id, c("ts"))
        seen.merge(batch, batch_id, c("ts"))  # a replay changes nothing

    for arriving in (events.filter(early), events.filter(~early), later):
        arriving.write.mode("append").parquet(source)
        ST.upsert_stream(f.spark.readStream.schema(events.schema).parquet(source), merge, mark).awaitTermination()
    return seen.read().select("user_id", "event_type", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"))


_upserted = "unit_uid, prov_code, city_code, function_key, name_from_source, name_canonical, name_status, group_id, record_count, role, crawl_note"


@query("str_03_incremental_upsert", f"SELECT {_upserted} FROM full_master")
def upsert_q(f: Frames):
    """The master kept up batch by batch: a file of units arrives for each province, after the table of an earlier run."""
    source, schema = scratch_path(f.spark, "unit-files"), ", ".join(f"{x.strip()} string" for x in _upserted.split(","))
    store = ST.MasterStore(f.spark, scratch_path(f.spark, "master-parts"), "prov_code", schema)
    store.merge(f.previous, -1, lambda old, rows: rows)
    codes = f.area.select("prov_code", c("city_name").alias("city"), "city_code").distinct()
    units = f.units.join(codes, ["prov_code", "city"], "left").na.fill("", ["city_code"])
    units.repartition("prov_code").sortWithinPartitions("prov_code").write.partitionBy("prov_code").parquet(source)
    files = name_files(f.spark, source, f"{source}-named", lambda prov, i: f"{prov}_{i}.parquet")
    stream = (f.spark.readStream.schema(units.drop("prov_code").schema).option("maxFilesPerTrigger", 2).parquet(files)
              .withColumn("prov_code", F.substring(F.element_at(F.split(F.input_file_name(), "/"), -1), 1, 6)))
    apply = lambda old, rows: upsert_units(rows, old, f.places)

    def merge(batch, batch_id):
        batch = durable(batch, "batch")
        store.merge(batch, batch_id, apply)
        store.merge(batch, batch_id, apply)  # a replay changes nothing

    ST.upsert_stream(stream, merge, scratch_path(f.spark, "master-mark")).awaitTermination()
    return store.read()


def notice_files(f: Frames, rows: int = 250_000):
    """Folder and schema of the notices as files, each of ``rows`` notices or an eighth of a small table; every task writes its own."""
    path, notices = scratch_path(f.spark, "notice-files"), notice_input(f)
    notices.write.option("maxRecordsPerFile", max(1, min(rows, f.lineitem.count() // 8))).parquet(path)
    return path, notices.schema


@query("str_04_stream_classification", """SELECT ord, title, bracket, bracket_meaning, radiation, approval_org, approval_district,
  array_to_string(project_districts, ',') AS project_districts, n_projects FROM cls""")
def stream_classification_q(f: Frames):
    """Notices that arrive as files are read like the table of all of them."""
    out = scratch_path(f.spark, "classified")
    source, schema = notice_files(f)
    count = len(f.spark.read.schema(schema).parquet(source).inputFiles())
    stream = f.spark.readStream.schema(schema).option("maxFilesPerTrigger", (count + 1) // 2).parquet(source)
    ST.classify_stream(stream, f.places, out, scratch_path(f.spark, "classified-mark")).awaitTermination()
    read = f.spark.read.parquet(out)
    return read.select("ord", "title", "bracket", "bracket_meaning", "radiation", "approval_org", "approval_district",
                       F.array_join("project_districts", ",").alias("project_districts"), "n_projects")
