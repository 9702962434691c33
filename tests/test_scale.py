"""Keys beyond the provided sizes, orders of files, and the guards of intermediates."""

import json
import random
from datetime import date, timedelta

import duckdb
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from regwise import session
from regwise.operators import audit, layout, samples, sequence, units
from regwise.operators.spellings import select_field
from regwise.sources import readers as RD
from regwise.streaming.jobs import FirstSeen, MasterStore, RecordLog
from workload.frames import FRAMES, PARENTS, TABLES, frame_ctes

BIG = 9_000_000_000_000


@pytest.fixture(scope="module")
def big_tables(spark, tmp_path_factory):
    """A few rows of the tables with order, part and supplier keys far above 10^9."""
    root = tmp_path_factory.mktemp("big")
    sf = "/root/testdata/sf0.001"
    up = lambda t, *keys: spark.read.parquet(f"{sf}/{t}.parquet").withColumns({k: F.col(k) + BIG for k in keys})
    frames = {"orders": up("orders", "o_orderkey", "o_custkey"), "customer": up("customer", "c_custkey"),
              "lineitem": up("lineitem", "l_orderkey", "l_partkey", "l_suppkey")}
    for name, df in frames.items():
        df.coalesce(1).write.parquet(f"{root}/{name}.parquet")
    for t in TABLES:
        if t not in frames:
            (root / f"{t}.parquet").symlink_to(f"{sf}/{t}.parquet")
    return str(root)


def _made(spark, root, name):
    if name in TABLES:
        return spark.read.parquet(f"{root}/{name}.parquet")
    return spark.sql(FRAMES[name], **{p: _made(spark, root, p) for p in PARENTS[name]})


@pytest.mark.parametrize("name", ["notices", "attachments", "projects"])
def test_frames_take_keys_of_any_size(spark, big_tables, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{big_tables}/{t}.parquet" + ("/*.parquet" if t in ("orders", "customer", "lineitem") else "") + "')")
    df = _made(spark, big_tables, name)
    got = sorted(repr(tuple(r)) for r in df.collect())
    heads = ", ".join(f"{n} AS ({q})" for n, q in frame_ctes(name))
    assert got == sorted(map(repr, con.execute(f"WITH {heads} SELECT {', '.join(df.columns)} FROM {name}").fetchall()))
    assert df.select("ord").distinct().count() >= 0.9 * len(got) > 0


def test_counters_of_any_length(spark):
    rows = [("p", "c", "受理", n, "0", "1", "") for n in ("123456789012", "9" * 60, "0", "000", "00007", "-1", "", "x")]
    got = audit.stage_summary(spark.createDataFrame(rows, "prov string, city string, stage string, n_official string, n_external string, n_all string, error string"))
    assert {(r["official"], r["external"], r["sampled"]) for r in got.collect()} == {(3, 0, 8)}


def test_windows_split_until_no_range_is_full(spark):
    days = spark.createDataFrame([("k", i, 10) for i in range(200)], "k string, i int, n long").select(
        "k", F.date_add(F.lit("1000-01-01").cast("date"), F.col("i")).alias("day"), "n")
    start, end = F.lit("1000-01-01").cast("date"), F.lit("1000-12-31").cast("date")
    got = layout.capped_windows(days, ["k"], start, end, 11).collect()
    assert sum(r["n"] for r in got) == 2000 and not any(r["over_cap"] for r in got)


def test_too_many_parts_are_refused(spark):
    rows = spark.createDataFrame([("p", "c", "2024-01-01", "", "x、y", 5)], "prov_code string, city_code string, notice_date string, county string, combined_units string, ord long")
    assert [int(r["ord"]) for r in select_field(rows, "export").orderBy("ord").collect()] == [5_000_000, 5_000_001]
    wide = rows.withColumn("combined_units", F.repeat(F.lit("甲、"), 1_000_001))
    with pytest.raises(Exception, match="too many parts"):
        select_field(wide, "export").agg(F.max("ord")).collect()


def test_positions_in_groups_that_span_ranges(spark):
    rows = spark.createDataFrame([("hot" if i % 10 else f"k{i}", i) for i in range(3000)], "k string, i long").repartition(7)
    got = sequence.index_within(rows, ["k"], [F.col("i")]).collect()
    want = {}
    for k, i in sorted((r["k"], r["i"]) for r in got):
        want.setdefault(k, []).append(i)
    assert {(r["k"], r["i"], r["seq"]) for r in got} == {(k, i, n + 1) for k, v in want.items() for n, i in enumerate(v)}


def _envelope(city, names):
    return json.dumps({"省编码": "320000", "模块": [1], "记录": [["1", city, n, "", "2024-01-01", ""] for n in names]}, ensure_ascii=False)


@pytest.mark.parametrize("size", ["128m", "200b"])
def test_record_order_follows_files_and_envelopes(spark, tmp_path, size):
    """Two files of one city, several envelopes to a file: the order does not depend on how files are split."""
    files = {"320100_a.json": [["甲", "乙"], ["丙"]], "320100_b.json": [["丁"], ["戊", "己"], ["庚"]], "part-0.json": [["辛", "壬"]]}
    for name in sorted(files, reverse=True):  # written in another order
        (tmp_path / name).write_text("\n".join(_envelope("320100", names) for names in files[name]), encoding="utf-8")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        rows = RD.read_records(spark, str(tmp_path), lines=True).select("process_department", "ord").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len({r["ord"] for r in rows}) == 9
    assert [r[0] for r in sorted(rows, key=lambda r: r["ord"])] == list("甲乙丙丁戊己庚辛壬")


def test_files_that_arrive_during_a_read_change_nothing(spark, tmp_path, monkeypatch):
    files = {"320100_b.json": [["甲", "乙"], ["丙"]], "320100_c.json": [["丁"], ["戊"]]}
    for name, envelopes in files.items():
        (tmp_path / name).write_text("\n".join(_envelope("320100", names) for names in envelopes), encoding="utf-8")
    number = RD.global_index

    def late(*args):
        (tmp_path / "320100_a.json").write_text(_envelope("320100", ["新"]), encoding="utf-8")
        return number(*args)
    monkeypatch.setattr(RD, "global_index", late)
    rows = RD.read_records(spark, str(tmp_path), lines=True).select("process_department", "ord").collect()
    assert [r[0] for r in sorted(rows, key=lambda r: r["ord"])] == list("甲乙丙丁戊") and len({r["ord"] for r in rows}) == 5


def test_one_city_files_keep_their_order(spark):
    """The check of the one-city form, over ranges of several envelopes each."""
    from tools.check import compare, connect
    from workload import all_queries
    sf = "/root/testdata/sf0.01"
    queries, checks = all_queries()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    try:
        ok, note = compare(spark, connect(sf), "src_01_one_city_form", queries["src_01_one_city_form"], checks["src_01_one_city_form"], sf)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert ok, note


def test_interval_join_meets_little_more_than_its_windows(spark):
    """A spelling with notices on every day of ten years joins the days around a unit's window only."""
    units = spark.createDataFrame([("u", "c", "2020-06-30", "局", "局 / 处")], "unit_uid string, city_code string, last_notice_date string, name_from_source string, name_variants string")
    days = spark.createDataFrame([("c", "局", i, str(date(2015, 1, 1) + timedelta(i))) for i in range(3650)],
                                 "city_code string, process_department string, ord long, notice_date string")
    hits = samples.evidence_samples(units, days, days=20, per_unit=100)
    assert [r["ord"] for r in hits.orderBy("ord").collect()] == list(range(1987, 2008))
    plan = hits._jdf.queryExecution().optimizedPlan().toString()
    join = next(x for x in plan.splitlines() if "Join Inner" in x)
    assert "_bucket" in join and "city_code" in join and "name" in join


def test_variants_are_sorted_without_a_comparator(spark):
    rows = [("p", "c", "a", "f", n, d, k, i) for i, (n, d, k) in enumerate([("甲局", date(2020, 1, 1), 5), ("乙局", date(2021, 1, 1), 1), ("丙局", None, 9), ("甲局", date(2022, 1, 1), 1), ("丁局", date(2020, 1, 1), 7)])]
    spellings = spark.createDataFrame(rows, "prov_code string, city string, area string, function string, name string, last_date date, n long, first long").withColumn("recovered", F.lit(False))
    merged = units.merge_units(spellings)
    row = merged.first()
    assert (row["unit"], list(row["variants"]), row["record_count"]) == ("甲局", ["乙局", "丁局", "丙局"], 23)
    plan = merged._jdf.queryExecution().optimizedPlan().toString()
    assert "array_sort" not in plan and "sort_array" in plan


def test_intermediates_need_a_shared_folder(spark):
    class Bare:
        conf = type("C", (), {"get": staticmethod(lambda key, default=None: default)})
        sparkContext = spark.sparkContext
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Bare())
    assert session.shared_dir(spark).endswith(spark.sparkContext.applicationId)


def test_store_rewrites_only_changed_parts(spark, tmp_path):
    store = MasterStore(spark, str(tmp_path / "s"), "p", "p string, k string, n long")
    batch = lambda *rows: spark.createDataFrame([Row(p=p, k=k, n=n) for p, k, n in rows])
    add = lambda old, new: old.unionByName(new).groupBy("p", "k").agg(F.sum("n").alias("n"))
    for number, rows in enumerate(([("a", "x", 1), ("b", "x", 1)], [("a", "x", 2)], [("a", "y", 5)], [("a", "x", 4)])):
        store.merge(batch(*rows), number, add)
        store.merge(batch(*rows), number, add)  # a replay
    assert sorted(tuple(r) for r in store.read().collect()) == [("a", "x", 7), ("a", "y", 5), ("b", "x", 1)]
    folders = {at: sorted(store.table.folders("rows", at)) for at in store.table.folders("rows")}
    a, b = "_part=v61", "_part=v62"
    assert folders == {"at=0": [a, b], "at=2": [a], "at=3": [a]}


def test_store_keeps_rows_without_a_part(spark, tmp_path):
    store = MasterStore(spark, str(tmp_path / "s"), "p", "p string, k string, n long")
    batch = lambda *rows: spark.createDataFrame(rows, "p string, k string, n long")
    add = lambda old, new: old.unionByName(new).groupBy("p", "k").agg(F.sum("n").alias("n"))
    for number, rows in enumerate(([(None, "x", 1), ("", "x", 10), ("a/b c", "x", 100)], [(None, "x", 2)], [("", "x", 5), ("a/b c", "y", 1)])):
        store.merge(batch(*rows), number, add)
    want = {(None, "x", 3), ("", "x", 15), ("a/b c", "x", 100), ("a/b c", "y", 1)}
    assert {tuple(r) for r in store.read().collect()} == want
    store.merge(batch(("a/b c", "x", 0)), 3, lambda old, new: new.filter("n > 0"))  # a part may become empty
    assert {tuple(r) for r in store.read().collect()} == {w for w in want if w[0] != "a/b c"}


def test_store_shows_whole_batches_only(spark, tmp_path):
    """A batch that breaks off before its manifest is written leaves the table as it was, and can be repeated."""
    store = MasterStore(spark, str(tmp_path / "s"), "p", "p string, k string, n long")
    batch = spark.createDataFrame([("a", "x", 1), ("b", "x", 1)], "p string, k string, n long")
    put = lambda old, new: new
    store.merge(batch, 0, put)
    commit, store.table.commit = store.table.commit, lambda *_: (_ for _ in ()).throw(OSError("lost"))
    with pytest.raises(OSError):
        store.merge(batch.withColumn("n", F.col("n") + 1), 1, put)
    assert {r["n"] for r in store.read().collect()} == {1}
    store.table.commit = commit
    store.merge(batch.withColumn("n", F.col("n") + 2), 1, put)
    assert {r["n"] for r in store.read().collect()} == {3}


def test_first_seen_has_no_horizon(spark, tmp_path):
    schema = "k string, i int, day date"
    draw, want, batches = random.Random(4), {}, []
    for number in range(7):
        rows = [(draw.choice([None, "", *map(str, range(60))]), draw.choice([None, *range(4)]), date(2000 + number, 1, 1 + draw.randrange(28))) for _ in range(80)]
        batches.append(rows)
        for k, i, day in sorted(rows, key=lambda r: r[2]):
            want.setdefault((k, i), day)
    for bits in (1 << 16, 64):  # a filter that tells little changes nothing
        seen = FirstSeen(spark, str(tmp_path / str(bits)), ["k", "i"], schema, filter_bits=bits, parts=3)
        for number, rows in enumerate(batches):
            for _ in range(2):
                seen.merge(spark.createDataFrame(rows, schema), number, F.col("day"))
        assert sorted(map(repr, ((r["k"], r["i"], r["day"]) for r in seen.read().collect()))) == sorted(map(repr, ((*k, d) for k, d in want.items())))
        assert len(seen.table.state()["rows"]) <= 4


def test_grown_files_give_their_new_records(spark, tmp_path):
    folder, log = tmp_path / "states", RecordLog(spark, str(tmp_path / "log"), parts=3)
    folder.mkdir()

    def save(name, *envelopes):
        (folder / name).write_text("\n".join(_envelope("320100", names) for names in envelopes), encoding="utf-8")

    def taken(run):
        return sorted((r["file_stem"], r["process_department"]) for r in log.read().filter(F.col("run") == run).collect())

    save("a_甲市.json", ["甲", "乙", "乙"])
    save("b{x}[1]_乙市.json", ["甲"])
    assert log.ingest(str(folder), lines=True) == 0 and log.ingest(str(folder), lines=True) is None
    assert taken(0) == [("a_甲市", "乙"), ("a_甲市", "乙"), ("a_甲市", "甲"), ("b{x}[1]_乙市", "甲")]
    save("a_甲市.json", ["乙", "乙", "甲"], ["丙", "乙"])  # saved again in another order, with a new and a repeated record
    save("c_丙市.json", ["甲"])
    assert log.ingest(str(folder), lines=True) == 1
    assert taken(1) == [("a_甲市", "丙"), ("a_甲市", "乙"), ("c_丙市", "甲")]
    save("a_甲市.json", ["甲"])  # started anew: nothing is taken back, and nothing comes twice
    assert log.ingest(str(folder), lines=True) == 2 and taken(2) == [] and log.read().count() == 7


def test_classification_shuffles_no_notices(spark, places):
    """Agencies and brackets come back as small tables, addresses are located where they stand; totals go by distinct wordings."""
    from regwise.plans.notices import approval_agreement, classify, classify_counts
    rows = [("320000", "320100", "南京市生态环境局受理公示（玄武）", "南京市生态环境局", ["玄武区中山路1号", None, "无名"], "南京市生态环境局"),
            ("320000", None, "江苏省生态环境厅受理公示", "江苏省生态环境厅", ["鼓楼区1号"], ""), ("320000", "999999", "公示", None, None, None)]
    notices = spark.createDataFrame(rows * 3, "prov_code string, city_code string, title string, source string, locations array<string>, channel_org string")
    out = classify(notices, places)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan
    assert out.count() == 9 and {tuple(r.project_districts) for r in out.collect()} >= {("玄武", ""), ()}
    counts = classify_counts(notices, places)
    assert [r.n for r in counts.select("n").collect()] == [3, 3, 3]
    assert approval_agreement(counts).collect() == approval_agreement(out).collect()


def test_large_frames_are_not_written(spark):
    from pathlib import Path
    from regwise.session import shared_dir
    from workload.frames import LARGE, Frames
    f = Frames(spark, "/root/testdata/sf0.001")
    before = set(Path(shared_dir(spark).removeprefix("file:")).glob("*"))
    for name in LARGE:
        assert getattr(f, name).columns
    new = {p.name.rsplit("-", 1)[0] for p in set(Path(shared_dir(spark).removeprefix("file:")).glob("*")) - before}
    assert not new & set(LARGE) and "area" in new


def test_notice_files_are_written_where_they_are_made(spark):
    """No task takes in more than its share: the files need no exchange and grow in number with the table."""
    from pathlib import Path
    from workload.frames import Frames
    from workload.q_io import notice_files
    f = Frames(spark, "/root/testdata/sf0.001")
    path, schema = notice_files(f, rows=200)
    files = spark.read.schema(schema).parquet(path).inputFiles()
    assert len(files) >= f.notices.count() // 200 and Path(path.removeprefix("file:")).exists()


def test_address_parts_are_read_once(spark):
    """Four parts of the page and five of the link are matched once each, and dots are resolved only where there are some."""
    from regwise.functions.url import resolve
    rows = [("http://a.cn/x/y/p.html?q", h) for h in ("../n.html", "./n.html", "n.html", "/r/./n", "?z", "#m", "//b.cn/n", "mailto:x", "..")]
    df = spark.createDataFrame(rows, "base string, href string").select(resolve(F.col("base"), F.col("href")).alias("url"))
    assert df._jdf.queryExecution().analyzed().toString().count("regexp_extract(") == 9
    assert [r.url for r in df.collect()] == [
        "http://a.cn/x/n.html", "http://a.cn/x/y/n.html", "http://a.cn/x/y/n.html", "http://a.cn/r/n", "http://a.cn/x/y/p.html?z",
        "http://a.cn/x/y/p.html?q#m", "http://b.cn/n", "mailto:x", "http://a.cn/x/"]


def test_reach_is_one_row_a_site(spark, monkeypatch):
    """Levels are written with one row for a site; several homes of a site share their visit, and their targets go by position."""
    from regwise.operators import pages
    written, durable = [], pages.durable
    monkeypatch.setattr(pages, "durable", lambda df, label: (written.append((label, durable(df, label))), written[-1][1])[1])
    edges = spark.createDataFrame([("a", "x", 5), ("b", "y", 3), ("a", "z", 9), ("a", "x", 7), ("b", "x", 1), ("x", "b", 1), ("x", "w", 2), ("y", "v", 1)],
                                  "src string, dst string, pos long")
    homes = spark.createDataFrame([("s", "a"), ("s", "b"), ("t", "q")], "site string, url string")
    out = sorted((r.site, r.visit, r.depth, r.url) for r in pages.bounded_reach(homes, edges, 2, 5).collect())
    assert out == [("s", 1, 0, "a"), ("s", 1, 0, "b"), ("s", 2, 1, "x"), ("s", 3, 1, "y"), ("s", 4, 1, "z"), ("s", 5, 2, "w"), ("t", 1, 0, "q")]
    assert [df.count() for label, df in written if label == "reach"] == [2, 2, 2]


def test_fill_summary_counts_projects_once(spark):
    from pathlib import Path
    from regwise.session import shared_dir
    from workload.frames import Frames
    from workload.q_notices import fill_summary_q
    counts = lambda: set(Path(shared_dir(spark).removeprefix("file:")).glob("slices-*"))
    before = counts()
    assert fill_summary_q(Frames(spark, "/root/testdata/sf0.001")).count() > 0
    assert len(counts() - before) == 1


def test_appended_projects_are_classified_once(spark, monkeypatch):
    from workload import q_io
    from workload.frames import Frames
    sources, append = [], q_io.WR.append_projects
    monkeypatch.setattr(q_io.WR, "append_projects", lambda rows, path: (sources.append(rows.inputFiles()), append(rows, path)))
    back = q_io.append_q(Frames(spark, "/root/testdata/sf0.001"))
    assert [any("lineitem" in x for x in s) for s in sources] == [True, False]
    assert back.agg(F.sum(F.col("n") % 2)).first()[0] == 0


def test_lines_meet_orders_that_know_their_customers(spark):
    """Lines are joined to orders once; the join of orders and customers lies below that join."""
    from workload.frames import Frames
    plan = Frames(spark, "/root/testdata/sf0.001").notices._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = lambda key: next(x.index("Join Inner") for x in plan if "Join Inner" in x and key in x)
    assert depth("c_custkey") > depth("l_orderkey")


def test_wordings_are_counted_in_one_pass(spark, places, monkeypatch):
    """Projects are read for one count; blanks and nulls give no hint, but count for their wording."""
    from regwise.operators import channels
    written, durable = [], channels.durable
    monkeypatch.setattr(channels, "durable", lambda df, label: (written.append(label), durable(df, label))[1])
    rows = [("320000", "南京市", "320100", p, d, o) for o, (p, d) in enumerate(
        [("行政审批局", ""), ("行政审批局 ", "玄武"), ("行政审批局", None), ("行政审批局环评科", "鼓楼"), ("", "玄武"), (None, "玄武")])]
    projects = spark.createDataFrame(rows, "prov_code string, city string, city_code string, publisher string, project_district string, ord long")
    projects.select("*").write.parquet(path := f"{session.scratch_path(spark, 'projects')}")
    projects = spark.read.parquet(path)
    units_ = spark.createDataFrame([("320000", "南京市|玄武|行政审批")], "prov_code string, function_key string")
    out = channels.attribute_with_hints(projects, units_, places)
    assert written == ["districts"] and not any("projects-" in x for x in out.inputFiles())
    assert [(r.name, r.n) for r in out.collect()] == [("行政审批局", 4)]
    hints = channels.location_hints(projects)
    assert [(r.project_district, r.n, r["rank"]) for r in hints.orderBy("rank").collect()] == [("玄武", 1, 1), ("鼓楼", 1, 2)]


def test_titles_are_made_once(spark):
    """Filters and publishers read a title that is there, instead of making it again from the line."""
    from regwise.operators import channels
    from workload import q_notices
    from workload.frames import Frames
    f = Frames(spark, "/root/testdata/sf0.001")
    parts = "送出工程环境影响评价文件受理情况的公示"  # stands in the text of one title form
    for df in (channels.published(channels.accepted(q_notices.titles_of(f))), q_notices.accepted_q(f), q_notices.declared_q(f)):
        assert df._jdf.queryExecution().optimizedPlan().toString().count(parts) == 1
    titles = q_notices.titles_of(f)
    assert titles.columns == ["prov_code", "city", "city_code", "url", "title", "ord"]
    assert titles.select("ord", "title").exceptAll(f.notices.select("ord", "title")).count() == 0 < titles.count() == f.notices.count()


def test_portal_titles_leave_their_texts_behind(spark, places, monkeypatch):
    """The first record of a publisher is found among rows without titles and page texts; nulls mark nothing."""
    from regwise.operators import channels
    written, durable = {}, channels.durable
    monkeypatch.setattr(channels, "durable", lambda df, label: written.setdefault(label, durable(written.setdefault(f"{label} plan", df), label)))
    page = ("320000", "南京市", "320100", "玄武", "http://x/")
    rows = [(*page, "南京市生态环境局关于受理玄武项目的公示", "公示", "环评", "门户", "首页", "2"), (*page, None, "公示", "环评", "门户", "首页", "1"),
            (*page, "公示", "公示", "环评", "门户", "玄武分局", "3"), (*page, "南京市生态环境局关于批复的公示", None, "环评", "门户", None, "4")]
    titles = spark.createDataFrame(rows, "prov_code string, city string, city_code string, district_short string, url string, title string, "
                                         "column_title string, link_text string, source_title string, page_text string, ord string")
    units_ = spark.createDataFrame([("320000", f"南京市|{a}|生态环境") for a in ("玄武", "市本级")], "prov_code string, function_key string")
    hits = channels.county_channel_hits(titles, units_, places).collect()
    plan = written["published plan"]._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert "Aggregate" in plan[0] and "title" not in plan[0] and "page_text" not in plan[0]
    got = {r.publisher: (r["all"], r.n, r.ord, r.names_county, r.eco_page) for r in written["published"].collect()}
    assert got == {"南京市生态环境局": (2, 1, "2", True, False), "": (2, 0, "1", False, True)}
    assert [(r.unit_key, r.n) for r in hits] == [("南京市|玄武|生态环境", 1)]
