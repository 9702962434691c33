"""Invariants of the plans, on small records and under skew."""

import json
import random

from pyspark.sql import functions as F

from regwise.operators import layout as L, sequence as SQ, spellings as S, units as UN
from regwise.operators.pages import bounded_reach
from regwise.plans.clean import clean
from regwise.plans.master import allocate_uids
from regwise.sources import readers as RD, writers as WR

RECORD = ("ord long, module int, prov_code string, city_code string, city_name string, process_department string, "
          "combined_units string, notice_date string, county string, city_field string")


def record(i, name, city="320100", day="2024-01-01", county="", combined=""):
    return (i, 1, "320000", city, "", name, combined, day, county, "")


def run(spark, places, rows):
    return clean(spark.createDataFrame(rows, RECORD), places)


def test_kept_plus_dropped_plus_blank_is_everything(spark, places):
    names = ["南京市生态环境局", "南京市玄武生态环境局", "玄武区环境保护局", "郑州市生态环境局", "", "　", "我局(江宁)", "南京市行政审批局", "某公司"]
    rng = random.Random(5)
    rows = [record(i, rng.choice(names), day=f"2024-01-{rng.randint(1, 28):02d}", county=rng.choice(["玄武区", ""])) for i in range(500)]
    done = run(spark, places, rows)
    kept = done.units.agg(F.sum("record_count")).first()[0]
    dropped = done.dropped.agg(F.sum("n")).first()[0]
    assert kept + dropped + sum(1 for r in rows if not r[5].strip()) == len(rows)


def test_result_does_not_depend_on_partitions_or_order(spark, places):
    names = ["南京市生态环境局", "玄武区生态环境局", "南京市生态环境局玄武分局", "玄武环保局", "南京市数据局"]
    rows = [record(i, names[i % 5], day=f"2024-01-{i % 9 + 1:02d}", county="玄武区" if i % 3 else "") for i in range(200)]
    one = run(spark, places, rows).units
    other = clean(spark.createDataFrame(list(reversed(rows)), RECORD).repartition(7), places).units
    key = lambda df: sorted(map(str, df.drop("_x").collect()))
    assert key(one) == key(other)


def test_hot_spelling(spark, places):
    """One spelling holds most rows; the counts combine before any shuffle."""
    rows = [record(i, "南京市生态环境局", county="玄武区") for i in range(3000)] + [record(9000 + i, f"玄武区第{i}局") for i in range(300)]
    units = run(spark, places, rows).units
    assert units.filter("unit = '南京市生态环境局'").first().record_count == 3000
    plan = S.spelling_stats(S.select_field(spark.createDataFrame(rows, RECORD)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_count") >= 1


def test_recovery_needs_one_group_and_county(spark, places):
    rows = [record(1, "南京市江宁区行政审批局", county="江宁区"), record(2, "京市江宁区行政审批", county="江宁区"),
            record(3, "市江宁区行政审批局", county="江宁区"), record(4, "江宁区行政审批局", county=""),
            record(5, "市江宁区行政审批", county="")]
    done = run(spark, places, rows)
    assert done.units.count() == 1 and done.units.first().record_count >= 3


def test_zone_follows_the_larger_partner(spark):
    rows = [("p", "c", "太湖度假区", 9), ("p", "c", "国家太湖度假区", 4), ("p", "c", "太湖开发区", 1), ("p", "c", "湖度假区", 9)]
    got = UN.canonical_zones(spark.createDataFrame(rows, "prov_code string, city string, area string, n long")).collect()
    # the long head touches both others, two larger partners: it stays
    assert {(r.area, r.canonical) for r in got} == set()
    got = UN.canonical_zones(spark.createDataFrame(rows[:3], "prov_code string, city string, area string, n long")).collect()
    assert {(r.area, r.canonical) for r in got} == {("国家太湖度假区", "太湖度假区")}


def test_uids_are_stable(spark):
    rows = spark.createDataFrame([("320000", "k1", "甲", "c", 5, "a", "f"), ("320000", "k2", "乙", "c", 9, "a", "f")],
                                 "prov_code string, function_key string, unit string, city string, record_count long, area string, function string")
    prev = spark.createDataFrame([("JS0007", "320000", "k1", "甲"), ("JS0041", "320000", "k9", "丁")],
                                 "unit_uid string, prov_code string, function_key string, name_from_source string")
    first = {r.unit: r.unit_uid for r in allocate_uids(rows, prev).collect()}
    assert first == {"甲": "JS0007", "乙": "JS0042"}
    again = allocate_uids(rows, allocate_uids(rows, prev).withColumnRenamed("unit", "name_from_source").select(*prev.columns))
    assert {r.unit: r.unit_uid for r in again.collect()} == first


def test_global_order_helpers_match_brute_force(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice(["", "x", "y"]), "hot" if i % 3 else "cold") for i in rng.sample(range(5000), 2000)]
    df = spark.createDataFrame(rows, "n long, v string, k string")
    ordered = sorted(rows)
    assert {(r.n, r.idx) for r in SQ.global_index(df, [F.col("n")]).collect()} == {(r[0], i) for i, r in enumerate(ordered)}
    want, last = {}, ""
    for n, v, _ in ordered:
        last = v or last
        want[n] = last
    assert {r.n: r.v for r in SQ.forward_fill(df, [F.col("n")], "v").collect()} == want
    seq = {}
    for n, _, k in ordered:
        seq.setdefault(k, []).append(n)
    got = {r.n: r.seq for r in SQ.index_within(df, ["k"], [F.col("n")]).collect()}
    assert got == {n: i + 1 for ns in seq.values() for i, n in enumerate(ns)}
    runs = sorted((r.first, r.last, r.size) for r in SQ.runs(df, "n").collect())
    assert sum(r[2] for r in runs) == len(rows) and all(r[1] - r[0] + 1 == r[2] for r in runs)


def test_bounded_reach_matches_a_queue(spark):
    rng = random.Random(11)
    edges = {(a, b): p for p, (a, b) in enumerate((rng.randrange(60), rng.randrange(60)) for _ in range(400))}
    df = spark.createDataFrame([(str(a), str(b), p) for (a, b), p in edges.items()], "src string, dst string, pos long")
    homes = spark.createDataFrame([("s0", "0"), ("s1", "1")], "site string, url string")
    got = {}
    for r in bounded_reach(homes, df, 3, 12).collect():
        got.setdefault(r.site, []).append((r.visit, r.url))
    for site, home in (("s0", 0), ("s1", 1)):
        queue, seen = [(home, 0)], []
        while queue and len(seen) < 12:
            u, d = queue.pop(0)
            if u in seen:
                continue
            seen.append(u)
            if d < 3:
                queue += [(b, d + 1) for (a, b), p in sorted(edges.items(), key=lambda e: e[1]) if a == u and b not in seen]
        assert [u for _, u in sorted(got[site])] == [str(u) for u in seen]


def test_capped_windows(spark):
    from datetime import date
    rows = [("a", date(2024, 1, d), 10 if d != 5 else 100) for d in range(1, 17)]
    out = L.capped_windows(spark.createDataFrame(rows, "k string, day date, n long"), ["k"], F.lit("2024-01-01").cast("date"),
                           F.lit("2024-01-16").cast("date"), 50).collect()
    assert sum(r.n for r in out) == 250 and [r.d0.day for r in out if r.over_cap] == [5]
    assert all(r.n < 50 or r.d0 == r.d1 for r in out)


def test_record_files(spark, tmp_path):
    tree = {"编码": "320000", "名称": "江苏省", "简称": "江苏", "市": [
        {"编码": "320100", "名称": "南京市", "简称": "南京", "区县": [{"编码": "320102", "名称": "玄武区", "简称": "玄武"}]},
        {"编码": "320300", "名称": "徐州市", "简称": "徐州", "区县": []}]}
    env = {"省编码": "320000", "抓取日期": "2024-01-01", "模块": [1, 3], "地区树": tree, "已完成": [[1, "320100"]], "城市统计": {},
           "截断警告": [], "记录": [[1, "320100", "甲局", "甲局、乙局", "2024-01-01", "玄武", "南京"], [3, "320100", "乙局", "", "2024-01-02", ""]]}
    (tmp_path / "320100_南京市.json").write_text(json.dumps(env, ensure_ascii=False, indent=1), encoding="utf-8")
    (tmp_path / "330100_杭州市.json").write_text(json.dumps({**env, "省编码": "330000"}, ensure_ascii=False), encoding="utf-8")
    rows = RD.read_province(spark, str(tmp_path), "320000").orderBy("ord").collect()
    assert [(r.city_name, r.module, r.process_department, r.city_field) for r in rows] == [("南京市", 1, "甲局", "南京"), ("南京市", 3, "乙局", "")]
    assert RD.read_province(spark, str(tmp_path), "320000", module=3).count() == 1
    envelopes = RD.read_envelopes(spark, str(tmp_path), "32*.json")
    assert [(r.file_stem, r.module) for r in RD.unfinished(envelopes).collect()] == [("320100_南京市", 3)]
    assert [(r.city_name, r.district_name) for r in RD.area_of_tree(envelopes).orderBy("city_code").collect()] == [("南京市", "玄武区"), ("徐州市", None)]


def test_entry_logs_and_tables(spark, tmp_path):
    head = "单位,首页入口,受理公示入口,审批前公示入口,审批后意见入口,入口（点击路径）,备注,核验情况,核验日期\n"
    for stem, unit in (("320600_南通市", "高新区行政审批局"), ("000000_省级及国家", "江苏省生态环境厅")):
        (tmp_path / f"{stem}.csv").write_text("﻿" + head + f"{unit},http://a,http://b,,,,,已核实,2024-01-01\n,,,,,,,,\n", encoding="utf-8")
    got = {(r.city, r.unit, r["首页入口"]) for r in RD.read_entry_logs(spark, str(tmp_path)).collect()}
    assert got == {("南通市", "高新区行政审批局", "http://a"), ("—", "江苏省生态环境厅", "http://a")}
    table = RD.read_table(spark, str(tmp_path / "320600_南通市.csv"), ["单位", "首页入口"])
    assert table.first()["单位"] == "高新区行政审批局"


def test_write_guards(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    path = str(tmp_path / "t")
    WR.create_only(df, path)
    try:
        WR.create_only(df, path)
        raise AssertionError("an existing table was overwritten")
    except Exception as e:
        assert "already exists" in str(e)
    WR.append_missing(spark.createDataFrame([("b", 9), ("c", 3)], "k string, v int"), path, ["k"])
    assert {(r.k, r.v) for r in spark.read.parquet(path).collect()} == {("a", 1), ("b", 2), ("c", 3)}
    assert WR.readback_differences(df.union(spark.createDataFrame([("c", 3)], "k string, v int")), path).count() == 0


def test_shared_dir_is_read_from_the_session(spark):
    from regwise import session
    path = session.scratch_path(spark, "x")
    assert path.startswith(session.shared_dir(spark))
