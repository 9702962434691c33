"""Table-driven cases of the naming, place, notice and attachment rules."""

import urllib.parse

import pytest
from pyspark.sql import functions as F

from regwise.functions import agency as A, notice as N, page as P, text as T, url as U
from regwise.operators.places import judge, locate

# Names, titles and file names with the reading they must get.
ROLES = {
    "扬州市邗江生态环境局": "生态环境", "经开区分局": "生态环境", "淮安市生态环局": "生态环境", "张家港市安环局": "生态环境",
    "镇江市生态环境和应急管理局": "生态环境", "无锡市大数据管理局": "行政审批", "泰州市姜堰区政务服务大厅": "行政审批",
    "江苏常州经济开发区管理委员会": "开发区管委会", "淮安工业园区": "开发区管委会", "扬州市邗江区司法局": "其他部门",
    "泰州市水利局医药高新区分局": "其他部门", "安徽自贸试验区蚌埠片区改革创新局": "行政审批", "定远县数据资源管理局": "行政审批",
    "驻合肥市政务服务管理局生态环境窗口": "生态环境", "安庆市公安局森林分局": "其他部门", "江苏省扬州市宝应县人民政府": "其他部门",
}


def test_roles(spark):
    df = spark.createDataFrame([(k,) for k in ROLES], "name string").select("name", A.role_of(F.col("name")).alias("role"))
    assert {r.name: r.role for r in df.collect()} == ROLES


AREAS = [  # province, name, queried city, county -> city, area
    ("340000", "马鞍山市和县生态环境分局", "340500", "", ("马鞍山市", "和")),
    ("340000", "马鞍山市住房和城乡建设局", "340500", "", ("马鞍山市", "市本级")),
    ("340000", "驻合肥市政务服务管理局生态环境", "340100", "", ("合肥市", "市本级")),
    ("340000", "行政服务中心环保局", "340100", "庐江", ("合肥市", "庐江")),
    ("340000", "行政服务中心环保局", "340100", "", None),
    ("340000", "生态环境分局", "340100", "庐江", None),
    ("340000", "行政服务中心环保局", "340400", "庐江", None),
    ("340000", "毛集实验区环保局", "340400", "", ("淮南市", "毛集实验区")),
    ("999999", "毛集实验区环保局", "340400", "", None),
    ("320000", "淮安市生态环境局", "320800", "", ("淮安市", "市本级")),
    ("320000", "淮安市淮安生态环境局", "320800", "", ("淮安市", "淮安")),
    ("320000", "淮安市生态环境局开发区分局", "320800", "涟水县", ("淮安市", "本级开发区")),
    ("320000", "鼓楼区水务局", "320400", "", None),
    ("320000", "江苏省生态环境厅", "320100", "", ("—", "省级")),
    ("320000", "江苏省南京市数据局", "320300", "", ("南京市", "市本级")),
    ("320000", "生态环境部", "320100", "", ("—", "国家")),
    ("320000", "南京经济技术开发区管委会", "320100", "江宁", ("南京市", "本级开发区")),
    ("330000", "宁波杭州湾新区环境保护局", "330200", "", ("宁波市", "湾新区")),
    ("330000", "杭州湾上虞经济技术开发区生态环境分局", "330100", "", ("绍兴市", "湾上虞开发区")),
]


def test_areas(spark, places):
    rows = [(i, p, n, c, d) for i, (p, n, c, d, _) in enumerate(AREAS)]
    df = locate(spark.createDataFrame(rows, "i int, prov_code string, name string, city_code string, county string"), places)
    got = {r.i: (r.city, r.area) if r.area is not None else None for r in df.collect()}
    assert got == {i: a[4] for i, a in enumerate(AREAS)}


def test_misplaced(spark, places):
    names = {"驻合肥市政务服务管理局生态环境": None, "郑州市生态环境局": "标错地区", "合肥市第九化工有限公司": "不规范", "我局(合肥市)": "不规范"}
    rows = [("340000", n, "340100", "") for n in names]
    df = judge(spark.createDataFrame(rows, "prov_code string, name string, city_code string, county string"), places)
    assert {r.name: r.drop_reason for r in df.collect()} == names


NOTICES = [  # city, title, source, locations, channel org -> meaning, approval district, project districts, radiation
    ("320100", "南京市生态环境局关于2026年9月23日建设项目环境影响评价文件 受理情况的公示（玄武）", "南京市玄武生态环境局",
     ["江苏省南京市玄武区龙蟠路9号兴隆大厦负一、三、四层"], "", ("发文机关", "玄武", ["玄武"], False)),
    ("320100", "南京市生态环境局关于2025年8月1日建设项目环境影响评价文件受理情况的公示（高淳）", "南京市生态环境局",
     ["南京市高淳区古柏街道"], "", ("项目属地", "市本级", ["高淳"], False)),
    ("320100", "2026年09月17日南京市生态环境局受理建设项目环评文件情况公示(辐射)", "南京市生态环境局",
     ["南京江北新区浦滨路"], "", ("业务类别", "市本级", ["江北新区"], True)),
    ("320100", "南京市生态环境局关于220千伏送出工程环境影响评价文件受理情况的公示", "南京市生态环境局", [], "",
     ("业务类别", "市本级", [], True)),
    ("320400", "关于2026年9月18日建设项目生态环境影响评价文件受理情况的公示", "生态环境局", ["经开区"], "", ("无", "", ["本级开发区"], False)),
    ("320400", "关于2026年9月18日建设项目生态环境影响评价文件受理情况的公示", "生态环境局", ["经开区"], "常州市生态环境局",
     ("无", "市本级", ["本级开发区"], False)),
    ("320400", "关于2026年9月10日建设项目生态环境影响评价文件受理情况的公示", "生态环境局", ["溧阳市天目湖镇", "金坛区尧塘街道"],
     "常州市生态环境局", ("无", "市本级", ["溧阳", "金坛"], False)),
    ("", "江苏省生态环境厅公示", "江苏省生态环境厅", ["鼓楼区一路", "丰县二路"], "", ("无", "省级", ["", "丰"], False)),
    ("", "公示", "环境监察局", [], "", ("无", "", [], False)),
]


def test_notices(spark, places):
    from regwise.plans.notices import classify
    rows = [(i, "320000", c, t, s, loc, o) for i, (c, t, s, loc, o, _) in enumerate(NOTICES)]
    df = classify(spark.createDataFrame(rows, "i int, prov_code string, city_code string, title string, source string, "
                                              "locations array<string>, channel_org string"), places)
    got = {r.i: (r.bracket_meaning, r.approval_district, list(r.project_districts), r.radiation) for r in df.collect()}
    assert got == {i: n[5] for i, n in enumerate(NOTICES)}


REPORTS = [
    ("湖环建〔2026〕36号-关于某公司年产730吨光刻胶原料项目环境影响报告书的审查意见.pdf", 0, None, False),
    ("关于某环保科技有限公司技改项目环境影响报告表审批意见的函.pdf", 0, None, False),
    ("台环建（新）〔2026〕25号关于某厂建设项目生态环境影响报告表的许可决定书.pdf", 0, None, False),
    ("建设项目概况、主要环境影响及预防或减轻不良影响的对策或措施.docx", 0, None, False),
    ("环境影响评价公众参与说明.pdf", 0, None, False),
    ("吴兴区埭溪镇共富羊场建设项目报告书公示稿及公众参与说明.zip", 0, None, True),
    ("环评报告-某再生资源回收有限公司-公示稿.pdf", 0, None, True),
    ("某生物化学有限公司5000吨／年β-环糊精项目.pdf", 0, None, True),
    ("（公示文本）某实业有限公司.pdf", 0, None, True),
    ("附件1", 1_600_000, 8, False), ("附件1", 35_400_000, 456, True), ("附件1", 900_000, 456, False), ("附件1", 2_000_000, None, True),
]


def test_reports(spark):
    df = spark.createDataFrame([(i, *r[:3]) for i, r in enumerate(REPORTS)], "i int, label string, size long, pages int")
    got = {r.i: r.report for r in df.select("i", N.is_report(F.col("label"), F.col("size"), F.col("pages")).alias("report")).collect()}
    assert got == {i: r[3] for i, r in enumerate(REPORTS)}


@pytest.mark.parametrize("fn,cases", [
    (T.normalize, {" 2023年4月21日苏州市生态环境局　": "苏州市生态环境局", "某局环评窗口": "某局", "某局行政审批科(监督管理科)": "某局"}),
    (T.core, {"景宁畲族自治县": "景宁畲族", "溧水区": "溧水", "南京市": "南京"}),
    (N.stage_of, {"受理并拟批准公示": "受理", "拟作出审批意见的公示": "拟审批", "关于某项目的批复": "审批决定", "新闻": ""}),
    (N.publisher_of, {"金华市生态环境局婺城分局关于某项目受理的公告": "金华市生态环境局婺城分局", "关于受理的公告": "",
                      "​2016年7月1日省环保厅关于受理的公告": "省环保厅"}),
    (N.parse_source, {"首页 来源：港区管委会访问量：3": "港区管委会", "文章来源: 某局 发布时间": "某局", "无": ""}),
    (T.split_badges, {"管委会(甲局、乙局，丙局)": "甲局 / 乙局 / 丙局", "管委会": ""}),
    (T.strip_annotation, {"【某局（含甲局6条）】": "【某局（含甲局6条）".strip("【】 ") , "某局(太湖办)": "某局(太湖办)", "某局（旧名：乙）": "某局"}),
    (U.norm_url, {"https://www.a.gov.cn/x/": "a.gov.cn/x"}), (U.host, {"http://WWW.a.cn/x": "www.a.cn", "https://www.b.cn": "b.cn"}),
    (U.url_prefix, {"http://a.cn/b/c/d.html?x=1": "/b/c", "http://a.cn": ""}),
])
def test_scalars(spark, fn, cases):
    df = spark.createDataFrame([(k,) for k in cases], "x string").select("x", fn(F.col("x")).alias("y"))
    assert {r.x: r.y for r in df.collect()} == cases


def test_resolve_agrees_with_urllib(spark):
    bases = ["http://a.cn/b/c/d.html?q=1#f", "https://a.cn", "http://a.cn/b/"]
    refs = ["x.html", "/y", "../z", "../../../z", "./w/./v", "?p=2", "//h.cn/k", "http://m.cn/n", "a/b/../c/", "..", "x#t", "javascript:void(0)"]
    rows = [(b, r) for b in bases for r in refs]
    df = spark.createDataFrame(rows, "b string, r string").select("b", "r", U.resolve(F.col("b"), F.col("r")).alias("u"))
    bad = [(x.b, x.r, x.u, urllib.parse.urljoin(x.b, x.r)) for x in df.collect() if x.u != urllib.parse.urljoin(x.b, x.r)]
    assert not bad


def test_nested_table_and_titles(spark):
    page = ("<table><tr><td>[打印]<table><tr><td>x</td></tr><tr><th>序号</th><th>项目名称</th><th>建设地点</th><th>建设单位</th></tr>"
            "<tr><td>1</td><td>甲</td><td>一路&amp;</td><td>乙</td></tr></table></td></tr></table>"
            "<title>短</title><h1><span>这是一个足够长的标题文字 | 站点</span></h1>")
    from regwise.operators.pages import page_records, page_titles
    df = spark.createDataFrame([(1, "http://a.cn/", page)], "page_id int, url string, html string")
    recs = page_records(df).collect()[0].horizontal
    assert [(r["项目名称"], r["建设地点"], r["建设单位"]) for r in recs] == [("甲", "一路&", "乙")]
    assert page_titles(df).collect()[0].title == "这是一个足够长的标题文字"


def test_page_families(spark):
    pages = {
        "dahan": "x dataproxy.jsp?unitid=1&amp;webid=2' proxyUrl:'/p.jsp'", "xxgk": 'module/xxgk/ tree.jsp?area=ABC"',
        "truecms": "messageController/getMessage.do columnId:'9' proxyUrl:'/q'", "jpaas": 'jpaas-publish-server webId="1" pageId="2" tplSetId="3"',
        "ewb": "EWB-FRONT", "static": "<html>"}
    df = spark.createDataFrame([(k, v, "http://a.cn/col/col7/index.html") for k, v in pages.items()], "k string, html string, url string")
    got = {r.k: r.c for r in df.select("k", P.classify_cms(F.col("html"), F.col("url")).alias("c")).collect()}
    assert {k: v.family for k, v in got.items()} == {k: k for k in pages}
    assert got["dahan"].params == {"unitid": "1", "webid": "2", "api": "http://a.cn/p.jsp"}
    assert got["xxgk"].params["only"] == "art_7_"
