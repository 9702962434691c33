"""Agency frames derived from the provided tables.

Each frame is one SQL text that Spark and DuckDB both run, so the Spark query
and its check start from the same rows. ``{name}`` stands for a table or an
earlier frame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from regwise.operators.places import places_dim
from regwise.operators.spellings import judged_spellings, select_field
from regwise.plans.clean import clean
from regwise.session import durable

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Places standing for the regions (by key) and nations (by key).
PROVINCES = ("(0,'320000','江苏省','江苏'),(1,'330000','浙江省','浙江'),(2,'340000','安徽省','安徽'),"
             "(3,'370000','山东省','山东'),(4,'350000','福建省','福建')")
CITIES = (
    "(0,'320100','南京市','南京'),(1,'330100','杭州市','杭州'),(2,'340100','合肥市','合肥'),"
    "(3,'370100','济南市','济南'),(4,'350100','福州市','福州'),(5,'320300','徐州市','徐州'),"
    "(6,'330200','宁波市','宁波'),(7,'340500','马鞍山市','马鞍山'),(8,'370200','青岛市','青岛'),"
    "(9,'350200','厦门市','厦门'),(10,'320800','淮安市','淮安'),(11,'330600','绍兴市','绍兴'),"
    "(12,'340400','淮南市','淮南'),(13,'370300','淄博市','淄博'),(14,'350500','泉州市','泉州'),"
    "(15,'320500','苏州市','苏州'),(16,'331000','台州市','台州'),(17,'341800','宣城市','宣城'),"
    "(18,'370600','烟台市','烟台'),(19,'350600','漳州市','漳州'),(20,'320400','常州市','常州'),"
    "(21,'331100','丽水市','丽水'),(22,'340300','蚌埠市','蚌埠'),(23,'370700','潍坊市','潍坊'),"
    "(24,'350800','龙岩市','龙岩')")
DISTRICTS = (
    "(0,0,'320102','玄武区','玄武'),(0,1,'320106','鼓楼区','鼓楼'),(0,2,'320115','江宁区','江宁'),(0,3,'320118','高淳区','高淳'),"
    "(1,0,'330102','上城区','上城'),(1,1,'330108','滨江区','滨江'),(1,2,'330110','余杭区','余杭'),(1,3,'330122','桐庐县','桐庐'),"
    "(2,0,'340111','包河区','包河'),(2,1,'340124','庐江县','庐江'),(2,2,'340123','肥西县','肥西'),(2,3,'340181','巢湖市','巢湖'),"
    "(3,0,'370102','历下区','历下'),(3,1,'370103','市中区','市中'),(3,2,'370114','章丘区','章丘'),(3,3,'370124','平阴县','平阴'),"
    "(4,0,'350102','鼓楼区','鼓楼'),(4,1,'350104','仓山区','仓山'),(4,2,'350121','闽侯县','闽侯'),(4,3,'350181','福清市','福清'),"
    "(5,0,'320302','鼓楼区','鼓楼'),(5,1,'320321','丰县','丰县'),(5,2,'320322','沛县','沛县'),(5,3,'320324','睢宁县','睢宁'),"
    "(6,0,'330203','海曙区','海曙'),(6,1,'330206','北仑区','北仑'),(6,2,'330281','余姚市','余姚'),(6,3,'330282','慈溪市','慈溪'),"
    "(7,0,'340503','花山区','花山'),(7,1,'340504','雨山区','雨山'),(7,2,'340523','和县','和县'),(7,3,'340521','当涂县','当涂'),"
    "(8,0,'370202','市南区','市南'),(8,1,'370211','黄岛区','黄岛'),(8,2,'370215','即墨区','即墨'),(8,3,'370281','胶州市','胶州'),"
    "(9,0,'350203','思明区','思明'),(9,1,'350211','集美区','集美'),(9,2,'350212','同安区','同安'),(9,3,'350213','翔安区','翔安'),"
    "(10,0,'320803','淮安区','淮安'),(10,1,'320812','清江浦区','清江浦'),(10,2,'320826','涟水县','涟水'),(10,3,'320831','金湖县','金湖'),"
    "(11,0,'330602','越城区','越城'),(11,1,'330604','上虞区','上虞'),(11,2,'330624','新昌县','新昌'),(11,3,'330681','诸暨市','诸暨'),"
    "(12,0,'340402','大通区','大通'),(12,1,'340406','潘集区','潘集'),(12,2,'340421','凤台县','凤台'),(12,3,'340422','寿县','寿县'),"
    "(13,0,'370303','张店区','张店'),(13,1,'370305','临淄区','临淄'),(13,2,'370321','桓台县','桓台'),(13,3,'370323','沂源县','沂源'),"
    "(14,0,'350502','鲤城区','鲤城'),(14,1,'350503','丰泽区','丰泽'),(14,2,'350526','德化县','德化'),(14,3,'350581','石狮市','石狮'),"
    "(15,0,'320505','虎丘区','虎丘'),(15,1,'320506','吴中区','吴中'),(15,2,'320581','常熟市','常熟'),(15,3,'320582','张家港市','张家港'),"
    "(16,0,'331002','椒江区','椒江'),(16,1,'331003','黄岩区','黄岩'),(16,2,'331022','三门县','三门'),(16,3,'331081','温岭市','温岭'),"
    "(17,0,'341802','宣州区','宣州'),(17,1,'341821','郎溪县','郎溪'),(17,2,'341882','广德市','广德'),(17,3,'341881','宁国市','宁国'),"
    "(18,0,'370602','芝罘区','芝罘'),(18,1,'370611','福山区','福山'),(18,2,'370681','龙口市','龙口'),(18,3,'370682','莱阳市','莱阳'),"
    "(19,0,'350602','芗城区','芗城'),(19,1,'350603','龙文区','龙文'),(19,2,'350622','云霄县','云霄'),(19,3,'350629','东山县','东山'),"
    "(20,0,'320402','天宁区','天宁'),(20,1,'320411','新北区','新北'),(20,2,'320413','金坛区','金坛'),(20,3,'320481','溧阳市','溧阳'),"
    "(21,0,'331102','莲都区','莲都'),(21,1,'331121','青田县','青田'),(21,2,'331127','景宁畲族自治县','景宁'),(21,3,'331181','龙泉市','龙泉'),"
    "(22,0,'340302','龙子湖区','龙子湖'),(22,1,'340303','蚌山区','蚌山'),(22,2,'340321','怀远县','怀远'),(22,3,'340322','五河县','五河'),"
    "(23,0,'370702','潍城区','潍城'),(23,1,'370705','奎文区','奎文'),(23,2,'370781','青州市','青州'),(23,3,'370783','寿光市','寿光'),"
    "(24,0,'350802','新罗区','新罗'),(24,1,'350803','永定区','永定'),(24,2,'350821','长汀县','长汀'),(24,3,'350881','漳平市','漳平')")

FRAMES: dict[str, str] = {}

FRAMES["area"] = f"""
SELECT p.prov_code, p.prov_name, p.prov_short, c.city_code, c.city_name, c.city_short,
       n.n_nationkey AS city_ord, d.district_code, d.district_name, d.district_short, d.district_ord
FROM {{nation}} n
JOIN {{region}} r ON n.n_regionkey = r.r_regionkey
JOIN (VALUES {PROVINCES}) AS p(region_key, prov_code, prov_name, prov_short) ON p.region_key = r.r_regionkey
JOIN (VALUES {CITIES}) AS c(city_key, city_code, city_name, city_short) ON c.city_key = n.n_nationkey
JOIN (VALUES {DISTRICTS}) AS d(city_key, district_ord, district_code, district_name, district_short)
  ON d.city_key = n.n_nationkey
"""

# One notice record per order: the publisher is written in one of 40 ways,
# clean and dirty, with the county and city fields partly missing.
FRAMES["records"] = """
SELECT b.ord, b.module, b.prov_code, b.city_code, b.city_name,
       CASE b.k
         WHEN 1 THEN b.city_name || '生态环境局' || b.dcore || '分局'
         WHEN 2 THEN b.district_name || '生态环境局'
         WHEN 3 THEN b.district_name || '环境保护局'
         WHEN 4 THEN b.district_name || '行政审批局'
         WHEN 5 THEN b.city_name || '行政审批局'
         WHEN 6 THEN b.day_text || b.city_name || '生态环境局'
         WHEN 7 THEN ' ' || b.city_name || '生态环境局环评窗口　'
         WHEN 8 THEN b.city_name || b.district_name || '数据局'
         WHEN 9 THEN b.prov_name || '生态环境厅'
         WHEN 10 THEN '生态环境部'
         WHEN 11 THEN b.dcore || '经济技术开发区管委会'
         WHEN 12 THEN b.city_short || '经济技术开发区管理委员会'
         WHEN 13 THEN '国家' || b.dcore || '高新区管委会'
         WHEN 14 THEN b.dcore || '高新区行政审批局'
         WHEN 15 THEN b.city_name || '行政审批'
         WHEN 16 THEN '我局(' || b.dcore || ')'
         WHEN 17 THEN b.city_name || '第' || CAST(b.cust AS STRING) || '化工有限公司'
         WHEN 18 THEN '郑州市生态环境局'
         WHEN 19 THEN '　 '
         WHEN 20 THEN b.district_name || '水务局'
         WHEN 21 THEN b.dcore || '分局'
         WHEN 22 THEN '行政服务中心环保局'
         WHEN 23 THEN '驻' || b.city_name || '政务服务管理局生态环境窗口'
         WHEN 24 THEN '青山镇人民政府'
         WHEN 25 THEN b.city_name || '行审批局'
         WHEN 26 THEN b.city_name || '生态环境局;行政审批局'
         WHEN 27 THEN '生态环境分局'
         WHEN 28 THEN '港区行政审批局'
         WHEN 29 THEN '毛集实验区环保局'
         WHEN 30 THEN b.city_name || '安环局'
         WHEN 31 THEN '杭州湾上虞经济技术开发区生态环境分局'
         WHEN 32 THEN '水' || '务局'
         WHEN 33 THEN b.district_name || '住房和城乡建设局(' || b.dcore || '办、城管局)'
         WHEN 34 THEN '国家东中西区域合作示范区环境保护局'
         WHEN 35 THEN b.city_name || '生态环境局开发区分局'
         ELSE b.city_name || '生态环境局'
       END AS process_department,
       CASE b.ord % 5
         WHEN 0 THEN b.city_name || '生态环境局、' || b.district_name || '生态环境局'
         WHEN 1 THEN b.city_name || '生态环境局'
         WHEN 2 THEN b.city_name || '生态环境局,' || b.city_name || '行政审批局；' || b.district_name || '水务局'
         WHEN 3 THEN b.district_name || '行政审批局， ' || b.city_name || '生态环境局环评科'
         ELSE ''
       END AS combined_units,
       CASE WHEN b.ord % 61 = 0 THEN '' ELSE b.day END AS notice_date,
       CASE WHEN b.ord % 7 = 0 THEN '' ELSE b.district_name END AS county,
       CASE WHEN b.ord % 11 = 0 THEN '' WHEN b.ord % 11 = 1 THEN b.city_name
            WHEN b.ord % 11 = 2 THEN '外地' ELSE b.city_short END AS city_field
FROM (
  SELECT o.o_orderkey AS ord, o.o_custkey AS cust, CAST(o.o_orderkey % 4 + 1 AS INT) AS module,
         a.prov_code, a.prov_name, a.city_code, a.city_name, a.city_short, a.district_name,
         CASE WHEN a.district_name = '景宁畲族自治县' THEN '景宁畲族'
              ELSE substr(a.district_name, 1, length(a.district_name) - 1) END AS dcore,
         CAST(CAST(o.o_orderdate AS DATE) AS STRING) AS day,
         CAST(year(o.o_orderdate) AS STRING) || '年' || CAST(month(o.o_orderdate) AS STRING) || '月'
           || CAST(day(o.o_orderdate) AS STRING) || '日' AS day_text,
         (o.o_orderkey % 40 * 7 + o.o_custkey % 40) % 40 AS k
  FROM {orders} o
  JOIN {customer} c ON o.o_custkey = c.c_custkey
  JOIN {area} a ON a.city_ord = c.c_nationkey AND a.district_ord = o.o_custkey % 4
) b
"""

# One notice per order line: title, source line of the page and up to three
# project addresses. (order, line) repeats in the table, so ``url`` does too.
# ``ord`` writes every key at the full width of a 64-bit number, so that it sorts
# like the keys and stays unique at any size; ``seq`` is a small number to vary texts by.
FRAMES["notices"] = """
SELECT x.ord, x.seq, x.prov_code, x.city_code, x.city_name, x.channel_url, x.url, x.day,
       CASE x.k
         WHEN 0 THEN x.city_name || '生态环境局关于' || x.day_text || '建设项目环境影响评价文件受理情况的公示（' || x.dcore || '）'
         WHEN 1 THEN x.city_name || '生态环境局' || x.dcore || '分局关于' || x.day_text || '拟作出的建设项目环评审批意见的公示'
         WHEN 2 THEN x.day_text || x.city_name || '生态环境局受理建设项目环评文件情况公示(辐射)'
         WHEN 3 THEN x.city_name || '生态环境局关于220千伏送出工程环境影响评价文件受理情况的公示'
         WHEN 4 THEN '关于' || x.day_text || '建设项目生态环境影响评价文件受理情况的公示'
         WHEN 5 THEN x.district_name || '行政审批局关于项目环境影响报告书的批复（报告书）'
         WHEN 6 THEN x.city_name || '行政审批局作出建设项目环评审批决定公告（市级）'
         WHEN 7 THEN x.prov_name || '生态环境厅受理环评文件公示（化工）'
         WHEN 8 THEN '　' || x.day_text || x.dcore || '经济开发区管委会关于受理环评文件的公示'
         ELSE '建设项目环境信息公开'
       END AS title,
       CASE x.k
         WHEN 0 THEN '首页 > 公示 文章来源：' || x.city_name || x.dcore || '生态环境局 发布时间：' || x.day
         WHEN 1 THEN '来源：' || x.city_name || '生态环境局访问量：' || CAST(x.part AS STRING)
         WHEN 4 THEN '来源: 生态环境局　字体：大 中 小'
         WHEN 5 THEN '来源：' || x.district_name || '行政审批局'
         WHEN 8 THEN '正文没有标注'
         ELSE '来源：' || x.city_name || '生态环境局'
       END AS body,
       CASE WHEN x.qty % 4 = 0 THEN ''
            WHEN x.qty % 4 = 1 THEN x.prov_name || x.city_name || x.district_name || '龙蟠路' || CAST(x.part AS STRING) || '号'
            WHEN x.qty % 4 = 2 THEN x.city_name || x.dcore || '经济开发区' || '｜' || x.district_name || '古柏街道'
            ELSE x.district_name || '天目湖镇' || '｜' || '鼓楼区中山路' || '｜' || '无名地址' END AS locations,
       CASE WHEN x.k % 2 = 0 THEN x.city_name || '生态环境局' ELSE '' END AS channel_org
FROM (
  SELECT lpad(CAST(l.l_orderkey AS STRING), 19, '0') || lpad(CAST(l.l_linenumber AS STRING), 10, '0') || lpad(CAST(l.l_partkey AS STRING), 19, '0')
           || lpad(CAST(l.l_suppkey AS STRING), 19, '0') || lpad(CAST(CAST(l.l_quantity AS BIGINT) AS STRING), 19, '0') AS ord,
         l.l_orderkey % 9699690 + l.l_linenumber + l.l_partkey % 9699690 + l.l_suppkey % 9699690 AS seq,
         a.prov_code, a.prov_name, a.city_code, a.city_name, a.district_name,
         CASE WHEN a.district_name = '景宁畲族自治县' THEN '景宁畲族'
              ELSE substr(a.district_name, 1, length(a.district_name) - 1) END AS dcore,
         'http://sthj' || a.city_code || '.gov.cn/col/col' || CAST(l.l_suppkey % 3 AS STRING) || '/index.html' AS channel_url,
         'http://sthj' || a.city_code || '.gov.cn/art/2024/1/' || CAST(l.l_linenumber AS STRING) || '/art_'
           || CAST(l.l_suppkey % 3 AS STRING) || '_' || CAST(l.l_orderkey AS STRING) || '.html' AS url,
         CAST(CAST(l.l_shipdate AS DATE) AS STRING) AS day,
         CAST(year(l.l_shipdate) AS STRING) || '年' || CAST(month(l.l_shipdate) AS STRING) || '月'
           || CAST(day(l.l_shipdate) AS STRING) || '日' AS day_text,
         CAST(l.l_quantity AS INT) AS qty, l.l_partkey AS part, (l.l_orderkey % 10 + l.l_linenumber) % 10 AS k
  FROM {lineitem} l
  JOIN {orders} o ON l.l_orderkey = o.o_orderkey
  JOIN {customer} c ON o.o_custkey = c.c_custkey
  JOIN {area} a ON a.city_ord = c.c_nationkey AND a.district_ord = o.o_custkey % 4
) x
"""

# Entry log: one hand-written line per supplier, several lines for one unit.
FRAMES["entry_log"] = """
SELECT s.s_suppkey AS ord, a.city_code || '_' || a.city_name AS file_stem,
       a.prov_code, a.city_code, a.city_name AS city,
       CASE s.s_suppkey % 6
         WHEN 0 THEN a.city_name || '生态环境局'
         WHEN 1 THEN a.district_name || '行政审批局'
         WHEN 2 THEN a.city_name || '生态环境局'
         WHEN 3 THEN a.district_name || '水务局'
         WHEN 4 THEN a.district_name || '生态环境局'
         ELSE '' END AS unit,
       'https://www.' || a.city_code || '.gov.cn/' AS home_url,
       CASE s.s_suppkey % 5
         WHEN 0 THEN 'http://sthj' || a.city_code || '.gov.cn/col/col' || CAST(s.s_suppkey % 3 AS STRING) || '/index.html'
         WHEN 1 THEN 'https://www.' || a.city_code || '.gov.cn/sthj/slgs/index.html'
         WHEN 2 THEN 'http://shared.gov.cn/hpsl/'
         WHEN 3 THEN ''
         ELSE 'http://10.0.0.' || CAST(s.s_suppkey % 50 AS STRING) || '/hp/list.html' END AS entry_url,
       '首页 > 公示' || CAST(s.s_suppkey % 4 AS STRING) AS entry_path,
       CASE s.s_suppkey % 4 WHEN 0 THEN '已核实' WHEN 1 THEN '推断' WHEN 2 THEN '未核实' ELSE '访问受限' END AS verify_status,
       CASE WHEN s.s_suppkey % 4 = 2 THEN '' ELSE '2024-01-1' || CAST(s.s_suppkey % 10 AS STRING) END AS verify_date,
       '备注' || CAST(s.s_suppkey % 7 AS STRING) AS note
FROM {supplier} s
JOIN {area} a ON a.city_ord = s.s_nationkey AND a.district_ord = s.s_suppkey % 4
"""

# Curated registry of entry pages: known ids, categories and rules by address.
FRAMES["curated"] = """
SELECT min(e.prov_code) AS prov_code, e.entry_url,
       substr(min(e.prov_code), 1, 4) || '-E' || lpad(CAST(min(e.ord) % 900 AS STRING), 3, '0') AS entry_id,
       CASE min(e.ord) % 3 WHEN 0 THEN '混合栏目' ELSE '' END AS entry_category,
       CASE min(e.ord) % 2 WHEN 0 THEN '人工路径' ELSE '' END AS entry_path,
       '标题含受理' AS filter_rule, '' AS title_bracket_meaning,
       CASE min(e.ord) % 5 WHEN 1 THEN '' ELSE '已核实' END AS verify_status,
       CASE min(e.ord) % 5 WHEN 1 THEN '' ELSE '2024-02-02' END AS verify_date
FROM {entry_log} e WHERE e.entry_url <> '' AND e.ord % 3 <> 1 GROUP BY e.entry_url
"""

# Channels: up to three stages per city; every fifth city has one mixed channel.
FRAMES["channels"] = """
SELECT a.prov_code, a.city_code, a.city_name AS city,
       CASE a.district_ord WHEN 0 THEN '受理' WHEN 1 THEN '拟审批' WHEN 2 THEN '审批决定' ELSE '混合' END AS stage,
       'http://sthj' || a.city_code || '.gov.cn/col/col' || CAST(a.district_ord AS STRING) || '/index.html' AS url,
       'http://sthj' || a.city_code || '.gov.cn/' AS home
FROM {area} a
WHERE (a.city_ord % 5 = 4 AND a.district_ord = 3) OR (a.city_ord % 5 <> 4 AND a.district_ord <= a.city_ord % 3)
"""

# Zone dimension: zones some agencies sit in, partly confirmed.
FRAMES["zones"] = """
SELECT a.prov_code, a.city_code || '-Z0' || CAST(a.district_ord + 1 AS STRING) AS zone_id, a.city_code, a.city_name AS city,
       CASE a.district_ord WHEN 0 THEN '本级开发区' WHEN 1 THEN '本级高新区'
            WHEN 2 THEN substr(a.district_name, 1, length(a.district_name) - 1) || '开发区'
            ELSE substr(a.district_name, 1, length(a.district_name) - 1) || '高新区' END AS source_label,
       a.district_short || '片区' AS zone_name, a.district_short AS zone_short,
       CASE a.city_ord % 2 WHEN 0 THEN '国家级' ELSE '' END AS zone_level,
       CASE (a.city_ord + a.district_ord) % 4 WHEN 0 THEN '合署' WHEN 1 THEN '下属部门' WHEN 2 THEN '上级派出' ELSE '' END AS admin_relation,
       CASE WHEN (a.city_ord + a.district_ord) % 3 = 0 THEN '' ELSE a.district_code END AS zone_admin_code,
       a.district_short,
       CASE WHEN a.district_ord % 2 = 0 THEN '是' ELSE '否' END AS confirmed,
       '站点' || a.city_code AS evidence
FROM {area} a
"""

# Attachments of notices: labels of all kinds with size and page count.
FRAMES["attachments"] = """
SELECT lpad(CAST(l.l_orderkey AS STRING), 19, '0') || lpad(CAST(l.l_linenumber AS STRING), 10, '0') || lpad(CAST(l.l_partkey AS STRING), 19, '0')
            || lpad(CAST(l.l_suppkey AS STRING), 19, '0') || lpad(CAST(CAST(l.l_quantity AS BIGINT) AS STRING), 19, '0') AS ord,
       CASE l.l_partkey % 9
         WHEN 0 THEN '环建〔2026〕' || CAST(l.l_linenumber AS STRING) || '号-关于项目环境影响报告书的审查意见.pdf'
         WHEN 1 THEN '环境影响评价公众参与说明.pdf'
         WHEN 2 THEN '共富羊场建设项目报告书公示稿及公众参与说明.zip'
         WHEN 3 THEN '主要环境影响及对策措施.docx'
         WHEN 4 THEN '年产' || CAST(l.l_partkey AS STRING) || '吨环糊精项目.pdf'
         WHEN 5 THEN '（公示文本）实业有限公司.pdf'
         ELSE '附件' || CAST(l.l_linenumber AS STRING) || '.pdf' END AS label,
       CAST(floor(l.l_extendedprice) AS BIGINT) * 40 AS size,
       CASE WHEN l.l_linenumber % 3 = 0 THEN NULL ELSE CAST(l.l_quantity AS INT) END AS pages
FROM {lineitem} l
"""

# Project rows found by reading notice pages, one per order line.
FRAMES["projects"] = """
SELECT n.ord, n.seq, n.prov_code, n.city_code, n.city_name AS city, n.channel_url AS entry_url, n.url AS notice_url,
       CASE WHEN n.seq % 7 = 0 THEN '' ELSE n.city_name || '生态环境局' ||
            CASE WHEN n.seq % 3 = 0 THEN '环评窗口' ELSE '' END END AS publisher,
       CASE n.seq % 4 WHEN 0 THEN '市本级' WHEN 1 THEN a.district_short WHEN 2 THEN '' ELSE a.district_short END AS approval_district,
       CASE n.seq % 5 WHEN 0 THEN '' ELSE a.district_short END AS project_district,
       n.city_name || a.district_name || CASE WHEN n.seq % 6 = 0 THEN '临港经济开发区' ELSE '中山路' END AS location,
       CASE WHEN n.seq % 9 = 0 THEN '是' ELSE '否' END AS radiation
FROM {notices} n JOIN {area} a ON a.city_code = n.city_code AND a.district_ord = n.seq % 4
"""

# Notice pages: the same notices written as HTML, as horizontal tables inside
# a layout table, as label/value tables, as running text, or without fields.
FRAMES["notice_pages"] = """
SELECT o.o_orderkey AS page_id, 'http://sthj' || a.city_code || '.gov.cn/art/2024/1/2/art_1_' || CAST(o.o_orderkey AS STRING) || '.html'
  || CASE WHEN o.o_orderkey % 9 = 6 THEN '?from=col' || CAST(o.o_custkey % 7 AS STRING) WHEN o.o_orderkey % 9 = 8 THEN '?deptcode=D' || CAST(o.o_custkey AS STRING) || '&categorynum=0' || CAST(o.o_custkey % 5 AS STRING) ELSE '' END AS url,
  '<html><head><title>' || a.city_name || '公示_首页</title>'
  || CASE WHEN o.o_orderkey % 3 = 0 THEN '<meta name="ArticleTitle" content="关于受理' || a.district_name || '建设项目&amp;环评文件的公示"/>' ELSE '' END
  || '</head><body><h1>' || a.district_name || '建设项目环评 | 公示</h1>'
  || '<p>文章来源：' || a.city_name || '生态环境局 发布时间：2024</p>'
  || '<a href="/art/2024/1/1/art_12_345.html" title="关于受理' || a.district_name || '建设项目环评文件的公示">关于受理...</a>'
  || '<a href="list.html">列表</a><a href=''../content/0123abcd.html''>公告 &lt;二&gt; 批复环评文件公示信息</a>'
  || '<a href="/files/report' || CAST(o.o_orderkey % 10 AS STRING) || '.pdf">环境影响报告书全本</a>'
  || '<a href="http://other.com/%E9%99%84%E4%BB%B6.pdf" title="附件">审批意见的函</a>'
  || '<a href="/xxgk/index.html">信息公开</a><a href="/hpsl/index.html">环评受理公示</a>'
  || '<iframe src="/visitcount?x=1"></iframe>' || CASE o.o_orderkey % 4 WHEN 0 THEN '<iframe src="inner.html"></iframe>'
       WHEN 1 THEN '<iframe height="9" src=''/frame/list_' || CAST(o.o_custkey AS STRING) || '.html?a=1&amp;b=2''></iframe><iframe src="later.html"></iframe>'
       WHEN 2 THEN '<iframe src="http://sthj' || a.city_code || '.gov.cn/footer.html"></iframe><iframe src="../up.html"></iframe>' ELSE '' END || '<iframe src="http://other.com/f.html"></iframe>'
  || CASE WHEN o.o_orderkey % 9 = 6 THEN '<script src="/module/xxgk/tree.jsp?area=' || a.city_code || '&div=d"></script>'
       WHEN o.o_orderkey % 9 = 7 THEN '<script>post(''messageController/getMessage.do'',columnId:''k' || CAST(o.o_custkey AS STRING) || ''');proxyUrl:''/true/p.do''</script>'
       WHEN o.o_orderkey % 9 = 8 THEN '<link href="EWB-FRONT.css">' ELSE '' END
  || CASE o.o_orderkey % 6
       WHEN 0 THEN '<table><tr><td>版面<table><tr><th>序号</th><th>项目名称</th><th>建设 地点</th><th>建设单位</th></tr>'
         || '<tr><td>1</td><td>项目甲' || CAST(o.o_custkey AS STRING) || '</td><td>' || a.district_name || '一路</td><td>甲公司</td></tr>'
         || '<tr><td>2</td><td>项目乙</td><td> </td><td>乙公司</td></tr>'
         || '<tr><td>3</td><td>项目丙</td><td>' || a.city_name || ' 二路</td></tr></table></td></tr></table>'
       WHEN 1 THEN '<table><tr><td>项目名称</td><td>项目丁' || CAST(o.o_custkey AS STRING) || '</td></tr><tr><td>建设地址</td><td>'
         || a.district_name || '三路</td></tr><tr><td>环评机构</td><td>丁中心</td></tr></table>'
       WHEN 2 THEN '<div>项目名称：项目戊； 建设地点：' || a.district_name || '四路； 建设单位：戊公司；受理日期：2024-01-01</div>'
       WHEN 3 THEN '<script>dataproxy.jsp?columnid=' || CAST(o.o_custkey AS STRING) || '&amp;unitid=7''</script><script>proxyUrl:''/module/p.jsp''</script>'
       WHEN 4 THEN '<script>jpaas-publish-server webId="w' || CAST(o.o_custkey AS STRING) || '" pageId:"p1" tplSetId="t1" tagId="列表" tagid=''次表'' tagId="列表"</script>'
       ELSE '<script>location.href="/col/col' || CAST(o.o_custkey AS STRING) || '/index.html";</script>' END
  || '</body></html>' AS html
FROM {orders} o
JOIN {customer} c ON o.o_custkey = c.c_custkey
JOIN {area} a ON a.city_ord = c.c_nationkey AND a.district_ord = o.o_custkey % 4
"""

# Human decisions on merging two units of one area.
FRAMES["merges"] = """
SELECT a.prov_code, a.city_name AS city, '市本级' AS area, a.city_name || '安环局' AS unit,
       a.city_name || '生态环境局' AS merge_into, CASE WHEN a.city_ord % 3 = 2 THEN '' ELSE '是' END AS confirmed
FROM {area} a WHERE a.district_ord = 0
"""

# Master table of an earlier run: partly still valid, partly gone, one extra column.
FRAMES["previous"] = """
SELECT CASE a.prov_code WHEN '320000' THEN 'JS' WHEN '330000' THEN 'ZJ' WHEN '340000' THEN 'AH' ELSE substr(a.prov_code, 1, 2) END
         || lpad(CAST(a.city_ord * 4 + a.district_ord + 1 AS STRING), 4, '0') AS unit_uid,
       a.prov_code, a.city_code,
       CASE a.district_ord WHEN 0 THEN a.city_name || '|市本级|生态环境' WHEN 1 THEN a.city_name || '|市本级|行政审批'
            WHEN 2 THEN a.city_name || '|市本级|安环局' ELSE a.city_name || '|市本级|撤销' END AS function_key,
       CASE a.district_ord WHEN 0 THEN a.city_name || '生态环境局' WHEN 1 THEN a.city_name || '行政审批局'
            WHEN 2 THEN a.city_name || '安环局' ELSE a.city_name || '撤销局' END AS name_from_source,
       CASE a.district_ord WHEN 0 THEN '正式名' || a.city_code ELSE '' END AS name_canonical,
       CASE WHEN a.city_ord % 4 = 0 THEN '改名' ELSE '' END AS name_status,
       'G' || a.city_code AS group_id, CAST(a.city_ord + 1 AS STRING) AS record_count,
       '生态环境' AS role, '实爬' || CAST(a.district_ord AS STRING) AS crawl_note
FROM {area} a
"""

# What each frame is built from.
PARENTS = {
    "area": ("nation", "region"), "records": ("orders", "customer", "area"),
    "notices": ("lineitem", "orders", "customer", "area"), "entry_log": ("supplier", "area"),
    "curated": ("entry_log",), "channels": ("area",), "zones": ("area",), "attachments": ("lineitem",),
    "projects": ("notices", "area"), "merges": ("area",), "previous": ("area",), "notice_pages": ("orders", "customer", "area"),
}


# One row per order, line or page: made where they are read, with the columns that are asked for.
# Written, they would be the largest tables of a run; whoever reads one twice reduces it first.
LARGE = ("notices", "projects", "attachments", "notice_pages")


def spark_text(name: str) -> str:
    """The SQL of a frame for Spark, which joins in the written order: orders meet their customers before the lines, so that lines are shuffled once."""
    lines, orders = "FROM {lineitem} l\n  JOIN {orders} o ON l.l_orderkey = o.o_orderkey\n", "JOIN {customer} c ON o.o_custkey = c.c_custkey\n"
    return FRAMES[name].replace(f"{lines}  {orders}", f"FROM {{lineitem}} l\n  JOIN ({{orders}} o {orders.rstrip()}) ON l.l_orderkey = o.o_orderkey\n")


class Frames:
    """Tables and derived frames of one data folder, as attributes."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._made: dict[str, DataFrame] = {}

    def cleaned(self, field: str = "proc"):
        """The clean-up of one field, run once; its units are a written table."""
        key = f"cleaned_{field}"
        if key not in self._made:
            done = clean(self.records, self.places, field)
            done.units = durable(done.units, "units")
            self._made[key] = done
        return self._made[key]

    @property
    def judged(self) -> DataFrame:
        if "judged" not in self._made:
            self._made["judged"] = judged_spellings(select_field(self.records), self.places)
        return self._made["judged"]

    @property
    def units(self) -> DataFrame:
        return self.cleaned().units

    @property
    def places(self) -> DataFrame:
        """The place dictionary, written once because every rule joins it."""
        if "places" not in self._made:
            self._made["places"] = durable(places_dim(self.area), "places")
        return self._made["places"]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._made:
            if name in TABLES:
                self._made[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
            else:
                parents = {p: getattr(self, p) for p in PARENTS[name]}
                made = self.spark.sql(spark_text(name), **parents)
                # the others are written once: they stand for input files that are read many times
                self._made[name] = made if name in LARGE else durable(made, name)
        return self._made[name]


def frame_ctes(*names: str) -> list[tuple[str, str]]:
    """The frames and what they need, as ordered (name, SQL) pairs for DuckDB."""
    out: list[tuple[str, str]] = []

    def add(name: str) -> None:
        if name in TABLES or any(name == n for n, _ in out):
            return
        for p in PARENTS[name]:
            add(p)
        out.append((name, FRAMES[name].format(**{p: p for p in PARENTS[name]})))

    for n in names:
        add(n)
    return out


_open: dict[tuple, Frames] = {}


def frames_for(spark: SparkSession, sf_dir: str) -> Frames:
    """One ``Frames`` per session and folder, so written intermediates are shared."""
    key = (spark.sparkContext.applicationId, id(spark), sf_dir)
    if key not in _open:
        _open[key] = Frames(spark, sf_dir)
    return _open[key]
