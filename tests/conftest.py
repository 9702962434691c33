import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    s = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g")
         .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC").config("spark.checkpoint.dir", shared).getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s
    from regwise.session import remove_shared
    remove_shared(s)


AREA = [  # province, city, districts
    ("340000", "安徽省", "安徽", "340100", "合肥市", "合肥", [("340111", "包河区", "包河"), ("340124", "庐江县", "庐江")]),
    ("340000", "安徽省", "安徽", "340500", "马鞍山市", "马鞍山", [("340523", "和县", "和")]),
    ("340000", "安徽省", "安徽", "340400", "淮南市", "淮南", []),
    ("320000", "江苏省", "江苏", "320100", "南京市", "南京", [("320102", "玄武区", "玄武"), ("320106", "鼓楼区", "鼓楼"),
                                                     ("320115", "江宁区", "江宁"), ("320118", "高淳区", "高淳")]),
    ("320000", "江苏省", "江苏", "320300", "徐州市", "徐州", [("320302", "鼓楼区", "鼓楼"), ("320321", "丰县", "丰县")]),
    ("320000", "江苏省", "江苏", "320400", "常州市", "常州", [("320481", "溧阳市", "溧阳"), ("320413", "金坛区", "金坛")]),
    ("320000", "江苏省", "江苏", "320800", "淮安市", "淮安", [("320803", "淮安区", "淮安"), ("320826", "涟水县", "涟水")]),
    ("330000", "浙江省", "浙江", "330100", "杭州市", "杭州", [("330110", "余杭区", "余杭")]),
    ("330000", "浙江省", "浙江", "330200", "宁波市", "宁波", [("330206", "北仑区", "北仑")]),
    ("330000", "浙江省", "浙江", "330600", "绍兴市", "绍兴", [("330604", "上虞区", "上虞")]),
    ("999999", "安徽省", "安徽", "340400", "淮南市", "淮南", []),
]
AREA_SCHEMA = ("prov_code string, prov_name string, prov_short string, city_code string, city_name string, city_short string, "
               "city_ord int, district_code string, district_name string, district_short string, district_ord int")


@pytest.fixture(scope="session")
def area(spark):
    rows = []
    for i, (pc, pn, ps, cc, cn, cs, ds) in enumerate(AREA):
        for j, d in enumerate(ds or [(None, None, None)]):
            rows.append((pc, pn, ps, cc, cn, cs, i, *d, j))
    return spark.createDataFrame(rows, AREA_SCHEMA)


@pytest.fixture(scope="session")
def places(area):
    from regwise.operators.places import places_dim
    return places_dim(area).cache()
