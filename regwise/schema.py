"""Declared schemas; nothing is inferred."""

from __future__ import annotations

DISTRICT = "struct<`编码`:string,`名称`:string,`简称`:string>"
CITY = "struct<`编码`:string,`名称`:string,`简称`:string,`区县`:array<" + DISTRICT + ">>"
TREE = "struct<`编码`:string,`名称`:string,`简称`:string,`市`:array<" + CITY + ">>"
TREE_FILE = "`省编码` string, `快照日期` string, `来源` string, `地区树` " + TREE
ENVELOPE = ("`省编码` string, `抓取日期` string, `模块` array<int>, `地区树` " + TREE + ", `已完成` array<array<string>>, "
            "`城市统计` map<string,struct<`市`:string,`模块`:string,`抓到`:int,`城市字段不符`:int>>, "
            "`截断警告` array<string>, `记录` array<array<string>>")
# position of each field in a raw record
PROVINCE_FIELDS = {"module": 0, "city_code": 1, "process_department": 2, "combined_units": 3, "notice_date": 4, "county": 5, "city_field": 6}
ONE_CITY_FIELDS = {"process_department": 0, "combined_units": 1, "notice_date": 2}
AREA_NODE = "code string, name string, short string, level int, parent string"
CHANNELS = "city string, stage string, url string, home string"
PORTALS = "map<string,map<string,string>>"
SAMPLES = "map<string,struct<`单位`:string,`城市`:string,`样本`:array<map<string,string>>>>"
