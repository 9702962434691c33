"""Readers: raw record envelopes, area trees, tables of text, link lists, pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regwise import rules as R, schema as S
from regwise.functions.collections import item
from regwise.functions.text import strip
from regwise.operators.sequence import global_index
from regwise.session import durable, small


def file_stem() -> Column:
    """Name of the file a row came from, without folder and extension."""
    return F.regexp_extract(F.url_decode(F.replace(F.input_file_name(), F.lit("+"), F.lit("%2B"))), "([^/]+)\\.[^./]*$", 1)


def place_in_files() -> Column:
    """Where a row of a file scan stands: file, split, and row of the split."""
    return F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("line"))


def read_envelopes(spark: SparkSession, path: str, glob: str = "*.json", lines: bool = False) -> DataFrame:
    """One row per envelope, with its ``place`` in the files.

    By default a file is one (indented) document and one task's work; with
    ``lines`` a file holds one envelope per line and is split between tasks.
    """
    return (spark.read.schema(S.ENVELOPE).option("multiLine", not lines).option("pathGlobFilter", glob).json(path)
            .withColumn("file_stem", file_stem()).withColumn("place", place_in_files()))


def records_of(envelopes: DataFrame, fields: dict[str, int] = S.PROVINCE_FIELDS) -> DataFrame:
    """One row per record; short records give blanks. ``pos`` is the position in the envelope."""
    more = [c for c in ("place", "envelope") if c in envelopes.columns]
    each = envelopes.select(F.col("省编码").alias("prov_code"), "file_stem", *more, F.posexplode("记录").alias("pos", "r"))
    values = [item(F.col("r"), i).alias(name) for name, i in fields.items()]
    out = each.select("prov_code", "file_stem", F.regexp_replace("file_stem", "^[^_]*_", "").alias("city_name"), *values, *more, "pos")
    return out.withColumn("module", F.col("module").cast("int")) if "module" in fields else out


def read_records(spark: SparkSession, path: str, glob: str = "*.json", lines: bool = False,
                 fields: dict[str, int] = S.PROVINCE_FIELDS) -> DataFrame:
    """Records with ``ord``, the order in which ties are settled.

    Files follow their names, envelopes their place in the file, records their
    position in the envelope. The files are scanned once, into a table that
    numbers and records are then taken from, so a file that arrives meanwhile
    is read whole or not at all. Envelopes are numbered densely (only their
    places are sorted), so ``ord`` is one number, unique whatever the files are
    called and however many envelopes they hold: a position is below 2^31.
    """
    wanted = read_envelopes(spark, path, glob, lines).select("省编码", "记录", "file_stem", "place")
    envelopes = durable(wanted, "envelopes")
    numbers = global_index(envelopes.select("place"), [F.col("place")], "envelope")
    numbered = envelopes.join(small(numbers), "place")
    ord_ = F.col("envelope").cast("decimal(18,0)") * F.lit(2 ** 31).cast("decimal(10,0)") + F.col("pos")
    return records_of(numbered, fields).withColumn("ord", ord_.cast("decimal(28,0)")).drop("place")


def read_province(spark: SparkSession, path: str, prov_code: str, module: int | None = None, lines: bool = False) -> DataFrame:
    """Records of all files of one province (file names start with its first two digits)."""
    out = read_records(spark, path, f"{prov_code[:2]}*.json", lines)
    return out if module is None else out.filter(F.col("module") == module)


def unfinished(envelopes: DataFrame) -> DataFrame:
    """(file_stem, module) pairs that were wanted and are not marked done."""
    own_city = item(F.get(F.col("记录"), F.lit(0)), 1)
    wanted = envelopes.filter(F.size("记录") > 0).select("file_stem", own_city.alias("city_code"), F.explode("模块").alias("module"))
    done = envelopes.select("file_stem", F.explode("已完成").alias("d")).select(
        "file_stem", item(F.col("d"), 0).cast("int").alias("module"), item(F.col("d"), 1).alias("city_code"))
    return wanted.join(done, ["file_stem", "module", "city_code"], "left_anti").select("file_stem", "module")


def area_of_tree(trees: DataFrame) -> DataFrame:
    """Nested trees (column ``地区树``) to one row per district; cities without districts keep one row."""
    cities = trees.select(F.col("地区树.编码").alias("prov_code"), F.col("地区树.名称").alias("prov_name"),
                          F.col("地区树.简称").alias("prov_short"), F.posexplode_outer("地区树.市").alias("city_ord", "c"))
    return cities.select(
        "prov_code", "prov_name", "prov_short", F.col("c.编码").alias("city_code"), F.col("c.名称").alias("city_name"),
        F.col("c.简称").alias("city_short"), "city_ord", F.posexplode_outer("c.区县").alias("district_ord", "d")).select(
        "prov_code", "prov_name", "prov_short", "city_code", "city_name", "city_short", "city_ord",
        F.col("d.编码").alias("district_code"), F.col("d.名称").alias("district_name"), F.col("d.简称").alias("district_short"), "district_ord")


def read_area_tree(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    return area_of_tree(spark.read.schema(S.TREE_FILE).option("multiLine", not lines).json(path))


def normalise_municipality(nodes: DataFrame) -> DataFrame:
    """Area nodes (code, name, short, level, parent) where districts hang directly under a province.

    Such a province becomes its own only city; others are returned unchanged.
    """
    provinces = nodes.filter("level = 1").select(F.col("code").alias("prov"), F.col("name").alias("_n"), F.col("short").alias("_s"))
    shallow = (nodes.join(provinces, nodes["parent"] == provinces["prov"]).groupBy("prov").agg(F.min("level").alias("_l"))
               .filter("_l = 3").join(provinces, "prov"))
    city = shallow.select(F.concat("prov", F.lit("#")).alias("code"), F.col("_n").alias("name"), F.col("_s").alias("short"),
                          F.lit(2).alias("level"), F.col("prov").alias("parent"))
    moved = (nodes.join(shallow.select("prov"), nodes["parent"] == F.col("prov"), "left")
             .withColumn("parent", F.when(F.col("prov").isNotNull(), F.concat("prov", F.lit("#"))).otherwise(F.col("parent"))).drop("prov"))
    return moved.unionByName(city)


def read_table(spark: SparkSession, path: str, columns, sep: str = ",") -> DataFrame:
    """Header table, all text, blanks kept as blank; a byte-order mark is dropped by the reader."""
    ddl = ", ".join(f"`{c}` string" for c in columns)
    return spark.read.schema(ddl).csv(path, header=True, sep=sep, multiLine=True, escape='"').na.fill("")


def read_channels(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated channels; comment and blank lines are skipped, first four fields count."""
    return spark.read.schema(S.CHANNELS).csv(path, sep="\t", comment="#", mode="PERMISSIVE").na.fill("")


def read_entry_logs(spark: SparkSession, path: str) -> DataFrame:
    """Entry logs of all cities; the city comes from the file name ``<code>_<city>.csv``.

    Files of the code 000000 hold provincial and national units.
    """
    ddl = ", ".join(f"`{c}` string" for c in R.ENTRY_LOG_COLUMNS)
    # notes are written by hand and hold line breaks and quotes, so a file is read as a whole
    rows = (spark.read.schema(ddl).csv(path, header=True, multiLine=True, escape='"').withColumn("file_stem", file_stem())
            .withColumn("_line", F.monotonically_increasing_id())
            .na.fill("", list(R.ENTRY_LOG_COLUMNS)))
    city = F.when(F.col("file_stem").startswith("000000"), R.NO_CITY).otherwise(F.regexp_replace("file_stem", "^[^_]*_", ""))
    named = rows.withColumn("city", city).withColumn("unit", strip(F.col("单位"))).filter(F.col("unit") != "")
    return named.withColumn("ord", F.struct("file_stem", "_line")).drop("_line")


def first_available(keys: list[str], *sources: DataFrame) -> DataFrame:
    """Rows of the first source that has the key; later sources only fill gaps."""
    ranked = None
    for i, s in enumerate(sources):
        one = s.withColumn("_tier", F.lit(i))
        ranked = one if ranked is None else ranked.unionByName(one, allowMissingColumns=True)
    best = ranked.groupBy(*keys).agg(F.min("_tier").alias("_tier"))
    return ranked.join(best, [*keys, "_tier"], "left_semi").drop("_tier")


def read_links(spark: SparkSession, path: str) -> DataFrame:
    """``url<TAB>title`` lines; the title is optional, blank lines are dropped."""
    line = strip(F.col("value"))
    parts = F.split(line, "\t", 2)
    return (spark.read.text(path).filter(line != "")
            .select(strip(F.get(parts, F.lit(0))).alias("url"), strip(item(parts, 1)).alias("title")))


def portals_of(text: Column) -> Column:
    return F.from_json(text, S.PORTALS)


def read_portals(spark: SparkSession, path: str, only: list[str] | None = None) -> DataFrame:
    """Map city to district to home page, as rows; ``only`` keeps the named districts."""
    whole = spark.read.text(path, wholetext=True)
    return portal_rows(whole.select(portals_of(F.col("value")).alias("m")), only)


def portal_rows(maps: DataFrame, only: list[str] | None = None) -> DataFrame:
    rows = maps.select(F.explode("m").alias("city", "ds")).select("city", F.explode("ds").alias("district", "home"))
    return rows.filter(F.col("district").isin(*only)) if only else rows


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """A stored page table takes the place of fetching; text is UTF-8."""
    return spark.read.parquet(path).select("page_id", "url", "html")


def samples_of(maps: DataFrame) -> DataFrame:
    """Stored samples (column ``m``) as one row per unit and sample."""
    units = maps.select(F.explode("m").alias("unit_uid", "s"))
    return units.select("unit_uid", F.col("s.单位").alias("unit"), F.col("s.城市").alias("city"), F.posexplode_outer("s.样本").alias("pos", "sample"))


def pending(units: DataFrame, done: DataFrame, key: str = "unit_uid") -> DataFrame:
    """Units that have no stored samples yet."""
    return units.join(done.select(key).distinct(), key, "left_anti")

