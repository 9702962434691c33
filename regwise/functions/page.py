"""Reading of HTML with patterns that run in linear time inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from regwise import rules as R
from regwise.functions.notice import field_of
from regwise.functions.text import let, squash, strip
from regwise.functions.url import query_map, resolve

ANCHOR = r"(?s)<a\b[^>]*>.*?</a>"
FIELDS = tuple(R.FIELD_SYNONYMS)


def tag_free(markup: Column, to: str = "") -> Column:
    return F.regexp_replace(markup, "<[^>]+>", to)


def page_text(page: Column) -> Column:
    """Tag-free, white-space-free text for containment tests."""
    return F.regexp_replace(page, r"(?U)<[^>]+>|\s+", "")


def body_text(page: Column) -> Column:
    return squash(tag_free(page))


def anchors(page: Column) -> Column:
    """All anchors of a page as markup, in order."""
    return F.regexp_extract_all(page, F.lit(ANCHOR), F.lit(0))


def attribute(tag: Column, name: str) -> Column:
    return F.regexp_extract(tag, name + "=[\"']([^\"']*)[\"']", 1)


def anchor_tag(anchor: Column) -> Column:
    return F.regexp_extract(anchor, r"^(<a\b[^>]*>)", 1)


def anchor_inner(anchor: Column) -> Column:
    return F.regexp_extract(anchor, r"(?s)^<a\b[^>]*>(.*?)</a>", 1)


def title_of_page(page: Column) -> Column:
    """Raw candidates of the page title in order of trust (entities still encoded)."""
    meta = F.coalesce(
        F.nullif(F.regexp_extract(page, "<meta\\b[^>]*name=[\"']ArticleTitle[\"'][^>]*content=[\"']([^\"']*)[\"']", 1), F.lit("")),
        F.nullif(F.regexp_extract(page, "<meta\\b[^>]*content=[\"']([^\"']*)[\"'][^>]*name=[\"']ArticleTitle[\"']", 1), F.lit("")))
    heading = F.regexp_extract(page, "<h1\\b[^>]*>(?:\\s*<[^>]*>)*([^<]+)", 1)
    title = F.regexp_extract(page, "<title\\b[^>]*>([^<]*)", 1)
    return F.array(F.coalesce(meta, F.lit("")), heading, title)


def pick_title(candidates: Column) -> Column:
    """First candidate that is longer than 8 characters once cut at a separator."""
    cut = F.transform(candidates, lambda t: strip(F.get(F.split(strip(squash(t)), r"(?U)\s*[|_]\s*"), F.lit(0))))
    return F.coalesce(F.get(F.filter(cut, lambda t: F.length(t) > 8), F.lit(0)), F.lit(""))


# --- tables --------------------------------------------------------------------

# Tables are read from pages in which runs of white space are single spaces already,
# so that a cell needs a pattern of its own only where it holds a tag.

def flat(page: Column) -> Column:
    """The page with each run of white space as one space: what the readings of tables and text start from."""
    return squash(page)


def _behind(pieces: Column) -> Column:
    """All pieces but the first; asking for their number would make them twice."""
    return F.slice(pieces, 2, 1 << 30)


def _cells(row: Column) -> Column:
    found = F.regexp_extract_all(row, F.lit(r"(?is)<t[dh]\b[^>]*>(.*?)(?=</t[dh]>|<t[dh]\b|</tr|\z)"), F.lit(1))
    return F.transform(found, lambda c: F.trim(F.when(c.contains("<"), squash(tag_free(c))).otherwise(c)))


def _rows(markup: Column) -> Column:
    return F.transform(_behind(F.split(markup, r"(?i)<tr\b")), _cells)


def table_parts(page: Column) -> Column:
    """What follows each ``<table``; a part that holds ``</table`` is an innermost table."""
    return _behind(F.split(page, r"(?i)<table\b"))


def innermost_tables(page: Column) -> Column:
    """Rows and cells of every table without a table inside, of a ``flat`` page."""
    inner = F.filter(table_parts(page), lambda t: F.lower(t).contains("</table"))
    return F.transform(inner, lambda t: _rows(F.get(F.split(t, "(?i)</table"), F.lit(0))))


def _no_space(cell: Column) -> Column:
    return F.replace(cell, F.lit(" "), F.lit(""))


def _columns(fields: Column) -> Column:
    """Column index of each field; a field named twice takes the last column, -1 where it is missing."""
    last = lambda f: F.array_position(F.reverse(fields), f).cast("int")
    return F.array(*[F.when(last(f) > 0, F.size(fields) - last(f)).otherwise(-1) for f in FIELDS])


def _record(cells: Column, columns: Column) -> Column:
    at = lambda i: F.get(columns, F.lit(i))
    return F.struct(*[F.when(at(i) >= 0, F.coalesce(F.get(cells, at(i)), F.lit(""))).otherwise("").alias(f)
                      for i, f in enumerate(FIELDS)])


def horizontal_records(tables: Column) -> Column:
    """Records of the table with a header row in which a column is the project address.

    The header is among the first three rows and has at least four cells; of
    several such tables the one with most records is kept.
    """
    header_fields = lambda row: F.transform(F.transform(row, _no_space), field_of)

    def records(table: Column) -> Column:
        heads = F.filter(F.sequence(F.lit(0), F.lit(2)), lambda i: F.coalesce(
            (F.size(F.get(table, i)) >= 4) & F.array_contains(header_fields(F.get(table, i)), "建设地点"), F.lit(False)))
        body = lambda h: F.slice(table, h + 2, F.greatest(F.size(table) - h - 1, F.lit(0)))
        below = lambda h: let(let(header_fields(F.get(table, h)), _columns), lambda cols: F.filter(
            F.transform(body(h), lambda row: _record(row, cols)),
            lambda r: (r["建设地点"] != "") & ~r["建设地点"].contains("建设地点")))
        return let(F.get(heads, F.lit(0)), lambda h: F.when(h.isNull() | (F.size(table) < 2), F.array().cast(RECORDS)).otherwise(below(h)))

    return F.aggregate(F.transform(tables, records), F.array().cast(RECORDS),
                       lambda best, r: F.when(F.size(r) > F.size(best), r).otherwise(best))


RECORDS = "array<struct<" + ",".join(f"`{f}`:string" for f in FIELDS) + ">>"


def _from_pairs(pairs: Column) -> Column:
    """One record from (field, value) pairs, first filled value per field; none without an address."""
    def record(known: Column) -> Column:
        value = lambda f: F.coalesce(F.get(F.filter(known, lambda p: (p["f"] == f) & (p["v"] != "")), F.lit(0))["v"], F.lit(""))
        return F.when(value("建设地点") != "", F.array(F.struct(*[value(f).alias(f) for f in FIELDS]))).otherwise(F.array().cast(RECORDS))

    return let(pairs, record)


def vertical_records(page: Column) -> Column:
    """The label/value record of a ``flat`` page, read up to the table that gives the address."""
    pairs_of = lambda part: F.transform(F.filter(_rows(part), lambda r: F.size(r) >= 2), lambda r: F.struct(
        let(_no_space(F.get(r, F.lit(0))), field_of).alias("f"), F.get(r, F.lit(1)).alias("v")))
    known = F.transform(table_parts(page), lambda t: F.filter(pairs_of(t), lambda p: (p["f"] != "") & (p["v"] != "")))
    used = F.aggregate(known, F.array().cast("array<struct<f:string,v:string>>"), lambda acc, t: F.when(
        F.exists(acc, lambda p: p["f"] == "建设地点"), acc).otherwise(F.concat(acc, t)))
    return _from_pairs(used)


def inline_records(text: Column) -> Column:
    """The record written as running text ``label：value；``."""
    pattern = F.lit("(?U)" + R.INLINE_FIELD)
    labels, values = F.regexp_extract_all(text, pattern, F.lit(1)), F.regexp_extract_all(text, pattern, F.lit(2))
    # most pages name no field in running text; they skip the pattern
    return F.when(~text.rlike("建设地[点址][：:]"), F.array().cast(RECORDS)).otherwise(_from_pairs(F.zip_with(labels, values, lambda a, v: F.struct(field_of(a).alias("f"), strip(v).alias("v")))))


# --- page families -----------------------------------------------------------------

def origin(url: Column) -> Column:
    """Scheme and host; anything but http counts as https."""
    authority = F.regexp_extract(url, "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    return F.concat(F.when(url.startswith("http://"), "http://").otherwise("https://"), authority)


def block_tags(page: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(page, F.lit(R.BLOCK_TAG), F.lit(1)))


def frame_sources(page: Column) -> Column:
    return F.regexp_extract_all(page, F.lit("<iframe[^>]*src=[\"']([^\"']+)"), F.lit(1))


def inner_frame(page: Column, url: Column) -> Column:
    """First same-host frame that is no counter, login, share or footer; blank when none."""
    site = F.regexp_extract(url, "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    targets = F.transform(frame_sources(page), lambda s: resolve(url, F.replace(s, F.lit("&amp;"), F.lit("&"))))
    own = F.filter(targets, lambda u: (F.regexp_extract(u, "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1) == site)
                   & ~u.rlike(R.FRAME_SKIP))
    return F.coalesce(F.get(own, F.lit(0)), F.lit(""))


def js_redirect(page: Column, url: Column) -> Column:
    """Target of a script redirect; only short pages are shells, others blank."""
    target = F.regexp_extract(page, R.SCRIPT_REDIRECT, 1)
    return F.when((target != "") & (F.length(page) <= 4000), resolve(url, target)).otherwise("")


def classify_cms(page: Column, url: Column) -> Column:
    """``struct<family, params>`` by the ordered fingerprints of the page."""
    get = lambda p: F.regexp_extract(page, p, 1)
    site, empty = origin(url), F.create_map().cast("map<string,string>")
    proxy = get(R.PROXY_URL)
    dahan_q = query_map(F.concat(F.lit("?"), F.replace(get(R.DATA_PROXY), F.lit("&amp;"), F.lit("&"))))
    dahan = F.map_concat(dahan_q, F.create_map(F.lit("api"), F.concat(site, F.when(proxy != "", proxy).otherwise(
        "/module/web/jpage/dataproxy.jsp"))))
    area, col = get(R.TREE_AREA), F.regexp_extract(url, R.COLUMN_NUMBER, 1)
    xxgk = F.create_map(F.lit("api"), F.concat(site, F.lit("/module/xxgk/search.jsp")), F.lit("area"), area,
                        F.lit("only"), F.when(col != "", F.concat(F.lit("art_"), col, F.lit("_"))).otherwise(""))
    column = get(R.COLUMN_ID)
    truecms = F.create_map(F.lit("column_id"), column, F.lit("api"), F.concat(site, proxy))
    keys = ("webId", "pageId", "tplSetId")
    found = {k: get(k + R.UNIT_KEY) for k in (*keys, "tagId")}
    jpaas = F.map_filter(F.create_map(*[x for k in found for x in (F.lit(k), found[k])],
                                      F.lit("api"), F.concat(site, F.lit("/api-gateway/jpaas-publish-server/front/page/build/unit"))),
                         lambda _, v: v != "")
    made = lambda name, params: F.struct(F.lit(name).alias("family"), params.alias("params"))
    all_keys = (found["webId"] != "") & (found["pageId"] != "") & (found["tplSetId"] != "")
    return (F.when(page.contains("dataproxy.jsp"), made("dahan", dahan))
            .when(page.contains("module/xxgk/") & (area != ""), made("xxgk", xxgk))
            .when(page.contains("messageController/getMessage.do") & (column != ""), made("truecms", truecms))
            .when(page.contains("jpaas-publish-server") & all_keys, made("jpaas", jpaas))
            .when(url.contains("govInfoPub") | page.contains("EWB-FRONT"), made("ewb", query_map(url)))
            .otherwise(made("static", empty)))
