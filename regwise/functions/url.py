"""URL functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from regwise import rules as R
from regwise.functions.text import let


def norm_url(url: Column) -> Column:
    """URL without scheme, ``www.`` and closing slashes, for comparisons."""
    bare = F.regexp_replace(F.coalesce(url, F.lit("")), "/+$", "")
    return F.regexp_replace(bare, "https://|http://|www\\.", "")


def host(url: Column) -> Column:
    after_scheme = F.element_at(F.split(url, "//"), -1)
    authority = F.get(F.split(after_scheme, "/"), F.lit(0))
    return F.lower(F.regexp_replace(authority, "^www\\.", ""))


def domain(url: Column) -> Column:
    return F.regexp_replace(url, "^https?://([^/]+).*$", "$1")


def is_government(host_name: Column) -> Column:
    return host_name.endswith(".gov.cn") | host_name.rlike("^\\d+\\.\\d+\\.\\d+\\.\\d+")


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, "^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)


def url_prefix(url: Column) -> Column:
    """Leading slash plus the first two path segments."""
    return F.array_join(F.slice(F.split(path_of(url), "/"), 1, 3), "/")


def column_of(url: Column) -> Column:
    """Index page of the column an article belongs to, for the two known URL families."""
    nested = F.regexp_extract(url, R.NESTED_COLUMN, 1)
    site, number = F.regexp_extract(url, R.ARTICLE_ADDRESS, 1), F.regexp_extract(url, R.ARTICLE_ADDRESS, 2)
    return (F.when(nested != "", F.concat(nested, F.lit("/index.html")))
            .when(site != "", F.concat(site, F.lit("/col/col"), number, F.lit("/index.html")))
            .otherwise(""))


def query_map(url: Column) -> Column:
    """Decoded query parameters; the last value of a repeated name wins."""
    query = F.regexp_extract(url, "\\?([^#]*)", 1)
    pairs = F.filter(F.split(query, "&"), lambda p: p.rlike("^[^=]+=.+"))
    decode = lambda c: F.coalesce(F.try_url_decode(c), c)
    keys = F.transform(pairs, lambda p: decode(F.substring_index(p, "=", 1)))
    values = F.transform(pairs, lambda p: decode(F.regexp_replace(p, "^[^=]*=", "")))
    numbered = F.zip_with(keys, values, lambda k, v: F.struct(k.alias("k"), v.alias("v")))
    return F.aggregate(
        numbered, F.create_map().cast("map<string,string>"),
        lambda acc, kv: F.map_concat(F.map_filter(acc, lambda k, _: k != kv["k"]),
                                     F.create_map(kv["k"], kv["v"])))


def page_url_candidates(url: Column, page: Column) -> Column:
    """Addresses at which page ``page`` of a static list may live, by URL shape."""
    base = F.substring_index(url, "?", 1)
    query = F.when(url.contains("?"), F.regexp_replace(url, "^[^?]*", "")).otherwise("")
    query = F.when(query == "?", "").otherwise(query)
    before, this = (page - 1).cast("string"), page.cast("string")
    has_dot = base.contains(".")
    stem = F.regexp_extract(base, "^(.*)\\.[^.]*$", 1)
    ext = F.regexp_extract(base, "\\.([^.]*)$", 1)
    folder = F.regexp_extract(base, "^(.*)/[^/]*$", 1)
    bare = F.regexp_replace(base, "/+$", "")
    numbered = lambda root, n: F.concat(root, F.lit("/index_"), n, F.lit(".html"), query)
    files = F.array(F.concat(stem, F.lit("_"), before, F.lit("."), ext, query),
                    F.concat(stem, F.lit("_"), this, F.lit("."), ext, query),
                    numbered(folder, before), numbered(folder, this))
    folders = F.array(F.concat(bare, F.lit("/"), this, query), numbered(bare, before), numbered(bare, this))
    return F.when(has_dot, files).otherwise(folders)


def resolve(base: Column, href: Column) -> Column:
    """Absolute address of ``href`` on the page ``base`` (RFC 3986, section 5.2); each part of the two is read once."""
    part = lambda c, i: F.regexp_extract(
        c, "^(?:([A-Za-z][A-Za-z0-9+.-]*:))?(//[^/?#]*)?([^?#]*)(\\?[^#]*)?(#.*)?$", i)
    page = F.struct(*[part(base, i).alias(n) for i, n in ((1, "scheme"), (2, "site"), (3, "path"), (4, "query"))])
    own = lambda h: F.struct(h.alias("href"), *[part(h, i + 1).alias(n) for i, n in enumerate(("scheme", "site", "path", "query", "mark"))])
    read = lambda h: F.struct(page.alias("page"), own(h).alias("own"))
    return let(let(href, read), lambda x: _resolved(x["page"], x["own"]))


def _resolved(page: Column, own: Column) -> Column:
    path, query, mark, href = own["path"], own["query"], own["mark"], own["href"]
    site = F.concat(page["scheme"], page["site"])
    merged = F.when(path.startswith("/"), path).otherwise(
        F.concat(F.when(page["path"] == "", "/").otherwise(F.regexp_replace(page["path"], "[^/]*$", "")), path))
    # most paths hold no "." or ".." and are whole as they stand
    target = let(merged, lambda m: F.when(m.rlike("(?:^|/)\\.\\.?(?:/|$)"), _without_dots(m)).otherwise(m))
    return (F.when(own["scheme"] != "", href)
            .when(own["site"] != "", F.concat(page["scheme"], href))
            .when((path == "") & (query == ""), F.concat(site, page["path"], page["query"],
                                                         F.when(mark != "", mark).otherwise("")))
            .when(path == "", F.concat(site, page["path"], query, mark))
            .otherwise(F.concat(site, target, query, mark)))


def _without_dots(path: Column) -> Column:
    segments = F.split(path, "/")
    last = F.element_at(segments, -1)
    kept = F.aggregate(
        segments, F.array().cast("array<string>"),
        lambda acc, s: F.when(s == "..", F.when(F.size(acc) > 1, F.slice(acc, 1, F.size(acc) - 1)).otherwise(acc))
        .when(s == ".", acc).otherwise(F.concat(acc, F.array(s))))
    closed = F.when(last.isin(".", ".."), F.concat(kept, F.array(F.lit("")))).otherwise(kept)
    return F.array_join(closed, "/")
