"""Jobs over a table of pages (page_id, url, html)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regwise import rules as R
from regwise.functions import page as P
from regwise.functions.entities import unescape, unescape_all
from regwise.functions.notice import attachment_label, is_attachment, is_report, parse_source
from regwise.functions.text import squash, strip
from regwise.functions.url import column_of, host, is_government, resolve, url_prefix
from regwise.session import durable, once


def raw_anchors(pages: DataFrame) -> DataFrame:
    """One row per anchor: page_id, page_url, pos, its opening tag and inner markup."""
    found = once(pages.select("page_id", F.col("url").alias("page_url"), "html"), _anchors=P.anchors(F.col("html")))
    each = found.select("page_id", "page_url", F.posexplode("_anchors").alias("pos", "anchor"))
    parts = once(each, tag=P.anchor_tag(F.col("anchor")), inner=P.anchor_inner(F.col("anchor")))
    return parts.select("page_id", "page_url", F.col("pos").cast("long").alias("pos"), "tag", "inner")


def extract_links(pages: DataFrame) -> DataFrame:
    """Article links of each page: absolute url and title.

    The title attribute wins over the tag-free text; list, index, anchor and
    script links are left out. Only links that hold an entity leave the JVM:
    the candidates are written once, and the others are finished as they are.
    """
    attr = P.attribute(F.col("tag"), "title")
    text = F.when(strip(attr) != "", attr).otherwise(P.tag_free(F.col("inner")))
    found = raw_anchors(pages).select("page_id", "page_url", "pos", P.attribute(F.col("tag"), "href").alias("href"), text.alias("text"))
    href = F.col("href")
    article = (href != "") & ~href.rlike(R.LIST_LINK) & href.rlike(R.ARTICLE_LINK)
    candidates = durable(once(found, article=article, coded=href.contains("&") | F.col("text").contains("&")).filter(
        F.col("article") | href.contains("&")), "links")
    plain = candidates.filter(~F.col("coded")).select(*found.columns)
    decoded = candidates.filter("coded").select("page_id", "page_url", "pos", unescape(href).alias("href"), unescape("text").alias("text"))
    kept = plain.unionByName(once(decoded, article=article).filter("article").select(*found.columns))
    return kept.select("page_id", "page_url", "pos", F.when(F.col("href").startswith("http"), F.col("href")).otherwise(
        resolve(P.origin(F.col("page_url")), F.col("href"))).alias("url"), strip(F.col("text")).alias("title"))


def extract_anchors(pages: DataFrame) -> DataFrame:
    """All anchors with an address: absolute url and visible text.

    A text that is too short or ends with an ellipsis gives way to the title
    attribute; a ``?t=_blank`` tail is removed.
    """
    href = F.regexp_extract("tag", "href=[\"']([^\"'#]+)", 1)
    attr = F.regexp_extract("tag", "title=[\"']([^\"']+)", 1)
    text = F.col("text")
    cut = (F.length(text) < 2) | text.endswith("...") | text.endswith("…")
    read = once(raw_anchors(pages), href=href, attr=attr, text=P.page_text(F.col("inner"))).filter("href <> ''")
    linked = once(read.select("page_id", "page_url", "pos", F.when((F.col("attr") != "") & cut, F.col("attr")).otherwise(text).alias("text"), "href"),
                  url=F.regexp_replace(resolve(F.col("page_url"), strip(F.col("href"))), "(?s)\\?t=_blank.*$", ""))
    return linked.select("page_id", "page_url", "pos", "text", "url")


def notice_links(links: DataFrame, pattern: str) -> DataFrame:
    """Links to notices: article address, long title, matching the channel's pattern."""
    title = squash(F.col("title"))
    return links.filter((F.length(title) > 12) & title.rlike(pattern) & F.col("url").rlike(R.NOTICE_HREF) & ~F.col("url").contains("javascript"))


def majority(df: DataFrame, keys: list[str], value: Column, order: Column, to: str) -> DataFrame:
    """Most frequent value per key, ties to the first seen; counts combine before the shuffle."""
    n = df.groupBy(*keys, value.alias("_v")).agg(F.count(F.lit(1)).alias("_n"), F.min(order).alias("_o"))
    return n.groupBy(*keys).agg(F.min_by("_v", F.struct((-F.col("_n")).alias("a"), "_o")).alias(to))


def same_column(links: DataFrame) -> DataFrame:
    """Links that share the page's own path prefix, or the majority prefix when no link does."""
    prefixed = links.withColumn("_p", url_prefix(F.col("url"))).withColumn("_own", url_prefix(F.col("page_url")))
    has_own = prefixed.groupBy("page_id").agg(F.bool_or(F.col("_p") == F.col("_own")).alias("_has"))
    most = majority(prefixed, ["page_id"], F.col("_p"), F.col("pos"), "_most")
    return (prefixed.join(has_own.join(most, "page_id"), "page_id")
            .filter(F.col("_p") == F.when(F.col("_has"), F.col("_own")).otherwise(F.col("_most"))).drop("_p", "_own", "_has", "_most"))


def page_titles(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", P.pick_title(unescape_all(P.title_of_page(F.col("html")))).alias("title"))


def _decoded(records: Column) -> Column:
    """Records with the few entities of table cells decoded in the JVM."""
    plain = lambda c: F.replace(F.replace(F.replace(F.replace(c, F.lit("&lt;"), F.lit("<")), F.lit("&gt;"), F.lit(">")),
                                          F.lit("&nbsp;"), F.lit(" ")), F.lit("&amp;"), F.lit("&"))
    return F.transform(records, lambda r: F.struct(*[plain(r[f]).alias(f) for f in P.FIELDS]))


def page_records(pages: DataFrame) -> DataFrame:
    """The three readings of each page: horizontal table, label/value table, running text."""
    page = F.col("_flat")
    return once(pages.select("page_id", "url", "html"), _flat=P.flat(F.col("html"))).select(
        "page_id", "url", _decoded(P.horizontal_records(P.innermost_tables(page))).alias("horizontal"),
        _decoded(P.vertical_records(page)).alias("vertical"), _decoded(P.inline_records(P.body_text(page))).alias("inline"))


def parse_notice_pages(pages: DataFrame) -> DataFrame:
    """Source, title and records per page; the first reading with records counts.

    White space is evened out once; the text, both readings of tables and the
    running text start from that. The vertical tables are read only where no
    horizontal one has records, the running text only where no table has.
    """
    page = F.col("_flat")
    evened = once(pages.select("page_id", "url", "html"), _flat=P.flat(F.col("html")), _titles=P.title_of_page(F.col("html"))).drop("html")
    text = once(evened, _text=P.body_text(page), _h=P.horizontal_records(P.innermost_tables(page)))
    tables = once(text, _v=F.when(F.size("_h") == 0, P.vertical_records(page))).drop("_flat")
    no_table = (F.size("_h") == 0) & (F.size("_v") == 0)
    read = once(tables, source=parse_source(F.col("_text")),
                recs=_decoded(F.when(F.size("_h") > 0, F.col("_h")).when(no_table, P.inline_records(F.col("_text"))).otherwise(F.col("_v"))))
    kept = read.select("page_id", "url", "source", "recs", unescape_all("_titles").alias("_titles"))
    return (kept.withColumn("title", P.pick_title(F.col("_titles")))
            .withColumn("locations", F.transform("recs", lambda r: r["建设地点"])).drop("_titles"))


def cms_families(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", "url", P.classify_cms(F.col("html"), F.col("url")).alias("c")).select("page_id", "url", "c.family", "c.params")


def candidate_columns(anchors: DataFrame, site: str = "page_url") -> DataFrame:
    """Addresses that look like a channel, per site; the first evidence is kept.

    A notice points to the column it belongs to; other links count by text.
    """
    own = anchors.filter((F.col("text") != "") & (host(F.col("url")) == host(F.col("page_url"))))
    is_notice = F.col("text").rlike(R.NOTICE_TEXT)
    by_text = (F.length("text") <= 24) & ~F.col("url").rlike(R.SKIP_LINK) & F.col("text").rlike(R.CHANNEL_TEXT)
    picked = once(own.select(F.col(site).alias("site"), "page_id", "pos", "text", "url"),
                  column_url=F.when(is_notice, F.nullif(column_of(F.col("url")), F.lit(""))).when(by_text, F.col("url")),
                  evidence=F.when(is_notice, F.concat(F.lit("公告："), F.substring("text", 1, 30))).otherwise(F.col("text")))
    found = picked.filter(F.col("column_url").isNotNull())
    return found.groupBy("site", "column_url").agg(F.min_by("evidence", F.struct("page_id", "pos")).alias("evidence"))


def follow_edges(anchors: DataFrame) -> DataFrame:
    """(src, dst, pos) along links that are worth following on the same host."""
    return (anchors.filter(F.col("text").rlike(R.FOLLOW_TEXT) & (F.length("text") <= 24) & ~F.col("url").rlike(R.SKIP_LINK)
                           & (host(F.col("url")) == host(F.col("page_url"))))
            .select(F.col("page_url").alias("src"), F.col("url").alias("dst"), "pos"))


def bounded_reach(homes: DataFrame, edges: DataFrame, depth: int = R.MAX_DEPTH, max_pages: int = R.MAX_PAGES) -> DataFrame:
    """Pages reached from each home in breadth-first order: (site, url, depth, visit).

    At most ``max_pages`` pages per site and ``depth`` links away. A page is one
    row with its first ``2 * max_pages`` distinct targets, a site is one row
    with its pages: fewer than ``max_pages`` of the targets can be visited
    already, and no more than ``max_pages`` can still be visited. Each level
    joins the pages visited last to their targets and is written, so a lost
    executor repeats one level only.
    """
    order = Window.partitionBy("src").orderBy("pos", "dst")
    links = edges.groupBy("src", "dst").agg(F.min("pos").alias("pos"))
    links = links.withColumn("_k", F.row_number().over(order)).filter(F.col("_k") <= 2 * max_pages)
    targets = F.transform(F.sort_array(F.collect_list(F.struct("_k", "pos", "dst"))), lambda x: F.struct(x["pos"].alias("pos"), x["dst"].alias("dst")))
    links = durable(links.groupBy(F.col("src").alias("url")).agg(targets.alias("targets")), "links")
    page = lambda url, level, visit: F.struct(url.alias("url"), F.lit(level).alias("depth"), visit.cast("long").alias("visit"))
    reached = durable(homes.groupBy("site").agg(F.collect_list(page(F.col("url"), 0, F.lit(1))).alias("pages")), "reach")
    done = F.array_max(F.transform("pages", lambda p: p["visit"]))
    room = F.lit(max_pages) - done
    for level in range(1, depth + 1):
        # sites that used up their pages are not expanded any further; of a page, as many targets as are visited or have room
        ends = reached.filter(done < max_pages).select(
            "site", (room + F.size("pages")).cast("int").alias("_most"), F.inline(F.filter("pages", lambda p: p["depth"] == level - 1)))
        told = F.slice("targets", F.lit(1), F.col("_most"))
        steps = ends.join(links, "url").select("site", "visit", (told if level == 1 else told["dst"]).alias("targets")).groupBy("site").agg(
            F.collect_list(F.struct("visit", "targets")).alias("_steps"))
        # visits differ but for the homes of one site, whose targets are merged by position
        found = F.flatten(F.transform(F.sort_array("_steps"), lambda x: x["targets"]))
        found = F.sort_array(found)["dst"] if level == 1 else found
        fresh = F.slice(F.array_except(found, F.col("pages")["url"]), F.lit(1), F.greatest(room, F.lit(0)).cast("int"))
        more = F.transform(fresh, lambda u, i: page(u, level, done + 1 + i))
        reached = durable(reached.join(steps, "site", "left").select(
            "site", F.concat("pages", F.coalesce(more, F.array().cast(reached.schema["pages"].dataType))).alias("pages")), "reach")
    return reached.select("site", F.inline("pages"))


def attachments(pages: DataFrame, files: DataFrame) -> DataFrame:
    """Per page: report attachments on official and other hosts, all attachments, first samples.

    ``files`` gives size and page count of known addresses (url, size, pages).
    """
    href = F.regexp_extract("tag", "href=[\"']([^\"']+)[\"']", 1)
    attr = F.regexp_extract("tag", "title=[\"']([^\"']*)", 1)
    read = once(raw_anchors(pages), href=href).filter("href <> ''")
    linked = once(read, url=resolve(F.col("page_url"), strip(F.col("href"))))
    found = (once(linked, label=attachment_label(P.page_text(F.col("inner")), attr, F.col("url")))
             .filter(is_attachment(F.col("url"), F.col("label"))))
    sized = (found.join(files.select("url", "size", "pages"), "url", "left")
             .withColumn("size", F.coalesce("size", F.lit(0))))
    report = is_report(F.col("label"), F.col("size"), F.col("pages"))
    official = is_government(F.regexp_extract("url", "^[A-Za-z]+://([^/?#]*)", 1))
    shown = F.substring(strip(F.col("label")), 1, 50)
    tagged = F.concat(shown, F.lit(" ["), F.format_string("%.1f", F.col("size") / 1e6), F.lit("MB]"))
    first = lambda cond, value, n: F.array_join(F.transform(F.slice(F.sort_array(F.collect_list(
        F.when(cond, F.struct("pos", value.alias("t"))))), 1, n), lambda x: x["t"]), " | ")
    everything = F.lit(True)
    # the anchors of one page all come from one row, so this list is bounded by that row
    per_page = sized.groupBy("page_id").agg(
        F.count_if(report & official).alias("n_official"), F.count_if(report & ~official).alias("n_external"),
        F.count(F.lit(1)).alias("n_all"), first(report & official, tagged, 2).alias("samples"), first(everything, shown, 4).alias("labels"))
    return (pages.select("page_id", "url").join(per_page, "page_id", "left").na.fill(0, ["n_official", "n_external", "n_all"])
            .na.fill("", ["samples", "labels"]))
