"""Decisions about entry addresses and their propagation; fills and change logs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regwise import rules as R
from regwise.functions.url import domain, norm_url


@dataclass(frozen=True)
class Remap:
    """An address that moved: any address containing ``fragment`` gets the new one."""

    fragment: str
    url: str
    category: str
    note: str


@dataclass(frozen=True)
class Blocked:
    """A host that refused requests."""

    host: str
    status: str
    note: str


def crawl_counts(projects: DataFrame) -> DataFrame:
    """(normalised address, rows): evidence that an entry really yields notices.

    Counted per raw address first, so that the clean-up runs once per address.
    """
    raw = projects.groupBy("entry_url").agg(F.count(F.lit(1)).alias("n"))
    return raw.groupBy(norm_url(F.col("entry_url")).alias("norm")).agg(F.sum("n").alias("crawled"))


def decide(urls: DataFrame, crawled: DataFrame, remaps: list[Remap], blocked: list[Blocked], day: str, crawl_day: str) -> DataFrame:
    """One decision per distinct address: remapped, else blocked, else crawled, else none.

    ``urls`` has ``entry_url``; the result adds new_url, category, status, note,
    decided_on. Remaps and blocked hosts are short caller-given lists.
    """
    distinct = urls.select("entry_url").filter("entry_url <> ''").distinct().withColumn("norm", norm_url(F.col("entry_url")))
    joined = distinct.join(crawled, "norm", "left")
    n, site = F.col("norm"), F.substring_index("norm", "/", 1)
    none = F.lit("")

    def row(new_url=none, category=none, status=none, note=none, kind="") -> Column:
        return F.struct(new_url.alias("new_url"), category.alias("category"), status.alias("status"), note.alias("note"), F.lit(kind).alias("kind"))

    choice = F.when(F.lit(False), row())
    for m in remaps:
        choice = choice.when(n.contains(m.fragment), row(F.lit(m.url) if m.url else F.col("entry_url"), F.lit(m.category), none, F.lit(m.note), "remap"))
    for b in blocked:
        choice = choice.when(site == b.host, row(none, none, F.lit(b.status), F.lit(b.note), "blocked"))
    found = F.concat(F.lit(f"{crawl_day} 实爬：该入口抓到 "), F.col("crawled").cast("string"), F.lit(" 条受理公告明细"))
    choice = choice.when(F.col("crawled") > 0, row(none, none, F.lit(R.VERIFIED), found, "crawled")).otherwise(row())
    return joined.select("entry_url", choice.alias("d")).select("entry_url", "d.*", F.lit(day).alias("decided_on"))


def reconcile_master(master: DataFrame, decisions: DataFrame) -> DataFrame:
    """Master rows with their address decision applied; only entry columns change."""
    d = F.struct("new_url", "category", "status", "note", "kind", "decided_on").alias("_d")
    joined = master.join(decisions.select("entry_url", d), "entry_url", "left")
    k = F.coalesce(F.col("_d.kind"), F.lit(""))
    changed = (F.col("_d.status") != "") & (F.col("_d.status") != F.col("verify_status"))
    dated = k.isin("remap", "blocked") | ((k == "crawled") & changed)
    values = {
        "entry_url": F.when((k == "remap") & (F.col("_d.new_url") != ""), F.col("_d.new_url")).otherwise(F.col("entry_url")),
        "entry_category": F.when((k == "remap") & (F.col("_d.category") != ""), F.col("_d.category")).otherwise(F.col("entry_category")),
        "verify_status": F.when(changed, F.col("_d.status")).otherwise(F.col("verify_status")),
        "verify_date": F.when(dated, F.col("_d.decided_on")).otherwise(F.col("verify_date")),
        "crawl_note": F.when(k != "", F.col("_d.note")).otherwise(F.col("crawl_note") if "crawl_note" in master.columns else F.lit("")),
    }
    return joined.select(*[values.get(c, F.col(c)).alias(c) for c in master.columns],
                         *([] if "crawl_note" in master.columns else [values["crawl_note"].alias("crawl_note")]))


def reconcile_registry(registry: DataFrame, decisions: DataFrame) -> DataFrame:
    """Registry rows with the same decisions applied."""
    moved = reconcile_master(registry.withColumn("crawl_note", F.lit("")), decisions).drop("crawl_note")
    return moved.withColumn("domain", domain(F.col("entry_url")))


def reconcile_log(log: DataFrame, decisions: DataFrame) -> DataFrame:
    """Entry-log lines whose address moved get the new address and date."""
    d = decisions.filter((F.col("kind") == "remap") & (F.col("new_url") != F.col("entry_url"))).select("entry_url", "new_url", "decided_on")
    return (log.join(d, "entry_url", "left")
            .withColumn("verify_date", F.coalesce("decided_on", "verify_date")).withColumn("entry_url", F.coalesce("new_url", "entry_url"))
            .drop("new_url", "decided_on"))


def cells(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Long form: one row per (key, column, value)."""
    return df.select(key, *[F.col(c).cast("string").alias(c) for c in columns]).unpivot(key, columns, "column", "value")


def change_log(old: DataFrame, new: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Cells that differ between two versions: (key, column, old_value, new_value)."""
    before = cells(old, key, columns).withColumnRenamed("value", "old_value")
    after = cells(new, key, columns).withColumnRenamed("value", "new_value")
    return before.join(after, [key, "column"], "full").filter(~F.col("old_value").eqNullSafe(F.col("new_value")))


def change_counts(log: DataFrame, key: str) -> DataFrame:
    return log.groupBy("column").agg(F.count(F.lit(1)).alias("changes"), F.count_distinct(key).alias("touched"))


def fill_blanks(existing: DataFrame, new: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Existing rows with blank cells filled from ``new``; filled cells are never replaced."""
    fresh = new.select(key, *[F.col(c).alias(f"_{c}") for c in columns])
    rest = [c for c in existing.columns if c not in columns]
    return existing.join(fresh, key, "left").select(*rest, *[
        F.coalesce(F.nullif(F.col(c), F.lit("")), F.col(f"_{c}"), F.lit("")).alias(c) for c in columns])


def fill_conflicts(existing: DataFrame, new: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Filled cells that differ from the new value; any row here blocks a write."""
    return change_log(existing, new, key, columns).filter(
        (F.coalesce("old_value", F.lit("")) != "") & F.col("new_value").isNotNull())
