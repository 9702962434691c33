"""Writers with the guards the registry needs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regwise import rules as R
from regwise.operators.audit import same_rows
from regwise.operators.units import approvers, unit_table
from regwise.session import durable


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists", order: list[Column] | None = None) -> None:
    """Header CSV, one file per task; with ``order`` the files follow the global order."""
    out = df.orderBy(*order) if order else df
    out.write.mode(mode).csv(path, header=True, quoteAll=True, emptyValue="")


def unit_order(label: str = "单位") -> list[Column]:
    return [F.col("prov_code"), F.col("城市"), F.col("记录数").desc(), F.col(label), F.col("地区")]


def write_units(units: DataFrame, path: str, field: str = "proc", mode: str = "errorifexists") -> DataFrame:
    """The unit table: 7 columns, or 8 with the comparison flag for the combined field."""
    label = "单位" if field == "proc" else "受理/监督单位"
    table = unit_table(units, label, seen=None if field == "proc" else "seen")
    write_csv(table, path, mode, unit_order(label))
    return table


def write_deliverables(units: DataFrame, full_path: str, approver_path: str, mode: str = "errorifexists") -> None:
    """Full table and approver table from one written result, so that both agree."""
    fixed = durable(units, "deliverable")
    write_csv(unit_table(fixed), full_path, mode, unit_order())
    write_csv(unit_table(approvers(fixed)), approver_path, mode, unit_order())


def write_master(master: DataFrame, path: str, order: list[Column], mode: str = "errorifexists") -> None:
    """Fixed columns first, then the columns other steps own."""
    extra = [c for c in master.columns if c not in R.MASTER_COLUMNS]
    write_csv(master.select(*R.MASTER_COLUMNS, *extra), path, mode, order)


def append_projects(rows: DataFrame, path: str) -> None:
    """Add project rows to the data set; a partial failure adds nothing."""
    rows.write.mode("append").parquet(path)


def create_only(df: DataFrame, path: str) -> None:
    """Write a table that must not exist yet (it may hold human work)."""
    df.write.mode("errorifexists").parquet(path)


def append_missing(df: DataFrame, path: str, key: list[str]) -> None:
    """Add only rows whose key the shared table does not hold."""
    have = df.sparkSession.read.schema(df.schema).parquet(path)
    durable(df.join(have.select(*key).distinct(), key, "left_anti"), "missing").write.mode("append").parquet(path)


def readback_differences(expected: DataFrame, path: str) -> DataFrame:
    """Rows that a written table lacks or has in excess; empty when the write is right."""
    actual = expected.sparkSession.read.schema(expected.schema).parquet(path)
    return same_rows(expected, actual)


def write_candidates(df: DataFrame, path: str, order: list[Column]) -> None:
    """Tables for human review; an empty result still has its header."""
    write_csv(df, path, "errorifexists", order)
