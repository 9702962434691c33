"""Records to units: the complete clean-up plan."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regwise.operators.spellings import judged_spellings, select_field, select_module
from regwise.operators.units import apply_canonical, merge_units, recover_truncated, with_role
from regwise.session import durable


@dataclass
class Cleaned:
    """``units``, the ``spellings`` behind them, and what was ``dropped``."""

    units: DataFrame
    spellings: DataFrame
    dropped: DataFrame


def clean(records: DataFrame, places: DataFrame, field: str = "proc", module: int | None = None,
          misplaced: DataFrame | None = None) -> Cleaned:
    """Normalise, judge, locate, merge and recover agency spellings.

    The records are read once: the judged spelling table is written to the
    shared folder, and the remaining steps branch off that small table.
    """
    rows = select_field(select_module(records, module), field)
    judged = judged_spellings(rows, places, misplaced)
    kept = apply_canonical(judged.filter(F.col("drop_reason").isNull()))
    dropped = judged.filter(F.col("drop_reason").isNotNull())
    recovered = recover_truncated(kept, dropped)
    spellings = durable(kept.withColumn("recovered", F.lit(False)).unionByName(recovered), "kept")
    left = dropped.join(spellings.select("prov_code", "city_code", "name"),
                        ["prov_code", "city_code", "name"], "left_anti")
    units = with_role(merge_units(spellings))
    return Cleaned(units, spellings, left)
