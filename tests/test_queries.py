"""Every registered query against its DuckDB check on the smallest data."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

from tools.check import compare, connect
from workload import all_queries

SF = "/root/testdata/sf0.001"
QUERIES, CHECKS = all_queries()
# results that can be empty on the smallest tables
MAY_BE_EMPTY = {"jon_20_remap", "jon_21_blocked_hosts", "jon_25_evidence_window", "win_13_samples_per_unit", "flt_18_target_units",
                "snk_06_fill_conflicts", "snk_07_change_log", "snk_07_change_counts", "snk_06_fill_blanks"}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_a_check():
    assert set(QUERIES) == set(CHECKS)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    ok, note = compare(spark, con, name, QUERIES[name], CHECKS[name], SF)
    assert ok or (name in MAY_BE_EMPTY and note.startswith("0 rows")), note


def test_entry(spark):
    import __spark_entry__
    assert __spark_entry__.entry(spark).count() > 0


@pytest.mark.parametrize("left", [[], ["corpus_pipeline.py"]])
def test_entry_without_the_training_data_operators(tmp_path, left):
    root = Path(__file__).resolve().parents[1]
    shutil.copytree(root, tmp_path / "copy", ignore=lambda folder, names: [n for n in names if n in (".git", "llm", "__pycache__") or (n == "corpus_pipeline.py" and not left)])
    code = "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); assert set(q) == set(s) and len(q) > 200, (len(q), len(s))"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "copy", check=True, timeout=120)
