"""Every known licence in another dress."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from regwise.llm import known_licences, licences

PUBLISHED = Path("/usr/share/common-licenses")
LONG = {"Apache-2.0": "Apache-2.0", "Artistic-1.0-Perl": "Artistic", "CC0-1.0": "CC0-1.0", "GFDL-1.2-only": "GFDL-1.2", "GFDL-1.3-only": "GFDL-1.3", "GPL-1.0-only": "GPL-1",
        "GPL-2.0-only": "GPL-2", "GPL-3.0-only": "GPL-3", "LGPL-2.0-only": "LGPL-2", "LGPL-2.1-only": "LGPL-2.1", "LGPL-3.0-only": "LGPL-3", "MPL-1.1": "MPL-1.1", "MPL-2.0": "MPL-2.0"}


def _dressed(text):
    """Other case, marks, spelling and line breaks, and a copyright line."""
    words = text.replace("license", "licence").replace(",", " ,").replace('"', "''").upper().split()
    lines = [" ".join(words[k:k + 9]) for k in range(0, len(words), 9)]
    return "Copyright (c) 1999, 2020 Some Body <a@b.org>\nAll rights reserved.\n\n" + "\r\n * ".join(lines)


def _found(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("licence", F.lit("clash"))
    return {r["doc_id"]: r["licence"] for r in licences.scan(df, licences.known_texts(spark)).collect()}


def test_every_known_wording(spark):
    texts = known_licences.texts()
    found = _found(spark, [(i, _dressed(t)) for i, (_, t) in enumerate(texts)] + [(10_000 + i, t + " more") for i, (_, t) in enumerate(texts)])
    assert [(n, found[i]) for i, (n, _) in enumerate(texts) if found[i] != n] == []
    assert all(found[10_000 + i] is None for i in range(len(texts)))
    assert len({n for n, _ in texts} | set(known_licences.DIGESTS)) > 70


@pytest.mark.skipif(not PUBLISHED.is_dir(), reason="the published texts are not on this machine")
def test_long_licences_by_their_digests(spark):
    assert set(LONG) == set(known_licences.DIGESTS)
    names = [n for n in LONG if (PUBLISHED / LONG[n]).exists()]
    texts = [(PUBLISHED / LONG[n]).read_text(encoding="utf-8", errors="replace") for n in names]
    found = _found(spark, [(i, t.replace("license", "licence").upper().replace(";", " ;")) for i, t in enumerate(texts)] + [(100 + i, t[200:]) for i, t in enumerate(texts)])
    assert [found[i] for i in range(len(names))] == names and all(found[100 + i] is None for i in range(len(names)))
