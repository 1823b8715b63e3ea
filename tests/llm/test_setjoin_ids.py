from __future__ import annotations

from test_setjoin import brute
from tidemark.llm.setjoin import jaccard_components


def test_an_original_without_an_id_does_not_part_its_copies(spark):
    base = [f"b{k}" for k in range(100)]
    copies = [(i, " ".join(base[: i + 20] + [f"z{i}x"] + base[i + 21 :])) for i in range(1, 61)]
    rows = [*copies, (None, " ".join(base)), (None, " ".join(base))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = jaccard_components(docs).collect()
    assert {r[0]: (r[1], r[2]) for r in got if r[0] is not None} == brute(copies)
    assert [(r[1], r[2]) for r in got if r[0] is None] == [(96, None)] * 2
