"""Texts that tokenizers find hard: white space, words and base64 without end."""

from __future__ import annotations

import base64
import random

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemark.llm import packing, tokencount

TOKENS = public_tokenizers.path("byte_bpe_50k.json")
RND = random.Random(8)
LONG = {
    "spaces": " " * 2_000_000,
    "spaces before a word": "x" + " " * 2_000_000 + "word",
    "spaces before a special string": " " * 100_000 + "<|endoftext|>" + " " * 70_000 + "!",
    "line breaks": "\n" * 1_000_000 + "a",
    "mixed white space": "".join(RND.choices(" \n\t  ", k=300_000)) + "\n　b",
    "base64": base64.b64encode(RND.randbytes(2_000_000)).decode(),
    "one word": "ab" * 400_000,
    "random letters": "".join(RND.choices("abcdefghijklmnopqrstuvwxyzé", k=300_000)),
    "separators": "a\x1c" * 200_000 + "!\x1c!" * 200_000,
    "digits": "".join(RND.choices("0123456789", k=300_000)),
}


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(TOKENS)


@pytest.mark.parametrize("name", LONG)
def test_ids_and_counts_are_the_librarys(tokenizer, name):
    want = tokenizer.encode(LONG[name], add_special_tokens=False).ids
    assert packing.token_ids(TOKENS, LONG[name]).tolist() == want
    assert tokencount.count_tokens(TOKENS, pa.array([LONG[name]])).tolist() == [len(want)]


def test_eight_megabytes_of_base64_through_spark(spark, tokenizer):
    text = base64.b64encode(RND.randbytes(6_000_000)).decode()
    docs = spark.createDataFrame([(1, text), (2, LONG["spaces"])], "doc_id long, text string")
    sizes = {1: len(packing.token_ids(TOKENS, text)), 2: 2_000_000}
    assert {r.doc_id: r.n_tokens for r in tokencount.token_counts(docs, TOKENS).collect()} == sizes
    rows = packing.pack_documents(docs, TOKENS).select("doc_id", "length").groupBy("doc_id").sum("length").collect()
    assert {r[0]: r[1] for r in rows} == {k: n + 1 for k, n in sizes.items()}


@pytest.mark.parametrize("table", [13, 15])
def test_a_block_too_large_for_the_table_is_taken_in_parts(monkeypatch, tokenizer, table):
    machine = tokencount.Transducer(TOKENS)
    monkeypatch.setattr(tokencount, "TABLE", table)
    machine.clear()
    texts = ["".join(RND.choices("abcdefghijklmnopqrstuvwxyz", k=20_000)), "", "x y z", "".join(RND.choices("aeiou rst", k=20_000))]
    assert machine.count(texts).tolist() == [len(tokenizer.encode(t).ids) for t in texts]


def test_the_scan_composes_maps_and_shows_where_they_do_not_meet():
    rnd = np.random.default_rng(2)
    for n in (1, 2, 7, 64, 100):
        first = rnd.random(n) < 0.2
        first[0] = True
        enter, leave, count = rnd.integers(0, 2, n), rnd.integers(0, 2, n), rnd.integers(0, 9, n)
        total, whole = tokencount.scan(first, enter, leave, count)
        sum_, met = 0, True
        for i in range(n):
            sum_, met = (int(count[i]), True) if first[i] else (sum_ + int(count[i]), met and enter[i] == leave[i - 1])
            assert (total[i], whole[i]) == (sum_, met)


def test_sequences_are_bucketed_and_numbered_the_same_from_any_partitions(spark):
    rows = [(k % 37 if k % 5 else None, " ".join(["word"] * (k % 23)), "x") for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, rank string")

    def packed(parts):
        found = packing.pack_documents(docs.repartition(parts), TOKENS, limit=16).collect()
        return sorted((p.sequence_id, p.bucket, p.doc_id is None or p.doc_id, p.start, bytes(p.ids)) for p in found)

    got = packed(3)
    assert got == packed(7) and [g[0] for g in got] == list(range(len(got)))
    assert [g[1] for g in got] == sorted((g[1] for g in got), reverse=True)
