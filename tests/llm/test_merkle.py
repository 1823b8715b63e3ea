from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import midstate
from tidemark.llm.merkle import LOWER, UPPER, fold, grow, merkle_manifest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sha(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def code(value) -> str:
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf_of(row) -> str:
    doc_id, text, lang, source, n_chars = row
    return sha(*map(code, (doc_id, source, lang, n_chars, text)))


def climb(nodes: list[str], at: int, value: str) -> tuple[str, str, str]:
    """The digest of a tree, what it comes to with `value` in place `at`, and the siblings on the way."""
    proof = ""
    while len(nodes) > 1:
        low = at - at % 8
        run = nodes[low : low + 8]
        proof += "".join(run[: at - low] + run[at - low + 1 :])
        value = sha(*run[: at - low], value, *run[at - low + 1 :])
        nodes = [sha(*nodes[k : k + 8]) for k in range(0, len(nodes), 8)]
        at //= 8
    return nodes[0], value, proof


def plain(rows) -> list[tuple]:
    trees: dict = {}
    for row in rows:
        trees.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, leaf_of(row), row))
    names = sorted(trees, key=lambda n: (n is not None, (n or "").encode()))
    for name in names:
        trees[name].sort(key=lambda t: t[:3])
    roots = [climb([t[2] for t in trees[n]], 0, "")[0] for n in names]
    out = []
    for i, name in enumerate(names):
        leaves = [t[2] for t in trees[name]]
        for at, (_, _, leaf, row) in enumerate(trees[name]):
            value = leaf
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0 and row[1] is not None:
                value = leaf_of((row[0], row[1].translate(str.maketrans(UPPER, LOWER)), *row[2:]))
            subroot, value, low = climb(leaves, at, value)
            root, value, high = climb(roots, i, value)
            out.append((row[0], leaf, subroot, root, sha(low + high), value, value == root))
    return sorted(out, key=repr)


def run(spark, rows, levels=3):
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    docs = spark.createDataFrame(rows, SCHEMA)
    found = merkle_manifest(docs, changed={"text": F.translate("text", UPPER, LOWER)}, tampered=tampered, levels=levels)
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted(map(tuple, found.collect()), key=repr)


def test_states_are_those_of_sha256():
    raw = np.random.default_rng(3).integers(0, 256, (300, 32)).astype(np.uint8)
    blocks = midstate.from_bytes(midstate.hexed(raw))
    state = midstate.start(300)
    for n in range(4):
        want = [hashlib.sha256(bytes(r).hex().encode() * n).digest() for r in raw]
        assert list(map(bytes, midstate.to_bytes(midstate.finish(state, np.full(300, n))))) == want
        state = midstate.from_bytes(midstate.to_bytes(midstate.absorb(state, blocks)))  # stored and resumed


def test_a_fold_reads_only_the_state_and_what_is_right_of_it():
    raw = np.random.default_rng(4).integers(0, 256, (8, 32)).astype(np.uint8)
    level, parent = grow(raw, np.zeros(8, int))
    assert bytes(fold(level, np.array([5]), raw[5:6])[0]) == bytes(parent[0])
    level.blocks[:, :5] = 0  # what is left of the slot isn't needed any more
    level.state[:, :5] = 0
    assert bytes(fold(level, np.array([5]), raw[5:6])[0]) == bytes(parent[0])
    assert bytes(fold(level, np.array([5]), raw[4:5])[0]) != bytes(parent[0])


@pytest.mark.parametrize(("seed", "levels"), [(1, 1), (2, 2), (3, 3)])
def test_equals_a_plain_version(spark, seed, levels):
    rnd = random.Random(seed)
    rows = []
    sizes = {None: 9, "": 1, "de": 8, "en": 600, "zh": 65, "é": 2, "fr": 64}
    for lang, size in sizes.items():
        for _ in range(size):
            text = rnd.choice([None, "", "Plain text", "no capitals", "É À é", "Long " * rnd.randint(1, 50), str(rnd.random()) + "A"])
            rows.append((rnd.choice([None, rnd.randint(-5, 400), rnd.randint(0, 1 << 60)]), text, lang, rnd.choice([None, "", "web", "a:b"]), rnd.choice([None, 0, 7])))
    rnd.shuffle(rows)
    assert run(spark, rows, levels) == plain(rows)


@pytest.mark.parametrize("rows", [
    [(1, "One row", "en", "s", 7)],
    [(1, None, None, None, None)],
    [(i, "Same text", "en", "s", 9) for i in range(9)],
    [(7, "Repeated", "en", "s", 8)] * 70,
    [(None, None, None, None, None)] * 20,
])
def test_small_tables(spark, rows):
    assert run(spark, rows) == plain(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_clashing_columns_and_very_long_text(spark):
    names = ["tree", "id", "digest", "changed", "place", "size", "stretch", "nodes", "path", "_at", "_from", "root"]
    rows = [(1, "Very LONG " * 400_000, "en", "s", 1), (2, "x", "en", "s", 2)]
    docs = spark.createDataFrame(rows, SCHEMA).select("*", *(F.lit("x").alias(n) for n in names))
    assert sorted(map(tuple, merkle_manifest(docs).collect()), key=repr) == [
        (*r[:5], r[3], True) for r in plain(rows)]


def test_tables_shrink_by_the_stretch(spark, plan):
    rows = [(i, str(i), "en", "s", 1) for i in range(200)]
    text = plan(merkle_manifest(spark.createDataFrame(rows, SCHEMA)))
    assert "Exchange SinglePartition" not in text and "CartesianProduct" not in text
