from __future__ import annotations

import random
import re

import numpy as np
import pytest

from tidemark.llm import setjoin
from tidemark.llm.setjoin import jaccard_components

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def grams(text):
    raw = (text or "").encode()
    words = WORD.findall(bytes(b + 32 if 65 <= b <= 90 else b for b in raw))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    sets = [(i, grams(t)) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for k, (i, x) in enumerate(sets):
        for j, y in sets[:k]:
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(x), find(i)) for i, x in sets}


def corpus(seed, n=150):
    rnd = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    passage = rnd.choices(vocabulary, k=60)
    rows, texts = [], []
    for i in range(n):
        kind = rnd.random()
        if texts and kind < 0.55:
            words = list(rnd.choice(texts[:6] if kind < 0.35 else texts))
            for _ in range(rnd.randint(0, 4)):
                words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
        else:
            words = rnd.choices(vocabulary, k=rnd.choice([1, 3, 5, 30, 60, 90]))
            if kind > 0.8:
                words = passage + words
        texts.append(words)
        rows.append((i * 3 + 7, rnd.choice([" ", "\t", " \n"]).join(words)))
    return rows


@pytest.mark.parametrize("seed, longest", [(1, 2), (2, 6), (3, 32)])
def test_equals_brute_force(spark, seed, longest):
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r[0]: (r[1], r[2]) for r in jaccard_components(docs, longest=longest, often=2).collect()}
    assert got == brute(rows)


def test_nulls_blanks_ties_and_other_columns(spark):
    long = " ".join(f"x{k}" for k in range(400_000))
    rows = [(1, None, "a"), (2, "", "b"), (3, " \t\n", None), (4, "one two", "c"), (5, "ONE  two", "d"), (5, "ONE  two", "d"),
            (None, "one two", "e"), (None, "three", "f"), (9, long, "g"), (8, long + " end", "h")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, set string")
    got = sorted(map(tuple, jaccard_components(docs).collect()), key=str)
    assert got == sorted([(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4), (5, 1, 4), (None, 1, 4), (None, 1, None),
                          (9, 399_996, 8), (8, 399_997, 8)], key=str)
    assert jaccard_components(docs.limit(0)).collect() == []


def test_a_hot_group_is_compared_through_leaders(spark):
    base = [f"b{k}" for k in range(100)]
    rnd = random.Random(3)
    rows = []
    for i in range(300):
        words = list(base)
        for _ in range(rnd.randint(0, 3)):
            words[rnd.randrange(100)] = f"z{rnd.randrange(10**9)}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert {r[0]: (r[1], r[2]) for r in jaccard_components(docs, longest=8).collect()} == brute(rows)


def test_least_overlaps_are_exact():
    assert setjoin.least_overlap(5, 80) == 4 and setjoin.pair_overlap(9, 9, 80) == 8


def test_parities_never_differ_more_than_their_sets():
    rnd = np.random.default_rng(3)
    for n, m, same in ((1, 1, 0), (64, 65, 60), (100, 120, 90), (1000, 1200, 1000), (5, 4000, 5), (700, 700, 700)):
        both = rnd.integers(0, 1 << 63, n + m, dtype=np.uint64)
        x, y = both[:n], np.concatenate((both[:same], both[n : n + m - same]))
        apart = setjoin.parity_distance(setjoin.parity(x), setjoin.parity(y))
        assert apart <= n + m - 2 * same and (apart == 0) == (n + m == 2 * same)
