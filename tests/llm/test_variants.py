from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.llm import variants
from tidemark.llm.variants import neighbourhood, reduced, spelling_variants

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def near(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain(rows, least=5, ratio=5, one_in=199) -> list[tuple]:
    count = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % one_in == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += 1
    words = {w: n for w, n in count.items() if len(w) >= 6 and n >= least}
    out, form = {}, {}
    for w, n in words.items():
        around = sorted((-words[x], x) for x in words if near(w, x))
        if around and -around[0][0] >= ratio * n:
            form[w] = around[0][1]
        out[w] = len(around)
    rows = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        rows.append((w, form.get(w), root, n, out[w], words.get(form.get(w))))
    return sorted(rows, key=repr)


def run(spark, rows, **kwargs):
    found = spelling_variants(spark.createDataFrame(rows, "doc_id long, text string"), **kwargs)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(map(tuple, found.collect()), key=repr)


def edited(rnd, word: str) -> str:
    k, c = rnd.randrange(len(word)), rnd.choice("abcé÷ÿ")
    return rnd.choice([word[:k] + word[k + 1 :], word[:k] + c + word[k + 1 :], word[:k] + c + word[k:]])


@pytest.mark.parametrize(("seed", "symbols", "one_in"), [(1, 8, 199), (2, 2, 3), (3, 3, 10)])
def test_equals_a_plain_version(spark, seed, symbols, one_in):
    rnd = random.Random(seed)
    words = ["Letters", "letterss", "straße", "ÉCLAIRS", "éclairs", "aaaaaaa", "bananas", "short", "×÷×÷×÷"]
    for _ in range(4):
        words += [edited(rnd, w) for w in words]
    weights = [rnd.choice([1, 1, 2, 10, 60]) for _ in words]
    rows = []
    for k in range(150):
        text = "".join(w + rnd.choice([" ", ", ", "1", "\n", "Ā", "¿"]) for w in rnd.choices(words, weights, k=rnd.randint(0, 60)))
        rows.append((rnd.choice([k, None, 7]), rnd.choice([text, text, None, ""])))
    got = run(spark, rows, symbols=symbols, one_in=one_in)
    assert got == plain(rows, one_in=one_in) and len(got) > 30


def test_forms_chain_to_one_root(spark):
    text = " ".join(["abcdef"] * 5 + ["abcdeg"] * 30 + ["abcdhg"] * 200 + ["abcihg"] * 1200 + ["abcjhg"] * 1200)
    got = {r[0]: r[1:3] for r in run(spark, [(1, text)])}
    assert got["abcdef"] == ("abcdeg", "abcihg") and got["abcihg"] == (None, "abcihg")


def test_long_texts_are_split_between_runs(monkeypatch):
    text = "Aé ß÷xyzĀÃb À" * 50
    want = re.findall("[A-Za-zÀ-ÿ]+", text)
    for size in range(1, 40):
        monkeypatch.setattr(variants, "_PIECE", size)
        got = [w.decode() for part in variants.runs(text.encode()) for w in part]
        assert got == [w.translate(LOW) for w in want]


def test_long_text_through_spark(spark):
    rows = [(1, "Wordings " * 300_000 + "wordingz " * 7), (2, "x" * 3_000_000)]
    assert run(spark, rows) == plain(rows)


def test_neighbourhoods_are_whole(spark):
    word = "01120"
    got = spark.range(1).select(neighbourhood(F.lit(word), 3).alias("x")).first().x
    want = {word[:k] + word[k + 1 :] for k in range(5)} | {word[:k] + s + word[k + 1 :] for k in range(5) for s in "012"}
    want |= {word[:k] + s + word[k:] for k in range(6) for s in "012"}
    assert len(got) == len(set(got)) and set(got) == want
    short = spark.createDataFrame([("éÿabc",)], "w string").select(reduced(F.col("w")).alias("x")).first().x
    assert len(short) == 5


@pytest.mark.parametrize("rows", [[], [(None, None)], [(1, "")], [(1, "!?")], [(1, "single")] * 5])
def test_small_tables(spark, rows):
    assert run(spark, rows, one_in=10**9) == plain(rows, one_in=10**9)


def test_clashing_columns(spark):
    names = ["word", "n", "short", "other", "near", "root", "form", "doc", "best"]
    docs = spark.createDataFrame([(1, "letter letter letter letter letter")], "doc_id long, text string")
    assert spelling_variants(docs.select("*", *(F.lit("x").alias(n) for n in names))).collect()[0].word == "letter"
