from __future__ import annotations

import random
from collections import defaultdict

import pytest
import regex

from tidemark.llm import decontam
from tidemark.llm.decontam import find_leaks

NAME = regex.compile(r"(?<=[\p{Ll}\p{N},;] )\p{Lu}\p{Ll}+")
TOKEN = regex.compile(decontam._TOKEN)


def template(text, names):
    text = (text or "").translate({ord(c): None for c in "\ue001\ue002\ue003\ue004"})
    if names:
        text = NAME.sub(lambda m: "\ue003" + m.group(), text)
    tokens = TOKEN.findall(text.lower())
    forms = []
    for i, t in enumerate(tokens):
        number = "0" <= t[0] <= "9"
        unit = t in decontam.UNITS and i > 0 and "0" <= tokens[i - 1][0] <= "9"
        forms.append("#" if number else "@" if t[0] == "\ue003" else "%" if unit else t)
    return tokens, forms


def windows_of(text, names, size, only_names=False):
    """(place, key, values) of every window; values is None for words alone and for mostly slots, which are taken as they are."""
    tokens, forms = template(text, names)
    marked = template(text, True)[0]
    for p in range(len(tokens) - size + 1):
        own, form = tokens[p : p + size], forms[p : p + size]
        if only_names and not any(t[0] == "\ue003" for t in marked[p : p + size]):
            continue
        slots = sum(f != t for f, t in zip(form, own, strict=True))
        if 2 * slots > size:
            yield p, ("as it is", *own), None
        else:
            yield p, ("form", *form), tuple("" if f == t else t for f, t in zip(form, own, strict=True)) if slots else None


def number_runs(text):
    runs = [[]]
    for t in template(text, False)[0]:
        if "0" <= t[0] <= "9":
            runs[-1].append(t)
        else:
            runs.append([])
    return {" ".join(r) for r in runs if len(r) >= 4}


def plain_leaks(docs, items, width=8, least=6):
    """By the rules of find_leaks: documents and items in two readings, mostly-slot windows as they are, a
    counterpart for each value only where values differ, different places of the item counted."""
    index, counts = defaultdict(set), defaultdict(set)
    for item, text in items:
        tokens = template(text, False)[0]
        if all("0" <= t[0] <= "9" for t in tokens):
            for run in number_runs(text):
                counts[run].add(item)
            continue
        size = min(width, len(tokens))
        for names in (True, False):
            for p, key, values in windows_of(text, names, size):
                index[key].add((item, p, len(tokens) - size + 1, values))
    sizes = {len(k) - 1 for k in index}
    out, placed = set(), defaultdict(set)
    for doc, text in docs:
        out |= {(doc, item, 1, 1, False) for run in number_runs(text) for item in counts.get(run, ())}
        for names in (True, False):
            for size in sizes:
                for p, key, values in windows_of(text, names, size, only_names=not names):
                    for item, q, n, own in index.get(key, ()):
                        pairs = None
                        if own is not None and own != values:
                            pairs = frozenset((i, d) for i, d in zip(own, values, strict=True) if i)
                        placed[doc, item, n, p - q].add((q, pairs))
    held = defaultdict(lambda: (set(), set()))
    for (doc, item, n, _), found in placed.items():
        moved = {pair for _, pairs in found if pairs is not None for pair in pairs}
        twice = {i for i, _ in moved if sum(i == j for j, _ in moved) > 1}
        for q, pairs in found:
            if pairs is None or not twice & {i for i, _ in pairs}:
                held[doc, item, n][0].add(q)
                held[doc, item, n][1].add(pairs is not None)
    return out | {(d, i, len(w), n, True in r) for (d, i, n), (w, r) in held.items() if len(w) >= min(n, least)}


ITEMS = [
    (1, "Yesterday Anna bought 3 apples for 5 dollars and later Anna sold 3 apples to Peter for 9 dollars in town."),
    (2, "A train leaves the station at 8 and travels 120 km in 2 hours before it stops near the river."),
    (3, "Short question here"), (4, ""), (5, None), (6, "3 4 5 6 7 8 9 10 11"), (2, "A train leaves the station at 8 and travels 120 km in 2 hours before it stops near the river."),
]
DOCS = [
    (10, "intro words here. " + ITEMS[0][1] + " more words follow."),
    (11, "Yesterday, Maria bought 7 apples for 2 dollars and later Maria sold 7 apples to Klaus for 4 dollars in town."),
    (12, "Yesterday, Maria bought 7 apples for 2 dollars and later Maria sold 8 apples to Klaus for 4 dollars in town."),
    (13, ITEMS[0][1].lower()), (14, "a train leaves the STATION at 9 and travels 300 miles in 5 hours -- before it stops near the river"),
    (15, "nothing of that kind is in here at all, just 3 words and 4 more of them"), (16, None), (17, ""),
    (18, "they ask: short question here? yes"), (19, "1 2 3 4 5 6 7 8 9 10 11 12"), (None, ITEMS[1][1]), (10, "twin of the first"),
    (20, "x " * 30_000 + ITEMS[1][1]), (21, "A train leaves the station at 8 and travels"),
]


def test_reworded_questions_and_slots(spark):
    docs = spark.createDataFrame([(*d, "x") for d in DOCS], "doc_id long, text string, item_id string").repartition(3)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = {tuple(r) for r in find_leaks(docs, items).collect()}
    assert got == plain_leaks(DOCS, ITEMS)
    pairs = {(d, i): reworded for d, i, _, _, reworded in got}
    assert pairs[10, 1] is False and pairs[11, 1] is True and (13, 1) in pairs and pairs[14, 2] is True
    assert (18, 3) in pairs and (None, 2) in pairs and (20, 2) in pairs
    assert not {15, 16, 17, 19, 21} & {d for d, _ in pairs}
    assert {tuple(r) for r in find_leaks(docs, items, broadcast_rows=0).collect()} == got
    assert find_leaks(docs.limit(0), items).collect() == []
    assert find_leaks(docs, items.limit(0)).collect() == [] == find_leaks(docs, items.where("item_id in (4, 5)")).collect()


@pytest.mark.parametrize("seed", range(1, 11))
def test_equals_a_plain_version(spark, seed):
    rnd = random.Random(seed)
    words = ["the", "cost", "of", "apples", "is", "km", "Anna", "Ben", "river", "goes", "kg", *map(str, range(5))]
    text = lambda n: " ".join(rnd.choices(words, k=n))
    items = [(i, text(rnd.choice([2, 5, 9, 20]))) for i in range(12)]
    docs = []
    for d in range(60):
        body = [text(rnd.randint(0, 12))]
        if rnd.random() < 0.6:
            copy = rnd.choice(items)[1].split()
            for _ in range(rnd.randint(0, 2)):
                copy[rnd.randrange(len(copy))] = rnd.choice(words)
            body.append(" ".join(copy))
        docs.append((d, ". ".join([*body, text(rnd.randint(0, 6))])))
    got = find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), width=6, least=3)
    assert {tuple(r) for r in got.collect()} == plain_leaks(docs, items, 6, 3)
    assert got.count() > 5


def test_the_benchmark_planted_in_the_tables(spark):
    sf = "/root/testdata/sf0.01"
    docs, items = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    held = {(d, i) for d, t in docs.select("doc_id", "text").collect() for i, b in items.select("item_id", "text").collect() if b in t}
    assert {(r.doc_id, r.item_id) for r in find_leaks(docs, items).collect()} == held and held
