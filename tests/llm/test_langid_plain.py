"""Language identification against a version of it with dictionaries and loops, long texts included."""

import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import langid

MASK = (1 << 64) - 1
WORDS = {
    "aa": "lumo kira sende voltu brasi nemi torka", "bb": "ünter schlag weit gröber knapp zwölf", "cc": "été très beau fenêtre cœur loin",
    "dd": "quy nhz vrrk plk zzgh wqx", "ee": "日本 語の 文章 です ね",
}


def plain_mix(x):
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & MASK
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & MASK
    return x ^ (x >> 31)


def plain_grams(text):
    folded = bytearray(b" ")
    for byte in text.encode():
        char = byte + 32 if 65 <= byte <= 90 else byte
        folded.append(char if char >= 128 or 97 <= char <= 122 else 32)
    folded.append(32)
    squeezed = bytes(b for i, b in enumerate(folded) if b != 32 or i == 0 or folded[i - 1] != 32)
    if squeezed == b" ":
        return Counter()
    return Counter(
        plain_mix((int.from_bytes(squeezed[i : i + n], "big") + (n << 40)) & MASK) >> 48
        for n in (1, 2, 3, 4) for i in range(len(squeezed) - n + 1)
    )


def plain_model(rows):
    """(languages, code, weight of a bucket and bit, scale, trust) from (text, lang, part)."""
    languages = sorted({lang for _, lang, _ in rows})
    code = langid.codewords(len(languages)).tolist()
    bits, size = len(code[0]), 1 << 16
    counts = {lang: Counter() for lang in languages}
    for text, lang, part in rows:
        if part:
            counts[lang] += plain_grams(text)
    total = {lang: sum(c.values()) + 0.5 * size for lang, c in counts.items()}

    def weight(bucket, bit):
        sides = defaultdict(list)
        for lang, word in zip(languages, code, strict=True):
            sides[word[bit]].append((counts[lang][bucket] + 0.5) / total[lang])
        return math.log((sum(sides[1]) / len(sides[1])) / (sum(sides[-1]) / len(sides[-1])))

    known = {}

    def margins(text):
        grams = plain_grams(text)
        for bucket in grams:
            if bucket not in known:
                known[bucket] = [weight(bucket, bit) for bit in range(bits)]
        n = math.sqrt(sum(grams.values()))
        return [sum(k * known[g][bit] for g, k in grams.items()) / n for bit in range(bits)]

    graded = [(lang, margins(text)) for text, lang, part in rows if not part and plain_grams(text)]
    scale, trust = [1.0] * bits, [1.0] * bits
    for bit in range(bits):
        sides = {1: [], -1: []}
        for lang, found in graded:
            sides[code[languages.index(lang)][bit]].append(found[bit])
        if sides[1] and sides[-1]:
            mean = {k: sum(v) / len(v) for k, v in sides.items()}
            spread = sum((x - mean[k]) ** 2 for k, v in sides.items() for x in v) / len(graded)
            scale[bit] = min(max((mean[1] - mean[-1]) / max(spread, 1e-6), 1e-4), 20)
            missed = {1: sum(x <= 0 for x in sides[1]), -1: sum(x > 0 for x in sides[-1])}
            wrong = sum((missed[k] + 0.5) / (len(v) + 1) for k, v in sides.items()) / 2
            trust[bit] = max(math.log((1 - wrong) / wrong), 0.01) if wrong < 0.5 else 0.01
    trust = [t / sum(trust) for t in trust]

    def judge(text):
        if text is None or not any(c.isalpha() for c in text) or not plain_grams(text):
            return "und", 0.0, False
        odds = [min(max(m * s, -30), 30) for m, s in zip(margins(text), scale, strict=True)]
        loss = [sum(t * math.log1p(math.exp(-o * w)) for o, w, t in zip(odds, word, trust, strict=True)) for word in code]
        order = sorted(loss)
        score = 1 / sum(math.exp(-(x - order[0]) * bits) for x in loss)
        return languages[loss.index(order[0])], score, order[1] - order[0] < 0.1 * math.log(2)

    return judge


def texts(seed, n=160):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(list(WORDS))
        words = rng.choices(WORDS[lang].split(), k=rng.randrange(1, 30)) + rng.choices(WORDS[rng.choice(list(WORDS))].split(), k=rng.randrange(6))
        rows.append((i, rng.choice([" ", ", ", "  "]).join(words).title() if i % 3 else " ".join(words), lang))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_a_plain_version(spark, seed):
    rows = texts(seed)
    long = " ".join(w for _, t, lang in rows * 40 if lang == "bb" for w in [t])
    rows += [(900, long[: 200_000], "bb"), (901, "é" * 70_000, "cc"), (902, " " * 140_000 + "lumo" + "-" * 140_000, "aa"), (903, "12 34", "aa")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    parts = docs.select("text", "lang", F.pmod(F.xxhash64(F.lit(12), "doc_id"), F.lit(5)).alias("part")).collect()
    judge = plain_model([tuple(r) for r in parts])
    asked = spark.createDataFrame(
        [(t,) for _, t, _ in rows + texts(seed + 50)] + [(None,), ("",), ("?!",), ("x",), ("lumo" * 40_000,)], "text string"
    )
    got = langid.predict(asked, langid.fit(docs)).collect()
    assert len(got) == asked.count()
    for r in got:
        lang, score, near = judge(r.text)
        assert r.lang_pred == lang or near and r.ambiguous, (r.text or "")[:60]
        assert r.score == pytest.approx(score, abs=1e-4)
        assert r.ambiguous == near


def test_cuts_neither_lose_nor_invent_grams(monkeypatch):
    import pyarrow as pa

    rng = random.Random(4)
    column = ["".join(rng.choices("aB é  .,7日", k=rng.randrange(40))) for _ in range(300)] + ["", None, "   ", "a", " a", "a "]

    def grams():
        found = [Counter() for _ in column]
        for row, raw, seen in langid._pieces(pa.array(column)):
            found[row] += Counter(langid._grams(raw, seen).tolist())
        return found

    whole = grams()
    assert whole == [plain_grams(t or "") for t in column]
    for piece in (1, 2, 3, 5, 8, 13):
        monkeypatch.setattr(langid, "PIECE", piece)
        assert grams() == whole
