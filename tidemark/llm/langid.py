"""Language identification by error-correcting output codes over byte n-grams.

Every language has a codeword. For each bit a binary classifier, the log-ratio of n-gram frequencies
between the languages with a one and those with a zero, says how sure it is; a text gets the language
whose codeword has the least loss, bits weighted by how well they did on rows they were not fit on.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.batches import small_batches, tidy
from tidemark.llm.order import unused
from tidemark.llm.texts import batch_bytes, mix

UNKNOWN = "und"
LETTER = r"\p{L}"
ORDERS = (1, 2, 3, 4)  # lengths of the n-grams in bytes
HASH_BITS = 16
PIECE = 1 << 16
MAX_LANGUAGES = 400

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[[*range(0, 65), *range(91, 97), *range(123, 128)]] = 32  # what isn't a letter in ASCII is a gap


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """Codewords of n languages as rows of -1 and 1: all splits for up to 7, random ones beyond.

    No column is constant, and none is another one or its opposite in the exhaustive code.
    """
    if n <= 7:
        columns = [
            [1 if k == 0 or k in ones else -1 for k in range(n)]
            for size in range(n - 1) for ones in combinations(range(1, n), size)
        ]
        return np.array(columns, np.int8).reshape(-1, n).T
    rng = np.random.default_rng(seed)
    bits, best, apart = int(np.ceil(10 * np.log2(n))), None, -1
    for _ in range(200):
        code = rng.choice(np.array([-1, 1], np.int8), (n, bits))
        code = np.where(np.abs(code.sum(0)) == n, rng.permutation(np.resize([-1, 1], n))[:, None], code).astype(np.int8)
        distance = (bits - code.astype(int) @ code.T.astype(int)) // 2
        least = distance[~np.eye(n, dtype=bool)].min()
        if least > apart:
            best, apart = code, least
    return best


def _grams(raw: np.ndarray, known: int = 0) -> np.ndarray:
    """The bucket of every n-gram of folded bytes that doesn't end among the first `known` ones."""
    out = []
    value = np.zeros(len(raw), np.uint64)
    for order in range(1, max(ORDERS) + 1):
        if len(raw) < order:
            break
        value = (value[: len(raw) - order + 1] << np.uint64(8)) | raw[order - 1 :]
        if order in ORDERS:
            fresh = value[max(known - order + 1, 0) :]
            bucket = mix(fresh + np.uint64(order << 40)) >> np.uint64(64 - HASH_BITS)
            out.append(bucket.astype(np.int32))
    return np.concatenate(out) if out else np.empty(0, np.int32)


def _pieces(column: pa.Array) -> Iterator[tuple[int, np.ndarray, int]]:
    """(row, folded bytes, how many of them are known): every row that isn't all gaps, with one gap between words,
    before the first and after the last.

    A long row comes in pieces of about PIECE bytes. Each begins with the last bytes of the one before, so
    the n-grams of all pieces are those of the whole text, none lost and none made up at a cut.
    """
    raw, at = batch_bytes(column)
    gap = np.full(1, 32, np.uint8)
    for row in range(len(at) - 1):
        seen, waiting, end = gap[:0], gap, int(at[row + 1])
        for low in range(int(at[row]), end, PIECE):
            high = min(low + PIECE, end)
            new = np.concatenate((waiting, _FOLD[raw[low:high]], gap if high == end else gap[:0]))
            after = np.concatenate((seen[-1:] == 32, new[:-1] == 32)) if len(seen) else np.concatenate(([False], new[:-1] == 32))
            new = new[~(after & (new == 32))]
            if not len(seen) and len(new) == 1:
                continue  # nothing but the first gap so far
            waiting = gap[:0]
            if len(new):
                whole = np.concatenate((seen, new))
                yield row, whole, len(seen)
                seen = whole[1 - max(ORDERS) :]


def _count(languages: list[str]):
    known = {name: i for i, name in enumerate(languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(languages), 1 << HASH_BITS), np.int64)
        for batch in batches:
            names = batch.column(1).to_pylist()
            for row, raw, seen in _pieces(batch.column(0)):
                counts[known[names[row]]] += np.bincount(_grams(raw, seen), minlength=1 << HASH_BITS)
        lang, bucket = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(lang.astype(np.int32)), pa.array(bucket.astype(np.int32)), pa.array(counts[lang, bucket])],
            names=["lang", "bucket", "n"],
        )

    return run


def _margins(column: pa.Array, weights: np.ndarray) -> np.ndarray:
    """Log-ratio sums per row and bit over the square root of the n-grams; nan where a row has no gram."""
    total, n = np.zeros((len(column), weights.shape[1])), np.zeros(len(column))
    for row, raw, seen in _pieces(column):
        grams = _grams(raw, seen)
        total[row] += weights[grams].sum(0, dtype=np.float64)
        n[row] += len(grams)
    with np.errstate(invalid="ignore", divide="ignore"):
        return total / np.sqrt(n)[:, None]


def _grade(languages: list[str], weights: np.ndarray):
    known = {name: i for i, name in enumerate(languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            margins = _margins(batch.column(0), weights)
            lang = np.array([known[v] for v in batch.column(1).to_pylist()], np.int32)
            ok = np.isfinite(margins).all(1)
            margins, lang = margins[ok], lang[ok]
            bit = np.tile(np.arange(weights.shape[1], dtype=np.int32), len(margins))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(lang, weights.shape[1])), pa.array(bit), pa.array(margins.ravel())], names=["lang", "bit", "margin"]
            )

    return run


@dataclass(frozen=True)
class Model:
    languages: list[str]
    code: np.ndarray  # languages x bits, -1 and 1
    weights: np.ndarray  # buckets x bits
    scale: np.ndarray  # bits: from margins to log-odds
    trust: np.ndarray  # bits: weight of a bit's loss, they sum to 1

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(language number, score, ambiguous) for rows of margins: the least weighted logistic loss wins.

        score is the winner's share of exp(-loss) summed over bits; a text is ambiguous when the runner-up's
        loss isn't larger by a tenth of the loss of one whole bit at even odds.
        """
        odds = np.clip(margins * self.scale, -30, 30)
        loss = np.stack([(np.logaddexp(0, -odds * word) * self.trust).sum(1) for word in self.code], 1)
        best = loss.argmin(1)
        order = np.sort(loss, 1)
        share = np.exp(-(loss - order[:, :1]) * len(self.trust))
        score = 1 / share.sum(1)
        near = order[:, 1] - order[:, 0] < 0.1 * np.log(2) if loss.shape[1] > 1 else np.zeros(len(loss), bool)
        return best, score, near


def fit(rows: DataFrame, *, text_col: str = "text", lang_col: str = "lang", key_col: str = "doc_id", sample: int = 40_000) -> Model | None:
    """Learn from the labelled rows; null labels are left out, None if nothing is left.

    About `sample` rows, chosen by a hash of `key_col`, are read (all where there are fewer): four fifths for
    the n-grams, the rest for the scale and trust of the bits. Counts are summed over tasks, so the
    driver sees at most 2**HASH_BITS numbers a language, and a dozen a bit. More than MAX_LANGUAGES labels raise
    a ValueError, as that bounds the model that is broadcast to 2**HASH_BITS times 87 numbers of 4 bytes.
    """
    rows = small_batches(rows).where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    found = rows.groupBy(lang_col).count().orderBy(F.desc("count"), lang_col).limit(MAX_LANGUAGES + 1).collect()
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} labels")
    if not found:
        return None
    languages = sorted(str(r[0]) for r in found)
    buckets = 1_000_000
    dealt = F.pmod(F.xxhash64(F.lit(11), F.col(key_col)), F.lit(buckets))
    share = min(1.0, sample / sum(r["count"] for r in found))
    chosen = rows.where(dealt < int(np.ceil(share * buckets))).select(
        F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"),
        F.pmod(F.xxhash64(F.lit(12), F.col(key_col)), F.lit(5)).alias("part"),
    )
    counted = (
        chosen.where("part > 0").drop("part").mapInArrow(tidy(_count(languages)), "lang int, bucket int, n long")
        .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    )
    counts = np.zeros((len(languages), 1 << HASH_BITS))
    counts[counted["lang"].to_numpy(), counted["bucket"].to_numpy()] = counted["n"].to_numpy()
    code = codewords(len(languages))
    if len(languages) == 1:
        return Model(languages, np.ones((1, 1), np.int8), np.zeros((1 << HASH_BITS, 1), np.float32), np.ones(1), np.ones(1))
    freq = (counts + 0.5) / (counts.sum(1, keepdims=True) + 0.5 * counts.shape[1])  # each language counts alike
    weights = np.empty((counts.shape[1], code.shape[1]), np.float32)
    for bit in range(code.shape[1]):
        one, zero = freq[code[:, bit] > 0].mean(0), freq[code[:, bit] < 0].mean(0)
        weights[:, bit] = np.log(one / zero)
    graded = (
        chosen.where("part = 0").drop("part").mapInArrow(tidy(_grade(languages, weights)), "lang int, bit int, margin double")
        .groupBy("lang", "bit").agg(F.count("*").alias("n"), F.avg("margin").alias("mean"), F.var_pop("margin").alias("var"),
                                    F.sum((F.col("margin") > 0).cast("int")).alias("ones")).toArrow().to_pylist()
    )
    scale, trust = np.ones(code.shape[1]), np.ones(code.shape[1])
    for bit in range(code.shape[1]):
        sides = {1: [0, 0.0, 0.0, 0], -1: [0, 0.0, 0.0, 0]}
        for r in (r for r in graded if r["bit"] == bit):
            word = int(code[r["lang"], bit])
            side = sides[word]
            side[0] += r["n"]
            side[1] += r["n"] * r["mean"]
            side[2] += r["n"] * (r["var"] + r["mean"] ** 2)
            side[3] += r["n"] - r["ones"] if word > 0 else r["ones"]
        if all(s[0] for s in sides.values()):
            mean = {k: s[1] / s[0] for k, s in sides.items()}
            var = sum(max(s[2] - s[1] ** 2 / s[0], 0) for s in sides.values()) / sum(s[0] for s in sides.values())
            scale[bit] = np.clip((mean[1] - mean[-1]) / max(var, 1e-6), 1e-4, 20)
            wrong = sum((s[3] + 0.5) / (s[0] + 1) for s in sides.values()) / 2
            trust[bit] = max(np.log((1 - wrong) / wrong), 0.01) if wrong < 0.5 else 0.01
    return Model(languages, code, weights, scale, trust / trust.sum())


def predict(docs: DataFrame, model: Model | None, *, text_col: str = "text") -> DataFrame:
    """`docs` with lang_pred, score and ambiguous added (columns of those names are replaced).

    lang_pred is a learned label, or 'und' with score 0 where the text is null or has no letter, or where
    nothing was learned. score, 0 to 1, is the winner's share; ambiguous says that two codewords are about
    as near. Only the text counts, all of it, piece by piece. Repeated rows are each predicted, other
    columns stay as they are, an empty table stays empty.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)  # bounded by MAX_LANGUAGES, see fit

    @F.arrow_udf("lang_pred string, score double, ambiguous boolean")
    def judge(text: pa.Array) -> pa.Array:
        m = held.value
        n = len(text)
        names, score, near = np.full(n, UNKNOWN, object), np.zeros(n), np.zeros(n, bool)
        if m is not None and n:
            margins = _margins(text, m.weights)
            ok = np.flatnonzero(np.isfinite(margins).all(1))
            if len(ok):
                best, s, a = m.decode(margins[ok])
                names[ok], score[ok], near[ok] = np.array(m.languages, object)[best], s, a
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(score), pa.array(near)], names=["lang_pred", "score", "ambiguous"])

    text = F.col(text_col).cast("string")
    lettered = text.isNotNull() & F.regexp_like(text, F.lit(LETTER))
    [own] = unused(docs, "_judged")
    judged = small_batches(docs).withColumn(own, judge(F.when(lettered, text)))
    return judged.withColumns({
        "lang_pred": F.when(lettered, F.col(f"{own}.lang_pred")).otherwise(UNKNOWN),
        "score": F.when(lettered, F.col(f"{own}.score")).otherwise(0.0),
        "ambiguous": lettered & F.col(f"{own}.ambiguous"),
    }).drop(own)
