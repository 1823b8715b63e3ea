"""SpotSigs fingerprints: chains of content words that follow common words, compared by pruned Jaccard."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.batches import small_batches, tidy
from tidemark.llm.texts import MARKS, mix, word_hashes

#: Common words of English, German, French and Spanish: they start chains and are never content.
ANCHORS = (
    "a an and are as at be been by did do for from had has have he in is it its of on or she that the these they this to was were with "
    "als am auf aus bei das dem den der des die ein eine einem einen einer eines er es für hat im ist mit nicht sich sie sind und von war zu "
    "au aux avec ce cette dans de du elle en est et il ils la le les mais ne ou où par pas plus pour que qui sa se ses son sont sur un une "
    "al como con del el ella era esta este fue las lo los más no para pero por su sus una uno y"
).split()
CHAIN = 2  # content words of a chain

_KEY = mix(np.arange(31, 41, dtype=np.uint64)) | np.uint64(1)


def _anchor_hashes(anchors: tuple[str, ...] | list[str]) -> np.ndarray:
    return np.unique(np.concatenate([h for _, h, _ in word_hashes(pa.array(list(anchors)), MARKS)]))


def _chains(words: np.ndarray, starts: np.ndarray, content: np.ndarray, after: np.ndarray, length: int) -> np.ndarray:
    """Hashes of words[starts] and the `length` content words from number after[i] on."""
    total = words[starts] * _KEY[0]
    for k in range(length):
        total += words[content[after + k]] * _KEY[k + 1]
    return (mix(total) >> np.uint64(32)).astype(np.uint32)


def spot_sets(column: pa.Array, anchors: np.ndarray, chain: int = CHAIN) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct signatures). Without a whole chain after any anchor every word starts one, of
    the words after it; a text of fewer words than that is one signature, one without words has none."""
    for row, words, at in word_hashes(column, MARKS):
        common = anchors[np.minimum(np.searchsorted(anchors, words), len(anchors) - 1)] == words
        content = np.flatnonzero(~common)
        passed = np.concatenate(([0], np.cumsum(~common)))
        spots = np.flatnonzero(common)
        owner = np.searchsorted(at, spots, "right") - 1
        whole = passed[spots] + chain <= passed[at[owner + 1]]
        spots, owner = spots[whole], owner[whole]
        hashes = _chains(words, spots, content, passed[spots], chain)
        cut = np.searchsorted(owner, np.arange(len(at)))
        for i in range(len(at) - 1):
            own = hashes[cut[i] : cut[i + 1]]
            if not len(own) and at[i + 1] > at[i]:
                every = np.arange(at[i], at[i + 1])
                if len(every) > chain:
                    own = _chains(words, every[:-chain], np.arange(len(words)), every[:-chain] + 1, chain)
                else:
                    own = _chains(words, every[:1], np.arange(len(words)), every[:1] + 1, len(every) - 1) ^ np.uint32(len(every))
            yield row + i, np.unique(own)


def likeness(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Jaccard of two sorted signature sets; 0 without comparing where their lengths allow less than `least`."""
    low, high = sorted((len(a), len(b)))
    if not high:
        return 1.0
    if not low or low < least * high:
        return 0.0
    both = np.concatenate((a, b))
    both.sort()
    shared = int((both[1:] == both[:-1]).sum())
    return shared / (low + high - shared)


def encode(spots: np.ndarray) -> str:
    return base64.b64encode(spots.astype("<u4").tobytes()).decode()


def decode(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), "<u4")


def length_bands(threshold: float, most: int) -> list[int]:
    """Borders of the set lengths 1, 2, …: sets two or more bands apart can't reach the threshold."""
    borders = [1]
    while borders[-1] <= most:
        borders.append(int(borders[-1] / threshold + 1e-9) + 1)
    return borders


def edit(text: str, following: str) -> str:
    """The text with its last quarter replaced by the begin of the next one."""
    size = len(text) // 4
    return text[: len(text) - size] + following[:size]


_COLUMNS = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
])
_SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double")


def _described(ids: list, texts: list[str], following: list[str], spots: list[np.ndarray], next_spots: list[np.ndarray], anchors) -> pa.RecordBatch:
    edited = [edit(t, f) for t, f in zip(texts, following, strict=True)]
    edits = [s for _, s in spot_sets(pa.array(edited, pa.large_string()), anchors)]
    return pa.RecordBatch.from_arrays([
        pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
        pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited]),
        pa.array([encode(s) for s in spots]), pa.array([encode(s) for s in edits]),
        pa.array([likeness(a, b) for a, b in zip(spots, edits, strict=True)], pa.float64()),
        pa.array([likeness(a, b) for a, b in zip(spots, next_spots, strict=True)], pa.float64()),
    ], schema=_COLUMNS)


def _in_order(anchors: np.ndarray, most: int = 1 << 20):
    """Rows come by range and in order; after a range comes, as border, the first row of the next one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        texts: list[str] = []
        spots: list[np.ndarray] = []
        size, own, ended = 0, None, False

        def flush() -> pa.RecordBatch:
            """All but the newest row, which waits for the one after it."""
            nonlocal size
            spots.extend(s for _, s in spot_sets(pa.array(texts[len(spots) :], pa.large_string()), anchors))
            out = _described(ids[:-1], texts[:-1], texts[1:], spots[:-1], spots[1:], anchors)
            del ids[:-1], texts[:-1], spots[:-1]
            size = 0
            return out

        for batch in batches:
            for doc, value, part, border in zip(batch.column(0).to_pylist(), batch.column(1), *(batch.column(k).to_pylist() for k in (2, 3)), strict=True):
                if part != own:
                    ids, texts, spots, own, ended = [], [], [], part, False
                if ended:
                    continue  # another row with the id of the next range's first one
                ids.append(doc)
                texts.append(value.as_py())
                size += len(texts[-1])
                ended = bool(border)
                if ended or size > most and len(ids) > 1:
                    yield flush()

    return run


def fingerprint_documents(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", anchors: tuple[str, ...] | list[str] = tuple(ANCHORS),
) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) for every row.

    A signature is an anchor word with the CHAIN content words after it; words are runs of letters and
    digits (and anything beyond ASCII), A-Z in lower case. A fingerprint is the sorted set of 32-bit
    signatures in base64: equal texts have equal ones, an empty text the empty string. The edited text
    has its last floor(n_chars / 4) code points replaced by as many from the begin of the next document
    (or all of it), in the order of (id, text), nulls first; the last one is followed by the first. near_edited
    and near_next are the Jaccard of the fingerprint with the edited text's and the next document's; two
    empty ones are alike. A null text counts as empty. Repeated rows follow one another and are each
    returned; other columns are left out; an empty table gives an empty result.

    Rows are dealt by ranges of the id, about four for each shuffle partition, so the next row is the
    next in the task. The first row of each range goes to the range before as well; which these are
    is found from the ids alone. The texts are shuffled once and nothing is written.
    """
    spark, hashes = docs.sparkSession, _anchor_hashes(anchors)
    number = F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)).cast("long"))
    source = small_batches(docs).select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), number.alias("number"),
    )
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [k / parts for k in range(1, parts)]
    bounds = np.unique(np.array(source.agg(F.percentile_approx("number", shares, 20 * parts)).first()[0] or [], np.int64))

    @F.arrow_udf("int")
    def part_of(number: pa.Array) -> pa.Array:
        return pa.array(np.searchsorted(bounds, number.to_numpy(zero_copy_only=False), "right").astype(np.int32))

    ranged = source.withColumn("part", part_of("number"))
    firsts = sorted((r["part"], r["first"]) for r in ranged.groupBy("part").agg(F.min("number").alias("first")).collect())  # one for each range
    borders = [(first, firsts[i - 1][0]) for i, (_, first) in enumerate(firsts)]
    borders = spark.createDataFrame(borders, "first long, before int")
    one = F.struct(F.col("part"), F.lit(0).alias("border"))
    two = F.struct(F.col("before").alias("part"), F.lit(1).alias("border"))
    return (
        ranged.join(F.broadcast(borders), F.col("number") == F.col("first"), "left")
        .withColumn("at", F.explode(F.when(F.col("before").isNull(), F.array(one)).otherwise(F.array(one, two))))
        .select("doc_id", "text", "at.part", "at.border")
        .repartition("part").sortWithinPartitions("part", "border", "doc_id", "text")
        .mapInArrow(tidy(_in_order(hashes)), _SCHEMA)
    )
