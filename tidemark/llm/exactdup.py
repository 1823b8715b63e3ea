"""Exact duplicates by composable polynomial fingerprints, with equal ones compared chunk by chunk."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.batches import small_batches
from tidemark.llm.graph import written
from tidemark.llm.texts import batch_bytes
from tidemark.session import remove, run_dir

CHUNK = 1 << 16  # bytes hashed together: sums of that many products of a byte and a 31-bit power fit 64 bits
BLOCK = 16 * CHUNK  # bytes taken up at a time

#: Two primes below 2**31 and a base for each: their residues side by side are the fingerprint.
MODULI = ((2_147_483_647, 1_103_515_245), (2_147_483_629, 1_566_083_941))
#: A group with more than this share of all rows is dealt to SALTS tasks, and there are fewer than 1 / HOT of them.
HOT, SALTS = 1 / 2048, 64


def _powers(prime: int, base: int, n: int) -> np.ndarray:
    out, size = np.ones(n, np.uint64), 1
    while size < n:
        step = np.uint64(pow(base, size, prime))
        out[size : 2 * size] = out[: min(size, n - size)] * step % np.uint64(prime)
        size *= 2
    return out


class Polynomial:
    """Σ (byte + 1) · base^(bytes behind it), modulo a prime.

    The hash of a text that goes on is that of the begin times base^(length of the rest) plus that of the
    rest. So chunks are hashed apart, side by side, and combined by their lengths alone.
    """

    def __init__(self, prime: int, base: int) -> None:
        self.prime, self.base = prime, base
        self.powers = _powers(prime, base, CHUNK)[::-1].copy()

    def join(self, begin: int, rest: int, length: int) -> int:
        """The hash of two pieces one after the other, the second of `length` bytes."""
        return (begin * pow(self.base, length, self.prime) + rest) % self.prime

    def chunks(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The hashes of pieces of at most CHUNK bytes that lie one after another in `raw`."""
        low = int(starts[0])
        size = ends - starts
        place = np.arange(low, int(ends[-1])) - np.repeat(ends, size) + CHUNK
        terms = (raw[low : int(ends[-1])].astype(np.uint64) + np.uint64(1)) * self.powers[place]
        return np.add.reduceat(terms, starts - low) % np.uint64(self.prime)


def _pieces(at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end) of the chunks of all rows; a row without bytes has none."""
    many = -(-np.diff(at) // CHUNK)
    row = np.repeat(np.arange(len(many)), many)
    nth = np.arange(len(row)) - (np.cumsum(many) - many)[row]
    start = at[:-1][row] + nth * CHUNK
    return row, start, np.minimum(start + CHUNK, at[1:][row])


def fingerprints(column: pa.Array, moduli: tuple[tuple[int, int], ...] = MODULI) -> np.ndarray:
    """One number below 2**62 for each text: the hashes by all moduli side by side, 0 for an empty one.

    Chunks are hashed in blocks of about BLOCK bytes, whatever texts they are from, so no text needs more
    memory than that besides itself.
    """
    raw, at = batch_bytes(column)
    row, start, end = _pieces(at)
    out = np.zeros(len(at) - 1, np.int64)
    if not len(row):
        return out
    cuts = np.searchsorted(end, np.arange(end[0], end[-1] + BLOCK, BLOCK), "left")
    cuts = np.unique(np.concatenate(([0], cuts, [len(row)])))
    last = np.concatenate((row[1:] != row[:-1], [True]))
    for prime, base in moduli:
        poly = Polynomial(prime, base)
        hashes = np.concatenate([poly.chunks(raw, start[a:b], end[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True) if b > a])
        whole = hashes[last].astype(np.int64)
        for k in np.flatnonzero(np.bincount(row, minlength=len(out))[row[last]] > 1):  # texts of several chunks
            total = 0
            first, stop = np.searchsorted(row, [row[last][k], row[last][k] + 1])
            for i in range(first, stop):
                total = poly.join(total, int(hashes[i]), int(end[i] - start[i]))
            whole[k] = total
        out[row[last]] = out[row[last]] << 31 | whole
    return out


def _fingerprint(moduli: tuple[tuple[int, int], ...]):
    @F.arrow_udf("long")
    def fingerprint(text: pa.Array) -> pa.Array:
        return pa.array(fingerprints(text, moduli), pa.int64())

    return fingerprint


def _chunked(raw: Column) -> Column:
    """The chunks of a binary column as rows (no, chunk)."""
    places = F.sequence(F.lit(0), F.floor((F.octet_length(raw) - 1) / CHUNK).cast("int"))
    cut = F.transform(places, lambda k: F.struct(k.alias("no"), F.substring(raw, k * CHUNK + 1, F.lit(CHUNK)).alias("chunk")))
    return F.inline(F.when(F.octet_length(raw) > 0, cut))


def _salted(groups: DataFrame, hot: DataFrame) -> DataFrame:
    """Groups, the hot ones once for each salt."""
    marked = groups.join(F.broadcast(hot.withColumn("_hot", F.lit(True))), ["size", "fingerprint"], "left")
    salts = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    return marked.withColumn("salt", F.explode(salts)).drop("_hot")


def _dealt(rows: DataFrame, hot: DataFrame, by: Column) -> DataFrame:
    """Rows with the salt they look for."""
    marked = rows.join(F.broadcast(hot.withColumn("_hot", F.lit(True))), ["size", "fingerprint"], "left")
    return marked.withColumn("salt", F.when(F.col("_hot"), F.pmod(by, F.lit(SALTS)).cast("int")).otherwise(F.lit(0))).drop("_hot")


def _classes(texts: DataFrame, kinds: DataFrame, clash: DataFrame, folder: str) -> DataFrame:
    """The light rows of texts that share size and fingerprint though they differ, with the numbers of
    their chunks among the different ones at the same place: equal numbers are equal texts."""
    own = written(texts.join(clash, ["size", "fingerprint"], "left_semi").withColumn("at", F.monotonically_increasing_id()), f"{folder}/clashing")
    place = ["size", "fingerprint", "no"]
    nth = F.row_number().over(Window.partitionBy(*place).orderBy("chunk")).alias("kind")
    numbered = kinds.join(clash, ["size", "fingerprint"], "left_semi").select(*place, "chunk", nth)
    parts = own.select("at", "size", "fingerprint", _chunked(F.col("raw")))
    number = parts.join(numbered, [*place, "chunk"]).select("at", "no", F.col("kind").cast("long"))
    kept = number.groupBy("at").agg(F.array_sort(F.collect_list(F.struct("no", "kind"))).alias("c")).select("at", F.col("c.kind").alias("class"))
    found = written(own.drop("raw").join(kept, "at"), f"{folder}/apart")
    remove(texts.sparkSession, f"{folder}/clashing")
    return found


def exact_duplicates(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", moduli: tuple[tuple[int, int], ...] = MODULI,
) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256, fingerprint) for every row.

    A group is all rows of one text, byte for byte; a null text counts as empty. Of a group the row with the
    largest id stays (null is below every id); of repeated rows with that id one. `fingerprint` is that of
    the text: equal texts have equal ones. Other columns are left out; an empty table gives an empty result.

    The texts are read twice. First each is fingerprinted in place and only id, length and hashes are written. Then
    those whose length and fingerprint occur more than once are cut into chunks, and the different chunks at
    each place are counted: copies combine before the exchange, so a group may hold any share of all rows. Where a
    place has two, texts only look equal; they are told apart by which chunks they hold. A group with more
    than HOT of all rows is spread by a salt in each join; there are fewer than 1 / HOT of those, which bounds what
    is broadcast.
    """
    spark, folder = docs.sparkSession, run_dir(docs.sparkSession, "exactdup")
    id_type = docs.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    texts = small_batches(docs).select(F.col(id_col).alias("doc_id"), text.alias("text")).select(
        "doc_id", F.octet_length("text").alias("size"), _fingerprint(moduli)("text").alias("fingerprint"),
        F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"), F.col("text").cast("binary").alias("raw"),
    )
    rows = written(texts.drop("raw").withColumn("at", F.monotonically_increasing_id()), f"{folder}/rows")
    groups = written(rows.groupBy("size", "fingerprint").agg(F.count("*").alias("n")).where("n > 1"), f"{folder}/groups")
    hot = written(groups.where(F.col("n") > HOT * rows.count()).select("size", "fingerprint"), f"{folder}/hot")
    several = _salted(groups.where("size > 0").select("size", "fingerprint"), hot)
    alike = _dealt(texts.drop("text_sha256"), hot, F.monotonically_increasing_id()).join(several, ["size", "fingerprint", "salt"], "left_semi")
    kinds = written(alike.select("size", "fingerprint", _chunked(F.col("raw"))).distinct(), f"{folder}/kinds")
    clash = kinds.groupBy("size", "fingerprint", "no").count().where("count > 1").select("size", "fingerprint").distinct()
    clash = written(clash, f"{folder}/clash")
    rows = rows.withColumn("class", F.array().cast("array<long>"))
    if not clash.isEmpty():
        apart = _classes(texts, kinds, clash, folder)
        rows = rows.join(clash, ["size", "fingerprint"], "left_anti").unionByName(apart)
    one = ["size", "fingerprint", "class"]
    best = written(rows.groupBy(one).agg(F.max(F.struct("doc_id", "at")).alias("best"), F.count("*").alias("group_size")), f"{folder}/best")
    remove(spark, f"{folder}/kinds")
    found = _dealt(rows, hot, F.col("at")).join(_salted(best, hot), [*one, "salt"])
    return found.select(
        F.col("doc_id").cast(id_type).alias("doc_id"), F.col("best.doc_id").alias("keep_id"), "group_size",
        (F.col("best.at") == F.col("at")).alias("kept"), "text_sha256", "fingerprint",
    )
