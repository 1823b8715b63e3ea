"""Packing without crossing: every document is cut into pieces of power-of-two length, one per sequence."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.batches import small_batches, tidy
from tidemark.llm.graph import written
from tidemark.llm.order import borders, range_of
from tidemark.session import run_dir

#: Fixed values of the public byte-level tokenizers: the pattern that splits text before the merges.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

STRIDE = 1 << 18
NO_ID = -(1 << 63)  # rows without an id come first
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"  # white space to the pattern
#: Between white space and what is before it, and between a letter and a number, no token spans.
GAP = re.compile(rf"(?<=[^{SPACE}])(?=[{SPACE}])|(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])")
LONG = 1 << 16  # white space beyond this is too long for the pattern's way back
_LONG = re.compile(rf"[{SPACE}]{{{LONG},}}")


def byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies: printable ones for themselves."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(rest)}


@cache
def _encoder(path: str):
    """The file's merges as ranks: ids of merged tokens ascend in the order of the merges."""
    import tiktoken

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    if spec["model"]["type"] != "BPE" or spec["pre_tokenizer"] != {
        "type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True
    } or spec["normalizer"] is not None:
        raise ValueError(f"{path} is not a plain byte-level BPE")
    alphabet, vocabulary = byte_alphabet(), spec["model"]["vocab"]
    merged = [vocabulary["".join(m if isinstance(m, list) else m.split(" "))] for m in spec["model"]["merges"]]
    if merged != sorted(merged):
        raise ValueError(f"{path}: ids don't ascend with the merges")
    added = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ranks = {bytes(map(alphabet.__getitem__, token)): i for token, i in vocabulary.items() if token not in added}
    return tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=added)


def token_ids(path: str, text: str) -> np.ndarray:
    """The ids of a text by the tokenizer file, special strings read as its library does by default.

    Long texts are cut where no token spans. Long white space is one word by the pattern but for its last
    character, which belongs to what follows, if anything does; it is merged without the pattern.
    """
    encoder, out = _encoder(path), []
    special = re.compile("|".join(map(re.escape, encoder.special_tokens_set)) or r"(?!)")

    def plain(part: str) -> None:
        low = 0
        while low < len(part):
            gap = GAP.search(part, low + STRIDE) if len(part) - low > STRIDE else None
            high = gap.start() if gap else len(part)
            out.append(encoder.encode_to_numpy(part[low:high], allowed_special=set(), disallowed_special=()))
            low = high

    def ordinary(part: str) -> None:
        low = 0
        for blank in _LONG.finditer(part):
            end = blank.end() if blank.end() == len(part) else blank.end() - 1
            plain(part[low : blank.start()])
            out.append(np.array(encoder._core_bpe.encode_single_piece(part[blank.start() : end].encode()), np.uint32))
            low = end
        plain(part[low:])

    low = 0
    for found in special.finditer(text):
        ordinary(text[low : found.start()])
        out.append(np.array([encoder.encode_single_token(found.group())], np.uint32))
        low = found.end()
    ordinary(text[low:])
    return np.concatenate(out) if out else np.empty(0, np.uint32)


def binary_pieces(n: int, limit: int) -> list[int]:
    """Lengths that sum to n: the limit as often as it fits, then the binary digits of the rest, largest first."""
    return [limit] * (n // limit) + [1 << b for b in reversed(range(limit.bit_length() - 1)) if n % limit >> b & 1]


_PIECES = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()),
    ("tie", pa.int64()), ("cell", pa.int32()),
])
_SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, tie long, cell int"


def _cut(path: str, limit: int, end_id: int, bounds: np.ndarray, most: int = 1 << 20):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size = 0
        for batch in batches:
            docs, texts, ties = batch.columns
            cells = range_of(bounds, docs.fill_null(NO_ID), ties).tolist()
            for doc, text, tie, cell in zip(docs.to_pylist(), texts, ties.to_pylist(), cells, strict=True):
                ids = np.append(token_ids(path, text.as_py() or ""), np.uint32(end_id)).astype("<u4")
                raw, at = memoryview(ids.tobytes()), 0
                for length in binary_pieces(len(ids), limit):
                    rows.append((doc, at, length, bytes(raw[4 * at : 4 * (at + length)]), len(ids), tie, cell))
                    at += length
                    size += 4 * length
                    if size > most:
                        yield _rows(rows)
                        rows, size = [], 0
            if rows:
                yield _rows(rows)
                rows, size = [], 0

    return run


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _PIECES, strict=True)], schema=_PIECES)


def pack_documents(
    docs: DataFrame, tokenizer: str, *, limit: int = 2048, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens, bucket, sequence_id, offset): a row per piece, a piece per sequence.

    A document is the ids of its text by the `tokenizer` file (a byte-level BPE) and then `end_id`; a null
    or empty text is `end_id` alone. It is cut into pieces of `limit` ids (a power of two) and one piece
    for each binary digit of the rest. Every piece is a sequence of its own whose length is a power of
    two, so nothing is padded and no sequence holds two documents. `ids` holds little-endian unsigned 32-bit
    numbers, `start` the ids of the document before the piece. Repeated rows are packed each; rows may have a
    null id; other columns are left out; an empty table gives an empty result. One document's ids are held in
    memory at a time.

    Sequences of one length are bucketed: in the order of `bucket`, longest first, document (null first) and start,
    neighbours can be batched as they lie, and `sequence_id` counts 0, 1, 2 … in that order, whatever the
    partitions of the input were (of documents that share an id, by a hash of the text; repeated rows are
    interchangeable). Pieces are exchanged once, by length and range of (document, hash), and written in their
    buckets; what is joined to number them is a row for each length and range. One Python worker a task cuts documents and
    finds their range, so no more workers hold the tokenizer than there are tasks.
    """
    if limit < 1 or limit & (limit - 1):
        raise ValueError("limit must be a power of two")
    spark, folder = docs.sparkSession, run_dir(docs.sparkSession, "packing")
    text = F.col(text_col).cast("string")
    keyed = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("tie"))
    number = F.coalesce("doc_id", F.lit(NO_ID).cast("long"))
    bounds = borders(keyed, number, F.col("tie"), 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    own = Window.partitionBy("length", "cell").orderBy("doc_id", "tie", "start")
    pieces = small_batches(keyed).mapInArrow(tidy(_cut(tokenizer, limit, end_id, bounds)), _SCHEMA).withColumn("place", F.row_number().over(own) - 1)
    path = f"{folder}/bucketed"
    pieces.write.option("compression", "zstd").parquet(path)
    pieces = spark.read.schema(pieces.schema).parquet(path)
    counts = pieces.groupBy("length", "cell").agg(F.count("*").alias("rows"))
    longer = F.sum("rows").over(Window.partitionBy("length").orderBy("cell")) - F.col("rows")
    counts = written(counts.withColumn("before", longer), f"{folder}/counts")
    many = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("rows").alias("n")).collect()}  # one for each power of two
    base = F.col("before")
    for length, count in many.items():
        base = base + F.when(F.col("length") < length, count).otherwise(0)
    counts = counts.select("length", "cell", base.alias("base"))
    return pieces.join(counts, ["length", "cell"]).select(
        "doc_id", "start", "length", "ids", "doc_tokens", F.col("length").alias("bucket"),
        (F.col("base") + F.col("place")).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
    )
