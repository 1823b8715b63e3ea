"""Shards of near equal bytes by a histogram sort: probe exact byte counts, refine, exchange once."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.graph import written
from tidemark.llm.order import unused
from tidemark.session import run_dir

STEP = 3  # hexadecimal digits of the key that one round of probes resolves
KEY = 24  # 8 digits for the crc32 of the text, 16 for the id with its sign bit turned


@dataclass(frozen=True)
class Histogram:
    """Rows and bytes of ascending key ranges that cover all keys; a range is a prefix of the key's digits."""

    prefixes: list[str]
    rows: np.ndarray
    bytes: np.ndarray


def histogram(keys: DataFrame, shards: int, *, tolerance: float = 0.001, ranges: int = 1024) -> Histogram:
    """Ranges so fine that every shard's ideal end has the border of a range within `tolerance` of a shard,
    and that none has more than 4 / `ranges` of the rows; a single key isn't cut any further.

    A round counts the exact rows and bytes of the 16**STEP parts of the ranges that are too coarse: at
    most one for each end, and at most `ranges` / 4 for their rows, which bounds what the driver sees.
    """
    found: list[tuple[str, int, int]] = [("", 1, 0)]
    coarse = {""}
    while coarse:
        length = min(map(len, coarse))  # ranges of one round have prefixes of one length
        coarse = {p for p in coarse if len(p) == length}
        counted = (
            keys.where(F.substring("key", 1, length).isin(list(coarse)) if length else F.lit(True))
            .groupBy(F.substring("key", 1, length + STEP).alias("part"))
            .agg(F.count("*").alias("rows"), F.sum("size").alias("bytes")).toArrow().to_pylist()
        )
        parts = sorted((r["part"], r["rows"], r["bytes"]) for r in counted)
        split = {p: list(v) for p, v in groupby(parts, key=lambda part: part[0][:length])}
        found = [part for old in found for part in (split.get(old[0], []) if old[0] in coarse else [old])]
        if not found:
            break
        rows, sizes = (np.array([f[k] for f in found], np.int64) for k in (1, 2))
        low = (np.cumsum(sizes) - sizes).astype(float)
        high, ends = low + sizes, sizes.sum() * np.arange(1, shards) / shards
        slack = tolerance * sizes.sum() / shards
        at = np.searchsorted(low, ends, "right") - 1
        wide = set(at[(ends - low[at] > slack) & (high[at] - ends > slack)].tolist()) | set(np.flatnonzero(rows * ranges > 4 * rows.sum()).tolist())
        coarse = {found[i][0] for i in wide if rows[i] > 1 and len(found[i][0]) < KEY}
    return Histogram([f[0] for f in found], *(np.array([f[k] for f in found], np.int64) for k in (1, 2)))


def assign(found: Histogram, shards: int) -> np.ndarray:
    """The shard of every range: a shard ends at the border nearest to its ideal end."""
    borders = np.concatenate(([0], np.cumsum(found.bytes))).astype(float)
    ideal = borders[-1] * np.arange(1, shards) / shards
    right = np.clip(np.searchsorted(borders, ideal), 1, len(borders) - 1)
    cut = np.where(ideal - borders[right - 1] <= borders[right] - ideal, right - 1, right)
    return np.searchsorted(cut, np.arange(len(found.prefixes)), "right")


def shard_documents(
    docs: DataFrame, shards: int, *, id_col: str = "doc_id", text_col: str = "text", overhead: int = 8,
    tolerance: float = 0.001, ranges: int = 1024,
) -> DataFrame:
    """`docs` with size, text_crc32, law ('bytes'), shard and slot added (columns of those names are replaced).

    The order is that of (crc32 of the text, id), so equal texts lie side by side and share a shard
    unless its end falls among them. size is the text's UTF-8 bytes plus `overhead`; a null text has no
    bytes and the crc of an empty one, a null id comes first. Shards are consecutive stretches whose
    sizes differ from the mean by about `tolerance` of it, or by a row where rows are larger than that;
    slot counts 0, 1, 2 … in the order within the shard. Rows of equal id and crc are interchangeable:
    each gets a slot, and no shard ends among them. Every row is kept; an empty table stays empty.

    Only keys and sizes are written and counted. Then the rows are exchanged once, by range, and numbered
    within it, so neither a shard nor a group of copies has to fit one task.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    lowest = F.lit(-(1 << 63)).cast("long")
    id_key, key, at = unused(docs.withColumns({c: F.lit(0) for c in ("size", "text_crc32", "law", "shard", "slot")}), "id_key", "key", "at")
    marked = docs.withColumns({
        "size": F.octet_length(text).cast("long") + overhead, "text_crc32": F.crc32(text.cast("binary")), "law": F.lit("bytes"),
        id_key: F.coalesce(F.col(id_col).cast("long"), lowest).bitwiseXOR(lowest),
    })
    keyed = marked.withColumn(key, F.concat(F.lpad(F.hex("text_crc32"), 8, "0"), F.lpad(F.hex(id_key), 16, "0"))).drop(id_key)
    keys = written(keyed.select(F.col(key).alias("key"), "size"), f"{run_dir(spark, 'shards')}/keys")
    found = histogram(keys, shards, tolerance=tolerance, ranges=ranges)
    if not found.prefixes:
        return keyed.drop(key).withColumns({"shard": F.lit(0), "slot": F.lit(0).cast("long")})
    shard = assign(found, shards)
    before = np.cumsum(found.rows) - found.rows
    base = before - before[np.searchsorted(shard, shard)]  # rows of the same shard in ranges before
    prefixes = np.array(found.prefixes, f"S{KEY}")

    @F.pandas_udf("range int, shard int, base long")
    def place(key: pd.Series) -> pd.DataFrame:
        at = np.searchsorted(prefixes, key.to_numpy().astype(f"S{KEY}"), "right") - 1
        return pd.DataFrame({"range": at, "shard": shard[at], "base": base[at]})

    order = F.row_number().over(Window.partitionBy(f"{at}.range").orderBy(key))
    return (
        keyed.withColumn(at, place(key))
        .withColumns({"shard": F.col(f"{at}.shard"), "slot": F.col(f"{at}.base") + order - 1}).drop(at, key)
    )
