"""A Merkle manifest of a table as a tree of SHA-256 midstates, its proofs, and what a changed leaf makes of the root.

A parent keeps the state of its hash before each child's slot. Folding a replaced leaf up to the root
resumes that state with the replacement and the siblings on its right; those on its left aren't hashed again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import midstate
from tidemark.llm.batches import small_batches, tidy
from tidemark.llm.graph import written
from tidemark.llm.order import placed
from tidemark.session import remove, run_dir

FAN = 8  # children of a parent
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Level:
    """Nodes in order and what their parents keep of them: the state before each node's slot, the siblings
    right of it (`count` of `blocks` from `first` on), those on both sides as text, and how many slots there are."""

    state: np.ndarray
    blocks: np.ndarray
    first: np.ndarray
    count: np.ndarray
    slots: np.ndarray


def grow(digests: np.ndarray, runs: np.ndarray) -> tuple[Level, np.ndarray]:
    """The level of nodes (rows of 32 bytes) whose parents are `runs`, ascending from 0, and the parents' digests."""
    blocks = midstate.from_bytes(midstate.hexed(digests))
    size = np.bincount(runs)
    begin = np.cumsum(size) - size
    state, kept = midstate.start(len(size)), np.empty((8, len(runs)), np.uint32)
    for slot in range(int(size.max(initial=0))):
        own = np.flatnonzero(size > slot)
        at = begin[own] + slot
        kept[:, at] = state[:, own]
        state[:, own] = midstate.absorb(state[:, own], blocks[:, at])
    at = np.arange(len(runs))
    level = Level(kept, blocks, at + 1, (begin + size)[runs] - at - 1, size[runs])
    return level, midstate.to_bytes(midstate.finish(state, size))


def fold(level: Level, node: np.ndarray, child: np.ndarray) -> np.ndarray:
    """The parents' digests when `child` (rows of 32 bytes) stands in the slots of `node`."""
    state = midstate.absorb(level.state[:, node], midstate.from_bytes(midstate.hexed(child)))
    for k in range(int(level.count[node].max(initial=0))):
        on = np.flatnonzero(level.count[node] > k)
        state[:, on] = midstate.absorb(state[:, on], level.blocks[:, level.first[node[on]] + k])
    return midstate.to_bytes(midstate.finish(state, level.slots[node]))


def siblings(digests: np.ndarray, runs: np.ndarray) -> list[bytes]:
    """For each node the hexadecimal digests of the others of its run."""
    text = midstate.hexed(digests).tobytes()
    size = np.bincount(runs)
    begin = np.cumsum(size) - size
    low, high = (begin[runs] * 64).tolist(), ((begin + size)[runs] * 64).tolist()
    return [text[a : 64 * i] + text[64 * (i + 1) : b] for i, (a, b) in enumerate(zip(low, high, strict=True))]


#: One step of a path: the parent's kept state, the digests right of the slot, all other digests, the slots.
_STEP = pa.struct([("state", pa.binary()), ("right", pa.binary()), ("others", pa.binary()), ("slots", pa.int32())])
_PATH = "array<struct<state: binary, right: binary, others: binary, slots: int>>"


def _column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def _digests(column: pa.Array) -> np.ndarray:
    """A binary column of 32 bytes a row; rows of another length (nulls) become zeros."""
    raw = b"".join(v if v is not None else bytes(32) for v in column.to_pylist())
    return np.frombuffer(raw, np.uint8).reshape(-1, 32)


def _flat(batch: pa.RecordBatch) -> tuple[pa.StructArray, np.ndarray, np.ndarray]:
    """The nodes of all stretches of a batch, the stretch of each, and its place in that."""
    lists = _column(batch, "nodes")
    size = np.array([len(v) if v is not None else 0 for v in lists], np.int64)
    owner = np.repeat(np.arange(len(size)), size)
    return lists.flatten(), owner, np.arange(len(owner)) - (np.cumsum(size) - size)[owner]


def _trees(digests: np.ndarray, owner: np.ndarray, place: np.ndarray, height: np.ndarray) -> tuple[list, np.ndarray]:
    """(level, nodes that have one, the digests there) for each step up, and the digest of each stretch.

    `height` is the number of steps that the tree of a stretch takes. Stretches lie one after another;
    their nodes of one level do too, and the parents of a level are numbered in that order.
    """
    steps = []
    for step in range(int(height.max(initial=0))):
        rises = height[owner] > step
        if rises.all():
            key = owner * (1 << 32) + place // FAN
        else:  # a stretch that has ended goes on as it is, as its own only node
            key = owner * (1 << 32) + np.where(rises, place // FAN, place)
        first = np.concatenate(([True], key[1:] != key[:-1]))
        runs = np.cumsum(first) - 1
        level, parents = grow(digests, runs)
        parents[~rises[first]] = digests[first][~rises[first]]
        steps.append((level, runs, rises, digests))
        digests, owner, place = parents, owner[first], (key[first] & 0xFFFFFFFF)
    return steps, digests


def _parents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each stretch the one digest that it comes to."""
    for batch in batches:
        nodes, owner, place = _flat(batch)
        _, top = _trees(_digests(nodes.field("digest")), owner, place, _column(batch, "height").to_numpy())
        yield pa.RecordBatch.from_arrays(
            [_column(batch, "tree"), _column(batch, "stretch"), _column(batch, "size"), pa.array(list(map(bytes, top)), pa.binary())],
            ["tree", "stretch", "size", "digest"],
        )


def _above(batch: pa.RecordBatch) -> list[list[dict]]:
    return [v or [] for v in _column(batch, "path").to_pylist()]


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each node its path: its own steps within the stretch, then those of the stretch."""
    for batch in batches:
        nodes, owner, place = _flat(batch)
        digests = _digests(nodes.field("digest"))
        steps, _ = _trees(digests, owner, place, _column(batch, "height").to_numpy())
        above, out = _above(batch), [[] for _ in owner]
        node = np.arange(len(owner))
        for level, runs, rises, own in steps:
            others, state = siblings(own, runs), midstate.to_bytes(level.state)
            for i, j in enumerate(node.tolist()):
                if rises[j]:
                    right = own[level.first[j] : level.first[j] + level.count[j]].tobytes()
                    out[i].append({"state": bytes(state[j]), "right": right, "others": others[j], "slots": int(level.slots[j])})
            node = runs[node]
        paths = [o + above[k] for o, k in zip(out, owner.tolist(), strict=True)]
        taken = pa.array(owner)
        yield pa.RecordBatch.from_arrays(
            [_column(batch, "tree").take(taken), nodes.field("place"), nodes.field("digest"), pa.array(paths, pa.list_(_STEP)), _column(batch, "subroot").take(taken)],
            ["tree", "place", "digest", "path", "subroot"],
        )


def _path_levels(above: list[list[dict]]) -> list[tuple[Level, np.ndarray]]:
    """The steps above the stretches of a batch as levels with a node for each stretch, and which have that step."""
    out = []
    for k in range(max(map(len, above), default=0)):
        here = [p[k] if k < len(p) else None for p in above]
        right = [s["right"] if s else b"" for s in here]
        count = np.array([len(r) // 32 for r in right])
        blocks = midstate.hexed(np.frombuffer(b"".join(right), np.uint8).reshape(-1, 32))
        states = np.frombuffer(b"".join(s["state"] if s else bytes(32) for s in here), np.uint8).reshape(-1, 32)
        level = Level(
            midstate.from_bytes(states), midstate.from_bytes(blocks) if len(blocks) else np.empty((16, 0), np.uint32),
            np.cumsum(count) - count, count, np.array([s["slots"] if s else 1 for s in here]),
        )
        out.append((level, np.array([s is not None for s in here])))
    return out


def _verified(root: bytes) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For each leaf its proof, and the root that its replacement, or else the leaf itself, folds to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, owner, place = _flat(batch)
            digests = _digests(nodes.field("digest"))
            changed = nodes.field("changed")
            value = np.where(changed.is_valid().to_numpy(zero_copy_only=False)[:, None], _digests(changed), digests)
            steps, _ = _trees(digests, owner, place, _column(batch, "height").to_numpy())
            above, node = _above(batch), np.arange(len(owner))
            for level, runs, rises, _ in steps:
                up = rises[node]
                value[up] = fold(level, node[up], value[up])
                node = runs[node]
            proof = [b"".join(s["others"] for s in path) for path in above]  # a node is left of each stretch
            for _, runs, rises, own in reversed(steps):
                others = siblings(own, runs)
                proof = [(o if r else b"") + proof[p] for o, r, p in zip(others, rises.tolist(), runs.tolist(), strict=True)]
            for level, has in _path_levels(above):
                on = np.flatnonzero(has[owner])
                value[on] = fold(level, owner[on], value[on])
            taken = pa.array(owner)
            text = lambda raw: pa.array([bytes(v).hex() for v in raw], pa.string())
            yield pa.RecordBatch.from_arrays([
                nodes.field("id"), text(digests),
                pa.array([v.hex() for v in _column(batch, "subroot").to_pylist()], pa.string()).take(taken),
                pa.array([root.hex()] * len(owner), pa.string()),
                pa.array([hashlib.sha256(p).hexdigest() for p in proof], pa.string()), text(value),
                pa.array([bytes(v) == root for v in value], pa.bool_()),
            ], ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])

    return run


_RESULT = "doc_id {id}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def encoded(column: Column) -> Column:
    """A value as text that can't run into the next one: `-` for null, else the bytes of it, a colon, and itself."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(columns: Sequence[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*map(encoded, columns)).cast("binary"), 256))


def _stretches(nodes: DataFrame, levels: int) -> DataFrame:
    """Nodes (tree, place, size, digest, …) as rows of FAN ** levels consecutive ones, in order, with their height."""
    wide = FAN**levels
    others = [c for c in nodes.columns if c not in ("tree", "place", "size", "digest")]
    one = F.struct("place", "digest", *others)
    steps = F.lit(0)
    for k in range(levels):
        steps = steps + (F.col("size") > FAN**k).cast("int")
    return (
        nodes.groupBy("tree", F.floor(F.col("place") / wide).alias("stretch"), "size")
        .agg(F.array_sort(F.collect_list(one)).alias("nodes")).withColumn("height", steps)
    )


def _climb(nodes: DataFrame, levels: int, folder: str) -> tuple[list[DataFrame], DataFrame]:
    """Tables of stretches from the nodes up, and (tree, digest): what each tree comes to."""
    kind = nodes.schema["tree"].dataType.simpleString()
    tables, step = [], 0
    while True:
        rows = written(_stretches(nodes, levels), f"{folder}/stretches-{step}")
        tables.append(rows)
        made = small_batches(rows).mapInArrow(tidy(_parents), f"tree {kind}, stretch long, size long, digest binary")
        wide = FAN**levels
        nodes = written(made.select("tree", F.col("stretch").alias("place"), F.ceil(F.col("size") / wide).cast("long").alias("size"), "digest"), f"{folder}/nodes-{step}")
        step += 1
        if (nodes.agg(F.max("size")).first()[0] or 1) <= 1:
            return tables, nodes.select("tree", "digest")


def _with_paths(rows: DataFrame, paths: DataFrame) -> DataFrame:
    paths = paths.select(F.col("tree").alias("_tree"), F.col("place").alias("_place"), "path", "subroot")
    same = F.col("tree").eqNullSafe(F.col("_tree")) & (F.col("stretch") == F.col("_place"))
    return small_batches(rows.join(paths, same).drop("_tree", "_place"))


def _descend(tables: list[DataFrame], paths: DataFrame, folder: str) -> DataFrame:
    """(tree, place, path, subroot) of the stretches of the lowest table, from those of the topmost one."""
    kind = paths.schema["tree"].dataType.simpleString()
    for step, rows in reversed(list(enumerate(tables))[1:]):
        made = _with_paths(rows, paths).mapInArrow(tidy(_paths), f"tree {kind}, place long, digest binary, path {_PATH}, subroot binary")
        paths = written(made.drop("digest"), f"{folder}/paths-{step}")
    return paths


def merkle_manifest(
    docs: DataFrame, *, id_col: str = "doc_id", tree_col: str = "lang",
    columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    changed: dict[str, Column] | None = None, tampered: Column | None = None, levels: int = 3,
) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) for every row.

    A leaf is the SHA-256 of `columns`, each encoded by `encoded`. The leaves of each value of `tree_col`, by
    ascending id, are hashed in runs of FAN (the last one may be shorter) up to one digest, the subroot;
    subroots by ascending value (null first) likewise up to the root. A null tree value is a tree of
    its own, a null id comes first, rows of equal id come by their leaf, repeated rows are leaves each. An
    empty table gives an empty result; columns not named are left out, whatever their names.

    proof_sha256 is the hash of the digests beside the way to the root, level by level. `tampered` marks rows whose columns
    are replaced by `changed` (for the fold alone): folded_root is what the replaced leaf, or the leaf itself
    where nothing is marked, comes to, and `verified` whether that is the root.

    The texts are read once and hashed in place. Leaves are ordered by one exchange by range and gathered by
    another, 32 bytes and the id each, into stretches of FAN ** `levels`, whose trees are grown in a task. Their
    digests are the nodes of the next table, so each is FAN ** `levels` times smaller; every table is
    written. Then paths (kept states and right siblings) go down from the root, one for each stretch.
    """
    spark, folder = docs.sparkSession, run_dir(docs.sparkSession, "merkle")
    id_type = docs.schema[id_col].dataType.simpleString()
    named = {c: F.col(c) for c in columns}
    leaf = leaf_digest(list(named.values()))
    replaced = F.lit(None).cast("binary")
    if tampered is not None:
        replaced = F.when(tampered, leaf_digest(list((named | (changed or {})).values())))
    leaves = docs.select(F.col(tree_col).cast("string").alias("tree"), F.col(id_col).alias("id"), leaf.alias("digest"), replaced.alias("changed"))
    leaves = written(leaves, f"{folder}/leaves/hashed")  # as finding the ranges reads them once more
    tables, subroots = _climb(placed(leaves, "tree", ["id", "digest"], f"{folder}/leaves"), levels, f"{folder}/trees")
    remove(spark, f"{folder}/leaves")
    named_roots = subroots.select(F.lit(0).alias("tree"), F.col("tree").alias("name"), "digest")
    top, root = _climb(placed(named_roots, "tree", ["name"], f"{folder}/roots"), levels, f"{folder}/top")
    found = root.first()
    if found is None:
        remove(spark, folder)
        return spark.createDataFrame([], _RESULT.format(id=id_type))
    start = spark.range(1).select(
        F.lit(0).alias("tree"), F.lit(0).cast("long").alias("place"), F.array().cast(_PATH).alias("path"), F.lit(None).cast("binary").alias("subroot"))
    paths = _with_paths(top[0], _descend(top, start, f"{folder}/top")).mapInArrow(
        tidy(_paths), f"tree int, place long, digest binary, path {_PATH}, subroot binary")
    names = top[0].select("tree", F.explode("nodes").alias("node")).select("node.place", "node.name")
    paths = written(paths.join(names, "place").select(
        F.col("name").alias("tree"), F.lit(0).cast("long").alias("place"), "path", F.col("digest").alias("subroot")), f"{folder}/subroots")
    paths = _descend(tables, paths, f"{folder}/trees")
    return _with_paths(tables[0], paths).mapInArrow(tidy(_verified(bytes(found["digest"]))), _RESULT.format(id=id_type))
