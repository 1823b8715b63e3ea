"""Near-duplicate groups by an exact Jaccard join of word n-gram sets, with set-relation skipping.

Equal sets are one class. Every class puts the rarest fifth of its n-grams into an inverted index
(two sets over the threshold share one of them), with its size and the n-gram's position. Two kinds
of relation keep the work below all pairs:

* within a list: entries of one size and neighbouring positions form a block, and whole blocks are
  skipped whose size or position can't reach the threshold;
* between sets: in a long list every set is compared with one leader only. The distance to the
  leader bounds the distance between two others (1 - Jaccard is a metric), so answers follow from
  the leader's computed ones; only pairs still open and in different components are compared.

The n-grams that many sets share come last in the order, from counts over all texts. The order
decides how much work there is, never the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.batches import small_batches, tidy
from tidemark.llm.graph import components, written
from tidemark.llm.texts import set_id, shingle_sets
from tidemark.session import run_dir

SPREAD = 256  # a list known to be long is dealt to so many places
_ARROW = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}


def _batch(schema: str, *columns: object) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, _ARROW[t]) for c, (_, t) in zip(columns, fields, strict=True)], names=[n for n, _ in fields]
    )


def least_overlap(n: np.ndarray, percent: int) -> np.ndarray:
    """The smallest overlap that a set of size n has with any set over the threshold."""
    return -(-n * percent // 100)


def pair_overlap(n: object, m: object, percent: int) -> object:
    """The smallest overlap of two sets of sizes n and m over the threshold."""
    return -(-(n + m) * percent // (100 + percent))


_SETS = "kind int, doc_id long, n int, set long, parity binary"


def parity(grams: np.ndarray) -> bytes:
    """A bit for each of at least as many places as there are hashes: whether an odd number falls there.

    Two of them differ in no more bits than their sets differ in hashes. The upper half folded onto the
    lower by exclusive or gives the bits of half as many places.
    """
    places = 1 << max(6, int(len(grams) - 1).bit_length())
    odd = np.bincount((grams >> np.uint64(11)).astype(np.int64) & (places - 1), minlength=places) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def parity_distance(x: bytes, y: bytes) -> int:
    """The bits in which two sets' parities differ, on as many places as the smaller one has."""
    a, b = (np.frombuffer(v, np.uint8) for v in (x, y))
    while len(a) != len(b):
        if len(a) < len(b):
            a, b = b, a
        a = a[: len(a) // 2] ^ a[len(a) // 2 :]
    return int(np.bitwise_count(a ^ b).sum())


def _describe(words: int, often: int, most: int = 2_000_000):
    """A row for each text, and one for n-grams that `often` sets have of those that hold `most` n-grams."""

    def common(sets: dict[int, np.ndarray]) -> pa.RecordBatch:
        grams, count = np.unique(np.concatenate(list(sets.values())), return_counts=True)
        many = count >= often
        grams, count = grams[many].view(np.int64), count[many]
        return _batch(_SETS, np.ones(len(grams), np.int32), pa.nulls(len(grams), pa.int64()), count, grams, pa.nulls(len(grams), pa.binary()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        distinct: dict[int, np.ndarray] = {}
        total = 0
        for batch in batches:
            sizes, keys, bits = [], [], []
            for _, grams in shingle_sets(batch.column(1), words):
                key = set_id(grams) if len(grams) else 0
                sizes.append(len(grams))
                keys.append(key)
                bits.append(parity(grams) if len(grams) else None)
                if len(grams) and key not in distinct:
                    distinct[key] = grams
                    total += len(grams)
                    if total > most:
                        yield common(distinct)
                        distinct, total = {}, 0
            yield _batch(_SETS, np.zeros(len(sizes), np.int32), batch.column(0), sizes, keys, bits)
        if distinct:
            yield common(distinct)

    return run


_POSTINGS = "gram long, n int, place long, set long"  # place: spread << 32 | position


def _post(words: int, percent: int, common: np.ndarray, counts: np.ndarray, longest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            if len(seen) > 100_000:
                seen.clear()  # copies met again are dropped in the lists
            out: list[tuple[np.ndarray, ...]] = []
            size = 0

            def rows() -> pa.RecordBatch:
                return _batch(_POSTINGS, *(np.concatenate(c) for c in zip(*out, strict=True)))

            for _, grams in shingle_sets(batch.column(1), words):
                n = len(grams)
                key = set_id(grams) if n else 0
                if not n or key in seen:
                    continue
                seen.add(key)
                shared = np.zeros(n, np.int64)
                if len(common):
                    at = np.minimum(np.searchsorted(common, grams), len(common) - 1)
                    shared = np.where(common[at] == grams, counts[at], 0)
                    if shared.any():
                        order = np.lexsort((grams, shared))
                        grams, shared = grams[order], shared[order]
                head = n - int(least_overlap(np.int64(n), percent)) + 1
                place = np.where(shared[:head] > longest, 1 + key % SPREAD, 0) << 32 | np.arange(head)
                out.append((grams[:head].view(np.int64), np.full(head, n, np.int32), place, np.full(head, key, np.int64)))
                size += head
                if size > 200_000:
                    yield rows()
                    out.clear()
                    size = 0
            if out:
                yield rows()

    return run


_FOUND = "kind int, gram long, n int, pos int, a long, m int, b long, shared int, rest int"


def _lists(percent: int, longest: int, block: int = 8):
    """Candidate pairs (kind 0) from the short lists; the entries of long lists go on (kind 1)."""

    def join(gram: np.ndarray, spread: np.ndarray, n: np.ndarray, pos: np.ndarray, key: np.ndarray):
        new = np.ones(len(gram), bool)  # copies of a set in other batches
        new[1:] = (gram[1:] != gram[:-1]) | (n[1:] != n[:-1]) | (key[1:] != key[:-1]) | (spread[1:] != spread[:-1])
        gram, spread, n, pos, key = (c[new] for c in (gram, spread, n, pos, key))
        first = np.flatnonzero(np.concatenate(([True], gram[1:] != gram[:-1])))
        length = np.diff(np.append(first, len(gram)))
        own = np.repeat(length, length)
        long = (own > longest) | (spread > 0)
        if long.any():
            yield _batch(_FOUND, np.ones(long.sum(), np.int32), gram[long], n[long], pos[long], key[long],
                         np.zeros(long.sum(), np.int32), np.zeros(long.sum(), np.int64), *[np.zeros(long.sum(), np.int32)] * 2)
        use = ~long & (own > 1)
        if not use.any():
            return
        gram, n, pos, key = (c[use].astype(np.int64) for c in (gram, n, pos, key))
        # Blocks of one list, one size and neighbouring positions; entries are sorted by all three.
        cut = (gram[1:] != gram[:-1]) | (n[1:] != n[:-1]) | (pos[1:] // block != pos[:-1] // block)
        start = np.flatnonzero(np.concatenate(([True], cut)))
        stop = np.append(start[1:], len(gram))
        mine = np.repeat(np.arange(len(start)), stop - start)
        bn, bp = n[start], pos[start] // block * block
        change = np.flatnonzero(np.concatenate(([True], gram[start][1:] != gram[start][:-1])))
        end = np.repeat(np.append(change[1:], len(start)), np.diff(np.append(change, len(start))))
        probe, k = np.arange(len(gram)), mine.copy()
        while len(probe):  # the k-th block from each entry on, for all entries at once
            x, y = n[probe], bn[k]
            need = pair_overlap(x, y, percent)
            p, q = pos[probe], bp[k]
            reach = np.minimum(p, q + block - 1) + 1 + np.minimum(x - p - 1, y - q - 1)
            hit = reach >= need
            if hit.any():
                a, kb = probe[hit], k[hit]
                size = stop[kb] - start[kb]
                left = np.repeat(a, size)
                right = np.repeat(start[kb], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                ok = right > left
                left, right = left[ok], right[ok]
                x, y, p, q = n[left], n[right], pos[left], pos[right]
                rest = np.minimum(x - p - 1, y - q - 1)
                ok = np.minimum(p, q) + 1 + rest >= pair_overlap(x, y, percent)
                left, right, rest = left[ok], right[ok], rest[ok]
                swap = key[left] > key[right]
                left, right = np.where(swap, right, left), np.where(swap, left, right)
                rows = np.stack([key[left], key[right], n[left], n[right]])
                pairs, which, shared = np.unique(rows, axis=1, return_inverse=True, return_counts=True)
                if pairs.shape[1]:
                    least = np.full(pairs.shape[1], 1 << 30)
                    np.minimum.at(least, which.ravel(), rest)
                    zero = np.zeros(pairs.shape[1], np.int64)
                    yield _batch(_FOUND, zero.astype(np.int32), zero, pairs[2].astype(np.int32), zero.astype(np.int32),
                                 pairs[0], pairs[3].astype(np.int32), pairs[1], shared.astype(np.int32), least.astype(np.int32))
            k = k + 1
            go = (k < end[mine[probe]])
            probe, k = probe[go], k[go]
            go = bn[k] * percent <= n[probe] * 100  # sizes only grow along a list
            probe, k = probe[go], k[go]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] = []
        gone = None  # a list too long to wait for its end: all of its entries go on as they come
        for batch in batches:
            grams, n, place, key = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            columns = [grams, (place >> 32).astype(np.int32), n, (place & 0xFFFFFFFF).astype(np.int32), key]
            if kept:
                columns = [np.concatenate(c) for c in zip(kept, columns, strict=True)]
            if not len(columns[0]):
                continue
            last = int(np.searchsorted(columns[0], columns[0][-1]))
            if gone is not None:
                columns[1] = np.where(columns[0] == gone, 1, columns[1]).astype(np.int32)
            if len(columns[0]) - last > 50_000:
                gone = columns[0][-1]
                columns[1] = np.where(columns[0] == gone, 1, columns[1]).astype(np.int32)
                last = len(columns[0])
            kept = [c[last:] for c in columns]
            if last:
                yield from join(*(c[:last] for c in columns))
        if kept and len(kept[0]):
            yield from join(*kept)

    return run


def _short(grams: np.ndarray) -> bytes:
    """Five bytes of each hash: two sets are told apart by them, not a whole corpus."""
    return (grams >> np.uint64(24)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def _long(grams: bytes) -> np.ndarray:
    out = np.zeros((len(grams) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(grams, np.uint8).reshape(-1, 5)
    return out.view("<u8").ravel()


def _fetch(words: int, bits: np.ndarray):
    schema = "set long, n int, doc_id long, grams binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bit = batch.column(2).to_numpy(zero_copy_only=False)
            wanted = (bits[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1
            rows = pa.array(np.flatnonzero(wanted))
            ids, out, size = batch.column(0).take(rows), [], 0
            for i, grams in shingle_sets(batch.column(1).take(rows), words):
                if len(grams):
                    out.append((set_id(grams), len(grams), ids[i].as_py(), _short(grams)))
                    size += 5 * len(grams)
                if size > 2 << 20:
                    yield _batch(schema, *zip(*out, strict=True))
                    out, size = [], 0
            if out:
                yield _batch(schema, *zip(*out, strict=True))

    return run, schema


_PAIRS = "a long, n int, b long, m int"


def _plausible(percent: int):
    """The pairs whose parities don't show that the sets differ too much."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = (batch.column(c).to_numpy().astype(np.int64) for c in ("n", "m"))
            apart = [parity_distance(x.as_buffer(), y.as_buffer()) for x, y in zip(batch.column("bits_a"), batch.column("bits_b"), strict=True)]
            near = pa.array(np.array(apart, np.int64) <= n + m - 2 * pair_overlap(n, m, percent))
            yield _batch(_PAIRS, *(batch.column(c).filter(near) for c in ("a", "n", "b", "m")))

    return run


_COMPARED = "a long, n int, b long, m int, overlap int"


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        both = []
        for x, y in zip(batch.column("grams_a"), batch.column("grams_b"), strict=True):
            all_ = np.concatenate([_long(v.as_buffer()) for v in (x, y)])
            all_.sort()
            both.append(int((all_[1:] == all_[:-1]).sum()))
        yield _batch(_COMPARED, *(batch.column(c) for c in ("a", "n", "b", "m")), both)


def _wanted(nodes: DataFrame, bits: int) -> np.ndarray:
    """A bit map of `bits` bits over hashed ids, to leave out most texts nobody asks for."""
    bit = F.pmod(F.xxhash64("rep"), F.lit(bits))
    words = (
        nodes.select((bit / 32).cast("int").alias("at"), F.expr(f"shiftleft(1L, cast(pmod(xxhash64(rep), {bits}) % 32 as int))").alias("bit"))
        .groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()
    )
    out = np.zeros(bits // 32, np.uint32)
    out[words["at"].to_numpy()] = words["bits"].to_numpy().astype(np.uint32)
    return out.view(np.uint8)


def _linked(both: Column, n: Column, m: Column, percent: int) -> Column:
    return both * 100 >= (n + m - both) * percent


def jaccard_components(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80,
    common: int = 200_000, often: int = 3, longest: int = 32, most_bits: int = 1 << 28,
) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of `docs`.

    Words are runs of bytes other than space and tab to carriage return, with A-Z in lower case. Two
    rows link when the Jaccard similarity of their sets of distinct n-grams of `words` words is at least
    `percent` / 100; component_id is the smallest id reachable by links. A text of fewer words is one
    n-gram; a null or blank text has none, and is linked with nothing. Rows with the same id are one
    node. A row with a null id takes the component of the rows with an equal set, if any, and links
    nothing by itself. An empty table gives an empty result; other columns don't matter.

    `common` bounds the n-grams whose counts are sent to every task (those of `often` sets or more among
    some thousands of a task, most frequent first), and `most_bits` the map of wanted ids; both shift work only. Lists
    of more than `longest` entries are compared through a leader. Results are exact, up to collisions
    of 64-bit hashes (40 bits within a compared pair).
    """
    spark, folder = docs.sparkSession, run_dir(docs.sparkSession, "jaccard")
    source = small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    described = written(source.mapInArrow(tidy(_describe(words, often)), _SETS), f"{folder}/sets")
    parities = described.where("kind = 0 and n > 0").select("set", "n", "doc_id", "parity")
    sets = described.where("kind = 0").drop("kind", "parity")
    classes = written(
        sets.where("n > 0").groupBy("set", "n").agg(F.min("doc_id").alias("rep")).where("rep is not null"),
        f"{folder}/classes",
    )
    top = (
        described.where("kind = 1").groupBy(F.col("set").alias("gram")).agg(F.sum("n").alias("count"))
        .orderBy(F.desc("count"), "gram").limit(common).toArrow()
    )
    grams = top["gram"].to_numpy().view(np.uint64)
    order = np.argsort(grams)
    grams, counts = grams[order], top["count"].to_numpy()[order]

    # A set without an id links nothing; leading a list, it would take the list's pairs with it.
    postings = source.where("doc_id is not null").mapInArrow(tidy(_post(words, percent, grams, counts, longest)), _POSTINGS)
    found = written(
        postings.repartition("gram", F.shiftright("place", 32)).sortWithinPartitions("gram", "n", "place", "set")
        .mapInArrow(tidy(_lists(percent, longest)), _FOUND),
        f"{folder}/found",
    )
    listed = found.where("kind = 1").select("gram", F.col("a").alias("set"), "n", "pos").distinct()
    in_long = written(listed.groupBy("set", "n").agg(F.count("*").alias("long")), f"{folder}/in-long")
    entries = written(listed.join(in_long, ["set", "n"]), f"{folder}/entries")
    pairs = _likely(found.where("kind = 0"), in_long, percent)
    # The leader of a list is in most long lists: of a text and its edited copies it is the text, as
    # what the copies have of their own fills up their places in the index.
    leaders = entries.groupBy("gram").agg(F.max(F.struct("long", "set", "n")).alias("leader"))
    led = entries.join(leaders, "gram").select(
        "gram", "set", "n", "pos", "long", F.col("leader.set").alias("la"), F.col("leader.n").alias("ln")
    )
    star = led.where((F.col("set") != F.col("la")) | (F.col("n") != F.col("ln"))).select(
        F.col("la").alias("a"), F.col("ln").alias("n"), F.col("set").alias("b"), F.col("n").alias("m")
    )

    def nodes_of(pairs: DataFrame, path: str) -> DataFrame:
        ends = pairs.select(F.col("a").alias("set"), "n").unionByName(pairs.select(F.col("b").alias("set"), F.col("m").alias("n")))
        return written(ends.distinct().join(classes, ["set", "n"]), path)

    def with_both(pairs: DataFrame, own: DataFrame, name: str) -> DataFrame:
        own = own.hint("merge")  # pairs may be few, but one plan for every size is easier to foresee
        a = own.select(F.col("set").alias("a"), "n", F.col(name).alias(f"{name}_a"))
        b = own.select(F.col("set").alias("b"), F.col("n").alias("m"), F.col(name).alias(f"{name}_b"))
        return pairs.join(b, ["b", "m"]).join(a, ["a", "n"])

    def compare(pairs: DataFrame, step: str) -> DataFrame:
        """The overlap of every pair."""
        nodes = nodes_of(pairs, f"{folder}/nodes-{step}")
        bits = min(most_bits, 1 << max(16, (64 * nodes.count()).bit_length()))
        fetch, schema = _fetch(words, _wanted(nodes, bits))
        marked = source.withColumn("bit", F.pmod(F.xxhash64("doc_id"), F.lit(bits)))
        # Copies of a set that the map lets through must not multiply its pairs.
        own = written(marked.mapInArrow(tidy(fetch), schema).drop("doc_id").dropDuplicates(["set", "n"]), f"{folder}/grams-{step}")
        return written(with_both(pairs, own, "grams").mapInArrow(tidy(_compare), _COMPARED), f"{folder}/compared-{step}")

    def plausible(pairs: DataFrame, step: str) -> DataFrame:
        pairs = written(pairs.distinct(), f"{folder}/pairs-{step}")
        nodes = nodes_of(pairs, f"{folder}/ends-{step}").withColumnRenamed("rep", "doc_id")
        own = parities.join(nodes, ["set", "n", "doc_id"], "left_semi").select("set", "n", F.col("parity").alias("bits"))
        own = own.dropDuplicates(["set", "n"])
        return written(with_both(pairs, own, "bits").mapInArrow(_plausible(percent), _PAIRS), f"{folder}/plausible-{step}")

    def named(compared: DataFrame) -> DataFrame:
        a = classes.select(F.col("set").alias("a"), "n", F.col("rep").alias("rep_a"))
        b = classes.select(F.col("set").alias("b"), F.col("n").alias("m"), F.col("rep").alias("rep_b"))
        linked = compared.where(_linked(F.col("overlap"), F.col("n"), F.col("m"), percent))
        return linked.join(a, ["a", "n"]).join(b, ["b", "m"]).select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b"))

    # Distances to leaders are needed in any case; other pairs only if they can link.
    compared = compare(plausible(pairs, "1").unionByName(written(star.distinct(), f"{folder}/star")).distinct(), "1")
    groups = components(spark, named(compared), f"{folder}/components-1")
    open_ = written(_open_pairs(led, compared, classes, groups, percent), f"{folder}/open")
    if not open_.isEmpty():
        more = compare(plausible(open_, "2"), "2")
        links = named(more).unionByName(groups.select(F.col("node").alias("a"), F.col("component").alias("b")))
        groups = components(spark, links, f"{folder}/components-2")

    ids = classes.join(groups, F.col("rep") == F.col("node"), "left").select(
        "set", "n", F.coalesce("component", "rep").alias("component_id")
    )
    return (
        sets.join(ids, ["set", "n"], "left")
        .select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
    )


def _need(n: str, m: str, percent: int) -> Column:
    """Pairs over the threshold share more than so many indexed n-grams.

    Of two sets, let x be the one whose indexed n-grams end first in the order. What they have in common
    up to there is indexed in both, and x has fewer than its least overlap behind. So the overlap of a pair
    over the threshold, less the larger least overlap, is below what is indexed in both.
    """
    least = lambda c: F.ceil(F.col(c) * percent / F.lit(100) - 1e-9)
    return F.ceil((F.col(n) + F.col(m)) * percent / F.lit(100 + percent) - 1e-9) - F.greatest(least(n), least(m))


def _likely(found: DataFrame, in_long: DataFrame, percent: int) -> DataFrame:
    """The pairs of the short lists that can share enough; in long lists as much as both sets are in.

    Besides, up to the last n-gram seen to be shared all that is shared was seen, so what the shorter
    rest of the two has to offer must make up for what lacks.
    """
    in_long = in_long.hint("merge")  # joined alike at every size
    shared = F.col("shared") + F.least(F.coalesce("long_a", F.lit(0)), F.coalesce("long_b", F.lit(0)))
    overlap = F.ceil((F.col("n") + F.col("m")) * percent / F.lit(100 + percent) - 1e-9)
    return (
        found.groupBy("a", "n", "b", "m").agg(F.sum("shared").alias("shared"), F.min("rest").alias("rest"))
        .join(in_long.select(F.col("set").alias("a"), "n", F.col("long").alias("long_a")), ["a", "n"], "left")
        .join(in_long.select(F.col("set").alias("b"), F.col("n").alias("m"), F.col("long").alias("long_b")), ["b", "m"], "left")
        .where((shared > _need("n", "m", percent)) & (shared + F.col("rest") >= overlap))
        .select("a", "n", "b", "m")
    )


def _open_pairs(led: DataFrame, compared: DataFrame, classes: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """Pairs of long lists that neither a leader nor a common component has settled.

    A pair that shares an n-gram of a short list as well was judged there. Of the others, both must be in
    enough long lists, and share enough of them; their distances to a leader of both must be near.
    """
    near = compared.select(
        F.col("a").alias("la"), F.col("n").alias("ln"), F.col("b").alias("set"), F.col("m").alias("n"),
        (1 - F.col("overlap") / (F.col("n") + F.col("m") - F.col("overlap"))).alias("away"),
    )
    group = classes.join(groups, F.col("rep") == F.col("node"), "left").select("set", "n", F.coalesce("component", "rep").alias("group"))
    listed = (
        led.join(near, ["la", "ln", "set", "n"])  # the leader itself has been compared with all
        .join(group, ["set", "n"]).drop("la", "ln")
    )
    several = listed.groupBy("gram").agg(F.min("group").alias("low"), F.max("group").alias("high")).where("low < high").select("gram")
    listed = listed.join(several, "gram", "left_semi")
    x, y = (listed.select("gram", *(F.col(c).alias(f"{c}_{s}") for c in ("set", "n", "pos", "long", "away", "group"))) for s in "xy")
    limit = (100 - percent) / 100 + 1e-9
    overlap = F.ceil((F.col("n_x") + F.col("n_y")) * percent / F.lit(100 + percent) - 1e-9)
    reach = F.least("pos_x", "pos_y") + F.least(F.col("n_x") - F.col("pos_x"), F.col("n_y") - F.col("pos_y"))
    need = _need("n_x", "n_y", percent)
    return (
        x.join(y, "gram")
        .where((F.col("group_x") < F.col("group_y")) & (F.abs(F.col("away_x") - F.col("away_y")) <= limit)
               & (F.col("n_x") * percent <= F.col("n_y") * 100) & (F.col("n_y") * percent <= F.col("n_x") * 100)
               & (reach >= overlap) & (F.least("long_x", "long_y") > need))
        .groupBy("set_x", "n_x", "set_y", "n_y").agg(F.count("*").alias("shared")).where(F.col("shared") > need)
        .select(F.col("set_x").alias("a"), F.col("n_x").alias("n"), F.col("set_y").alias("b"), F.col("n_y").alias("m"))
    )
