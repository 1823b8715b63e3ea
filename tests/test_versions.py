"""Versioned tables: what a reader sees when the job that writes them ends anywhere."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tidemark import session
from tidemark.operators import changes
from tidemark.streaming import jobs, latest, versions

KEYS, ORDER = ["k"], ["t"]
SCHEMA = "k int, t int, v string"


class Stopped(Exception):
    pass


def steps(monkeypatch, targets, at):
    """Let the call number `at` of the functions fail, before it does anything or (odd halves) after it."""
    seen = [0]

    def wrap(f):
        def run(*args, **kwargs):
            seen[0] += 1
            if seen[0] == at:
                raise Stopped
            result = f(*args, **kwargs)
            if seen[0] == at - 0.5:
                raise Stopped
            return result
        return run

    for module, name in targets:
        monkeypatch.setattr(module, name, wrap(getattr(module, name)))
    return seen


def put(spark, path, batch, rows):
    spark.createDataFrame(rows, SCHEMA).write.mode("overwrite").parquet(jobs.batch_folder(path, batch))


def shown(spark, out):
    return {(r.k, r.t, r.v) for r in versions.read(spark, out, versions.version(spark, out)).collect()}


def merge(spark, folder, **kwargs):
    return latest.merge_batches(spark, f"{folder}/in", f"{folder}/out", KEYS, ORDER, KEYS, buckets=4, **kwargs)


@pytest.mark.parametrize("at", [n / 2 for n in range(1, 13)])
def test_a_merge_that_ends_anywhere_shows_the_old_or_the_new_rows(spark, folder, monkeypatch, at):
    put(spark, f"{folder}/in", 0, [(k, 1, "a") for k in range(8)])
    merge(spark, folder)
    old = shown(spark, f"{folder}/out")
    put(spark, f"{folder}/in", 1, [(1, 2, "b"), (9, 1, "c")])
    new = (old - {(1, 1, "a")}) | {(1, 2, "b"), (9, 1, "c")}
    with monkeypatch.context() as patch:
        steps(patch, [(versions, "write_text"), (versions, "remove"), (latest, "remove"), (versions, "change_feed")], at)
        try:
            merge(spark, folder)
        except Stopped:
            assert shown(spark, f"{folder}/out") in (old, new)
    merge(spark, folder)
    assert shown(spark, f"{folder}/out") == new
    fed = versions.changes_between(spark, f"{folder}/out", KEYS, 1, place=ORDER).collect()
    assert sorted((r.change_type, r.k, r.t) for r in fed) == [("insert", 9, 1), ("update_post", 1, 2), ("update_pre", 1, 1)]


def test_a_reader_keeps_its_version_while_the_next_one_comes(spark, folder):
    put(spark, f"{folder}/in", 0, [(k, 1, "a") for k in range(8)])
    merge(spark, folder)
    before = versions.read(spark, f"{folder}/out", versions.version(spark, f"{folder}/out"))
    put(spark, f"{folder}/in", 1, [(k, 2, "b") for k in range(8)])
    merge(spark, folder)
    assert {r.v for r in before.collect()} == {"a"} and len(shown(spark, f"{folder}/out")) == 8
    assert versions.version(spark, f"{folder}/out", 7) is None


def test_two_writers_of_one_version_cannot_both_win(spark, folder):
    rows = spark.createDataFrame([(1, 0)], "k int, bucket int")
    versions.commit(rows, folder, None, 4, [0])
    with pytest.raises(OSError):
        versions.commit(rows, folder, None, 4, [0])


def test_only_touched_buckets_are_listed_and_read(spark, folder):
    rows = spark.range(100).select(F.col("id").cast("int").alias("k"), versions.bucket_of(["id"], 4).alias("bucket"))
    first = versions.commit(rows, folder, None, 4, range(4))
    second = versions.commit(rows.where("bucket = 2 AND k > 50"), folder, first, 4, [2], keys=["k"])
    third = versions.commit(rows.where("false"), folder, second, 4, [3], keys=["k"])
    assert second.files == {0: 1, 1: 1, 2: 2, 3: 1} and third.files == {0: 1, 1: 1, 2: 2}
    read = versions.read(spark, folder, third, [1, 2])
    assert sorted({f.split("data/")[1].rsplit("/", 1)[0] for f in read.inputFiles()}) == ["version=1/bucket=1", "version=2/bucket=2"]
    gone = {r.k for r in rows.where("bucket = 3 OR bucket = 2 AND k <= 50").collect()}
    net = versions.changes_between(spark, folder, ["k"], 1)
    assert {(r.change_type, r.k) for r in net.collect()} == {("delete", k) for k in gone}
    assert net.inputFiles() and all("/changes/change_version=" in f for f in net.inputFiles())
    with pytest.raises(ValueError, match="aren't all there"):
        versions.read_changes(spark, folder, 0)
    versions.vacuum(spark, folder, keep=1, keep_changes=1)
    assert versions.numbers(spark, folder) == [3] and versions.read(spark, folder, third).count() == 100 - len(gone)
    assert session.folders(spark, f"{folder}/data/version=1") == ["bucket=0", "bucket=1"]
    assert versions.read_changes(spark, folder, 3).count() == 0


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_net_changes_equal_the_full_join_of_the_ends(spark, folder, seed):
    rnd = random.Random(seed)
    states, base = [], None
    for number in range(4):
        state = {k: rnd.choice("xyz") for k in range(30) if rnd.random() < 0.7} | {None: "n"}
        rows = spark.createDataFrame([(k, v, number) for k, v in state.items()], "k int, v string, t int")
        touched = range(4)
        base = versions.commit(
            rows.withColumn("bucket", versions.bucket_of(["k"], 4)), folder, base, 4, touched, keys=["k"], compare=["v"], place=["v"])
        states.append(rows.drop("t"))
    for a, b in ((0, 3), (1, 2), (0, 2), (2, 2)):
        got = changes.net_changes(versions.read_changes(spark, folder, a + 1, b + 1), ["k"], versions.VERSION, ["v"], ["v"])
        want = changes.change_feed(states[a], states[b], ["k"], place=["v"])
        assert sorted(got.select("change_type", "k", "v").collect(), key=str) == sorted(want.collect(), key=str)


@pytest.mark.parametrize("at", range(1, 8))
def test_a_compaction_that_ends_anywhere_is_finished_by_the_next(spark, folder, monkeypatch, at):
    path = f"{folder}/table"
    for batch in range(4):
        put(spark, path, batch, [(batch, 0, "a"), (batch, 1, "b")])
    with monkeypatch.context() as patch:
        steps(patch, [(jobs, "remove"), (jobs, "rename"), (jobs, "exists")], at)
        try:
            jobs.compact(spark, path, keep=1)
        except Stopped:
            pass
    assert jobs.compact(spark, path, keep=1) == 2
    assert spark.read.parquet(path).count() == 8 and jobs.batch_ids(spark, path) == [2, 3]


def test_a_merged_folder_that_is_not_whole_is_written_again(spark, folder):
    path = f"{folder}/table"
    for batch in range(3):
        put(spark, path, batch, [(batch, 0, "a")])
    put(spark, f"{path}/_merged-1", 9, [(7, 7, "half")])
    assert jobs.compact(spark, path, keep=1) == 2 and spark.read.parquet(path).count() == 3


@pytest.mark.parametrize("at", range(1, 14))
@pytest.mark.parametrize("fails", [False, True])
def test_a_full_refresh_that_is_killed_anywhere_loses_no_table(spark, folder, monkeypatch, at, fails):
    table, other = f"{folder}/table", f"{folder}/other"
    for path in (table, other):
        put(spark, path, 0, [(1, 0, "whole")])

    def run():
        put(spark, table, 0, [(2, 0, "new")])
        if fails:
            raise ValueError
        put(spark, other, 0, [(2, 0, "new")])
        return "ran"

    with monkeypatch.context() as patch:
        steps(patch, [(jobs, "remove"), (jobs, "rename"), (jobs, "exists"), (jobs, "write_text")], at)
        patch.setattr(jobs, "_put_back", lambda *a: None)  # a killed driver doesn't clean up
        try:
            jobs.refresh(spark, run, [table, other], "full")
        except (Stopped, ValueError, OSError):
            pass
    found = []
    jobs.refresh(spark, lambda: found.append([spark.read.parquet(p).first().v for p in (table, other)]), [table, other])
    assert found[0] in (["whole", "whole"], ["new", "new"])
    assert not [n for n in session.folders(spark, folder) if n.endswith(".before")]


def test_a_move_onto_something_is_refused(spark, folder):
    for name in "ab":
        put(spark, f"{folder}/{name}", 0, [(1, 0, name)])
    with pytest.raises(OSError):
        session.rename(spark, f"{folder}/a", f"{folder}/b")
    assert session.rename(spark, f"{folder}/c", f"{folder}/d") is False
