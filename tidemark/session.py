"""Session settings and the folder shared by all executors."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from contextlib import suppress
from functools import cache

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Windows are aligned to UTC, hours and dates to the session zone; one zone keeps them in step.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where the split costs another shuffle later in the plan.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Counting state rows costs a lookup per write; without it numRowsTotal is reported as 0.
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators expect; `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
        if master.startswith("local") and "spark__checkpoint__dir" not in conf:
            builder = builder.config("spark.checkpoint.dir", _local_scratch())
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session.

    The number of shuffle partitions is left to the caller: it also fixes the number of state
    partitions of a new stream, and adaptive execution merges what is too small.
    """
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.conf.get("spark.master", "").startswith("local")


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: `spark.checkpoint.dir`. Only a local session that was built
    elsewhere and leaves it unset gets a scratch folder."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not _is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_scratch()


@cache
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="tidemark-")


def _store(spark: SparkSession, folder: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, folder: str) -> bool:
    store, path = _store(spark, folder)
    return store.exists(path)


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder or file of this library's own making, wherever it is stored."""
    store, path = _store(spark, folder)
    store.delete(path, True)


def rename(spark: SparkSession, folder: str, to: str) -> bool:
    """Move a folder; False if there is none. Raises if it is there and can't be moved, as when `to` exists."""
    store, path = _store(spark, folder)
    if not store.exists(path):
        return False
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(to)
    if store.exists(target) or not store.rename(path, target):
        raise OSError(f"{folder} could not be moved to {to}")
    return True


def _listed(spark: SparkSession, folder: str):
    store, path = _store(spark, folder)
    return store.listStatus(path) if store.exists(path) else []


def folders(spark: SparkSession, folder: str) -> list[str]:
    """Names of the folders directly below one, from a listing alone; none if it doesn't exist."""
    return sorted(f.getPath().getName() for f in _listed(spark, folder) if f.isDirectory())


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files directly below a folder."""
    return sorted(f.getPath().getName() for f in _listed(spark, folder) if f.isFile())


def write_text(spark: SparkSession, file: str, text: str) -> None:
    """A small file that is there whole or not at all; raises if it already is."""
    store, path = _store(spark, f"{file}.{uuid.uuid4().hex}.part")
    out = store.create(path)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    rename(spark, path.toString(), file)


def read_text(spark: SparkSession, file: str) -> str:
    store, path = _store(spark, file)
    source = store.open(path)
    try:
        return bytes(source.readAllBytes()).decode()
    finally:
        source.close()


_made: dict[str, object] = {}


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for one run below the shared folder. Results may read from it until the driver
    ends; then it is deleted, unless the JVM is gone before."""
    if not _made:
        atexit.register(_clean)
    folder = f"{shared_dir(spark)}/tidemark/{name}-{uuid.uuid4().hex}"
    _made[folder] = spark.sparkContext._jsc.hadoopConfiguration()
    return folder


def _clean() -> None:
    from pyspark import SparkContext

    with suppress(Exception):  # at exit nothing can be done about a store that is out of reach
        for folder, conf in _made.items():
            path = SparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)
