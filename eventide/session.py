"""Session helpers: a local session for tests/bench and a lineage cutter.

On a cluster the session is supplied by the platform; nothing here
overrides settings that are already present.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Settings applied only when the caller has not set them already.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cpus: int | str = 8, shuffle_partitions: int = 8,
                  app: str = "eventide") -> SparkSession:
    """Local session for tests and the benchmark (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state."
                "RocksDBStateStoreProvider")
    )
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint dir; create a scratch one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is
    used as is.  Only in local runs (tests, bench) do we set one: a folder of
    this machine is of no use to executors on others, so a cluster without the
    setting is an error.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        d = tempfile.mkdtemp(prefix="eventide-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", d)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


_SCRATCH: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the checkpoint dir, which the ``scratch_space`` around the call deletes, if there is one."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    mine = _SCRATCH.get()
    if mine is not None:
        mine.append(path)
    return path


@contextmanager
def scratch_space(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end what the operators called in it wrote into the checkpoint dir.

    Frames are lazy, so write or collect the result inside::

        with scratch_space(spark):
            merge_intervals(df, "k", "start", "end").write.parquet(out)

    Spaces may be nested; each deletes its own.  Files of ``cut_lineage`` are Spark's checkpoints, which Spark deletes
    itself with ``spark.cleaner.referenceTracking.cleanCheckpoints``.
    """
    mine: list[str] = []
    token = _SCRATCH.set(mine)
    try:
        yield
    finally:
        _SCRATCH.reset(token)
        for path in mine:
            _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)


TASK_ROWS = 500_000  # of a shuffle's partition, about
_TASK_BYTES = {"spark.sql.files.maxPartitionBytes": 16 << 20, "spark.sql.adaptive.advisoryPartitionSizeInBytes": 8 << 20}
_PARTITIONS = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.initialPartitionNum")


@contextmanager
def bounded_tasks(spark: SparkSession) -> Iterator[Callable[[int], None]]:
    """What a task reads inside doesn't grow with the input: there are more tasks instead.

    Adaptive execution merges partitions up to a size meant for rows that are streamed through; rows of two
    numbers, sorted and hashed several times in a task, take many times as much.  Yields a function that
    takes a number of rows to be shuffled from then on.  Settings that are smaller already stay, and all
    come back at the end, so a frame must be staged inside.
    """
    conf = spark.conf
    old = {k: conf.get(k, None) for k in (*_TASK_BYTES, *_PARTITIONS)}
    parts = {k: int(old[k] or conf.get(k)) for k in _PARTITIONS if old[k] or not k.endswith("initialPartitionNum")}

    def rows(n: int) -> None:
        for k, least in parts.items():
            conf.set(k, max(least, -(-n // TASK_ROWS)))

    try:
        for k, most in _TASK_BYTES.items():
            conf.set(k, min(most, spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(conf.get(k))))
        rows(200 * TASK_ROWS)  # until it is known
        yield rows
    finally:
        for k, v in old.items():
            conf.unset(k) if v is None else conf.set(k, v)


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Each execution inside deletes its shuffle files at its end.

    They stay otherwise until the driver's garbage is collected, so those of all jobs of a query can lie on disk at once.
    """
    conf, name = spark.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    old = conf.get(name, None)
    conf.set(name, "true")
    try:
        yield
    finally:
        conf.unset(name) if old is None else conf.set(name, old)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint dir (survives executor loss).

    The input is persisted first so that writing the checkpoint does not
    recompute it (an eager checkpoint otherwise runs the plan twice); the
    cache is dropped once the checkpoint files exist.
    """
    ensure_checkpoint_dir(df.sparkSession)
    cached = df.persist()
    try:
        return cached.checkpoint(eager=True)
    finally:
        cached.unpersist()


def staged(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet into the checkpoint dir and read it back.

    Cuts the lineage with a single run of the plan, and later reads take only
    the columns they need.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "staged")
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_path = path
    return out


def drop_staged(df: DataFrame) -> None:
    """Delete the files behind a frame that ``staged`` returned."""
    path = getattr(df, "_staged_path", None)
    if path:
        _delete(df.sparkSession, path)
