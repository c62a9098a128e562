"""Running streaming queries to completion and reading their results.

Sinks are files under a shared folder (the session's checkpoint dir by
default), never the driver: append-mode results go to a parquet sink;
update-mode changes are appended per micro-batch with the batch id and
read back as the latest row per key.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..session import scratch_path


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint dir."""
    return scratch_path(spark, f"stream/{name}")


FILE_ROWS = 100_000  # of a staged file, about


def stage_by_time(df: DataFrame, ts: str, root: str, slices: int = 5) -> int:
    """Write ``df`` as time-ordered slices (one write job each, so file
    modification times follow event time) for a file stream source to
    replay in order.  A slice has as many files as its share of the input's partitions, or of its
    rows if these make more (two at least; a file of few bytes can hold many rows,
    and a micro-batch has no more tasks than files).  Returns the files-per-trigger to use."""
    files_per_slice = max(2, -(-df.rdd.getNumPartitions() // slices))
    b = df.agg(F.min(ts).alias("lo"), F.max(ts).alias("hi")).first()
    if b["lo"] is None:
        df.limit(0).write.mode("overwrite").parquet(f"{root}/slice=0")
        return files_per_slice
    lo = F.lit(b["lo"]).cast("timestamp")
    span = (F.unix_micros(F.lit(b["hi"]).cast("timestamp")) - F.unix_micros(lo) + 1)
    idx = F.floor((F.unix_micros(F.col(ts).cast("timestamp")) - F.unix_micros(lo)) * slices / span)
    tagged = df.withColumn("_slice", idx.cast("int"))
    n = [r["count"] for r in tagged.filter("_slice IS NOT NULL").groupBy("_slice").count().collect()]  # one per slice
    # no file of a slice may stay empty: a micro-batch would take files of the next
    files_per_slice = max(files_per_slice, min(-(-sum(n) // (slices * FILE_ROWS)), min(n) // 100))
    for i in range(slices):
        (tagged.filter(F.col("_slice") == i).drop("_slice").repartition(files_per_slice)
               .write.mode("overwrite").parquet(f"{root}/slice={i}"))
    return files_per_slice


SLICE_ROWS = 10 * FILE_ROWS  # of a slice that ``replay`` has on disk, about


def replay(df: DataFrame, ts: str, root: str, start: Callable[[int], StreamingQuery], records: Callable[[DataFrame], DataFrame],
           rows: int, slices: int = 5) -> None:
    """Run ``records`` of ``df``, in the order of its times, through a stream over the files below ``root``.

    Slice after slice of about ``rows`` rows (``slices`` at least, of equal numbers of rows) is worked out, written, run through
    the query that ``start`` starts and deleted, so one slice is on disk at a time, however many rows there are.  ``start``
    is given the slice's number of files; its query takes what is available and goes on from its checkpoint.  As in
    ``stage_by_time``, rows without a time are in no slice.
    """
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    df = df.filter(us.isNotNull())
    n = df.count()
    k = max(slices, -(-n // rows))
    cuts = df.agg(F.percentile_approx(us, [i / k for i in range(1, k + 1)], max(10_000, 100 * k)).alias("at")).first()["at"]
    cuts = sorted(set(cuts or [0]))  # times of rows, so no slice is empty; rows of one time stay together
    files = max(2, -(-n // (len(cuts) * FILE_ROWS)))
    for i in range(len(cuts)):
        part = df.filter(us > cuts[i - 1]) if i else df
        if i < len(cuts) - 1:
            part = part.filter(us <= cuts[i])
        records(part.repartition(files)).write.mode("overwrite").parquet(f"{root}/slice={i}")
        q = start(files)
        q.awaitTermination()
        if q.exception():
            raise q.exception()
        delete(df.sparkSession, f"{root}/slice={i}")


def file_stream(spark: SparkSession, root: str, schema, files_per_trigger: int) -> DataFrame:
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
                 .option("recursiveFileLookup", "true").parquet(root))


def run_append(sdf: DataFrame, name: str) -> DataFrame:
    """Append-mode query to a checkpointed parquet sink; returns the sink as a batch DataFrame."""
    spark = sdf.sparkSession
    out = scratch(spark, name)
    q = (sdf.writeStream.format("parquet").option("path", f"{out}/data")
            .option("checkpointLocation", f"{out}/_ckpt").outputMode("append")
            .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return spark.read.schema(sdf.schema).parquet(f"{out}/data")


def run_update(sdf: DataFrame, name: str, keys: Sequence[str]) -> DataFrame:
    """Update-mode query: each batch's changed rows are appended with the
    batch id; the result is the latest version of every key."""
    spark = sdf.sparkSession
    out = scratch(spark, name)

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("_batch", F.lit(batch_id)).write.mode("append").parquet(f"{out}/data")

    q = (sdf.writeStream.foreachBatch(sink).option("checkpointLocation", f"{out}/_ckpt")
            .outputMode("update").trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    schema = T.StructType([*sdf.schema.fields, T.StructField("_batch", T.LongType())])
    data = spark.read.schema(schema).parquet(f"{out}/data")
    cols = [c for c in sdf.columns if c not in keys]
    # column by column: a buffer of plain values is hashed, that of a struct would have all rows sorted
    return data.groupBy(*keys).agg(*[F.max_by(c, "_batch").alias(c) for c in cols]).select(*keys, *cols)


def newest_sink(out: str, order: Sequence[str], n: int, metrics: Callable[[DataFrame], DataFrame]):
    """A ``foreachBatch`` function that keeps the newest ``n`` rows and writes metrics over them.

    Batch i is folded into the rows kept after batch i - 1 and written to folders of its own (newest=i,
    metrics=i), so a replayed batch overwrites what it wrote before and counts once, and the work of a batch
    doesn't grow with the history.  Folders two batches old are deleted.
    """
    from ..operators.dashboard import recent_n

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch
        if batch_id:
            rows = rows.unionByName(spark.read.schema(batch.schema).parquet(f"{out}/newest={batch_id - 1}"))
        recent_n(rows, order, n).write.mode("overwrite").parquet(f"{out}/newest={batch_id}")
        kept = spark.read.schema(batch.schema).parquet(f"{out}/newest={batch_id}")
        metrics(kept).write.mode("overwrite").parquet(f"{out}/metrics={batch_id}")
        if batch_id > 1:  # batch_id - 1 stays: a replay of this batch reads it
            for kind in ("newest", "metrics"):
                delete(spark, f"{out}/{kind}={batch_id - 2}")

    return sink


def delete(spark: SparkSession, path: str) -> None:
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)


def latest_metrics(spark: SparkSession, out: str) -> DataFrame:
    """The metrics that the last batch wrote."""
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(out)
    names = [f.getPath().getName() for f in p.getFileSystem(sc._jsc.hadoopConfiguration()).listStatus(p)]
    last = max(int(name.split("=")[1]) for name in names if name.startswith("metrics="))
    return spark.read.parquet(f"{out}/metrics={last}")


def run_newest(sdf: DataFrame, name: str, order: Sequence[str], n: int, metrics: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Run a stream into ``newest_sink``; the metrics after its last batch."""
    out = scratch(sdf.sparkSession, name)
    q = (sdf.writeStream.foreachBatch(newest_sink(f"{out}/data", order, n, metrics)).option("checkpointLocation", f"{out}/_ckpt")
            .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return latest_metrics(sdf.sparkSession, f"{out}/data")
