"""Stream writers. ``trigger`` is what ``writeStream.trigger`` takes, e.g. ``{"availableNow": True}``."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from airlens.operators.clean import first_per_key
from airlens.shared import discard
from airlens.sinks.versions import batches, complete, merge, merged_upto, write_complete

EVERY_10_SECONDS = {"processingTime": "10 seconds"}


def _start(writer, trigger, checkpoint=None, name=None) -> StreamingQuery:
    writer = writer.trigger(**(trigger or EVERY_10_SECONDS))
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return writer.start()


def to_console(df: DataFrame, rows: int = 20, truncate: bool = False, trigger: dict | None = None,
               name: str | None = None) -> StreamingQuery:
    """Preview of each micro-batch."""
    writer = df.writeStream.format("console").outputMode("append")
    return _start(writer.option("numRows", rows).option("truncate", truncate), trigger, name=name)


def to_memory(df: DataFrame, name: str, mode: str = "append", trigger: dict | None = None) -> StreamingQuery:
    """In-memory table on the driver: for tests and small results."""
    return _start(df.writeStream.format("memory").outputMode(mode), trigger, name=name)


def to_json(df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    return _start(df.writeStream.format("json").option("path", path), trigger, checkpoint)


def to_parquet(df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    writer = df.writeStream.format("parquet").option("path", path).outputMode("append")
    return _start(writer, trigger, checkpoint)


def to_raw_csv(df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
               day: Column | None = None) -> StreamingQuery:
    """Raw CSV per micro-batch at ``ingest_dt=/batch_id=``.

    A repeated batch replaces its own folder. ``day`` (a date column, such as the message's
    timestamp) keeps a repeat after midnight in the same folder; without it the clock decides.
    """
    stamp = F.date_format(day if day is not None else F.current_date(), "yyyyMMdd")

    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumns({"ingest_dt": stamp, "batch_id": F.lit(batch_id)})
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .option("header", True).partitionBy("ingest_dt", "batch_id").csv(path))

    return _start(df.writeStream.foreachBatch(write), trigger, checkpoint)


def to_snapshot(df: DataFrame, path: str, checkpoint: str, mode: str = "append",
                trigger: dict | None = None, keep: int = 3, merge_every: int = 100, keys: Sequence[str] = ()) -> StreamingQuery:
    """Parquet per micro-batch at ``batch_id=``; :func:`read_snapshot` gives the current result.

    ``append`` writes closed windows only and ``update`` changed rows only: their state is bounded by the watermark, and
    every ``merge_every`` batches become one folder, so files do not pile up; with ``keys`` (of ``update``) that folder is a version
    of the whole result, one row per key. ``complete`` rewrites the whole result each
    time and leaves the last ``keep`` of them: for results of bounded size.

    A folder counts once its marker is there, which is written last. A batch that is repeated after a crash is left as it
    is stored, and so is a merge, so ``path`` and ``checkpoint`` belong together: start a new path with a new checkpoint.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if batch_id > merged_upto(spark, path) and batch_id not in complete(spark, path, "batch_id"):
            write_complete(batch, f"{path}/batch_id={batch_id}")
        else:                               # stored already; it runs for the query's state alone
            batch.write.format("noop").mode("overwrite").save()
        if mode == "complete" and batch_id >= keep:
            discard(spark, f"{path}/batch_id={batch_id - keep}")
        elif mode != "complete" and (batch_id + 1) % merge_every == 0:
            merge(spark, path, batch_id, keys if mode == "update" else ())

    return _start(df.writeStream.outputMode(mode).foreachBatch(write), trigger, checkpoint)


def read_snapshot(spark: SparkSession, path: str, mode: str = "append",
                  keys: Sequence[str] = ()) -> DataFrame:
    """Current result of :func:`to_snapshot`: all batches, newest row per key (``update``), or last batch (``complete``)."""
    if mode == "complete":
        newest = max(complete(spark, path, "batch_id"), default=None)
        return spark.read.parquet(path if newest is None else f"{path}/batch_id={newest}")
    versions = complete(spark, f"{path}__merged", "upto")
    rows = batches(spark, path, max(versions, default=-1))
    if versions:
        merged = spark.read.parquet(*[f"{path}__merged/upto={n}" for n in versions])
        rows = merged if rows is None else rows.unionByName(merged)
    if rows is None:
        return spark.read.parquet(path)     # says that there is nothing
    if mode == "update":
        rows = first_per_key(rows, keys, [F.desc("batch_id")])
    return rows.drop("batch_id")
