"""Folders that count once they are marked complete: batches as they come, and merges of them beside.

Nothing is renamed and nothing that readers may have listed is taken away at once, so this holds on object stores too.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from airlens.operators.clean import first_per_key
from airlens.shared import discard, hadoop

#: an empty file that makes a folder count
MARKER = "_complete"


def write_complete(df: DataFrame, folder: str) -> None:
    df.write.mode("overwrite").parquet(folder)
    marker, files = hadoop(df.sparkSession, f"{folder}/{MARKER}")
    files.create(marker, True).close()


def complete(spark: SparkSession, path: str, name: str) -> list[int]:
    """Numbers of the complete ``name=`` folders, in order; only folders are listed."""
    pattern, files = hadoop(spark, f"{path}/{name}=*/{MARKER}")
    return sorted(int(found.getPath().getParent().getName().removeprefix(f"{name}=")) for found in files.globStatus(pattern) or [])


def merged_upto(spark: SparkSession, path: str) -> int:
    return max(complete(spark, f"{path}__merged", "upto"), default=-1)


def batches(spark: SparkSession, path: str, after: int, last: int | None = None) -> DataFrame | None:
    """Rows of complete batches with their ``batch_id``."""
    found = [n for n in complete(spark, path, "batch_id") if n > after and (last is None or n <= last)]
    if not found:
        return None
    rows = spark.read.option("basePath", path).parquet(*[f"{path}/batch_id={n}" for n in found])
    return rows.withColumn("batch_id", F.col("batch_id").cast("long"))


def merge(spark: SparkSession, path: str, last: int, keys: Sequence[str]) -> None:
    """Batches up to ``last`` that no merge holds yet as one folder ``upto=`` beside ``path``; with ``keys`` the newest rows of
    the version before and of these batches.

    Readers go by the newest complete folder, so one that broke off is written again and loses or doubles nothing. What it
    replaces stays until the next merge, for readers who have listed it.
    """
    merged = f"{path}__merged"
    before = merged_upto(spark, path)
    if before >= last:
        return
    rows = batches(spark, path, before, last)
    if keys and before >= 0:
        rows = rows.unionByName(spark.read.parquet(f"{merged}/upto={before}"))
    if keys:
        rows = first_per_key(rows, keys, [F.desc("batch_id")])
    write_complete(rows.hint("rebalance"), f"{merged}/upto={last}")
    for batch_id in complete(spark, path, "batch_id"):
        if batch_id <= before:
            discard(spark, f"{path}/batch_id={batch_id}")
    if keys:
        for version in complete(spark, merged, "upto"):
            if version < before:
                discard(spark, f"{merged}/upto={version}")
