"""Helpers the operators share."""

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: white space of the contracts: tab, line feed, vertical tab, form feed, carriage return, space
SPACE = "[ \\t-\\r]"
NOT_SPACE = "[^ \\t-\\r]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``. Where nothing names one, as in a local test, one is made."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="llm-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """A checkpoint in the shared folder; runs the plan once, and a lost executor loses none of it."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def words(text: Column) -> Column:
    """Array of runs of anything but white space; null has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), f"{SPACE}+"), lambda w: w != "")


def crc_mod(doc_id: Column, n: int) -> Column:
    """Remainder of the CRC-32 of the id as text; null where the id is null."""
    return F.crc32(doc_id.cast("string").cast("binary")) % n


def broadcast_if_small(df: DataFrame, rows: int, most: int) -> DataFrame:
    """Broadcast ``df``, whose rows were counted as ``rows``, up to ``most``; else leave the join to Spark."""
    return F.broadcast(df) if rows <= most else df
