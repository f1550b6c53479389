"""Shared scratch space of the session, used to cut long lineages."""

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

#: rows of a compressed JSON file
FILE_ROWS = 100_000


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``. Where nothing names one, as in a test on a local master, one is made."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="airlens-"))
        folder = context.getCheckpointDir()
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no earlier run has used."""
    return f"{shared_dir(spark).rstrip('/')}/airlens/{name}-{uuid.uuid4().hex}"


def materialized(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as parquet and read it back: a cut that later steps scan column by column.

    Unlike a checkpoint, the table has a known size, so joins with a small one are planned as
    broadcasts from the start instead of after the large side has been shuffled.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_json(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Write ``df`` as compressed JSON lines, in files of at most :data:`FILE_ROWS` rows.

    Names repeat in every JSON line, so gzip leaves about a tenth. A compressed file is read by one task, whatever its
    size: hence the rows per file, which need no shuffle.
    """
    (df.write.mode("overwrite").option("compression", "gzip").option("maxRecordsPerFile", FILE_ROWS)
     .partitionBy(*partition_by).json(path))


def hadoop(spark: SparkSession, path: str):
    """A path and its file system, whatever storage it names."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder this library wrote for passing use."""
    folder, files = hadoop(spark, path)
    files.delete(folder, True)
