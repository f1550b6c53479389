"""File sources. Every read states its schema."""

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F
from pyspark.sql.types import StructType

from airlens import config as C, schema as S


def read_csv(spark: SparkSession, path, schema: StructType = S.BATCH, **options) -> DataFrame:
    """CSV with a header. A line that does not fit keeps its text in the corrupt column."""
    return (spark.read.schema(schema)
            .options(header=True, mode="PERMISSIVE", columnNameOfCorruptRecord=C.CORRUPT, **options)
            .csv(path))


def read_jsonl(spark: SparkSession, path, schema: StructType = S.BATCH, **options) -> DataFrame:
    """One JSON object per line. A line that does not fit keeps its text in the corrupt column."""
    return (spark.read.schema(schema)
            .options(mode="PERMISSIVE", columnNameOfCorruptRecord=C.CORRUPT, **options)
            .json(path))


def read_lines(spark: SparkSession, path, header: bool = False) -> DataFrame:
    """Text lines in column ``value``; with ``header``, without the first line of each file, whatever it holds.

    Blank lines are kept only without ``header``.
    """
    if not header:
        return spark.read.text(path)
    # a separator and a quote that no text file holds: each line is one cell
    return (spark.read.schema("value string")
            .options(header=True, enforceSchema=True, sep="\u0001", quote="\u0002", escape="\u0002", nullValue="\u0001",
                     ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, maxCharsPerColumn=-1)
            .csv(path))


def _ends_open(line: Column, delimiter: str, inside: bool) -> Column:
    """Whether a line ends within a quoted cell, if it begins ``inside`` one or at a cell's start.

    Cells that are whole are taken away; what is left is a cell whose quote does not close.
    """
    d = re.escape(delimiter)
    quoted = '[^"]*+(?:""[^"]*+)*+"[^%s]*+' % d
    whole = lambda text: F.regexp_replace(text, f'{d}(?:"{quoted}|[^"{d}][^{d}]*+|(?={d}|\\z))', "") == ""
    quotes = F.contains(line, F.lit('"'))       # a line without any leaves things as they are
    if not inside:
        return F.when(quotes, ~whole(F.concat(F.lit(delimiter), line))).otherwise(False)
    closes = f"^{quoted}"
    return F.when(quotes & line.rlike(closes), ~whole(F.regexp_replace(line, closes, ""))).otherwise(True)


def _state(fixed: str, flips: Column, start: Column) -> Column:
    """Open or not: the last fixed state, or else the start, turned over by the flips since."""
    since = F.when(F.col(fixed).isNotNull(), flips - F.col(f"{fixed}.flips")).otherwise(flips)
    return F.coalesce(F.col(f"{fixed}.open"), start) != (since % 2 == 1)


def read_records(spark: SparkSession, path, delimiter: str = ",", header: bool = False, most_lines: int = 100_000) -> DataFrame:
    """Records of delimited text in column ``value``; one whose quoted cells hold line breaks has several lines, joined by ``\\n``.

    Files are read split by split, as lines are. Whether a line begins inside a quoted cell depends on all lines before it, but what
    a line does to that is one of four things: open, shut, keep or turn over. So splits are summed up in one row each, a scan over a
    file's summaries gives the state at each split's start, and windows inside splits give it line by line. Lines that are records of
    their own go no further; only lines of longer records are grouped. ``header`` leaves out the first record of each file.

    A quote that never closes makes the rest of its file one record, as for any reader; more than ``most_lines`` lines of a record
    in one split are an error. A record that is open at the end of its file ends there.
    """
    lines = (spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"))
             .withColumn("line", F.monotonically_increasing_id()))     # order within a split
    along = W.partitionBy("file", "at").orderBy("line")
    files = W.partitionBy("file").orderBy("at")
    to_here, before = (W.unboundedPreceding, W.currentRow), (W.unboundedPreceding, -1)

    shut, opened = _ends_open(F.col("value"), delimiter, False), _ends_open(F.col("value"), delimiter, True)
    lines = lines.withColumns({"shut": shut, "opened": opened}).withColumn(
        "flips", F.sum((F.col("shut") & ~F.col("opened")).cast("int")).over(along.rowsBetween(*to_here)))
    fixed = F.when(F.col("shut") == F.col("opened"), F.struct(F.col("shut").alias("open"), "flips"))
    lines = lines.withColumn("fixed", F.last(fixed, ignorenulls=True).over(along.rowsBetween(*to_here)))

    # a split as a whole: fixed too, or an even or odd number of flips
    splits = lines.groupBy("file", "at").agg(F.max_by(F.struct("flips", "fixed"), "line").alias("end"), F.min("line").alias("first"))
    splits = splits.select("file", "at", "first", F.col("end.flips").alias("n"), F.col("end.fixed").alias("f")).withColumns({
        "open": F.when(F.col("f").isNotNull(), _state("f", F.col("n"), F.lit(False))),
        "flips": F.sum(F.when(F.col("f").isNull(), F.col("n")).otherwise(0)).over(files.rowsBetween(*to_here))})
    splits = splits.withColumns({
        "f": F.last(F.when(F.col("open").isNotNull(), F.struct("open", "flips")), ignorenulls=True).over(files.rowsBetween(*before)),
        "flips": F.coalesce(F.lag("flips").over(files), F.lit(0)),
        "head": F.first("first").over(files.rowsBetween(*to_here))})
    splits = splits.select("file", "at", "head", _state("f", F.col("flips"), F.lit(False)).alias("start"))

    # a line begins a record unless the line before leaves a cell open
    lines = lines.join(splits, ["file", "at"]).withColumn("open", _state("fixed", F.col("flips"), F.col("start")))
    begins = ~F.coalesce(F.lag("open").over(along), F.col("start"))
    lines = lines.withColumn("begins", begins).withColumn(
        "record", F.last(F.when(F.col("begins"), F.col("line")), ignorenulls=True).over(along.rowsBetween(*to_here)))
    alone = lines.where(F.col("begins") & ~F.col("open"))
    parts = lines.where(~F.col("begins") | F.col("open")).withColumn("k", F.row_number().over(
        W.partitionBy("file", "at", "record").orderBy("line"))).withColumn("value", F.when(
            F.col("k") > most_lines, F.raise_error(F.concat(F.lit(f"a record of more than {most_lines} lines in "), "file"))).otherwise(F.col("value")))
    carried = lines.groupBy("file", "at").agg(F.max("record").alias("record")).select(
        "file", "at", F.last("record", ignorenulls=True).over(files.rowsBetween(*before)).alias("carried"))
    parts = parts.join(carried, ["file", "at"]).withColumn("record", F.coalesce("record", "carried"))
    joined = parts.groupBy("file", "record", "head").agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("line", "value"))), lambda x: x["value"]), "\n").alias("value"))
    found = alone.select("record", "head", "value").unionByName(joined.select("record", "head", "value"))
    return (found.where("record <> head") if header else found).select("value")


def stream_json(spark: SparkSession, path: str, schema: StructType = S.CLEAN,
                max_files_per_trigger: int = 1) -> DataFrame:
    """JSON files as they arrive in a folder."""
    return (spark.readStream.schema(schema)
            .option("maxFilesPerTrigger", max_files_per_trigger).json(path))
