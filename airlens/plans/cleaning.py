"""Raw records to clean, validated readings."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from airlens import config as C
from airlens.operators import clean, enrich, impute, standardize, validate
from airlens.shared import discard, materialized, scratch_path
from airlens.sinks import write_validated
from airlens.sources import read_jsonl
from airlens import schema as S


def clean_readings(
    df: DataFrame,
    order_by: Sequence[str],
    city_lookup=C.CITY_TO_COUNTRY,
    country_lookup=C.COUNTRY_TO_CITY,
    mode: str = "nullify",
    approx: bool = False,
    stage: str | None = None,
) -> DataFrame:
    """Standardised readings -> filled, deduplicated, guarded, imputed and enriched ones.

    The medians need the deduplicated rows more than once, so these are written to ``stage``
    (a fresh path in the shared folder by default) and read back column by column.
    """
    stage = stage or scratch_path(df.sparkSession, "guarded")
    filled = (
        df.transform(clean.fill_country, city_lookup)
        .transform(clean.fill_city, country_lookup)
        .transform(clean.fill_missing_date, order_by, stage=f"{stage}__dates")
    )
    guarded = filled.transform(clean.dedup_daily, order_by).transform(clean.guard_ranges, mode)
    guarded = materialized(guarded, stage)
    discard(df.sparkSession, f"{stage}__dates")
    return (guarded.transform(impute.impute_median, approx=approx)
            .transform(impute.impute_aqi).transform(enrich.enrich))


def run_cleaning(spark: SparkSession, source: str, base: str, approx: bool = False,
                 partition_by: Sequence[str] = (), reader=read_jsonl, schema=S.RAW_BATCH) -> None:
    """Read raw records, clean them, and write valid and labelled invalid readings as JSON.

    Read order is kept as a column of the first stage; from there on every step is repeatable.
    The flagged readings are written once and both outputs read that table.
    """
    raw = standardize.standardize(reader(spark, source, schema))
    raw = raw.withColumn("_line", F.monotonically_increasing_id())
    stage = scratch_path(spark, "cleaning")
    lines = materialized(raw, f"{stage}/lines")
    cleaned = clean_readings(lines, ["_line"], approx=approx, stage=f"{stage}/guarded").drop("_line")
    cleaned = materialized(cleaned, f"{stage}/cleaned")
    valid, _, labeled = validate.split_valid(cleaned)
    write_validated(valid.drop(C.CORRUPT), labeled, base, partition_by)
    discard(spark, stage)
