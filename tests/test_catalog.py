"""Named queries against their checking SQL on the smallest tables, where these are at hand."""

import os
import time

import duckdb
import pytest

import __spark_entry__ as entry
from airlens.catalog import ORACLES, QUERIES
from airlens.session import tune
from airlens.shared import shared_dir
from check import TABLES, compare

FOLDER = entry.SMOKE_DIR
#: each covers several operators; ``check.py`` runs all
CHOSEN = [
    "clean_readings", "c12_fill_missing_date", "c18_impute_median", "c09_standardize", "k01_preview",
    "t1_06_encode_records", "t1_06_encode_wide", "k09_rejects", "k08_upsert_null_time", "v06_error_codes", "v08_error_message", "v10_error_histogram", "t5_20_urgent_alerts",
    "t5_03_city_metrics", "t5_04_country_trends", "t5_05_pollutant_correlations", "t5_02_city_metrics_append",
    "c14_dedup_stream", "m03_to_document", "m05_seasonal_pm25_profile", "m06_monthly_avg_aqi_mom", "m07_season_by_city",
    "k08_upsert_by_key", "g03_top_cities_by_avg_aqi", "g05_rank_pollutants", "k09_write_graph", "d06_risk_distribution",
    "d07_aqi_histogram", "d08_summary",
]
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


def test_every_query_has_checking_sql():
    assert set(QUERIES) == set(ORACLES) <= set(entry.queries())


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{FOLDER}/{table}.parquet')")
    return connection


@needs_tables
@pytest.mark.parametrize("name", CHOSEN)
def test_query_equals_sql(spark, con, name):
    text, _, good = compare(spark, con, name, FOLDER)
    assert good, text


@needs_tables
def test_entry(spark):
    assert entry.entry(spark).columns == ["city", "month", "avg_aqi", "mom_change_aqi"]


def test_shared_folder_is_the_configured_one(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_table_queries_start_with_many_partitions_unless_the_session_says_otherwise(spark):
    """A session of four shuffle partitions let one task sort a fourth of the table; training queries keep the session's number."""
    other = spark.newSession()
    start, size = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    default = other.conf.get(size)
    tune(other, tables=True)
    assert other.conf.get(start) == "200" and other.conf.get(size) == "32m"
    tune(other)
    assert other.conf.get(start, None) is None and other.conf.get(size) == default
    other.conf.set(start, "7")
    tune(other, tables=True)
    tune(other)
    assert other.conf.get(start) == "7"
    tune(other, tables=True)
    assert other.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("RocksDBStateStoreProvider")


def test_shuffle_files_go_with_their_execution(spark, tmp_path):
    """Those of all loads of a query, or all turns of a stream, lay on the disk until it ended."""
    other = tune(spark.newSession(), tables=True)
    stored = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {f for f in stored.getAllFiles().mkString("\n").split("\n") if "shuffle_" in f}
    before = files()
    for turn in range(3):
        other.range(1000).repartition(7, "id").write.parquet(str(tmp_path / str(turn)))
    deadline = time.time() + 20
    while files() - before and time.time() < deadline:
        time.sleep(0.2)
    assert not files() - before
    tune(other)
    assert other.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) in (None, "false")
