"""Session settings the library is written for."""

from pyspark.sql import SparkSession

#: Runtime settings, safe to set on a running session.
SETTINGS = {
    # Times are read and shown in one zone.
    "spark.sql.session.timeZone": "UTC",
    # Enrichment projects dozens of CASE expressions at once. Past 8,000 bytes of bytecode the JVM
    # no longer compiles a generated method, and it runs interpreted; with this limit Spark
    # generates smaller methods for such stages instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Runtime re-planning: joins by measured size, skewed partitions split.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A windowed stream has a group per window and place. They are held on disk and in bounded memory,
    # not as objects in the executors' heap.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    # State lies in the store's folder and once more in the checkpoint.
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
}


#: Shuffles of the table queries start with at least so many partitions, whatever the session's number, and are put together
#: again up to this size: what one task sorts is bounded while a session tuned for few cores would let it grow with the table.
#: 200 is also the most for which Spark writes a shuffle without sorting it first.
PARTITIONS, PARTITION_BYTES = 200, "32m"
#: A load or a stream is many executions, and Spark keeps each one's shuffle files until its driver collects garbage. For table queries
#: they go when the execution ends, so the disk holds those of one at a time; a result that is collected twice is dealt twice.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_START, _ADVISED = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def tune(spark: SparkSession, tables: bool = False) -> SparkSession:
    """Apply :data:`SETTINGS`, and with ``tables`` the partitioning of table queries, unless the session states its own.

    Other cluster-sized settings (shuffle partitions, memory) stay the caller's.
    """
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    wanted = {_START: str(max(PARTITIONS, int(spark.conf.get("spark.sql.shuffle.partitions")))), _ADVISED: PARTITION_BYTES, _CLEANUP: "true"}
    for key, value in wanted.items():
        ours = spark.conf.get(f"airlens.{key}", None)       # what an earlier call has set
        stated = ours is None and spark.conf.get(key, None) not in (None, "64MB", "67108864b")
        if tables and not stated:
            spark.conf.set(key, value)
            spark.conf.set(f"airlens.{key}", value)
        elif not tables and ours is not None:
            spark.conf.unset(key)
            spark.conf.unset(f"airlens.{key}")
    return spark
