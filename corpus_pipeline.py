"""The corpus pipeline: documents pass five stages, each written and read again before the next.

Stages take (spark, docs, sf_dir). All but the last return the columns of documents: they drop toxic documents, all but
one of each group of near copies, repeated byte strings inside the texts, and documents that hold benchmark items. The last
packs what is left into length buckets.

A row without doc_id is never dropped by a stage that decides by id, as nothing can be said of it. Repeated rows of one doc_id count as one
document: near-duplicate removal keeps one of them.
"""

import functools
import uuid

from pyspark.sql import DataFrame, SparkSession

from airlens.llm import decontaminate, packing, simhash_dedup, suffix_dedup, toxicity
from airlens.llm.common import broadcast_if_small, checkpoint_dir, cut, table
from airlens.shared import discard


#: ids that may be broadcast (about 40 bytes each); beyond it the join is by shuffle
MOST_BROADCAST = 2_000_000


#: bytes of an Arrow batch; Python workers hold a batch and what is made of it, and live through all stages
BATCH_BYTES = 8 << 20


def staged(stage):
    """A stage whose Python workers get batches of bounded size."""
    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
        return stage(spark, docs, sf_dir)
    return run


def without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` without the rows whose doc_id is in ``ids``."""
    ids = cut(ids.where("doc_id IS NOT NULL").select("doc_id").distinct())
    return docs.join(broadcast_if_small(ids, ids.count(), MOST_BROADCAST), "doc_id", "left_anti").select(docs.columns)


@staged
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose calibrated score reaches the threshold go."""
    scored = toxicity.classify(docs, table(spark, sf_dir, "labels"))
    return without(docs, scored.where("predicted = 1"))


@staged
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id stays of each component of near copies: SimHashes of four-word shingles, linked at
    four differing bits or fewer."""
    found = cut(simhash_dedup.near_duplicates(docs))
    kept = without(docs, found.where("doc_id <> component_id"))
    repeated = cut(found.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id"))
    if repeated.isEmpty():
        return kept
    once = kept.join(repeated, "doc_id", "left_anti").select(docs.columns)
    return once.unionByName(kept.join(repeated, "doc_id", "left_semi").select(docs.columns).dropDuplicates(["doc_id"]))


@staged
def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of strings that also start earlier go; what a cut leaves of a character goes too, and n_chars is counted anew."""
    return suffix_dedup.without_repeats(docs)


@staged
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window similar to a benchmark item go."""
    return without(docs, decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark")))


@staged
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with bucket, batch and place."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near-dedup", drop_near_copies),
    ("suffix-array dedup", drop_repeated_passages),
    ("benchmark decontamination", drop_contaminated),
    ("packing", pack),
]

#: near copies, nearest neighbours and dynamic programming are beyond SQL; tests compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents; what is between two stages is a Parquet table in the shared folder."""
    docs, path = table(spark, sf_dir, "documents"), None
    for number, (_, stage) in enumerate(STAGES):
        done = stage(spark, docs, sf_dir)
        if number == len(STAGES) - 1:
            return done
        before, path = path, f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}-{number}"
        done.write.parquet(path)
        if before:
            discard(spark, before)
        docs = spark.read.parquet(path)
    return docs

