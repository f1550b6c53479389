"""Packing into length buckets (operator 6).

Texts are cut into pieces of at most ``max_tokens`` words. The histogram of piece lengths over all rows, which
has at most ``max_tokens`` bins however large the table, goes to the driver; dynamic programming chooses the
``n_buckets`` upper bounds that minimise padding if every piece is padded to its bucket's bound. Inside a
bucket, pieces form batches of as many pieces as fit the token budget.

A bucket may hold most of all pieces, so none is numbered in one task: pieces are spread over fixed chunks
by hash, numbered inside each (bucket, chunk), and chunk totals, a small table of buckets times chunks, give
each chunk its offset. Every batch but the last of a bucket is full.

Defined cases: a null or empty text is one piece of length 0 in the first bucket; repeated rows are packed as often as
they occur; other columns are ignored; an empty table gives an empty result.
"""

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from airlens.llm.common import NOT_SPACE, cut

MAX_TOKENS = 2048
N_BUCKETS = 16
TOKEN_BUDGET = 65_536
CHUNKS = 1024


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(f"{NOT_SPACE}+"))


def boundaries(histogram: dict[int, int], n_buckets: int) -> list[int]:
    """Upper bounds of at most ``n_buckets`` buckets with the least padding in all; the last is the greatest length.

    best[b][j]: least padding of the j shortest lengths in b buckets. The cost of a bucket that holds lengths
    i+1..j is length_j * count - tokens of these. Exact; lengths squared times buckets steps.
    """
    lengths = np.array(sorted(histogram), dtype=np.float64)
    if not len(lengths):
        return []
    counts = np.array([histogram[int(x)] for x in lengths], dtype=np.float64)
    n, size = np.r_[0, np.cumsum(counts)], np.r_[0, np.cumsum(counts * lengths)]
    best, cuts = np.r_[0, np.full(len(lengths), np.inf)], []
    for _ in range(min(n_buckets, len(lengths))):
        new, cut_at = np.full(len(best), np.inf), np.zeros(len(best), dtype=int)
        new[0] = 0
        for j in range(1, len(best)):
            total = best[:j] + lengths[j - 1] * (n[j] - n[:j]) - (size[j] - size[:j])
            cut_at[j] = int(total.argmin())
            new[j] = total[cut_at[j]]
        best = new
        cuts.append(cut_at)
    found, j = [], len(lengths)
    for cut_at in reversed(cuts):
        if j:
            found.append(int(lengths[j - 1]))
            j = cut_at[j]
    return found[::-1]


def pieces(docs: DataFrame, length: Column, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """``doc_id, piece, n_tokens``: whole texts, the last piece of each being the shorter one."""
    sized = docs.select("doc_id", length.cast("long").alias("_n"))
    whole = F.sequence(F.lit(0).cast("long"), F.greatest(F.lit(0), F.ceil(F.col("_n") / max_tokens) - 1).cast("long"))
    return sized.select("doc_id", "_n", F.explode_outer(whole).alias("piece")).select(
        "doc_id", "piece", F.least(F.lit(max_tokens), F.col("_n") - F.col("piece") * max_tokens).cast("int").alias("n_tokens"))


def pack(docs: DataFrame, length: Column | None = None, max_tokens: int = MAX_TOKENS, n_buckets: int = N_BUCKETS,
         token_budget: int = TOKEN_BUDGET) -> DataFrame:
    """One row per piece: ``doc_id, piece, n_tokens, bucket, padded_to, batch, place``.

    ``length`` counts the tokens of a row (default: words of ``text``); ``batch`` counts within the bucket.
    """
    cut_up = cut(pieces(docs, word_count(F.col("text")) if length is None else length, max_tokens))
    histogram = {r["n_tokens"]: r["count"] for r in cut_up.groupBy("n_tokens").count().collect()}
    bounds = boundaries(histogram, n_buckets)
    if not bounds:
        bounds = [max_tokens]
    bucket, padded = F.lit(len(bounds) - 1), F.lit(bounds[-1])
    for k, bound in reversed(list(enumerate(bounds[:-1]))):
        bucket = F.when(F.col("n_tokens") <= bound, F.lit(k)).otherwise(bucket)
        padded = F.when(F.col("n_tokens") <= bound, F.lit(bound)).otherwise(padded)
    dealt = cut_up.select("doc_id", "piece", "n_tokens", bucket.alias("bucket"), padded.alias("padded_to"),
                          F.pmod(F.xxhash64("doc_id", "piece"), F.lit(CHUNKS)).cast("int").alias("_chunk"))
    offsets = dealt.groupBy("bucket", "_chunk").count().withColumn("_before", F.coalesce(F.sum("count").over(
        Window.partitionBy("bucket").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("count")
    numbered = dealt.withColumn("_row", F.row_number().over(
        Window.partitionBy("bucket", "_chunk").orderBy("doc_id", "piece", "n_tokens")))
    at = F.col("_before") + F.col("_row") - 1
    fit = F.greatest(F.lit(1), F.floor(F.lit(token_budget) / F.greatest(F.lit(1), F.col("padded_to")))).cast("long")
    return numbered.join(offsets, ["bucket", "_chunk"]).select(
        "doc_id", "piece", "n_tokens", "bucket", "padded_to", F.floor(at / fit).cast("long").alias("batch"),
        (at % fit).cast("long").alias("place"))
