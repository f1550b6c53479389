"""Benchmark decontamination (operator 10): DataFrame functions only.

A document is contaminated by an item if one of its windows of as many words as the item has a weighted
similarity of at least ``similarity`` to it over five-word shingles:
sum(min(a, b) * w) / sum(max(a, b) * w), with a, b the counts of a shingle on either side and w its weight,
ln(1 + items / items that hold it).

1. Similar texts share a shingle, so windows are placed by the shingles that a document shares with items of their size. A shingle
   at place p that an item has at o aligns a window to start at p - o. Moved right of the alignments of all it shares, or left of
   them, a window only loses; so one of the greatest similarity starts between two neighbouring alignments, or at one. These can be
   ``n / similarity`` apart at most, or the places between them that nothing shared covers would already weigh too much. Every
   start between such neighbours is tried.
2. Each window gets a 64-bit SimHash of its shingles and is looked up among the items of its size by multi-index blocks: with one
   block more than the radius has bits, two fingerprints within the radius agree in at least one block. Blocks are wide (16 bits at
   radius 3), so a lookup meets few items; this finds exact copies and windows with few other shingles.
3. Other pairs are found by weight: a window of ``similarity`` with an item holds one of its heaviest shingles, those
   that together weigh more than 1 - ``similarity`` of it, and is looked up by these too. So the result does not depend
   on the radius.
4. All pairs found are verified by the exact weighted similarity.

Defined cases: items of fewer than five words hold no shingle and match nothing; null or empty texts match
nothing; repeated rows and items count once in the result, one row per (doc_id, item_id); other columns are
ignored; empty tables give an empty result. ``n_windows`` and ``first_word`` are of the similar windows among those placed.
"""

from pyspark.sql import Column, DataFrame, functions as F

from airlens.llm.common import broadcast_if_small, cut, words

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 3
BITS = 64
#: benchmark shingles that may be broadcast (about 40 bytes each); beyond it the join is by shuffle
MOST_BROADCAST = 2_000_000


def with_shingles(df: DataFrame, *keep: str, text: str = "text") -> DataFrame:
    """``keep`` and ``_s``, the hashes of all five-word shingles in order, lower case; null for short texts.

    Explode it with ``posexplode_outer``: for the plain form Spark infers a filter on the size, pushes it below
    these projections and so repeats their work for each shingle.
    """
    df = df.select(*keep, F.transform(words(F.lower(text)), lambda x: F.xxhash64(x)).alias("_h"))
    return df.select(*keep, F.when(F.size("_h") >= SHINGLE, F.transform(
        F.sequence(F.lit(0), F.size("_h") - SHINGLE),
        lambda i: F.xxhash64(*[F.get("_h", i + k) for k in range(SHINGLE)]))).alias("_s"))


def numbered(s: str) -> Column:
    """Shingles with their repeats told apart: the k-th occurrence of a hash becomes a hash of its own."""
    count = lambda x, i: F.size(F.filter(F.slice(s, F.lit(1), i), lambda y: y == x))
    return F.when(F.size(F.array_distinct(s)) == F.size(s), F.col(s)).otherwise(F.transform(
        s, lambda x, i: F.when(count(x, i) == 0, x).otherwise(F.xxhash64(x, count(x, i)))))


def simhash(s: Column) -> Column:
    """Bit b is set if more than half of the hashes have it; repeats count."""
    bit = lambda b: F.aggregate(
        s, F.lit(0), lambda n, h: n + F.call_function("shiftrightunsigned", h, b).bitwiseAND(F.lit(1).cast("long")).cast("int"))
    return F.aggregate(F.transform(F.sequence(F.lit(0), F.lit(BITS - 1)), lambda b: F.when(
        2 * bit(b) > F.size(s), F.call_function("shiftleft", F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long"))),
        F.lit(0).cast("long"), lambda x, y: x.bitwiseOR(y))


def blocks(fingerprint: Column, radius: int) -> Column:
    """Array of (block, value): ``radius`` + 1 runs of bits that cover the fingerprint."""
    ends = [BITS * k // (radius + 1) for k in range(radius + 2)]
    return F.array(*[
        F.struct(F.lit(k).alias("block"),
                 F.shiftrightunsigned(fingerprint, a).bitwiseAND(F.lit((1 << (b - a)) - 1).cast("long")).alias("value"))
        for k, (a, b) in enumerate(zip(ends, ends[1:], strict=False))])


def items_of(benchmark: DataFrame) -> DataFrame:
    """``item_id, _t`` (numbered shingles), ``_w`` (their weights), ``_n``, ``_total``, ``_fp``; checkpointed."""
    items = with_shingles(benchmark.select("item_id", "text").distinct(), "item_id")
    items = cut(items.withColumn("_row", F.xxhash64("item_id", "_s"))).where(F.col("_s").isNotNull()).dropDuplicates(["item_id", "_row"])
    n_items = F.lit(max(1, items.count()))
    weights = (items.select("item_id", "_row", F.explode(F.array_distinct("_s")).alias("_g"))
               .groupBy("_g").agg(F.log1p(n_items / F.count(F.lit(1))).alias("_w")))
    held = (items.select("item_id", "_row", F.posexplode("_s").alias("_at", "_g")).join(weights, "_g")
            .groupBy("item_id", "_row").agg(F.array_sort(F.collect_list(F.struct("_at", "_g", "_w"))).alias("_x"))
            .select("item_id", F.col("_x")["_g"].alias("_s"), F.col("_x")["_w"].alias("_w")))
    return cut(held.select(
        "item_id", numbered("_s").alias("_t"), "_w", F.size("_s").alias("_n"), "_s", simhash(F.col("_s")).alias("_fp"),
        F.aggregate("_w", F.lit(0.0), lambda a, x: a + x).alias("_total"), F.log1p(n_items).alias("_other")))


def heaviest(items: DataFrame, similarity: float) -> DataFrame:
    """``_n, item_id, _fp, _g``: shingles of each item, heaviest first, until what is left weighs less than ``similarity`` of it."""
    ordered = F.array_sort(F.zip_with("_t", "_w", lambda t, w: F.struct((-w).alias("_minus"), t.alias("_g"))))
    before = lambda i: F.aggregate(F.slice("_o", F.lit(1), i), F.lit(0.0), lambda a, x: a - x["_minus"])
    return (items.withColumn("_o", ordered)
            .withColumn("_o", F.filter("_o", lambda x, i: before(i) <= F.col("_total") * (1 - similarity) + 1e-6))
            .select("_n", "item_id", "_fp", F.explode("_o._g").alias("_g")))


def starts(placed: str, n: str, similarity: float) -> Column:
    """Array of (from, to): the sorted starts ``placed``, each with those up to the next one if that is near enough."""
    following = lambda i: F.get(placed, i + 1)
    return F.transform(placed, lambda at, i: F.struct(
        at.alias("from"), F.when(following(i) - at <= F.col(n) / similarity, following(i) - 1).otherwise(at).alias("to")))


def windows(docs: DataFrame, items: DataFrame, similarity: float) -> DataFrame:
    """``doc_id, _key, _n, _start, _win``: windows of item size between alignments of shingles shared with an item."""
    places = items.select("_n", F.posexplode("_s").alias("_offset", "_g")).distinct()
    places = cut(places.groupBy("_g").agg(F.collect_set(F.struct("_n", "_offset")).alias("_places")))
    places = broadcast_if_small(places, places.count(), MOST_BROADCAST)
    docs = docs.select("doc_id", "text").withColumn("_key", F.xxhash64("text"))
    shingled = with_shingles(docs, "doc_id", "_key")
    hits = (shingled.select("doc_id", "_key", F.size("_s").alias("_size"), F.posexplode_outer("_s").alias("_pos", "_g"))
            .join(places, "_g").select("doc_id", "_key", "_size", "_pos", F.explode("_places").alias("_p")))
    start = F.greatest(F.lit(0), F.least(F.col("_pos") - F.col("_p._offset"), F.col("_size") - F.col("_p._n")))
    sized = (hits.select("doc_id", "_key", F.col("_p._n").alias("_n"), start.alias("_start"))
             .groupBy("doc_id", "_key", "_n").agg(F.array_sort(F.collect_set("_start")).alias("_starts")))
    found = cut(sized.select("doc_id", "_key", F.struct("_n", starts("_starts", "_n", similarity).alias("_ranges")).alias("_f"))
                .groupBy("doc_id", "_key").agg(F.collect_list("_f").alias("_found")))
    size = found.agg(F.count(F.lit(1)) + F.coalesce(F.sum(F.aggregate(
        "_found", F.lit(0), lambda a, x: a + F.size(x["_ranges"]))), F.lit(0))).first()[0]
    found = broadcast_if_small(found.withColumnsRenamed({"doc_id": "_doc", "_key": "_doc_key"}), size, MOST_BROADCAST)
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_key") == F.col("_doc_key"))
    chosen = with_shingles(docs.join(found, same), "doc_id", "_key", "_found")
    return (chosen.select("doc_id", "_key", "_s", F.explode_outer("_found").alias("_f"))
            .select("doc_id", "_key", "_s", F.col("_f._n").alias("_n"), F.explode_outer("_f._ranges").alias("_r"))
            .select("doc_id", "_key", "_s", "_n", F.explode_outer(F.sequence("_r.from", "_r.to")).alias("_start"))
            .select("doc_id", "_key", "_n", "_start", F.slice("_s", F.col("_start") + 1, F.col("_n")).alias("_win")))


def contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """``doc_id, item_id, similarity, n_windows, first_word``: every document and item with a similar window.

    Windows of equal content are fingerprinted and verified once, however many documents hold them.
    """
    items = items_of(benchmark)
    placed = cut(windows(docs, items, similarity).withColumn("_content", F.xxhash64("_win")))
    content = placed.groupBy("_n", "_content").agg(F.any_value("_win").alias("_win"))
    printed = cut(content.select("_n", "_content", numbered("_win").alias("_win"), simhash(F.col("_win")).alias("_f")))
    keyed = printed.select("_n", "_content", "_f", F.explode(blocks(F.col("_f"), radius)).alias("_b"))
    index = items.select("_n", "item_id", "_fp", F.explode(blocks(F.col("_fp"), radius)).alias("_b"))
    near = (keyed.join(index, ["_n", "_b"]).where(F.bit_count(F.col("_f").bitwiseXOR(F.col("_fp"))) <= radius)
            .select("_n", "_content", "item_id", "_fp"))
    heavy = cut(heaviest(items, similarity))
    heavy = broadcast_if_small(heavy, heavy.count(), MOST_BROADCAST)
    beyond = (printed.select("_n", "_content", F.explode("_win").alias("_g")).join(heavy, ["_n", "_g"])
              .select("_n", "_content", "item_id", "_fp"))
    near = near.unionByName(beyond).distinct()
    shared = F.aggregate(F.zip_with("_t", "_w", lambda t, w: F.when(F.array_contains("_win", t), w).otherwise(F.lit(0.0))),
                         F.lit(0.0), lambda a, x: a + x)
    common = F.size(F.array_intersect("_win", "_t"))
    verified = (near.join(printed, ["_n", "_content"]).join(items, ["_n", "item_id", "_fp"])
                .withColumn("_shared", shared)
                .withColumn("similarity", F.round(F.col("_shared") / (
                    F.col("_total") + F.col("_other") * (F.size("_win") - common)), 9))
                .where(F.col("similarity") >= similarity).select("_n", "_content", "item_id", "similarity"))
    return (placed.drop("_win").join(verified, ["_n", "_content"]).groupBy("doc_id", "item_id")
            .agg(F.max("similarity").alias("similarity"), F.countDistinct("_n", "_start").alias("n_windows"),
                 F.min("_start").cast("long").alias("first_word")))
