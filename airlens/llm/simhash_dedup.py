"""SimHash near-duplicates (operator 4): generalised pigeonhole with unequal thresholds.

Fingerprints are computed by Arrow batches, then everything is joins and aggregates over distinct ones.

For m parts with thresholds t_i, two fingerprints within radius r have a part at distance <= t_i in common if
sum(t_i + 1) = r + 1. Correlated bits go to the same part, so that parts are as independent of each other
as the data allow. How many candidates part i costs at threshold t is estimated from all fingerprints: pairs
that agree on it are counted, and the count is scaled by the chance that independent bits with these means
differ in at most t places. Dynamic programming deals the r + 1 units to parts; the number of parts is
chosen by the same cost. Both are done for a declared number of fingerprints, not the table's own. Every row is indexed by its parts and probes them with all values within t_i, and
candidates are verified by their full distance inside the join. Half the radius is taken first, so that a dense
group is one component, or a few, before its wider links are looked for.

Defined cases: a null or empty text has fingerprint zero and links like any other; texts of fewer words than a
shingle are one shingle; repeated rows return one row each; rows without doc_id take part in links but not
in the smallest id (null if a component has no id); other columns are ignored; an empty table gives an empty result.
"""

import itertools
import math

import numpy as np
from pyspark.sql import DataFrame, functions as F

from airlens.llm.common import broadcast_if_small, cut

SHINGLE = 4
SEED = 42
RADIUS = 4
BITS = 64
PARTS = (2, 3, 4, 5)
#: cost of a probe against that of a candidate pair
PROBE_COST = 4.0
#: fingerprints the plan is made for, whatever the table's size: rows per fingerprint do not change as a table grows
PLANNED = 10_000_000
STEP = 200_000
#: links, in both directions, up to which the labels of their ends are broadcast (about 40 bytes each); beyond it joins are by shuffle
MOST_BROADCAST = 200_000
#: links a task of a round gets, and how many tasks there are where that leaves less: few links are not dealt over all partitions again and again
TASK_LINKS, LEAST_TASKS = 100_000, 8


def fingerprint(text: str | None) -> int:
    """SimHash of a text as a signed 64-bit number."""
    import xxhash

    found = (text or "").encode().lower().split()  # bytes: A-Z and ASCII white space only
    n = max(1, len(found) - SHINGLE + 1) if found else 0
    ends = np.cumsum([len(w) + 1 for w in found]).tolist() if n else []
    joined, size = b" ".join(found), min(SHINGLE, len(found))
    starts = [0, *ends]
    counts = np.zeros(BITS, dtype=np.int64)
    for a in range(0, n, STEP):
        h = np.array([xxhash.xxh64_intdigest(joined[starts[i]:starts[i + size] - 1], SEED)
                      for i in range(a, min(n, a + STEP))], dtype="<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, fp``; one row per row of ``docs``."""
    import pyarrow as pa

    def compute(batches):
        for batch in batches:
            fps = [fingerprint(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps, pa.int64())], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(compute, "doc_id long, fp long")


def bit_counts(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints, and how many have both bits i and j; 64 x 64 sums come to the driver."""
    import pyarrow as pa

    def compute(batches):
        total, n = np.zeros((BITS, BITS)), 0
        for batch in batches:
            x = np.asarray(batch.column(0)).astype("<i8").view(np.uint8).reshape(-1, 8)
            x = np.unpackbits(x, axis=1, bitorder="little").astype(np.float32)
            total += x.T @ x
            n += len(x)
        if n:
            yield pa.RecordBatch.from_arrays([
                pa.array(np.arange(BITS * BITS + 1)), pa.array(np.r_[total.ravel(), n].astype(np.int64))], ["at", "n"])

    sums = {r["at"]: r["n"] for r in fps.select("fp").mapInArrow(compute, "at long, n long")
            .groupBy("at").agg(F.sum("n").alias("n")).collect()}
    both = np.array([sums.get(k, 0) for k in range(BITS * BITS)], dtype=float).reshape(BITS, BITS)
    return sums.get(BITS * BITS, 0), both


def parts_of(n: int, both: np.ndarray, m: int) -> list[list[int]]:
    """``m`` parts of the bits, sizes as equal as can be; each grows from a seed by the bits most correlated with it."""
    mean = np.diag(both) / max(1, n)
    spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-12))
    tied = np.abs((both / max(1, n) - np.outer(mean, mean)) / np.outer(spread, spread))
    np.fill_diagonal(tied, 0)
    left, found = set(range(BITS)), []
    for k in range(m):
        size = BITS * (k + 1) // m - BITS * k // m
        bits = sorted(left)
        part = [max(bits, key=lambda b: tied[b, bits].sum())]
        left.discard(part[0])
        while len(part) < size:
            part.append(max(sorted(left), key=lambda b: tied[b, part].sum()))
            left.discard(part[-1])
        found.append(sorted(part))
    return found


def near_chances(mean: np.ndarray, part: list[int], most: int) -> np.ndarray:
    """Chance that two fingerprints with independent bits differ in at most 0, 1 .. ``most`` places of the part."""
    differ = np.zeros(most + 1)
    differ[0] = 1.0
    for b in part:
        d = 2 * mean[b] * (1 - mean[b])
        differ = differ * (1 - d) + np.r_[0, differ[:-1]] * d
    return np.cumsum(differ)


def allocate(costs: list[list[float]], units: int) -> tuple[float, list[int]]:
    """Thresholds t_i >= -1 with sum(t_i + 1) = ``units`` and least total cost; costs[i][u] is part i's with u units."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for cost in costs:
        new: dict[int, tuple[float, list[int]]] = {}
        for spent, (total, chosen) in best.items():
            for u, c in enumerate(cost[: units - spent + 1]):
                if spent + u not in new or total + c < new[spent + u][0]:
                    new[spent + u] = (total + c, [*chosen, u - 1])
        best = new
    return best[units]


def value_of(part: list[int], mask: int = 0):
    """The part's bits of column ``fp``, some flipped, as a number that keeps their places."""
    bits = sum(1 << b for b in part)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    return F.col("fp").bitwiseXOR(F.lit(signed(mask)).cast("long")).bitwiseAND(F.lit(signed(bits)).cast("long"))


def masks(part: list[int], most: int) -> list[int]:
    return [sum(1 << b for b in bits) for k in range(most + 1) for bits in itertools.combinations(part, k)]


def statistics(fps: DataFrame) -> tuple[int, np.ndarray, dict, dict]:
    """Number of fingerprints, bit means, parts by their number, and pairs that agree on a part by (number, part)."""
    n, both = bit_counts(fps)
    choices = {m: parts_of(n, both, m) for m in PARTS}
    flat = [(m, k, part) for m, parts in choices.items() for k, part in enumerate(parts)]
    values = fps.select(F.explode(F.array(*[
        F.struct(F.lit(m).alias("m"), F.lit(k).alias("k"), value_of(part).alias("v")) for m, k, part in flat])).alias("x"))
    same = {(r["m"], r["k"]): float(r["pairs"] or 0) for r in values.groupBy("x").count()
            .groupBy("x.m", "x.k").agg((F.sum(F.col("count").cast("double") * (F.col("count") - 1))).alias("pairs")).collect()}
    return n, np.diag(both) / max(1, n), choices, same


def plan(known: tuple[int, np.ndarray, dict, dict], radius: int, planned: int = PLANNED) -> list[tuple[list[int], int]]:
    """(bits, threshold) of each part that is probed, for ``planned`` fingerprints that agree on parts as often as these do."""
    n, mean, choices, same = known
    share, n = {k: pairs / max(1, n * (n - 1)) for k, pairs in same.items()}, planned
    best = None
    for m, parts in choices.items():
        costs = []
        for k, part in enumerate(parts):
            chance = near_chances(mean, part, radius)
            pairs = n * n * max(share.get((m, k), 0.0), chance[0])
            costs.append([0.0] + [pairs * chance[t] / max(chance[0], 1e-300) + PROBE_COST * n * sum(math.comb(len(part), j) for j in range(t + 1))
                                  for t in range(min(radius, 2) + 1)])
        if radius + 1 <= 3 * m:
            cost, thresholds = allocate(costs, radius + 1)
            if best is None or cost < best[0]:
                best = (cost, [(p, t) for p, t in zip(parts, thresholds, strict=True) if t >= 0])
    return best[1]


def links(nodes: DataFrame, chosen: list[tuple[list[int], int]], radius: int) -> DataFrame:
    """``a, b``: pairs of labels, a < b, that have fingerprints within ``radius``; ``nodes`` is ``fp, label``."""
    one = lambda k, mask: F.struct(F.lit(k).alias("k"), mask.alias("v"))
    index = nodes.select("fp", "label", F.explode(F.array(*[
        one(k, value_of(part)) for k, (part, _) in enumerate(chosen)])).alias("x"))
    index = index.select(F.col("fp").alias("f"), F.col("label").alias("a"), F.col("x.k").alias("k"), F.col("x.v").alias("v"))
    probes = nodes.select("fp", "label", F.explode(F.array(*[
        one(k, value_of(part, mask)) for k, (part, most) in enumerate(chosen) for mask in masks(part, most)])).alias("x"))
    probes = probes.select(F.col("fp").alias("g"), F.col("label").alias("b"), F.col("x.k").alias("k"), F.col("x.v").alias("v"))
    near = ((index["k"] == probes["k"]) & (index["v"] == probes["v"]) & (index["a"] < probes["b"])
            & (F.bit_count(index["f"].bitwiseXOR(probes["g"])) <= radius))
    return index.join(probes, near).select("a", "b").distinct()


def clusters(fps: DataFrame, radius: int) -> DataFrame:
    """``fp, label``: the smallest fingerprint reachable by steps of at most ``radius``, of the distinct column ``fp``.

    Half the radius comes first, and what it has joined is not joined again by the whole: a dense group of
    near copies becomes one label, or a few, by its closer pairs, and does not make all its pairs.
    """
    known = statistics(fps)
    nodes = fps.select("fp", F.col("fp").alias("label"))
    for step in sorted({(radius + 1) // 2, radius}):
        joined = components(links(nodes, plan(known, step), step)).withColumnsRenamed({"node": "_node", "label": "_label"})
        nodes = cut(nodes.join(joined, nodes["label"] == joined["_node"], "left")
                    .select("fp", F.coalesce("_label", "label").alias("label")))
    return nodes


def components(pairs: DataFrame) -> DataFrame:
    """``node, label``: the smallest node reachable from each node of ``a, b``.

    Rounds of taking the smallest label of the neighbours, then the label of the label, until none changes;
    every round is checkpointed. Only a count comes to the driver. Links are counted once, and rounds have tasks and broadcasts by that count.
    """
    edges = cut(pairs.select("a", "b").union(pairs.select("b", "a")))
    number = edges.count()
    few = lambda df: df.coalesce(max(LEAST_TASKS, number // TASK_LINKS))
    small = lambda df: broadcast_if_small(df, number, MOST_BROADCAST)
    edges = few(edges)
    labels = cut(few(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label"))
                     .select("node", F.least("node", "label").alias("label"))))
    while True:
        around = edges.join(small(labels.withColumnRenamed("node", "b")), "b").select(F.col("a").alias("node"), "label", F.lit(None).cast("long").alias("_old"))
        # a node's own label is added up with those around it: a join of the two would double what the driver plans and holds in a round
        nearer = (around.unionByName(labels.withColumn("_old", F.col("label"))).groupBy("node")
                  .agg(F.min("label").alias("label"), F.min("_old").alias("_old")))
        jump = nearer.select(F.col("node").alias("label"), F.col("label").alias("_next"))
        new = cut(few(nearer.join(small(jump), "label")).select("node", F.least("label", "_next").alias("label"), "_old"))
        if new.where("label <> _old").isEmpty():
            return new.select("node", "label")
        labels = new.select("node", "label")


def near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row."""
    found = cut(fingerprints(docs))
    nodes = cut(found.groupBy("fp").agg(F.min("doc_id").alias("first")))
    named = nodes.join(clusters(nodes.select("fp"), radius), "fp")
    smallest = named.groupBy("label").agg(F.min("first").alias("component_id"))
    members = named.select("fp", "label").join(smallest, "label").select("fp", "component_id")
    return found.join(members, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
