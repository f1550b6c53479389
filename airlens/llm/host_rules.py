"""Host-level quality rules (operator 1): DataFrame functions only.

Every document is tested by :data:`RULES`; failures are counted per host and rule, each host's failure
rate is shrunk towards the rate of all hosts with a beta prior fitted to the hosts themselves, and
documents of a host whose shrunk rate exceeds ``max_rate`` for any rule are not kept.

Defined cases: a null or empty text has no words and fails; a null host is a host of its own; repeated rows
count as often as they occur; an empty table gives an empty result; other columns are ignored.
"""

from pyspark.sql import DataFrame, functions as F

from airlens.llm.common import NOT_SPACE, cut, words

WINDOW = 5
#: rule -> failed, over the columns of :func:`measures`; ``base_failed`` is any of the first two
RULES = {
    "short": "n_words < 10",
    "repetitive": "100 * n_repeat_words > 20 * n_words",
    "symbols": "10 * n_symbols > word_chars",
    "copied_lines": "10 * n_dup_lines > 3 * n_lines",
}
BASE = ("short", "repetitive")
MAX_RATE = 0.5
#: bounds of the prior's strength, in documents
STRENGTH = (1.0, 10_000.0)


def measures(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id", "source")) -> DataFrame:
    """``keep`` and the counts of each whole text; one pass over the rows, no shuffle.

    Windows are compared by a 64-bit hash. Only texts in which a hash occurs twice sort (hash, place)
    pairs, so a text of n words costs n log n at most.
    """
    df = docs.select(*keep, F.coalesce(text, F.lit("")).alias("_text"))
    df = df.select(
        *keep, words(F.col("_text")).alias("_w"),
        F.regexp_count("_text", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.filter(F.split("_text", "\n"), lambda line: line.rlike(NOT_SPACE)).alias("_lines"))
    df = df.select(
        *keep, "n_symbols",
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.transform("_w", lambda w: F.xxhash64(w)).alias("_h"))
    df = df.withColumn("_g", F.when(F.size("_h") >= WINDOW, F.transform(
        F.sequence(F.lit(0), F.size("_h") - WINDOW),
        lambda i: F.xxhash64(*[F.get("_h", i + k) for k in range(WINDOW)]))))
    df = df.withColumn("_s", F.when(F.size(F.array_distinct("_g")) < F.size("_g"), F.sort_array(F.transform(
        "_g", lambda g, i: F.struct(g.alias("g"), i.alias("i")))))).drop("_h", "_g")
    same = lambda k, x: F.get("_s", k)["g"].eqNullSafe(x["g"])
    df = df.withColumn("_at", F.sort_array(F.transform(
        F.filter("_s", lambda x, k: same(k - 1, x) | same(k + 1, x)), lambda x: x["i"]))).drop("_s")
    covered = F.aggregate(
        F.transform("_at", lambda at, k: F.least(F.lit(WINDOW), F.coalesce(F.get("_at", k + 1) - at, F.lit(WINDOW)))),
        F.lit(0), lambda total, n: total + n)
    return df.select(*keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines",
                     F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def host_verdicts(measured: DataFrame, host: str = "source", max_rate: float = MAX_RATE) -> DataFrame:
    """``host``, n_docs, the shrunk failure rate of each rule and ``host_failed``; one row per host."""
    counts = measured.groupBy(F.col(host)).agg(
        F.count(F.lit(1)).alias("n_docs"),
        *[F.sum(F.expr(f"CAST({rule} AS BIGINT)")).alias(f"failed_{name}") for name, rule in RULES.items()])
    means = counts.agg(*[
        (F.sum(f"failed_{name}") / F.sum("n_docs")).alias(name) for name in RULES])
    mean = means.select(F.struct(*RULES).alias("m")).scalar()
    rates = counts.withColumn("_mean", mean)
    # variance between hosts: what is left of the spread of rates beyond that of drawing n documents
    spread = [
        (F.avg(F.pow(F.col(f"failed_{name}") / F.col("n_docs") - F.col("_mean")[name], 2)
               - F.col("_mean")[name] * (1 - F.col("_mean")[name]) / F.col("n_docs"))).alias(name)
        for name in RULES]
    between = rates.agg(*spread).select(F.struct(*RULES).alias("v")).scalar()
    judged = rates.withColumn("_between", between)
    for name in RULES:
        mu = F.col("_mean")[name]
        strength = F.greatest(F.lit(STRENGTH[0]), F.least(F.lit(STRENGTH[1]), F.when(
            F.col("_between")[name] > 0, mu * (1 - mu) / F.col("_between")[name] - 1).otherwise(F.lit(STRENGTH[1]))))
        judged = judged.withColumn(f"rate_{name}", (F.col(f"failed_{name}") + mu * strength) / (F.col("n_docs") + strength))
    failed = F.greatest(*[F.col(f"rate_{name}") for name in RULES]) > max_rate
    return judged.select(host, "n_docs", *[f"rate_{name}" for name in RULES], failed.alias("host_failed"))


def judge(docs: DataFrame, host: str = "source", max_rate: float = MAX_RATE) -> DataFrame:
    """One row per document: its counts, ``base_failed``, the host's verdict and ``kept``.

    The counts are checkpointed, as hosts and documents both read them: texts are parsed once. The verdicts
    of hosts join by key; where one host has a third of all rows, adaptive execution splits it.
    """
    measured = cut(measures(docs, keep=("doc_id", host)))
    base = F.expr(" OR ".join(f"({RULES[name]})" for name in BASE))
    hosts = host_verdicts(measured, host, max_rate).select(
        F.col(host).alias("_host"), "host_failed", F.col("n_docs").alias("host_docs"))
    return (measured.join(hosts, F.col(host).eqNullSafe(F.col("_host")), "left")
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    base.alias("base_failed"), (~base & ~F.col("host_failed")).alias("kept"),
                    F.col(host), "host_docs", "host_failed"))
