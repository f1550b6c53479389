"""Toxicity by nearest labelled examples (operator 7).

Terms are lower-case words and their prefixes of four to six letters, which find inflected forms; occurring
twice, three or four times (for a prefix: in as many different words) makes terms of their own. How many toxic and clean training documents hold each term
is counted over all of them. A term belongs to the vector space if at least ``MIN_TOXIC`` toxic documents hold it and the toxic share of its documents
(with one document of the usual share added) is at least ``LIFT`` times the usual share: bounds that do not grow with the table. Its weight is
TF-IDF times that share, so that words of the subject count for less than words of the class.
Examples are training documents chosen by hash, at most ``max_examples`` of them (a documented bound of the classifier), and terms that none of them holds
cannot match anything and are left out. They go into an inverted index whose postings come in blocks of examples with the greatest weight of each.

A document's ``k`` nearest examples by cosine are found exactly: blocks are visited by falling upper bound, in growing groups, until none can
enter the k best. Neighbours vote with the square of their cosine, the vote is calibrated on
the examples' own leave-one-out votes by isotonic regression, and the nearest neighbours and shared terms are the evidence.
An example is never its own neighbour, neither here nor there.

Defined cases: documents without a term of the space, empty and null texts among them, score the share of toxic ones
among training documents without one (one pseudo-document of each class added); without any training rows that is 0.5.
Labels or ids that are null are not learned from; of conflicting labels of one id the greater holds; ties go to the smaller
id. A row without doc_id is not held out and not learned from. Other columns are ignored; an empty table gives an empty result.
"""

import math
import re
from collections import Counter
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame, functions as F

from airlens.llm.common import broadcast_if_small, crc_mod, cut

FOLDS, HELD_OUT = 3, 1
PREFIXES = (4, 5, 6)
LEVELS = (2, 3, 4)
MIN_TOXIC, LIFT = 2, 2.0
MAX_EXAMPLES = 20_000
NEIGHBOURS = 25
BLOCK = 64
#: blocks in the first group that a search visits; each further group is twice as large
FIRST_GROUP = 4
#: words whose prefixes a task remembers
CACHE = 200_000
#: weight of the prior in a vote
PRIOR_WEIGHT = 0.25
THRESHOLD = 0.7
#: labelled ids that may be broadcast (about 40 bytes each); beyond it the join is by shuffle
MOST_BROADCAST = 2_000_000

_WORD = re.compile(r"\w+")


def terms(text: str | None, wanted: "Wanted | None" = None) -> Counter:
    """Counts of words and, marked by a star, of the different words a prefix has; ``term=2`` if counted twice or more.

    With ``wanted``, only terms that it may hold: the others are skipped as early as can be.
    """
    found = Counter(_WORD.findall((text or "").lower()))
    if wanted is None:
        prefixes = Counter([f"{word[:size]}*" for word in found for size in PREFIXES if len(word) >= size])
    else:
        prefixes = Counter(chain.from_iterable(map(wanted.prefixes, found)))
        found = {word: n for word, n in found.items() if word in wanted.words}
    found.update(prefixes)
    often = [(t, n) for t, n in found.items() if n >= LEVELS[0]]
    found.update({f"{t}={level}": 1 for t, n in often for level in LEVELS if n >= level})
    return found


class Wanted:
    """Features by term, and what a text must hold for any of them to occur."""

    def __init__(self, weights: dict[str, float]):
        self.weights = {t: (f, w) for f, (t, w) in enumerate(weights.items())}
        bare = {t.rpartition("=")[0] or t for t in weights}
        self.words = {t for t in bare if not t.endswith("*")}
        self.starts = bare - self.words
        self.known: dict[str, tuple[str, ...]] = {}

    def prefixes(self, word: str) -> tuple[str, ...]:
        """Prefixes of a word that terms are made of; remembered."""
        found = self.known.get(word)
        if found is None:
            if len(self.known) > CACHE:
                self.known.clear()
            cut_off = [f"{word[:size]}*" for size in PREFIXES if len(word) >= size]
            found = self.known[word] = tuple(t for t in cut_off if t in self.starts)
        return found


def held_out(doc_id):
    return F.coalesce(crc_mod(doc_id, FOLDS) == HELD_OUT, F.lit(False))


def training(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, text, toxic`` of the rows that may be learned from."""
    known = cut(labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
                .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic")))
    known = broadcast_if_small(known, known.count(), MOST_BROADCAST)
    return docs.select("doc_id", "text").join(known, "doc_id")


def chosen(doc_id, n_train: int, max_examples: int):
    """Whether a training document is an example: all, or by hash about as many as there may be."""
    share = min(1.0, max_examples / max(1, n_train))
    return F.pmod(F.xxhash64(doc_id.cast("long")), F.lit(1 << 30)) < int(share * (1 << 30))


def term_counts(train: DataFrame) -> DataFrame:
    """``term, toxic, n, n_examples``: in how many documents, and examples, of each class; the term '' counts documents. Added up before the shuffle.

    ``train`` has a column ``example`` beside those of :func:`training`.
    """
    import pyarrow as pa

    def count(batches):
        for batch in batches:
            found, shown = Counter(), Counter()
            for text, toxic, example in zip(*(batch.column(c).to_pylist() for c in ("text", "toxic", "example")), strict=True):
                held = [(t, toxic) for t in terms(text)]
                held.append(("", toxic))
                found.update(held)
                if example:
                    shown.update(held)
            if found:
                yield pa.RecordBatch.from_arrays([
                    pa.array([t for t, _ in found]), pa.array([y for _, y in found], pa.int32()),
                    pa.array(list(found.values()), pa.int64()), pa.array([shown[k] for k in found], pa.int64())],
                    ["term", "toxic", "n", "n_examples"])

    counted = train.select("text", "toxic", "example").mapInArrow(count, "term string, toxic int, n long, n_examples long")
    return counted.groupBy("term", "toxic").agg(F.sum("n").alias("n"), F.sum("n_examples").alias("n_examples"))


def choose_terms(counts: DataFrame) -> tuple[dict[str, float], int, int]:
    """Terms of the space with their weights, and the numbers of toxic and clean training documents."""
    counts = cut(counts)
    totals = {r["toxic"]: r["n"] for r in counts.where("term = ''").collect()}
    n1, n0 = sum(n for y, n in totals.items() if y), totals.get(0, 0)
    if not n1 or not n0:
        return {}, n1, n0
    n, usual = n1 + n0, n1 / (n1 + n0)
    by_term = counts.where("term <> ''").groupBy("term").agg(
        F.sum(F.when(F.col("toxic") != 0, F.col("n")).otherwise(0)).cast("double").alias("a"),
        F.sum("n").cast("double").alias("all"), F.sum("n_examples").alias("shown"))
    share = (F.col("a") + usual) / (F.col("all") + 1)
    best = (by_term.where((F.col("a") >= MIN_TOXIC) & (F.col("shown") > 0)).withColumn("share", share)
            .where(F.col("share") >= LIFT * usual).select("term", "all", "share").collect())
    return {r["term"]: (math.log((1 + n) / (1 + r["all"])) + 1) * r["share"] for r in sorted(best, key=lambda r: r["term"])}, n1, n0


def vector(text: str | None, wanted: Wanted) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers, ascending, and weights of unit length."""
    weights = wanted.weights
    found = sorted((weights[t][0], (1 + math.log(n)) * weights[t][1]) for t, n in terms(text, wanted).items() if t in weights)
    at = np.array([f for f, _ in found], dtype=np.int32)
    w = np.array([x for _, x in found])
    return at, w / np.sqrt((w * w).sum()) if len(w) else w


def _spans(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All numbers of the ranges that begin at ``start``, one range after the other."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())


class Index:
    """Inverted index of unit vectors with the greatest weight of each term in each block of examples.

    Postings stand by term and place; ``entries`` are the runs of a term's postings inside one block.
    """

    def __init__(self, ids: list[int], labels: list[int], vectors: list[tuple[np.ndarray, np.ndarray]]):
        # examples with the same strongest terms side by side, so that bounds of blocks are tight
        order = sorted(range(len(ids)), key=lambda i: (vectors[i][0][np.argsort(-vectors[i][1], kind="stable")].tolist(), ids[i]))
        self.ids = np.array([ids[i] for i in order], dtype=np.int64)
        self.labels = np.array([labels[i] for i in order], dtype=np.int8)
        self.blocks = -(-len(order) // BLOCK)
        term = np.concatenate([vectors[i][0] for i in order]).astype(np.int64)
        place = np.repeat(np.arange(len(order)), [len(vectors[i][0]) for i in order])
        by_term = np.argsort(term, kind="stable")
        term, self.places = term[by_term], place[by_term]
        self.weights = np.concatenate([vectors[i][1] for i in order])[by_term]
        block = self.places // BLOCK
        self.start = np.flatnonzero(np.r_[True, (term[1:] != term[:-1]) | (block[1:] != block[:-1])])
        self.size = np.diff(np.r_[self.start, len(term)])
        self.block, self.most = block[self.start], np.maximum.reduceat(self.weights, self.start)
        #: entries of term f: from first[f] to first[f + 1]
        self.first = np.searchsorted(term[self.start], np.arange(int(term[-1]) + 2))

    def nearest(self, at: np.ndarray, w: np.ndarray, k: int, without: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Places and cosines of the ``k`` best examples of positive cosine, exact; ties by id."""
        known = at < len(self.first) - 1
        at, w = at[known], w[known]
        size = self.first[at + 1] - self.first[at]
        entries, x = _spans(self.first[at], size), np.repeat(w, size)
        bound = np.bincount(self.block[entries], weights=x * self.most[entries], minlength=self.blocks)
        order = np.argsort(-bound, kind="stable")[: np.count_nonzero(bound)]
        turn = np.full(self.blocks, len(order))
        turn[order] = np.arange(len(order))
        turn = turn[self.block[entries]]
        places, cosines, kth, seen, group = np.empty(0, dtype=np.int64), np.empty(0), 0.0, 0, FIRST_GROUP
        while seen < len(order) and (len(places) < k or bound[order[seen]] >= kth - 1e-12):
            here = np.flatnonzero((turn >= seen) & (turn < seen + group))
            postings = _spans(self.start[entries[here]], self.size[entries[here]])
            cosine = np.bincount(self.places[postings], weights=np.repeat(x[here], self.size[entries[here]]) * self.weights[postings])
            hit = np.flatnonzero(cosine)
            cosine = np.minimum(1.0, cosine[hit])
            other = slice(None) if without is None else self.ids[hit] != without
            places, cosines = np.r_[places, hit[other]], np.r_[cosines, cosine[other]]
            if len(places) > k:  # the k best, and all that tie with the last
                kth = np.partition(cosines, -k)[-k]
                good = cosines >= kth - 1e-9
                places, cosines = places[good], cosines[good]
            seen, group = seen + group, 2 * group
        best = np.lexsort((self.ids[places], -np.round(cosines, 12)))[:k]
        return places[best], cosines[best]

    def vote(self, places: np.ndarray, cosines: np.ndarray, prior: float) -> float:
        w = cosines ** 2
        return float(((w * self.labels[places]).sum() + PRIOR_WEIGHT * prior) / (w.sum() + PRIOR_WEIGHT))


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool-adjacent-violators: points of the rising step curve of least squares."""
    blocks: list[list[float]] = []
    order = np.argsort(x, kind="stable")
    for a, b in zip(x[order], y[order], strict=True):
        if blocks and blocks[-1][0] == a:
            blocks[-1][1:] = [blocks[-1][1] + b, blocks[-1][2] + 1]
        else:
            blocks.append([float(a), float(b), 1.0])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            top = blocks.pop()
            blocks[-1] = [top[0], blocks[-1][1] + top[1], blocks[-1][2] + top[2]]
    return np.array([b[0] for b in blocks]), np.array([b[1] / b[2] for b in blocks])


class Model:
    def __init__(self, weights: dict[str, float], examples: list[tuple[int, int, list, list]], prior: float, none: float):
        self.names = list(weights)
        self.wanted = Wanted(weights)
        self.prior, self.none, self.index, self.steps = prior, none, None, None
        if examples:
            self.index = Index([e[0] for e in examples], [e[1] for e in examples],
                               [(np.array(at, dtype=np.int32), np.array(w)) for _, _, at, w in examples])

    def own_vote(self, doc_id: int, at, w) -> float:
        """The vote of an example's neighbours."""
        return self.index.vote(*self.index.nearest(np.asarray(at), np.asarray(w), NEIGHBOURS, without=doc_id), self.prior)

    def score(self, doc_id: int | None, text: str | None) -> tuple[float, list[str], list[str]]:
        at, w = vector(text, self.wanted) if self.index else ((), ())
        if not len(at):
            return self.none, [], []
        places, cosines = self.index.nearest(at, w, NEIGHBOURS, without=doc_id)
        vote = self.index.vote(places, cosines, self.prior)
        score = float(np.interp(vote, *self.steps))
        near = [f"id {self.index.ids[p]}: toxic {self.index.labels[p]}, cosine {c:.4f}"
                for p, c in zip(places[:3], cosines[:3], strict=True)]
        return score, near, [self.names[at[i]] for i in np.argsort(-np.asarray(w), kind="stable")[:3]]


def fit(docs: DataFrame, labels: DataFrame, max_examples: int = MAX_EXAMPLES) -> Model:
    import pyarrow as pa

    train = training(docs, labels)
    train = train.withColumn("example", chosen(F.col("doc_id"), train.count(), max_examples))
    weights, n1, n0 = choose_terms(term_counts(train))
    context, wanted = docs.sparkSession.sparkContext, Wanted(weights)
    shared = context.broadcast(wanted)

    def vectors(batches):  # of other documents than examples, only whether they have a term
        for batch in batches:
            found = [vector(t, shared.value) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("toxic"), batch.column("example"),
                pa.array([at.tolist() if example else at[:1].tolist() for (at, _), example in zip(found, batch.column("example").to_pylist(), strict=True)],
                         pa.list_(pa.int32())),
                pa.array([w.tolist() if example else [] for (_, w), example in zip(found, batch.column("example").to_pylist(), strict=True)],
                         pa.list_(pa.float64()))], ["doc_id", "toxic", "example", "at", "w"])

    made = cut(train.select(F.col("doc_id").cast("long"), "text", "toxic", "example")
               .mapInArrow(vectors, "doc_id long, toxic int, example boolean, at array<int>, w array<double>"))
    shared.destroy()
    without = {bool(r["toxic"]): r["count"] for r in made.where("size(at) = 0").groupBy("toxic").count().collect()}
    examples = made.where("example AND size(at) > 0")
    rows = examples.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_examples).collect()  # the hash has left few more
    none = (without.get(True, 0) + 1) / (sum(without.values()) + 2)
    model = Model(weights, sorted((r["doc_id"], int(bool(r["toxic"])), r["at"], r["w"]) for r in rows), n1 / max(1, n1 + n0), none)
    if model.index:
        model.steps = isotonic(*own_votes(examples, model))
    return model


def own_votes(examples: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Leave-one-out votes of the examples, searched for in tasks, and their labels."""
    import pyarrow as pa

    shared = examples.sparkSession.sparkContext.broadcast(model)

    def compute(batches):
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("doc_id", "at", "w")), strict=True)
            votes = [shared.value.own_vote(*r) for r in rows]
            yield pa.RecordBatch.from_arrays([pa.array(votes, pa.float64()), batch.column("toxic")], ["vote", "toxic"])

    found = (examples.mapInArrow(compute, "vote double, toxic int")
             .groupBy("vote").agg(F.sum((F.col("toxic") != 0).cast("double")).alias("toxic"), F.count(F.lit(1)).alias("n")).collect())
    shared.destroy()
    found.sort(key=lambda r: r["vote"])
    x = np.repeat([r["vote"] for r in found], [r["n"] for r in found])
    y = np.concatenate([np.repeat([1.0, 0.0], [int(r["toxic"]), r["n"] - int(r["toxic"])]) for r in found])
    return x, y


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted, neighbours, evidence`` of every row; the model has bounded size."""
    import pyarrow as pa

    shared = docs.sparkSession.sparkContext.broadcast(model)

    def compute(batches):
        for batch in batches:
            found = list(map(shared.value.score, batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()))
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array([s for s, _, _ in found], pa.float64()),
                pa.array([near for _, near, _ in found], pa.list_(pa.string())),
                pa.array([why for _, _, why in found], pa.list_(pa.string()))], ["doc_id", "score", "neighbours", "evidence"])

    scored = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        compute, "doc_id long, score double, neighbours array<string>, evidence array<string>")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "neighbours", "evidence")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, fit(docs, labels))
