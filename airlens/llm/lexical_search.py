"""Ranked lexical search by exact inner products over sparse ball trees.

A document is a vector over the terms of the searched items: ``(1000000000 * tf) div (1000 * tf + 12 * m)`` where m grows with its
length; an item is a vector of term weights times occurrences; the score is their inner product, all in integers.

Items are taken in blocks whose terms fit a broadcast of bounded size. Per block one scan of the documents keeps the occurrences of the
block's terms (a table in the shared folder), from which the counts over all documents follow. Then each task reads its documents in
groups of bounded size and makes a ball tree of each: a node has a centre, and for every *field* of terms a radius, the largest
distance of one of its documents from the centre within that field. Fields are the terms that just one item has, item by item, and,
for terms of several items, bands of like weight; so a node without an item's own terms has radius and centre 0 there. By Cauchy
and Schwarz no document of the node scores more than

    sum over the item's terms of weight * centre  +  sum over fields of (length of the item's vector in the field) * radius

which is raised by more than the rounding of doubles can take off. Nodes are visited by their bounds, largest first; once the best bound
is below the score of the ``top``-th best document so far, nothing is left to find. Leaves are scored exactly, in 64-bit integers.
A task's best documents go on to its next groups; a window over the tasks' best gives the ranks. The result does not depend on how
documents are dealt to tasks, groups or trees.

A row of documents is a document; null text has no terms. Documents without an id count in all statistics but cannot be ranked. Texts of one
item_id belong together (equal ones count once); items without an id or terms, and empty tables, give no rows. Equal scores are
ranked by doc_id. Other columns are not looked at.
"""

import heapq
import math
import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from airlens.llm.common import checkpoint_dir
from airlens.shared import discard, materialized

TOP = 20
#: bytes of item text in a block, documents and entries in a tree, documents in a leaf, bands of shared terms
BLOCK_BYTES, TREE_DOCS, TREE_ENTRIES, LEAF, BANDS = 256 << 10, 4096, 1 << 20, 16, 256
#: text looked at at once
SLICE = 2 << 20
#: rounding of a sum of doubles stays far below this share of it
SLACK = 1e-9

#: upper case becomes lower case, all ASCII but digits and letters a blank
PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
VECTORS = "n long, terms binary, tfs binary"


def terms(text: bytes) -> list[bytes]:
    return text.translate(PLAIN).split()


# --- documents as vectors --------------------------------------------------------------
def _vectors(shared):
    """Terms of a document: their number, and of those searched for the places and occurrences. ``shared``: places from 1."""
    def vectors(batches):
        number = shared.value
        for batch in batches:
            ids, n, found, tfs, first, size = batch.column(0), [], [], [], 0, 0
            rows = lambda end: pa.RecordBatch.from_arrays([
                ids.slice(first, end - first), pa.array(n, pa.int64()), pa.array(found, pa.binary()), pa.array(tfs, pa.binary())],
                ["doc_id", "n", "terms", "tfs"])
            for k, text in enumerate(batch.column(1)):
                words = terms(bytes(text.as_buffer())) if text.is_valid else []
                known, tf = np.unique(np.array(list(filter(None, map(number.get, words))), np.int32) - 1, return_counts=True)
                n.append(len(words)), found.append(known.astype(np.int32).tobytes()), tfs.append(tf.astype(np.int32).tobytes())
                size += len(known)
                if size >= SLICE // 8:
                    yield rows(k + 1)
                    n, found, tfs, first, size = [], [], [], k + 1, 0
            if n:
                yield rows(batch.num_rows)
    return vectors


def _frequencies(terms_searched: int):
    def count(batches):
        df = np.zeros(terms_searched, np.int64)
        for batch in batches:
            for x in batch.column(0):
                df[np.frombuffer(x.as_buffer(), np.int32)] += 1
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(terms_searched)), pa.array(df)], ["term", "df"])
    return count


# --- trees --------------------------------------------------------------------------------
class Items:
    """The items of a block: their vectors over term numbers, and the fields of terms.

    ``vectors`` maps an item to its terms and occurrences, ``df`` has the documents of each term.
    """

    def __init__(self, vectors: dict, df: np.ndarray, documents: int, length: int):
        self.documents, self.length, self.ids = documents, length, list(vectors)
        weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(x) + 1))) for x in df], np.int64)
        owners = Counter(t for words, _ in vectors.values() for t in words)
        shared = np.array(sorted(t for t, c in owners.items() if c > 1), np.int64)
        self.field = np.zeros(len(df), np.int64)
        order = shared[np.argsort(weight[shared], kind="stable")]
        for band, some in enumerate(np.array_split(order, BANDS)):
            self.field[some] = band
        self.terms, self.weights, self.norms = [], [], []
        for k, (words, times) in enumerate(vectors.values()):
            words, times = np.array(words, np.int64), np.array(times, np.int64)
            self.field[words[[owners[t] == 1 for t in words.tolist()]]] = BANDS + k
            self.terms.append(words)
            self.weights.append(weight[words] * times)
        for words, weights in zip(self.terms, self.weights):
            fields, place = np.unique(self.field[words], return_inverse=True)
            self.norms.append((fields, np.sqrt(np.bincount(place, weights.astype(np.float64) ** 2, len(fields)))))

    def values(self, n: int, tf: np.ndarray) -> np.ndarray:
        m = 100 - 25 + 25 * n * self.documents // self.length
        return 1_000_000_000 * tf // (1000 * tf + 12 * m)


class Tree:
    """A ball tree over documents given as rows of (id, terms, values), none without terms. Children of node k are 2k + 1 and 2k + 2."""

    def __init__(self, rows: list, items: Items):
        self.ids = np.array([x[0] for x in rows], np.int64)
        self.terms, self.values = np.concatenate([x[1] for x in rows]), np.concatenate([x[2] for x in rows])
        self.starts = np.concatenate([[0], np.cumsum([len(x[1]) for x in rows])])
        self.owner = np.repeat(np.arange(len(rows)), np.diff(self.starts))
        self.used = np.unique(self.terms)
        self.local = np.searchsorted(self.used, self.terms)
        self.norm2 = np.bincount(self.owner, self.values.astype(np.float64) ** 2, len(rows))
        depth = max(0, math.ceil(math.log2(len(rows) / LEAF)))
        self.leaves_from, nodes = (1 << depth) - 1, (1 << (depth + 1)) - 1
        self.centres = np.zeros((nodes, len(self.used)))
        self.fields, field = np.unique(items.field[self.used], return_inverse=True)
        self.radii = np.zeros((nodes, len(self.fields)))
        self.members, self.leaves = [None] * nodes, {}
        self.members[0] = np.arange(len(rows))
        for node in range(nodes):
            docs = self.members[node]
            at, who = self._entries(docs)
            self._ball(node, docs, at, who, field)
            if node < self.leaves_from:
                order = docs[np.argsort(self._direction(docs, at, who), kind="stable")]
                half = (len(order) + 1) // 2
                self.members[2 * node + 1], self.members[2 * node + 2] = order[:half], order[half:]
            elif len(docs):
                self.leaves[node] = self.local[at], self.values[at], np.flatnonzero(np.diff(who, prepend=-1))

    def _entries(self, docs):
        """Places of the entries of ``docs``, and the place in ``docs`` each belongs to."""
        sizes = self.starts[docs + 1] - self.starts[docs]
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[docs] - (ends - sizes), sizes)
        return at, np.repeat(np.arange(len(docs)), sizes)

    def _ball(self, node, docs, at, who, field):
        if not len(docs):
            return
        v, t = self.values[at].astype(np.float64), self.local[at]
        centre = np.bincount(t, v, len(self.used)) / len(docs)
        self.centres[node] = centre
        # squared distance in a field: the centre's square, and for each entry what it makes of the centre's share
        inside = np.bincount(field, centre ** 2, len(self.fields))
        change = np.bincount(who * len(self.fields) + field[t], (v - centre[t]) ** 2 - centre[t] ** 2, len(docs) * len(self.fields))
        furthest = change.reshape(len(docs), -1).max(axis=0) + inside
        # differences of squares lose digits: what they may lose is added
        lost = SLACK * (inside + np.bincount(field[t], v ** 2, len(self.fields)))
        self.radii[node] = np.sqrt(np.maximum(furthest, 0) + lost)

    def _direction(self, docs, at, who):
        """Where each document lies between two that are far apart."""
        v, t = self.values[at].astype(np.float64), self.local[at]

        def along(k):
            dense = np.zeros(len(self.used))
            mine = who == k
            dense[t[mine]] = v[mine]
            return np.bincount(who, v * dense[t], len(docs))

        one = along(int(np.argmax(self.norm2[docs])))
        a = int(np.argmax(self.norm2[docs] - 2 * one))
        to_a = along(a)
        b = int(np.argmax(self.norm2[docs] - 2 * to_a))
        return to_a - along(b)

    def search(self, words: np.ndarray, weights: np.ndarray, norms, best: list, top: int) -> None:
        """Put documents that belong there into ``best``, a heap of (score, -id) of at most ``top``."""
        place = np.searchsorted(self.used, words)
        here = (place < len(self.used)) & (self.used[np.minimum(place, len(self.used) - 1)] == words)
        if not here.any():
            return
        place, weights = place[here], weights[here]
        at = np.searchsorted(self.fields, norms[0])
        there = (at < len(self.fields)) & (self.fields[np.minimum(at, len(self.fields) - 1)] == norms[0])
        bound = self.centres[:, place] @ weights.astype(np.float64) + self.radii[:, at[there]] @ norms[1][there]
        bound = bound * (1 + SLACK) + 1
        query = np.zeros(len(self.used), np.int64)
        query[place] = weights
        heap = [(-bound[0], 0)]
        while heap:
            limit, node = heapq.heappop(heap)
            if len(best) == top and -limit < best[0][0]:
                return
            if node < self.leaves_from:
                for child in (2 * node + 1, 2 * node + 2):
                    if len(self.members[child]):
                        heapq.heappush(heap, (max(limit, -bound[child]), child))
                continue
            docs = self.members[node]
            words_here, values, first = self.leaves[node]
            scores = np.add.reduceat(query[words_here] * values, first)
            least = best[0][0] if len(best) == top else 1
            for k in np.flatnonzero(scores >= least).tolist():
                one = (int(scores[k]), -int(self.ids[docs[k]]))
                if len(best) < top:
                    heapq.heappush(best, one)
                elif one > best[0]:
                    heapq.heapreplace(best, one)


def _search(shared, top: int, kinds: tuple):
    def search(batches):
        items, best, rows, entries = shared.value, {}, [], 0

        def look():
            tree = Tree(rows, items)
            for k, words in enumerate(items.terms):
                tree.search(words, items.weights[k], items.norms[k], best.setdefault(k, []), top)

        for batch in batches:
            for doc, n, found, tfs in zip(*batch.columns):
                found = np.frombuffer(found.as_buffer(), np.int32).astype(np.int64)
                rows.append((doc.as_py(), found, items.values(n.as_py(), np.frombuffer(tfs.as_buffer(), np.int32).astype(np.int64))))
                entries += len(found)
                if len(rows) >= TREE_DOCS or entries >= TREE_ENTRIES:
                    look()
                    rows, entries = [], 0
        if rows:
            look()
        found = [(items.ids[k], -doc, score) for k, some in best.items() for score, doc in some]
        if found:
            ids, docs, scores = zip(*found)
            yield pa.RecordBatch.from_arrays([pa.array(ids, kinds[0]), pa.array(docs, pa.int64()), pa.array(scores, pa.int64())],
                                             ["item_id", "doc_id", "score"])
    return search


# --- on the tables ----------------------------------------------------------------------
def _block(items: DataFrame) -> tuple[dict, dict]:
    """Vectors of a block's items (their text is bounded), and the number of each term."""
    number, vectors = {}, {}
    for item_id, texts in items.collect():
        found = Counter(number.setdefault(t, len(number)) for text in sorted(map(bytes, texts)) for t in terms(text))
        if found:
            vectors[item_id] = (list(found), list(found.values()))
    return vectors, number


def rank(docs: DataFrame, benchmark: DataFrame, top: int = TOP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The ``top`` best documents with a score above 0 of each item: item_id, rank (from 1), doc_id, score."""
    spark = docs.sparkSession
    base = f"{checkpoint_dir(spark)}/search-{uuid.uuid4().hex}"
    items = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").groupBy("item_id").agg(
        F.collect_set(F.col("text").cast("binary")).alias("texts"))
    size = items.agg(F.sum(F.aggregate("texts", F.lit(0).cast("long"), lambda s, x: s + F.octet_length(x)))).first()[0] or 0
    blocks = max(1, math.ceil(size / block_bytes))
    kind = benchmark.schema["item_id"].dataType.simpleString()
    found = spark.createDataFrame([], f"item_id {kind}, doc_id long, score long")
    item_type = found.select("item_id").toArrow().schema.field(0).type
    for block in range(blocks):
        vectors, number = _block(items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block))
        if not vectors:
            continue
        shared = spark.sparkContext.broadcast({t: k + 1 for t, k in number.items()})
        stored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).mapInArrow(
            _vectors(shared), f"doc_id long, {VECTORS}").where("n > 0")
        stored = materialized(stored, f"{base}-{block}")
        shared.destroy()
        documents, length = stored.agg(F.count("*"), F.sum("n")).first()
        counted = stored.select("terms").mapInArrow(_frequencies(len(number)), "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
        df = np.zeros(len(number), np.int64)
        for term, times in counted.collect():  # one row per term of the block
            df[term] = times
        shared = spark.sparkContext.broadcast(Items(vectors, df, documents, length or 1))
        best = stored.where("doc_id IS NOT NULL AND length(terms) > 0").mapInArrow(
            _search(shared, top, (item_type,)), f"item_id {kind}, doc_id long, score long")
        found = found.unionByName(materialized(best, f"{base}-{block}-best"))
        shared.destroy()
        discard(spark, f"{base}-{block}")
    place = W.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    return found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")
