"""Removal of repeated long byte strings (operator 3) with run-length Burrows-Wheeler indexes.

A byte goes if some ``length``-byte string that covers it also starts earlier: in a document of smaller id,
or earlier in the same one. Strings are judged on the input.

1. Every window of ``length`` bytes is keyed by the smallest hash of its 16-byte grams, so equal windows have equal keys.
   Windows in a row with one key form a run. Keys held by one run only cannot repeat and are left here: on most text nearly all.
2. Copies of a whole text are found by digest. Of each group only the first takes part further.
3. Runs with a repeated key are cut from their documents as segments. A batch of documents keeps one of equal
   segments. Keys of more than ``HOT`` runs are split: their segments become single windows, each by a key of its own and
   represented by its 128-bit digest, so no key gathers an unbounded number of different segments.
4. Segments meet by key. Each task indexes those of keys with several different ones, some megabytes at a time with keys never split: suffix order, run-compressed
   transform, and for the first and last row of each run its text position and match length with the row before or after.
   Matching statistics of all other positions follow from these samples as the text is streamed: a
   position whose row is inside a run matches one byte less than the position before it. Windows whose statistic reaches ``length``
   and that are not the first of their kind are marked.
5. Marks return to their documents.

Defined cases: null and short texts lose nothing; rows without doc_id come after all others; rows of equal doc_id and text
count as one document and return equal rows; rows of equal doc_id and different text are different documents, in order of a hash
of the text; other columns are ignored; an empty table gives an empty result.
"""

import hashlib

import numpy as np
from pyspark.sql import DataFrame, functions as F

from airlens.llm.common import broadcast_if_small, cut

LENGTH = 100
GRAM = 16
#: runs of one key beyond which its segments are split into windows
HOT = 5000
#: places in all marks, and five for each document with any, that may be broadcast (about 12 bytes each, 60 MB); beyond it
#: marks meet texts by a shuffle of the texts
MOST_BROADCAST = 5_000_000
#: bytes of text handled at a time while hashing, and while indexing
SLICE = 4 << 20
CHUNK = 2 << 20
LAST = (1 << 63) - 1
#: a run's place is start * 2**20 + windows, and half of 2**20 more if the run may repeat within itself
N_BITS = 20
SELF = 1 << N_BITS - 1
MOST_N = SELF - 1
_SEG = "key long, doc long, tag long, place long, seg binary"


def _hashes(text: np.ndarray, length: int) -> np.ndarray:
    """A 64-bit hash of every ``length`` bytes in a row, by doubling."""
    h, p, size = text.astype(np.uint64), 0x9E3779B97F4A7C15, 1
    whole, done = None, 0
    while True:
        if length & size:
            whole = h if whole is None else whole[: len(whole) - size] * np.uint64(p) + h[done:]
            done += size
        if done == length:
            break
        h = h[:-size] * np.uint64(p) + h[size:]
        p, size = p * p % (1 << 64), 2 * size
    h = whole ^ (whole >> np.uint64(29))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` over every ``width`` values in a row."""
    size = 1
    while 2 * size <= width:
        values = pick(values[:-size], values[size:])
        size *= 2
    return values if size == width else pick(values[: len(values) - (width - size)], values[width - size:])


def runs_of(text: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys, starts, numbers of windows, and weights of the runs of a text; weight 2 if a run may repeat within itself."""
    width = length - GRAM + 1
    grams = _hashes(text, GRAM)
    keys = _sliding(grams, width, np.minimum)
    start = np.r_[0, np.flatnonzero(keys[1:] != keys[:-1]) + 1]
    n = np.diff(np.r_[start, len(keys)])
    # a run holds two equal windows only if its key occurs twice in it, at most ``width`` apart
    padded = np.r_[np.zeros(width - 1, np.uint64), keys, np.zeros(width - 1, np.uint64)]
    at = np.flatnonzero(grams == _sliding(padded, width, np.maximum))
    order = np.lexsort((at, grams[at]))
    at = at[order]
    twice = (grams[at[1:]] == grams[at[:-1]]) & (np.diff(at) <= width)
    weight = 1 + np.isin(keys[start], grams[at[1:]][twice]).astype(np.int32)
    most = MOST_N
    if len(n) and n.max() > most:  # cut very long runs
        parts = -(-n // most)
        begin = np.concatenate([start[i] + most * np.arange(k) for i, k in enumerate(parts)])
        end = np.repeat(start + n, parts)
        keys_, weight = np.repeat(keys[start], parts), np.repeat(weight, parts)
        return keys_.view(np.int64), begin, np.minimum(most, end - begin), weight
    return keys[start].view(np.int64), start, n, weight


def _slices(text: np.ndarray, length: int):
    for a in range(0, max(1, len(text) - length + 1), SLICE):
        yield a, text[a:a + SLICE + length - 1]


def document_runs(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``key, doc, tag, place, weight`` of all runs of ``doc, tag, bytes``."""
    import pyarrow as pa

    def compute(batches):
        for batch in batches:
            found = []
            for doc, tag, content in zip(batch.column("doc").to_pylist(), batch.column("tag").to_pylist(),
                                         batch.column("bytes").to_pylist(), strict=True):
                if len(content) < length:
                    continue
                for offset, part in _slices(np.frombuffer(content, np.uint8), length):
                    keys, start, n, weight = runs_of(part, length)
                    found.append((keys, np.full(len(keys), doc), np.full(len(keys), tag),
                                  (start + offset << N_BITS) + n + np.where(weight > 1, SELF, 0), weight))
            if found:
                columns = [np.concatenate(x) for x in zip(*found, strict=True)]
                for a in range(0, len(columns[0]), 100_000):
                    yield pa.RecordBatch.from_arrays([
                        pa.array(c[a:a + 100_000], t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32()), strict=True)],
                        ["key", "doc", "tag", "place", "weight"])

    return docs.mapInArrow(compute, "key long, doc long, tag long, place long, weight int")


def _joined(marks: list[tuple]):
    """Marks ``doc, start, tag, n`` with those that follow one another in a document made one: ``doc, tag, start, n``."""
    held = None
    for doc, tag, start, n in sorted((doc, tag, start, n & MOST_N) for doc, start, tag, n in marks):
        if held and held[:2] == (doc, tag) and start <= held[2] + held[3] and start + n - held[2] <= MOST_N:
            held = (doc, tag, held[2], max(held[3], start + n - held[2]))
            continue
        if held:
            yield held
        held = (doc, tag, start, n)
    if held:
        yield held


def segments(found: DataFrame, length: int = LENGTH) -> DataFrame:
    """Segments of ``doc, tag, bytes, runs``; without ``seg`` a row is a mark: an equal segment starts earlier in its batch."""
    import pyarrow as pa
    import xxhash

    def compute(batches):
        for batch in batches:
            first, marks = {}, []

            def add(key, content, owner, first=first, marks=marks):
                held = first.get(content)
                if held is None or owner < held[1]:
                    first[content] = (key, owner)
                    owner = held[1] if held else None
                if owner is not None:
                    marks.append(owner)

            for doc, tag, content, runs in zip(*[batch.column(c).to_pylist() for c in ("doc", "tag", "bytes", "runs")], strict=True):
                for run in runs:
                    start, n, own = run["place"] >> N_BITS, run["place"] & MOST_N, run["place"] & SELF
                    if not run["hot"]:
                        add(run["key"], content[start:start + n + length - 1], (doc, start, tag, n + own))
                        continue
                    for at in range(start, start + n):
                        digest = xxhash.xxh128_digest(content[at:at + length])
                        add(int.from_bytes(digest[:8], "big", signed=True), digest, (doc, at, tag, 1))
            rows = [(key, doc, tag, (start << N_BITS) + n, seg) for seg, (key, (doc, start, tag, n)) in first.items()]
            rows += [(doc, doc, tag, (start << N_BITS) + n, None) for doc, tag, start, n in _joined(marks)]
            for a in range(0, len(rows), 20_000):
                columns = list(zip(*rows[a:a + 20_000], strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)],
                    ["key", "doc", "tag", "place", "seg"])

    return found.select("doc", "tag", "bytes", "runs").mapInArrow(compute, _SEG)


class RunIndex:
    """Run-compressed Burrows-Wheeler transform of texts that end in distinct, ever greater terminators.

    ``first`` and ``last`` hold, per run, the text positions of its first and last row; ``before`` and ``after`` the
    lengths of their matches with the row above and below. ``order`` is the suffix order the transform was made from.
    """

    def __init__(self, texts: list[bytes]):
        sizes = np.array([len(t) for t in texts])
        self.ends = np.cumsum(sizes + 1) - 1  # places of the terminators
        self.text = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)
        n = len(self.text)
        self.rest = np.repeat(self.ends, sizes + 1) - np.arange(n)  # bytes before the terminator
        self.order = self._suffix_order()
        before = self.order - 1
        symbols = np.where(before >= 0, self.text[before], 0).astype(np.int32)
        alone = (before < 0) | (self.rest[before] == 0)  # what precedes is a terminator, unlike all others
        symbols[alone] = 256 + np.arange(n)[alone]
        head = np.r_[True, symbols[1:] != symbols[:-1]]
        self.starts = np.flatnonzero(head)
        self.symbols = symbols[self.starts]
        tails = np.r_[self.starts[1:] - 1, n - 1]
        self.first, self.last = self.order[self.starts], self.order[tails]
        self.before = self._match(self.first, self.order[self.starts - 1])
        self.before[0] = 0
        self.after = np.r_[self.before[1:], 0]  # the row below a run's last row is the next run's first

    def _suffix_order(self) -> np.ndarray:
        """Prefix doubling from seven bytes; suffixes that have ended differ by their terminators, in text order."""
        n, step = len(self.text), 7
        key = np.zeros(n, dtype=np.int64)
        for k in range(step):
            shifted = np.zeros(n, dtype=np.int64)
            shifted[: n - k] = self.text[k:]
            key = key * 256 + np.where(self.rest > k, shifted, 0)
        key = key * 8 + np.minimum(self.rest, step)
        while True:
            order = np.argsort(key, kind="stable")
            in_order = key[order]
            new = np.r_[False, (in_order[1:] != in_order[:-1]) | (self.rest[order[1:]] < step)]
            rank = np.empty(n, dtype=np.int64)
            rank[order] = np.cumsum(new)
            if rank[order[-1]] == n - 1:
                return order
            after = np.zeros(n, dtype=np.int64)
            after[: n - step] = rank[step:] + 1
            key = rank * (n + 1) + np.where(self.rest >= step, after, 0)
            step *= 2

    def _match(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Lengths of the common prefixes of suffixes."""
        size = np.zeros(len(a), dtype=np.int64)
        most = np.minimum(self.rest[a], self.rest[b])
        live = np.flatnonzero(most > 0)
        while len(live):
            same = self.text[a[live] + size[live]] == self.text[b[live] + size[live]]
            live = live[same]
            size[live] += 1
            live = live[size[live] < most[live]]
        return size

    def _streamed(self, at: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Match lengths of all positions from those of the sampled ones, in text order."""
        sampled = np.full(len(self.text), -1, dtype=np.int64)
        sampled[at] = np.arange(len(at))
        place = np.maximum.accumulate(np.where(sampled >= 0, np.arange(len(self.text)), 0))
        return np.maximum(0, size[sampled[place]] - (np.arange(len(self.text)) - place))

    def matching_statistics(self) -> np.ndarray:
        """For each position, the length of its longest match elsewhere in the texts."""
        return np.maximum(self._streamed(self.first, self.before), self._streamed(self.last, self.after))

    def repeated(self, length: int) -> np.ndarray:
        """True where a string of ``length`` bytes starts that also starts earlier in the texts."""
        found = np.zeros(len(self.text), dtype=bool)
        above = self._streamed(self.first, self.before)[self.order]  # match of each row with the row above
        group = np.flatnonzero(np.r_[True, above[1:] < length])
        first = np.minimum.reduceat(self.order, group)
        found[np.flatnonzero(self.matching_statistics() >= length)] = True
        found[first] = False
        return found


def _promising(texts: list[bytes], length: int) -> list[bytes]:
    """The texts, in order, with a window whose hash occurs twice among all; the others hold no repeated window."""
    if not texts:
        return []
    sizes = np.array([len(t) for t in texts])
    n = np.maximum(0, sizes - length + 1)
    owner = np.repeat(np.arange(len(texts)), n)
    at = np.arange(n.sum()) + np.repeat(np.cumsum(sizes) - sizes - (np.cumsum(n) - n), n)
    if not len(at):
        return []
    found = _hashes(np.frombuffer(b"".join(texts), np.uint8), length)[at]
    order = np.argsort(found, kind="stable")
    same = found[order[1:]] == found[order[:-1]]
    hit = np.zeros(len(texts), dtype=bool)
    hit[owner[order[1:][same]]] = hit[owner[order[:-1][same]]] = True
    return [texts[k] for k in np.flatnonzero(hit)]


def _marked(rows: list[tuple], length: int):
    """Marks (doc, tag, place) of segment rows ``key, doc, tag, place, seg``, whole keys in any order.

    Segments are indexed where their key has several different ones, or where one may repeat within itself, and if a hash
    shows that some window may occur twice; copies of one segment need no index.
    """
    rows.sort(key=lambda r: (r[1], r[3] >> N_BITS, r[2]))
    contents: dict[int, set[bytes]] = {}
    for r in rows:
        contents.setdefault(r[0], set()).add(r[4])
    place: dict[bytes, int] = {}
    for r in rows:
        if len(contents[r[0]]) > 1 or r[3] & SELF:
            place.setdefault(r[4], len(place))
    place = {seg: k for k, seg in enumerate(_promising(list(place), length))}
    if place:
        index = RunIndex(list(place))
        again = index.repeated(length)
        begin = np.r_[0, index.ends[:-1] + 1]
    seen = set()
    for _, doc, tag, at, seg in rows:
        start, n = at >> N_BITS, at & MOST_N
        if seg in seen:  # a later copy of a whole segment
            yield doc, tag, (start << N_BITS) + n
            continue
        seen.add(seg)
        if (k := place.get(seg)) is None:
            continue
        hit = np.flatnonzero(np.diff(np.r_[0, again[begin[k]:begin[k] + n], 0]))
        for a, b in zip(hit[::2].tolist(), hit[1::2].tolist(), strict=True):
            yield doc, tag, (start + a << N_BITS) + b - a


def mark(segs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``doc, tag, place``: runs of windows that start earlier elsewhere."""
    import pyarrow as pa

    def out(found):
        for a in range(0, len(found), 50_000):
            columns = list(zip(*found[a:a + 50_000], strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc", "tag", "place"])

    def compute(batches):
        held, size = [], 0
        for batch in batches:
            rows = list(zip(*[batch.column(c).to_pylist() for c in ("key", "doc", "tag", "place", "seg")], strict=True))
            yield from out([r[1:4] for r in rows if r[4] is None])
            for r in rows:
                if r[4] is None:
                    continue
                if size >= CHUNK and r[0] != held[-1][0]:
                    yield from out(list(_marked(held, length)))
                    held, size = [], 0
                held.append(r)
                size += len(r[4])
        if held:
            yield from out(list(_marked(held, length)))

    dealt = segs.repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(compute, "doc long, tag long, place long")


def remaining(content: bytes, places: list[int], length: int) -> tuple[bytes, int]:
    """The bytes that stay, and the number of removed runs, if ``places`` are the repeated windows."""
    spans: list[list[int]] = []
    for place in sorted(places):
        start, n = place >> N_BITS, place & MOST_N
        end = start + n - 1 + length
        if spans and start <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], end)
        else:
            spans.append([start, end])
    kept, at = [], 0
    for a, b in spans:
        kept.append(content[at:a])
        at = b
    return b"".join([*kept, content[at:]]), len(spans)


def keyed_rows(docs: DataFrame, *more) -> DataFrame:
    """``doc, tag, bytes``, by which documents are told apart, and ``more`` columns.

    The tag is a hash of the text where an id has several texts and 0 elsewhere, which takes no room in a shuffle.
    """
    content = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))
    several = cut(docs.select(doc.alias("several"), F.xxhash64(content).alias("_tag")).groupBy("several")
                  .agg(F.min("_tag").alias("_least"), F.max("_tag").alias("_most")).where("_least < _most").select("several"))
    rows = docs.select(doc.alias("doc"), content.alias("bytes"), *more)
    if several.isEmpty():
        return rows.withColumn("tag", F.lit(0).cast("long"))
    joined = rows.join(several, F.col("doc") == F.col("several"), "left")
    return joined.withColumn("tag", F.when(F.col("several").isNotNull(), F.xxhash64("bytes")).otherwise(F.lit(0).cast("long"))).drop("several")


def with_places(keyed: DataFrame, length: int) -> DataFrame:
    """``keyed`` and ``places``, the repeated windows of each document that has any."""
    found = repeats(keyed, length)
    size = found.agg(F.coalesce(F.sum(F.size("places") + 5), F.lit(0))).first()[0]
    return keyed.join(broadcast_if_small(found, size, MOST_BROADCAST), ["doc", "tag"], "left")


def repeats(keyed: DataFrame, length: int) -> DataFrame:
    """``doc, tag, places`` of the documents with repeated windows; checkpointed."""
    named = keyed.select("doc", "tag", "bytes").where(F.octet_length("bytes") >= length)
    digests = named.select("doc", "tag", F.octet_length("bytes").alias("size"), F.sha2("bytes", 256).alias("digest"))
    firsts = digests.groupBy("digest").agg(F.min("doc").alias("_first"), F.max("doc").alias("_max")).where("_first < _max").drop("_max")
    copies = cut(digests.join(firsts, "digest").where("doc > _first").select("doc", "tag", "size").distinct())

    runs = document_runs(named.select("doc", "tag", "bytes"), length)
    held = runs.groupBy("key").agg(F.sum("weight").alias("_n")).where("_n > 1").select("key", (F.col("_n") > HOT).alias("hot"))
    again = runs.join(held, "key").groupBy("doc", "tag").agg(F.collect_list(F.struct("key", "place", "hot")).alias("runs"))
    again = again.join(copies, ["doc", "tag"], "left_anti")
    marks = mark(segments(named.join(again, ["doc", "tag"]), length), length)
    whole = copies.select("doc", "tag", F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - length, F.lit(MOST_N).cast("long"))).alias("a"), "size")
    whole = whole.select("doc", "tag", (F.shiftleft("a", N_BITS) + F.least(
        F.lit(MOST_N), F.col("size") - length + 1 - F.col("a"))).alias("place"))
    return cut(marks.union(whole).groupBy("doc", "tag").agg(F.collect_set("place").alias("places")))


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with the repeated bytes taken from ``text``, what that leaves of a cut character too; ``n_chars`` follows."""
    import pandas as pd

    @F.pandas_udf("string")
    def shortened(contents: pd.Series, places: pd.Series) -> pd.Series:
        return pd.Series([c.decode() if p is None else remaining(c, list(p), length)[0].decode("utf-8", "ignore")
                          for c, p in zip(contents, places, strict=True)], dtype=object)

    joined = with_places(keyed_rows(docs, F.struct("*").alias("row")), length)
    text = F.when(F.col("row.text").isNotNull(), shortened("bytes", "places"))
    made = joined.select("row", text.alias("kept"))
    new = {"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    return made.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def dedup(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every row."""
    import pyarrow as pa

    def compute(batches):
        for batch in batches:
            rows = []
            for content, places in zip(batch.column("bytes").to_pylist(), batch.column("places").to_pylist(), strict=True):
                kept, spans = remaining(content, places or [], length)
                rows.append((len(content), len(content) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(c, pa.int64()) for c in columns[:3]], pa.array(columns[3], pa.string())],
                                             ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    marked = with_places(keyed_rows(docs, F.col("doc_id").cast("long").alias("doc_id")), length)
    return marked.select("doc_id", "bytes", "places").mapInArrow(
        compute, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
