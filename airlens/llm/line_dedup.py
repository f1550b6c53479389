"""Lines found in many documents are dropped from all of them, by a sharded minimal perfect hash.

A line's key is the line without white space at both ends and with A-Z in lower case; its 128-bit hash stands for it. Tasks count in
how many documents each key is found, add up their own counts, and one shuffle of hashes adds up the rest; lines themselves are
never shuffled. Hashes of keys found in ``min_docs`` documents or more are dealt to shards by their first bits, and each shard becomes
a minimal perfect hash: levels of bits, where a key that falls on a bit of its own stays and the others go on to the next level. A
key's number is the count of bits before its own, and is its place in two arrays, of fingerprints (the hash's other half) and of
counts. Every hash gets some place, also one that was never indexed; the fingerprint tells.

Documents probe the arrays in bounded slices of text. An index of up to ``most_keys`` keys (about 13 bytes each) is
broadcast; a larger one is probed in rounds over as many shards as fit, and what a round found travels with the document to the next
one, by way of a table in the shared folder. The result is the same for any number of rounds.

A row is a document: repeated rows, also of one doc_id or none, count each. Null text is empty text: one empty line. An empty key, or one
of fewer than ``min_chars`` characters, is never dropped. A document that loses all its lines becomes empty text. An empty table gives no rows.
Other columns are not looked at.
"""

import math
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from airlens.llm.common import checkpoint_dir
from airlens.shared import discard, materialized

MIN_DOCS = 10
MIN_CHARS = 1
#: keys of a shard, and keys whose arrays may be broadcast at once (about 13 bytes each)
SHARD_KEYS, MOST_KEYS = 1 << 17, 10_000_000
#: text looked at at once, different hashes a task holds, and rows sent at once
SLICE, MOST_HELD, SENT = 4 << 20, 400_000, 1 << 16

SPACE = b" \t\n\v\f\r"
INDEX = "shard long, n long, sizes binary, bits binary, prints binary, counts binary"


# --- lines and their hashes ----------------------------------------------------------------
def _hashes(text: bytes, min_chars: int) -> list[bytes]:
    """The hash of each line's key; empty where the key is too short to be dropped."""
    keys = [line.strip(SPACE) for line in text.lower().split(b"\n")]  # of bytes, so only A-Z change
    short = lambda key: len(key) < min_chars or (min_chars > 1 and len(key.decode(errors="replace")) < min_chars)
    return [b"" if short(key) else xxhash.xxh3_128_digest(key) for key in keys]


def _pairs(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), np.uint64).reshape(-1, 2)


def _count(min_chars: int):
    def count(batches):
        held = Counter()

        def rows():
            digests, counts = list(held), list(held.values())
            for at in range(0, len(digests), SENT):
                h = _pairs(digests[at:at + SENT]).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(h[:, 0]), pa.array(h[:, 1]), pa.array(counts[at:at + SENT], pa.int64())], ["h1", "h2", "c"])
            held.clear()

        for batch in batches:
            for text in batch.column(0):
                text = text.as_buffer()
                if text is not None:
                    held.update({h for h in _hashes(bytes(text), min_chars) if h})
                if len(held) >= MOST_HELD:
                    yield from rows()
        yield from rows()
    return count


def line_counts(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """Hash (h1, h2) and number of documents (n_docs) of every line key found in at least ``min_docs`` of them."""
    counted = docs.select(F.col("text").cast("binary")).mapInArrow(_count(min_chars), "h1 long, h2 long, c long")
    return counted.repartition("h1", "h2").groupBy("h1", "h2").agg(F.sum("c").alias("n_docs")).where(F.col("n_docs") >= min_docs)


# --- the index -----------------------------------------------------------------------------
def _level_hash(h1: np.ndarray, h2: np.ndarray, level: int) -> np.ndarray:
    """Another hash of the two halves per level; odd factors keep apart keys that share a half."""
    x = h1 ^ (h2 * np.uint64(2 * level + 1)) ^ np.uint64((level * 0x9E3779B97F4A7C15) % (1 << 64))
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(33))


def perfect_hash(h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Level sizes in bits, the levels' bits as 64-bit words, and each key's number. Keys must differ."""
    left = np.arange(len(h1))
    sizes, words, places, before = [], [], np.zeros(len(h1), np.int64), 0
    while len(left):
        if len(sizes) == 200:
            raise ValueError("the keys are not distinct")
        size = 64 * math.ceil(1.5 * len(left) / 64)
        at = (_level_hash(h1[left], h2[left], len(sizes)) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(at, minlength=size)[at] == 1
        bits = np.zeros(size, np.uint8)
        bits[at[alone]] = 1
        words.append(np.packbits(bits, bitorder="little").view(np.uint64))
        places[left[alone]] = before + at[alone]
        sizes.append(size)
        before += size
        left = left[~alone]
    bits = np.concatenate(words) if words else np.zeros(0, np.uint64)
    return np.array(sizes, np.int64), bits, _rank(bits, _ranks(bits), places)


def _ranks(words: np.ndarray) -> np.ndarray:
    """Bits set before each word."""
    return np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])[:-1].astype(np.uint32)


def _rank(words: np.ndarray, ranks: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Bits set before each place."""
    word, bit = places >> 6, (places & 63).astype(np.uint64)
    return ranks[word].astype(np.int64) + np.bitwise_count(words[word] & ((np.uint64(1) << bit) - np.uint64(1)))


def _build(shard: pd.DataFrame) -> pd.DataFrame:
    h1, h2 = (shard[c].to_numpy().astype(np.int64).view(np.uint64) for c in ("h1", "h2"))
    sizes, bits, number = perfect_hash(h1, h2)
    prints, counts = np.empty(len(h1), np.uint64), np.empty(len(h1), np.uint32)
    prints[number] = h2
    counts[number] = np.minimum(shard["n_docs"].to_numpy(), (1 << 32) - 1)
    return pd.DataFrame({"shard": [int(shard["shard"].iloc[0])], "n": [len(h1)], "sizes": [sizes.tobytes()], "bits": [bits.tobytes()],
                         "prints": [prints.tobytes()], "counts": [counts.tobytes()]})


def build_index(counts: DataFrame, shard_bits: int) -> DataFrame:
    """One row per shard of hashes that share their first ``shard_bits`` bits."""
    shard = F.shiftrightunsigned("h1", 64 - shard_bits) if shard_bits else F.lit(0).cast("long")
    return counts.withColumn("shard", shard).groupBy("shard").applyInPandas(_build, INDEX)


class Probe:
    """Some shards of an index as arrays that follow one another."""

    def __init__(self, rows, shard_bits: int):
        self.shard_bits, rows = shard_bits, sorted(rows, key=lambda r: r["shard"])
        join = lambda name, kind: np.concatenate([np.zeros(0, kind)] + [np.frombuffer(bytes(r[name]), kind) for r in rows])
        self.bits, self.prints, self.counts = join("bits", np.uint64), join("prints", np.uint64), join("counts", np.uint32)
        levels = [np.frombuffer(bytes(r["sizes"]), np.int64) for r in rows]
        self.first = rows[0]["shard"] if rows else 0
        self.sizes = np.zeros((rows[-1]["shard"] - self.first + 1 if rows else 1, max([len(x) for x in levels], default=0)), np.int64)
        self.starts = np.zeros_like(self.sizes)
        before = 0
        for row, sizes in zip(rows, levels):
            self.sizes[row["shard"] - self.first, :len(sizes)] = sizes
            self.starts[row["shard"] - self.first, :len(sizes)] = before + np.cumsum(sizes) - sizes
            before += int(sizes.sum())
        self.ranks = _ranks(self.bits)

    def count(self, h: np.ndarray) -> np.ndarray:
        """Documents of each hash (rows of two halves); 0 where it is not indexed."""
        found = np.zeros(len(h), np.int64)
        shard = (h[:, 0] >> np.uint64(64 - self.shard_bits) if self.shard_bits else np.zeros(len(h), np.uint64)).astype(np.int64) - self.first
        left = np.flatnonzero((shard >= 0) & (shard < len(self.sizes)))
        for level in range(self.sizes.shape[1]):
            sizes = self.sizes[shard[left], level]
            left, sizes = left[sizes > 0], sizes[sizes > 0]
            at = self.starts[shard[left], level] + (_level_hash(h[left, 0], h[left, 1], level) % sizes.astype(np.uint64)).astype(np.int64)
            hit = (self.bits[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1
            here, number = left[hit], _rank(self.bits, self.ranks, at[hit])
            found[here] = np.where(self.prints[number] == h[here, 1], self.counts[number], 0)
            left = left[~hit]
        return found


# --- documents -----------------------------------------------------------------------------
def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows whose texts are about :data:`SLICE` bytes."""
    first = size = 0
    for k, text in enumerate(batch.column(1)):
        buffer = text.as_buffer()
        size += buffer.size if buffer is not None else 0
        if size >= SLICE:
            yield batch.slice(first, k + 1 - first)
            first, size = k + 1, 0
    if first < batch.num_rows:
        yield batch.slice(first)


def _probe(shared, min_chars: int, last: bool, min_docs: int):
    """Batches of doc_id, text and what earlier rounds found: 32-bit counts, one per line. The last round drops lines."""
    def probe(batches):
        index = shared.value
        for batch in batches:
            for part in _slices(batch):
                texts = [bytes(x.as_buffer()) if x.is_valid else b"" for x in part.column(1)]
                digests = [_hashes(text, min_chars) for text in texts]
                flat = [h for line in digests for h in line]
                known = np.fromiter(map(len, flat), np.int64, len(flat)) > 0
                counts = np.zeros(len(flat), np.uint32)
                counts[known] = index.count(_pairs(flat))
                ends = np.cumsum([len(x) for x in digests])
                found = np.split(counts, ends[:-1])
                for k, before in enumerate(part.column(2)):
                    if before.is_valid:
                        found[k] = np.maximum(found[k], np.frombuffer(before.as_buffer(), np.uint32))
                if not last:
                    yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([x.tobytes() for x in found], pa.binary())],
                                                     ["doc_id", "text", "found"])
                    continue
                kept, dropped, most = [], [], []
                for text, seen in zip(texts, found):
                    gone = seen >= min_docs
                    n = int(gone.sum())
                    kept.append(b"\n".join(line for line, drop in zip(text.split(b"\n"), gone) if not drop) if n else text)
                    dropped.append(n)
                    most.append(int(seen[gone].max()) if n else 0)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(kept, pa.binary()), pa.array([len(x) for x in found], pa.int64()), pa.array(dropped, pa.int64()),
                     pa.array(most, pa.int64())], ["doc_id", "kept", "n_lines", "n_dropped", "most_docs"])
    return probe


def drop_common_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, most_keys: int = MOST_KEYS,
                      shard_keys: int = SHARD_KEYS) -> DataFrame:
    """doc_id, kept (text without lines found in ``min_docs`` documents), n_lines before, n_dropped, and most_docs: the documents that
    the commonest dropped line was found in (0 if none was)."""
    spark = docs.sparkSession
    base = f"{checkpoint_dir(spark)}/lines-{uuid.uuid4().hex}"
    counts = materialized(line_counts(docs, min_docs, min_chars), f"{base}-counts")
    keys = counts.count()
    shard_bits = max(0, math.ceil(math.log2(keys / shard_keys))) if keys else 0
    index = materialized(build_index(counts, shard_bits), f"{base}-index")
    rounds = max(1, math.ceil(keys / most_keys))
    each = math.ceil((1 << shard_bits) / rounds)
    rounds = math.ceil((1 << shard_bits) / each)
    doc_id = docs.schema["doc_id"].dataType.simpleString()
    state = docs.select("doc_id", F.col("text").cast("binary").alias("text"), F.lit(None).cast("binary").alias("found"))
    for number in range(rounds):
        rows = index.where(F.col("shard").between(number * each, (number + 1) * each - 1)).collect()  # at most most_keys keys
        shared, last = spark.sparkContext.broadcast(Probe(rows, shard_bits)), number == rounds - 1
        shape = f"doc_id {doc_id}, " + ("kept binary, n_lines long, n_dropped long, most_docs long" if last else "text binary, found binary")
        state = state.mapInArrow(_probe(shared, min_chars, last, min_docs), shape)
        if not last:
            state = materialized(state, f"{base}-round-{number}")
            shared.destroy()
            if number:
                discard(spark, f"{base}-round-{number - 1}")
    discard(spark, f"{base}-counts")
    discard(spark, f"{base}-index")
    return state.withColumn("kept", F.col("kept").cast("string"))
