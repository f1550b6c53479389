"""Collocations of two and three words by dynamic itemset counting over cyclic shard scans.

Documents are dealt to ``shards`` by a hash of their id. Step after step one shard is scanned, round and round, and phrases
of all lengths are counted side by side: words from the first step on; a longer phrase from the step after both of its
parts (the phrase without its last, and without its first word) have reached ``least`` occurrences so far, until it has seen
each shard once. Counts are therefore exact when a phrase has completed its cycle, and no phrase with ``least`` occurrences
is missed, as its parts have at least as many.

What is active is known to the tasks by one table of slots per length, of a fixed size (``2 ** SLOT_BITS`` bytes,
broadcast and destroyed step by step): a part sets its two slots to the step at which it reached the threshold, unless
they are set, and the later of the two is the step it is taken to have reached it. That is fixed once both are set, so a
phrase starts and ends at the same steps in every task and attempt; a chance meeting of slots merely has a phrase counted
that stays below the threshold. Tables that are full cost shuffle, not results.

A word is known by 64 bits of its language and bytes. Should a frequent word share them with another one, all is
counted again with another seed. Tasks add up phrases before the shuffle, in slices of bounded size; totals so far are a
Parquet table in the shared folder, and a phrase that has ended its cycle below the threshold leaves it.

Null text has no words, a null language is ``und``; ids and other columns are not looked at except to deal documents to
shards, so repeated rows count as often as they occur, whatever else a table holds. Ties are decided by the phrase's UTF-8 bytes.
An empty table, or one without candidates, gives no rows.
"""

import uuid
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from airlens.llm.common import checkpoint_dir
from airlens.shared import discard, materialized

LEAST = 10
SHARDS = 2
TOP = 2000
#: a candidate goes if a longer one around it has this share of its occurrences, in percent
ABSORBED = 50
#: bytes of a slot table, as a power of two; 28 suits corpora of many terabytes
SLOT_BITS = 24
#: text looked at at once, words known and phrases held by a task, and rows sent at once
SLICE, MOST_WORDS, MOST_HELD, SENT = 2 << 20, 1 << 18, 3 << 20, 1 << 16
UNSET = 255

#: upper case becomes lower case, a tab a blank, and every separator of pieces a full stop, which then stands as its own word
PLAIN = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t,;:!?\n\v\f\r", b"abcdefghijklmnopqrstuvwxyz .........")
BREAK = b"."

WORD_ROWS = "lang string, word string, h long, c long"
PHRASE_ROWS = "h1 long, h2 long, h3 long, start long, c long"


# --- in tasks --------------------------------------------------------------------------
def _cuts(plain: bytes) -> Iterator[tuple[bytes, int]]:
    """Parts of a text, each with the number of its first words that are context only. A part ends with a piece or, inside a
    piece of more than two slices, with a word; the next one then begins with that part's last two words."""
    at, tail = 0, b""
    while at < len(plain):
        end = plain.find(BREAK, at + SLICE) + 1 or len(plain)
        blank = plain.find(b" ", at + SLICE, end) + 1 if end - at > 2 * SLICE else 0
        end = blank or end
        part = tail + plain[at:end]
        yield part, len(_words(tail))
        tail = b" ".join(part.rsplit(None, 2)[-2:]) + b" " if blank else b""
        at = end


def _words(plain: bytes) -> list[bytes]:
    return plain.replace(BREAK, b" . ").split()


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes, int]]:
    """Language and plain text of some pieces, about :data:`SLICE` bytes at a time, and the words of context they begin with."""
    held, sizes = defaultdict(list), defaultdict(int)
    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1)):
            lang, text = lang.as_py(), text.as_buffer()
            for part, context in _cuts(bytes(text).translate(PLAIN) if text is not None else b""):
                if context:
                    yield lang, part, context
                    continue
                held[lang].append(part)
                sizes[lang] += len(part)
                if sizes[lang] >= SLICE:
                    yield lang, BREAK.join(held.pop(lang)), 0
                    del sizes[lang]
    for lang, parts in held.items():
        yield lang, BREAK.join(parts), 0


class _Vocabulary:
    """Numbers for the words of a language seen by a task; number 0 is the break between pieces."""

    def __init__(self, lang: str, seed: int):
        encoded = lang.encode()
        self.prefix, self.seed = b"%d:%s" % (len(encoded), encoded), seed
        self.number = defaultdict()
        self.number.default_factory = self.number.__len__
        self.number[BREAK]
        self.hashes = np.zeros(1, np.uint64)

    def encode(self, plain: bytes) -> np.ndarray:
        words = _words(plain)
        found = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        known = len(self.hashes)
        if len(self.number) > known:
            fresh = list(self.number)[known:]
            self.hashes = np.concatenate([self.hashes, np.fromiter(
                (xxhash.xxh64_intdigest(self.prefix + w, self.seed) for w in fresh), np.uint64, len(fresh))])
        return found

    def full(self) -> bool:
        return len(self.number) > MOST_WORDS


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Counts of equal keys added up."""
    keys, counts = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([keys[:1] == keys[:1], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _count_words(seed: int):
    def count(batches):
        held, counts = {}, {}

        def rows(lang):
            words, c = held.pop(lang), counts.pop(lang)
            texts = list(words.number)
            for at in range(1, len(texts), SENT):
                part = slice(at, at + SENT)
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * len(texts[part])), pa.array([w.decode(errors="replace") for w in texts[part]], pa.string()),
                    pa.array(words.hashes[part].view(np.int64)), pa.array(c[part])], ["lang", "word", "h", "c"])

        for lang, plain, context in _slices(batches):
            words = held.setdefault(lang, _Vocabulary(lang, seed))
            found = words.encode(plain)
            c = np.bincount(found[context:], minlength=len(words.number))
            before = counts.get(lang, np.zeros(0, np.int64))
            c[:len(before)] += before
            counts[lang] = c
            if words.full():
                yield from rows(lang)
        for lang in list(held):
            yield from rows(lang)
    return count


def _pair(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """One number for two words; :func:`_pair_column` is the same in Spark."""
    return first ^ ((second << np.uint64(23)) | (second >> np.uint64(41)))


def _reached(slots: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Step at which each key is taken to have reached the threshold, :data:`UNSET` if it has not."""
    last = np.uint64(len(slots) - 1)
    return np.maximum(slots[key & last], slots[(key >> np.uint64(32)) & last]).astype(np.int64)


#: bits of a word's number in a packed phrase; a task begins a new vocabulary long before
BITS = np.int64(21)


def _count_phrases(step: int, shards: int, seed: int, shared):
    """Phrases active at ``step`` with their first step and occurrences. ``shared``: the slot tables of words and pairs."""
    def active(first, second):
        later = np.maximum(first, second)
        return (later < step) & (later + shards >= step)

    def count(batches):
        word_slots, pair_slots = shared.value
        held, reached, parts, size = {}, {}, {}, 0

        def at_pairs(lang, one, two):
            """Step at which pairs of word numbers, and so their words too, have reached the threshold."""
            h, known = held[lang].hashes, reached[lang]
            at = np.maximum(known[one], known[two])
            some = np.flatnonzero(at < step)
            at[some] = np.maximum(at[some], _reached(pair_slots, _pair(h[one[some]], h[two[some]])))
            return at

        def rows(lang):
            h, known = held[lang].hashes, reached[lang]
            pairs, triples = parts.pop(lang)
            for phrases, length in ((pairs, 2), (triples, 3)):
                if not phrases:
                    continue
                keys, c = _added(phrases)
                words = [(keys >> (BITS * k)) & ((1 << BITS) - 1) for k in reversed(range(length))]
                if length == 2:
                    at = np.maximum(known[words[0]], known[words[1]])
                else:
                    at = np.maximum(at_pairs(lang, *words[:2]), at_pairs(lang, *words[1:]))
                columns = [h[w].view(np.int64) for w in words] + [np.zeros(len(keys), np.int64)] * (3 - length) + [at + 1, c]
                for k in range(0, len(keys), SENT):
                    yield pa.RecordBatch.from_arrays([pa.array(x[k:k + SENT]) for x in columns], ["h1", "h2", "h3", "start", "c"])

        for lang, plain, context in _slices(batches):
            words = held.setdefault(lang, _Vocabulary(lang, seed))
            found = words.encode(plain)
            known = reached.get(lang, np.full(1, UNSET, np.int64))
            reached[lang] = known = np.concatenate([known, _reached(word_slots, words.hashes[len(known):])])
            phrases = parts.setdefault(lang, ([], []))
            counted = active(known[found[:-1]], known[found[1:]])
            counted[:max(0, context - 1)] = False
            pair = (found[:-1] << BITS) | found[1:]
            phrases[0].append(np.unique(pair[counted], return_counts=True))
            size += len(phrases[0][-1][0])
            if step >= 2 and len(found) > 2:
                at = at_pairs(lang, found[:-1], found[1:])
                counted = active(at[:-1], at[1:])
                phrases[1].append(np.unique((pair[:-1][counted] << BITS) | found[2:][counted], return_counts=True))
                size += len(phrases[1][-1][0])
            if size > MOST_HELD:
                parts = {k: tuple([_added(x)] if x else [] for x in both) for k, both in parts.items()}
                size = sum(len(x[0][0]) for both in parts.values() for x in both if x)
                if size > MOST_HELD // 2:
                    for k in list(parts):
                        yield from rows(k)
                    size = 0
            if words.full():
                if lang in parts:
                    yield from rows(lang)
                del held[lang], reached[lang]
        for lang in list(parts):
            yield from rows(lang)
    return count


# --- on the tables ---------------------------------------------------------------------
def _pair_column(first: str, second: str) -> Column:
    return F.col(first).bitwiseXOR(F.shiftleft(second, 23).bitwiseOR(F.shiftrightunsigned(second, 41)))


def _mark(slots: np.ndarray, keys: DataFrame, key: Column, step: int) -> bool:
    """Set what is unset of the two slots of each key to ``step``. Bits come to the driver in blocks: an eighth of the table."""
    last = len(slots) - 1
    both = keys.select(F.explode(F.array(key.bitwiseAND(F.lit(last)), F.shiftrightunsigned(key, 32).bitwiseAND(F.lit(last)))).alias("s"))
    blocks = both.groupBy(F.bitmap_bucket_number(F.col("s") + 1).alias("b")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(F.col("s") + 1)).alias("bits")).collect()
    for block in blocks:
        at = (block["b"] - 1) * 32_768
        some = slots[at:at + 32_768]
        bits = np.unpackbits(np.frombuffer(bytes(block["bits"]), np.uint8), bitorder="little")[:len(some)]
        some[(bits == 1) & (some == UNSET)] = step
    return bool(blocks)


class _Totals:
    """A Parquet table of occurrences so far that is replaced step by step."""

    def __init__(self, spark: SparkSession, name: str, keys: list[str]):
        self.spark, self.keys, self.table, self.path = spark, keys, None, None
        self.base = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"

    def add(self, counted: DataFrame, step: int, keep: Column | None = None) -> None:
        """``counted`` joins the totals; column ``old`` tells what a row had before."""
        rows = counted.withColumn("old", F.lit(0).cast("long"))
        if self.table is not None:
            rows = rows.unionByName(self.table.withColumn("old", F.col("c")))
        # dealt by key first: tasks have added up already, a second sum before the shuffle would find nothing
        rows = rows.repartition(*self.keys).groupBy(*rows.drop("c", "old").columns).agg(F.sum("c").alias("c"), F.sum("old").alias("old"))
        before, self.path = self.path, f"{self.base}-{step}"
        written = materialized(rows if keep is None else rows.where(keep), self.path)
        self.fresh, self.table = written, written.drop("old")
        if before:
            discard(self.spark, before)

    def reached(self, least: int) -> DataFrame:
        return self.fresh.where((F.col("c") >= least) & (F.col("old") < least))

    def drop(self) -> None:
        if self.path:
            discard(self.spark, self.path)


def count_phrases(docs: DataFrame, least: int = LEAST, shards: int = SHARDS, slot_bits: int = SLOT_BITS,
                  seed: int = 0) -> tuple[_Totals, _Totals]:
    """Occurrences of all words, and of all phrases of two and three words that occur ``least`` times, as tables.

    ``docs`` has doc_id, lang and text. Words: lang, word, h, c. Phrases: h1, h2, h3 (0 of two words), c.
    """
    spark = docs.sparkSession
    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.col("text").cast("binary").alias("text"),
                       F.pmod(F.xxhash64("doc_id"), F.lit(shards)).alias("shard"))
    words, phrases = _Totals(spark, "words", ["lang", "word"]), _Totals(spark, "phrases", ["h1", "h2", "h3"])
    if not 2 <= shards < UNSET // 3:
        raise ValueError("2 to 84 shards")
    word_slots, pair_slots = (np.full(1 << slot_bits, UNSET, np.uint8) for _ in range(2))
    step = last = 0
    while step <= max(last, shards - 1):
        shard = rows.where(F.col("shard") == step % shards).select("lang", "text")
        if step:
            shared = spark.sparkContext.broadcast((word_slots, pair_slots))
            counted = shard.mapInArrow(_count_phrases(step, shards, seed, shared), PHRASE_ROWS)
            ended = F.col("start") + shards <= step + 1
            phrases.add(counted, step, ~ended | (F.col("c") >= least))
            shared.destroy()
            if _mark(pair_slots, phrases.reached(least).where("h3 = 0"), _pair_column("h1", "h2"), step):
                last = step + shards
        if step < shards:
            words.add(shard.mapInArrow(_count_words(seed), WORD_ROWS), step)
            if _mark(word_slots, words.reached(least), F.col("h"), step):
                last = step + shards
        step += 1
    alike = words.table.groupBy("h").agg(F.count("*").alias("n"), F.max("c").alias("c")).where((F.col("n") > 1) & (F.col("c") >= least))
    if not alike.isEmpty():
        words.drop(), phrases.drop()
        return count_phrases(docs, least, shards, slot_bits, seed + 1)
    return words, phrases


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, absorbed: int = ABSORBED, shards: int = SHARDS,
                 slot_bits: int = SLOT_BITS) -> DataFrame:
    """The ``top`` collocations of each language: lang, rank, phrase, a, l, r, n, score.

    ``a`` is the phrase's occurrences, ``l`` and ``r`` those of its parts at the lowest-scoring cut, ``n`` the language's words, and
    score is ``1000000 * a * a div (l * r)``, computed in decimals of 38 digits. Phrases mostly found inside a longer candidate go.
    """
    words, phrases = count_phrases(docs, least, shards, slot_bits)
    total = words.table.groupBy("lang").agg(F.sum("c").alias("n"))
    known = words.table.where(F.col("c") >= least)
    single = lambda name: known.select(*(["lang"] if name == "h1" else []), F.col("h").alias(name),
                                       F.col("c").alias(f"c_{name}"), F.col("word").alias(f"w_{name}"))
    pairs = phrases.table.where("h3 = 0")
    double = lambda one, two: pairs.select(F.col("h1").alias(one), F.col("h2").alias(two), F.col("c").alias(f"c_{one}{two}"))

    def score(a, left, right):
        return F.expr(f"CAST((CAST(1000000 AS DECIMAL(7,0)) * CAST(CAST({a} AS DECIMAL(15,0)) * CAST({a} AS DECIMAL(15,0)) AS DECIMAL(30,0))) "
                      f"DIV (CAST({left} AS DECIMAL(19,0)) * CAST({right} AS DECIMAL(19,0))) AS BIGINT)")

    two = (pairs.join(single("h1"), "h1").join(single("h2"), "h2")
           .select("lang", "h1", "h2", F.concat_ws(" ", "w_h1", "w_h2").alias("phrase"), F.col("c").alias("a"),
                   F.col("c_h1").alias("l"), F.col("c_h2").alias("r")).withColumn("score", score("a", "l", "r")))
    three = (phrases.table.where("h3 <> 0").join(single("h1"), "h1").join(single("h2"), "h2").join(single("h3"), "h3")
             .join(double("h1", "h2"), ["h1", "h2"]).join(double("h2", "h3"), ["h2", "h3"])
             .select("lang", "h1", "h2", "h3", F.concat_ws(" ", "w_h1", "w_h2", "w_h3").alias("phrase"), F.col("c").alias("a"),
                     F.col("c_h1").alias("l1"), F.col("c_h2h3").alias("r1"), F.col("c_h1h2").alias("l2"), F.col("c_h3").alias("r2"))
             .withColumns({"s1": score("a", "l1", "r1"), "s2": score("a", "l2", "r2")}))
    early = F.col("s1") <= F.col("s2")
    three = three.select("lang", "h1", "h2", "h3", "phrase", "a", F.when(early, F.col("l1")).otherwise(F.col("l2")).alias("l"),
                         F.when(early, F.col("r1")).otherwise(F.col("r2")).alias("r"), F.least("s1", "s2").alias("score"))
    around = (phrases.table.where("h3 <> 0").select(F.explode(F.array(F.struct("h1", "h2"), F.struct(F.col("h2").alias("h1"), F.col("h3").alias("h2"))))
              .alias("p"), "c").groupBy("p.h1", "p.h2").agg(F.max("c").alias("longer")))
    own = two.join(around, ["h1", "h2"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < absorbed * F.col("a")))
    shown = ["lang", "phrase", "a", "l", "r", "score"]
    ranked = own.select(shown).unionByName(three.select(shown)).withColumn(
        "rank", F.row_number().over(W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))).where(F.col("rank") <= top)
    return ranked.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
