"""Phrase mining, line deduplication and ranked search against brute force, and their defined cases."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from airlens.llm import lexical_search, line_dedup, phrase_mining

SHAPE = "doc_id long, text string, lang string"
ODD = [(900, None, None), (901, "", "en"), (None, "no id here. no id here", "en"), (902, "  \t\n ", None), (903, "x" * 250_000, "de"),
       (904, "Same words\tsame words " * 40, "en"), (904, "Same words\tsame words " * 40, "en"), (905, "é 日本\x00 \x85 a b", "")]


def clashing(docs):
    return docs.select("*", *[F.lit("clash").alias(c) for c in ("c", "h1", "phrase", "n", "rank", "score", "shard", "kept", "found", "n_lines", "terms", "term", "a")])


@pytest.fixture(scope="module")
def odd(spark):
    return clashing(spark.createDataFrame(ODD, SHAPE))


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


# --- phrases ------------------------------------------------------------------------------
def phrases(docs, least, top=2000, absorbed=50):
    f, n = Counter(), Counter()
    for _, text, lang in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lower(text)):
            w = [x for x in re.split("[ \t]", piece) if x]
            n[lang] += len(w)
            for k in (1, 2, 3):
                f.update((lang, tuple(w[i:i + k])) for i in range(len(w) - k + 1))
    found = {p: a for p, a in f.items() if a >= least and len(p[1]) > 1}
    out = []
    for (lang, p), a in found.items():
        longer = [b for (m, q), b in found.items() if m == lang and len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q)))]
        if any(100 * b >= absorbed * a for b in longer):
            continue
        cuts = [(1_000_000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out.append((lang, " ".join(p), a, f[lang, p[:k]], f[lang, p[k:]], n[lang], score))
    out.sort(key=lambda x: (x[0], -x[6], -x[2], x[1].encode()))
    seen, ranked = Counter(), []
    for lang, p, a, left, right, n, score in out:
        seen[lang] += 1
        if seen[lang] <= top:
            ranked.append((lang, seen[lang], p, a, left, right, n, score))
    return sorted(ranked, key=str)


def chatter(seed, docs=150):
    r = random.Random(seed)
    words = "new york city Big apple pie the of and hot dog".split() + [f"w{i}" for i in range(40)]
    text = lambda: "".join(r.choice(words + ["New York City"] * 4) + r.choice([" ", " ", "\t", " ", ". ", ",", "\n"])
                           for _ in range(r.randrange(60)))
    return [(i, text(), r.choice(["en", "en", "de", None])) for i in range(docs)]


@pytest.mark.parametrize("shards, slot_bits", [(2, 16), (4, 4)])
def test_phrases_equal_brute_force(spark, shards, slot_bits):
    """Also with slot tables so small that they are full of chance meetings."""
    docs = chatter(shards)
    got = rows(phrase_mining.collocations(spark.createDataFrame(docs, SHAPE).repartition(3), 4, 15, shards=shards, slot_bits=slot_bits))
    assert got == phrases(docs, 4, 15) and len(got) > 15


def test_phrases_of_odd_rows(spark, odd):
    assert rows(phrase_mining.collocations(odd, 2)) == phrases(ODD, 2)
    assert phrase_mining.collocations(odd.where("false")).collect() == []
    assert phrase_mining.collocations(odd, 10 ** 9).collect() == []


def test_phrases_across_slices_of_one_piece(spark):
    """A piece of many slices is cut between words, and no phrase is lost or counted twice there."""
    n = 400_000
    got = {x.phrase: (x.a, x.n) for x in phrase_mining.collocations(
        spark.createDataFrame([(1, "aaa bbb ccc " * n + "ddd", "en")], SHAPE), absorbed=1000).collect()}
    assert got == {"aaa bbb": (n, 3 * n + 1), "bbb ccc": (n, 3 * n + 1), "ccc aaa": (n - 1, 3 * n + 1), "aaa bbb ccc": (n, 3 * n + 1),
                   "bbb ccc aaa": (n - 1, 3 * n + 1), "ccc aaa bbb": (n - 1, 3 * n + 1)}


def test_phrases_leave_no_tables(spark, tmp_path):
    from airlens.llm.common import checkpoint_dir
    import glob
    phrase_mining.collocations(spark.createDataFrame(chatter(9), SHAPE), 4).collect()
    # one table of words and one of phrases back the result; earlier steps are gone
    assert len({x.rsplit("-", 1)[0] for x in glob.glob(checkpoint_dir(spark).removeprefix("file:") + "/phrases-*")}) == \
        len(glob.glob(checkpoint_dir(spark).removeprefix("file:") + "/phrases-*"))


# --- lines --------------------------------------------------------------------------------
def lines(docs, least, min_chars=1):
    key = lambda line: lower(line.strip(" \t\n\x0b\x0c\r"))
    f = Counter()
    for _, text, _ in docs:
        f.update({key(x) for x in (text or "").split("\n")})
    out = []
    for doc_id, text, _ in docs:
        every = (text or "").split("\n")
        gone = [f[key(x)] if len(key(x)) >= min_chars and f[key(x)] >= least else 0 for x in every]
        out.append((doc_id, "\n".join(x for x, g in zip(every, gone) if not g), len(every), sum(g > 0 for g in gone), max(gone)))
    return sorted(out, key=str)


def paragraphs(seed, docs=120):
    r = random.Random(seed)
    pool = [f"Shared line {i}" for i in range(40)] + ["", "  ", "é", "日本"]
    dress = lambda x: r.choice(["", " ", "\t\r"]) + r.choice([x, x.upper()]) + r.choice(["", " \x0b"])
    return [(i, "\n".join(dress(r.choice(pool)) if r.random() < 0.6 else f"own {r.random()}" for _ in range(r.randrange(25))), None)
            for i in range(docs)]


@pytest.mark.parametrize("most_keys, shard_keys", [(10 ** 7, 1 << 17), (3, 2), (1, 1)])
def test_lines_equal_brute_force(spark, most_keys, shard_keys):
    """One round, and rounds over few shards of few keys."""
    docs = paragraphs(5)
    df = spark.createDataFrame(docs, SHAPE).repartition(3)
    assert rows(line_dedup.drop_common_lines(df, 10, most_keys=most_keys, shard_keys=shard_keys)) == lines(docs, 10)
    assert rows(line_dedup.drop_common_lines(df, 3, min_chars=2, most_keys=most_keys, shard_keys=shard_keys)) == lines(docs, 3, 2)


def test_lines_of_odd_rows(spark, odd):
    assert rows(line_dedup.drop_common_lines(odd, 2)) == lines(ODD, 2)
    assert rows(line_dedup.drop_common_lines(odd, 10)) == lines(ODD, 10)
    assert line_dedup.drop_common_lines(odd.where("false")).collect() == []


def test_perfect_hash_is_minimal_and_rejects_strangers():
    r = np.random.default_rng(1)
    for n in (0, 1, 2, 1000, 50_000):
        h = r.integers(0, 1 << 63, (n, 2)).astype(np.uint64)
        h[: n // 2, 0] = 7  # keys that share a half
        sizes, bits, number = line_dedup.perfect_hash(h[:, 0], h[:, 1])
        assert sorted(number.tolist()) == list(range(n)) and sizes.sum() <= max(64 * 8, 4 * n)
        row = {"shard": 0, "sizes": sizes.tobytes(), "bits": bits.tobytes(), "prints": h[np.argsort(number), 1].tobytes(),
               "counts": (np.argsort(number) + 1).astype(np.uint32).tobytes()}
        probe = line_dedup.Probe([row], 0)
        assert (probe.count(h) == np.arange(n) + 1).all()
        assert not probe.count(r.integers(0, 1 << 63, (1000, 2)).astype(np.uint64)).any()


# --- search -------------------------------------------------------------------------------
def search(docs, items, top=20):
    terms = lambda text: re.findall("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower(text))
    vectors = [(d, Counter(w), len(w)) for d, w in ((d, terms(t)) for d, t, _ in docs) if w]
    n_docs, length = len(vectors), sum(n for _, _, n in vectors)
    df = Counter(t for _, w, _ in vectors for t in w)
    out = []
    wanted = {}
    for item, text in set(items):
        if item is not None:
            wanted.setdefault(item, Counter()).update(terms(text))
    for item, words in wanted.items():
        scores = []
        for d, w, n in vectors:
            m = 100 - 25 + 25 * n * n_docs // length
            s = sum(times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1000000000 * w[t] // (1000 * w[t] + 12 * m))
                    for t, times in words.items() if t in w)
            if s > 0 and d is not None:
                scores.append((-s, d))
        out += [(item, k + 1, d, -s) for k, (s, d) in enumerate(sorted(scores)[:top])]
    return sorted(out, key=str)


def library(seed, n):
    r = random.Random(seed)
    words = [f"t{int(r.paretovariate(0.7))}" for _ in range(3000)]
    text = lambda k: " ".join(r.choice(words) for _ in range(k))
    docs = [(i, text(r.randrange(80)), None) for i in range(n)]
    docs += [(n + i, docs[i % 7][1], None) for i in range(60)]  # ties
    items = [(i, text(r.randrange(1, 30))) for i in range(25)] + [(100, None), (101, "!"), (102, "nowhere"), (3, "t1 t2 zz"), (None, "t1")]
    return docs, items


@pytest.mark.parametrize("block_bytes", [1 << 20, 200])
def test_search_equals_brute_force(spark, block_bytes):
    docs, items = library(2, 900)
    items += items[:4]
    got = lexical_search.rank(spark.createDataFrame(docs, SHAPE).repartition(2), spark.createDataFrame(items, "item_id long, text string"),
                              block_bytes=block_bytes)
    assert rows(got) == search(docs, items)


def test_search_of_odd_rows(spark, odd):
    items = [(1, "same no 日本 x"), (2, "ID here words"), (3, "x" * 250_000)]
    bench = clashing(spark.createDataFrame(items, "item_id long, text string"))
    assert rows(lexical_search.rank(odd, bench)) == search(ODD, items)
    assert lexical_search.rank(odd.where("false"), bench).collect() == []
    assert lexical_search.rank(odd, bench.where("false")).collect() == []


def test_tree_bounds_hold_and_prune():
    """No document of a node scores above the node's bound, and a search of clustered documents leaves many leaves unread."""
    r = np.random.default_rng(4)
    words = 400
    vectors = {k: (list(range(20 * k, 20 * k + 20)), [1] * 20) for k in range(20)}
    items = lexical_search.Items(vectors, r.integers(1, 50, words), 1000, 50_000)
    own = [np.unique(r.integers(20 * (k % 20), 20 * (k % 20) + 20, 12)) for k in range(1000)]
    docs = [(k, w, items.values(60, r.integers(1, 4, len(w)))) for k, w in enumerate(own)]
    tree = lexical_search.Tree(docs, items)
    dense = np.zeros((len(docs), words), np.int64)
    for k, w, v in docs:
        dense[k, w] = v
    pruned = 0
    for k in range(20):
        query = np.zeros(words, np.int64)
        query[items.terms[k]] = items.weights[k]
        scores = dense @ query
        field, norm = items.norms[k]
        at = np.searchsorted(tree.fields, field)
        bound = tree.centres @ query[tree.used].astype(float) + tree.radii[:, at] @ norm
        for node, members in enumerate(tree.members):
            assert len(members) == 0 or scores[members].max() <= bound[node] * (1 + lexical_search.SLACK) + 1
        best, read = [], []
        leaves = tree.leaves
        tree.leaves = type("Seen", (dict,), {"__getitem__": lambda s, n: read.append(n) or dict.__getitem__(s, n)})(leaves)
        tree.search(items.terms[k], items.weights[k], items.norms[k], best, 20)
        tree.leaves = leaves
        assert sorted(best, reverse=True) == sorted(((int(s), -i) for i, s in enumerate(scores)), reverse=True)[:20]
        pruned += len(leaves) - len(read)
    assert pruned > 20 * len(leaves) / 4


def test_digest_of_query(spark, tmp_path):
    from airlens.llm.catalog import QUERIES
    docs = [(i, "Common\nown %d" % i if i else "", None) for i in range(11)]
    spark.createDataFrame(docs, SHAPE).write.parquet(f"{tmp_path}/documents.parquet")
    got = {x.doc_id: x for x in QUERIES["op12_line_dedup"](spark, str(tmp_path)).collect()}
    assert got[3].kept_sha256 == hashlib.sha256(b"own 3").hexdigest() and (got[3].n_lines, got[3].n_dropped) == (2, 1)
    assert got[0].kept_sha256 == hashlib.sha256(b"").hexdigest() and (got[0].n_lines, got[0].n_dropped) == (1, 0)
