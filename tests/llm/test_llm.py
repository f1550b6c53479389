"""The training-data operators against brute force, on small fixtures, and their defined cases."""

import hashlib
import itertools
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from airlens.llm import (attention_lm, decontaminate, host_rules, html_extract, license_scan, packing,
                         simhash_dedup, suffix_dedup, toxicity, warc)
from tests.helpers import plan_of

WORDS = "alpha beta gamma delta omega sigma kappa theta lambda rho tau phi chi psi".split()
SHAPE = "doc_id long, text string, source string"


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(400)) for _ in range(n))


ODD = [(900, None, None), (901, "", "a"), (None, "no id here", "a"), (902, "  \t\n ", "a"), (903, "x" * 250_000, "b"),
       (904, "same words same words " * 40, "b"), (904, "same words same words " * 40, "b")]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and very long texts, repeated rows, and columns whose names clash with inner ones."""
    return spark.createDataFrame(ODD, SHAPE).select(
        "*", *[F.lit("clash").alias(c) for c in ("key", "label", "doc", "tag", "bytes", "places", "n_words", "fp", "row", "toxic", "bucket", "_n")])


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


# --- 1 ---------------------------------------------------------------------------------
def base_counts(text):
    w = [x for x in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in text or "").split(" ") if x]
    seen, windows = set(), {}
    for i in range(len(w) - 4):
        windows.setdefault(tuple(w[i:i + 5]), []).append(i)
    for places in windows.values():
        if len(places) > 1:
            seen.update(i + k for i in places for k in range(5))
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return (len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(seen))


def test_host_rules(spark, odd):
    r = random.Random(3)
    texts = [" ".join(r.choice("a b c d".split()) for _ in range(r.randrange(40))) for _ in range(40)] + ["a#b c\nq\nq\n\n", "\x0bone\x0ctwo"]
    docs = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], SHAPE)
    got = {x.doc_id: x for x in host_rules.judge(docs).collect()}
    for i, t in enumerate(texts):
        x = got[i]
        want = base_counts(t)
        assert (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words) == want
        assert x.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
    assert len(host_rules.judge(odd).collect()) == len(ODD)
    assert host_rules.judge(odd.where("false")).collect() == []


def test_host_verdict_reaches_documents(spark):
    good = [(i, prose(i, 60), "good") for i in range(30)]
    bad = [(100 + i, "too short", "bad") for i in range(29)] + [(200, prose(200, 60), "bad")]
    got = {x.doc_id: x.kept for x in host_rules.judge(spark.createDataFrame(good + bad, SHAPE)).collect()}
    assert all(got[i] for i in range(30)) and not any(got[d] for d, _, _ in bad)


# --- 2 ---------------------------------------------------------------------------------
def test_html_main_text():
    page = """<html><head><title>t</title><script>a<b</script></head><body><header><a href=/>Home</a></header>
    <nav><ul><li><a href=x>Menu one</a></li></ul></nav><div class="cookie-notice">We use cookies on this site to serve you.</div>
    <article><h1>Title &amp; more</h1><p>First   paragraph of
    the text<p><b>Second<br>one.</b></p><aside>Aside words.</aside><div class=ad>Buy now.</div><p>In.</p></article>
    <section id="comments"><p>I think this is a long comment of a reader with many words in it, is it not?</p></section>
    <form><p>Sign up</p></form><footer>&copy; me</footer></body>"""
    assert html_extract.main_text(page)[0] == "Title & more\n\nFirst paragraph of the text\n\nSecond one.\n\nIn."
    assert html_extract.main_text(None) == ("", 0) and html_extract.main_text("<p") == ("", 0)
    assert html_extract.main_text("<nav>" + "<p>a b" * 3000)[0] == ""


def test_html_raw_elements_and_forms():
    text = lambda page: html_extract.main_text(page)[0]
    article = "<article><h1>Title</h1><p>The text of the page.</p></article>"
    whole = "Title\n\nThe text of the page."
    for script in ("for(i=0;i<n;i++)f(i);", "a='<p'; b=\"it's\"", "if(a<b&&c>d)document.write('<style>')", "<!-- x"):
        assert text(f"<body><script>{script}</script>{article}<script>g()</script>") == whole
    assert text(f"<html><head><meta charset=utf-8><title>t</title><body>{article}") == whole
    assert text(f"<head><style>p<q{{}}</style>{article}") == whole
    assert text(f"<form id=page action=/x><nav><p>Menu</p></nav>{article}<p>Send</p></form>") == whole
    assert text(f"<main>{article}<form><p>Sign up here</p></form></main>") == whole
    assert text(f"<svg><svg>a</svg>b</svg>{article}<svg>") == whole
    assert text(f"{article}<script>never closed <p>no text") == whole


def test_min_cut_is_minimal():
    r = random.Random(5)
    for _ in range(200):
        n = r.randrange(1, 8)
        gains = [r.uniform(-3, 3) for _ in range(n)]
        edges = [(a, b, r.uniform(0, 2)) for a, b in itertools.combinations(range(n), 2) if r.random() < 0.5]
        cost = lambda side: (sum(abs(g) for g, s in zip(gains, side) if (g > 0) != s)  # noqa: B023, E731
                             + sum(c for a, b, c in edges if side[a] != side[b]))  # noqa: B023
        best = min(map(cost, itertools.product([False, True], repeat=n)))
        assert cost(html_extract.min_cut(gains, edges)) == pytest.approx(best)


def test_extract_odd_rows(spark):
    pages = spark.createDataFrame([(1, "u", None), (None, None, ""), (1, "u", None)], "page_id long, url string, html string").withColumn("text", F.lit(0))
    assert [x.text for x in html_extract.extract(pages).collect()] == ["", "", ""]
    assert html_extract.extract(pages.where("false")).collect() == []


LONG = "word " * 25


@pytest.mark.parametrize("name, kept", [("has-sidebar", True), ("no-share", True), ("related-content-layout", True), ("related-content", True),
                                        ("sidebar", False), ("post comments", False)])
def test_names_above_an_article(name, kept):
    """Parts of names doubt what is in them, which an article outweighs; whole names do not."""
    page = f'<body><div class="{name}"><article><h1>Title</h1><p>{LONG}</p></article></div><footer>foot</footer></body>'
    assert html_extract.main_text(page)[0] == (f"Title\n\n{LONG.strip()}" if kept else "")


def test_names_inside_an_article():
    page = (f'<article><header class="entry-header"><h1>Title</h1></header><p>{LONG}</p><div class="share-buttons"><p>Share {LONG}</p></div></article>'
            f'<section class="discussion"><article><p>Reader {LONG}</p></article></section>'
            f'<ol class="comment-list"><li><article id="comment-3"><p>Reader {LONG}</article></ol>')
    assert html_extract.main_text(page)[0] == f"Title\n\n{LONG.strip()}"


def test_lists_to_choose_from_have_no_text():
    page = f"<article><p>{LONG}</p><p>Choose <select><option>One<option>Two</select> now <button>Go</button>, {LONG}</p></article>"
    assert html_extract.main_text(page)[0] == f"{LONG.strip()}\n\nChoose now , {LONG.strip()}"


def test_deep_pages_take_work_in_proportion():
    """Steps through the tree, counted: twice as deep a page takes about twice as many."""
    def steps(n):
        blocks, tree = html_extract.blocks_of("<div>text here" * n + "</i></div>" * (n // 2) + "<p>end")
        assert len(blocks) == n + 1 and max(tree.depth) <= n + 1
        return sum(tree.distance(a.node, b.node) for a, b in itertools.pairwise(blocks))

    assert steps(4000) <= 2 * steps(2000) + 2
    assert html_extract.main_text("<b>" * 20_000 + "<p>x</i>" * 20_000)[1] == 20_000


# --- 3 ---------------------------------------------------------------------------------
def repeats_brute(texts, length):
    seen, out = set(), {}
    for doc, text in sorted(texts, key=lambda x: x[0]):
        b = (text or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if b[i:i + length] in seen:
                gone[i:i + length] = b"\1" * length
            seen.add(b[i:i + length])
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        out[doc] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def test_run_index():
    r = random.Random(1)
    for _ in range(80):
        base = bytes(r.choice(b"ab") for _ in range(60))
        texts = list(dict.fromkeys(bytes(r.choice(b"abc") for _ in range(r.randrange(20))) + base[a:a + r.randrange(30)] + b"a" * r.randrange(12)
                                   for a in (r.randrange(40) for _ in range(r.randrange(1, 9)))))
        index, length, seen, want = suffix_dedup.RunIndex(texts), r.choice([3, 5, 8]), set(), []
        statistics = index.matching_statistics()
        everything = b"\0".join(texts)
        at = 0
        for t in texts:
            for i in range(len(t) + 1):
                w = t[i:i + length]
                want.append(len(w) == length and w in seen)
                if len(w) == length:
                    seen.add(w)
            longest = next(n for n in range(len(t), -1, -1) if n == 0 or sum(
                everything.startswith(t[:n], p) for p in range(len(everything))) > 1)
            assert statistics[at] == longest
            at += len(t) + 1
        assert index.repeated(length).tolist() == want


@pytest.mark.parametrize("hot", [500, 2])
def test_suffix_dedup(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    passage = prose(77, 30)
    texts = [(i, prose(i, 30) + (passage if i % 3 == 0 else "") + prose(50 + i, 5)) for i in range(20)]
    texts += [(30, texts[0][1]), (31, "ab" * 400), (32, "a" * 180), (33, None), (34, ""), (35, "é" * 120), (36, "xé" + "é" * 60), (37, texts[0][1])]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    assert {x[0]: tuple(x)[1:] for x in suffix_dedup.dedup(docs).collect()} == repeats_brute(texts, 100)


def test_suffix_dedup_odd_rows(spark, odd):
    got = suffix_dedup.dedup(odd).collect()
    assert len(got) == len(ODD) and len({tuple(x) for x in got if x.doc_id == 904}) == 1
    kept = suffix_dedup.without_repeats(odd)
    assert kept.columns == odd.columns and kept.count() == len(ODD) and kept.where("text is null").count() == 1
    assert suffix_dedup.dedup(odd.where("false")).collect() == []


# --- 4 ---------------------------------------------------------------------------------
def fingerprint_brute(text):
    import xxhash
    w = [x for x in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else " " if c in "\t\n\x0b\x0c\r" else c for c in text or "").split(" ") if x]
    shingles = [" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def test_simhash(spark, odd):
    r = random.Random(2)
    texts = [(i, prose(i, 80)) for i in range(25)]
    for i in range(60):
        w = texts[r.randrange(25)][1].split(" ")
        w[r.randrange(len(w))] = "edit"
        texts.append((100 + i, " ".join(w)))
    texts += [(500, "É À ONE"), (501, None), (502, ""), (503, "one two"), (300, texts[3][1])]
    got = {x.doc_id: x for x in simhash_dedup.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    f = {d: fingerprint_brute(t) for d, t in texts}
    parent = {d: d for d in f}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(f), 2):
        if (f[a] ^ f[b]).bit_count() <= 4:
            parent[max(find(a), find(b))] = min(find(a), find(b))
    assert {d: (x.fingerprint, x.component_id) for d, x in got.items()} == {d: (f"{f[d]:016x}", find(d)) for d in f}
    assert len(simhash_dedup.near_duplicates(odd).collect()) == len(ODD)
    assert simhash_dedup.near_duplicates(odd.where("false")).collect() == []


def test_allocation_is_least():
    r = random.Random(4)
    for _ in range(50):
        costs = [[0.0] + sorted(r.uniform(0, 9) for _ in range(3)) for _ in range(4)]
        total, chosen = simhash_dedup.allocate(costs, 5)
        assert sum(t + 1 for t in chosen) == 5
        assert total == pytest.approx(min(sum(c[u] for c, u in zip(costs, us)) for us in itertools.product(range(4), repeat=4) if sum(us) == 5))


def test_components_join_labels_with_edges_and_themselves_only(spark, monkeypatch):
    """A round on 211 partitions planned nine shuffles and five broadcasts, half of them for one join more."""
    planned, cut = [], simhash_dedup.cut
    monkeypatch.setattr(simhash_dedup, "cut", lambda df: planned.append(plan_of(df)) or cut(df))
    chain, ring = [(k, k + 1) for k in range(-9, 40)], [(100, 101), (101, 102), (100, 102), (100, 101)]
    found = simhash_dedup.components(spark.createDataFrame([*chain, *ring], "a long, b long"))
    assert {(r.node, r.label) for r in found.collect()} == {(k, -9) for k in range(-9, 41)} | {(k, 100) for k in (100, 101, 102)}
    assert len(planned) > 3 and all(p.count("Join [") <= 3 and p.count("Exchange ") <= 7 for p in planned)
    assert simhash_dedup.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_components_deal_few_links_over_few_tasks(spark, monkeypatch):
    """Rounds over few links had as many tasks in every stage as the session has shuffle partitions; joins by shuffle find the same."""
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        pairs = spark.createDataFrame([*[(k, k + 1) for k in range(20)], (50, 60), (50, 70)], "a long, b long")
        expected = {(k, 0) for k in range(21)} | {(50, 50), (60, 50), (70, 50)}
        for most in (simhash_dedup.MOST_BROADCAST, 1):
            dealt, cut = [], simhash_dedup.cut
            with monkeypatch.context() as m:
                m.setattr(simhash_dedup, "MOST_BROADCAST", most)
                m.setattr(simhash_dedup, "cut", lambda df, cut=cut, dealt=dealt: (out := cut(df), dealt.append(out.rdd.getNumPartitions()))[0])
                assert {(r.node, r.label) for r in simhash_dedup.components(pairs).collect()} == expected
            assert len(dealt) > 3 and max(dealt[1:]) <= simhash_dedup.LEAST_TASKS
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_simhash_plan_does_not_follow_the_table():
    """As many rows per fingerprint at any size, where parts agree as often."""
    r = np.random.default_rng(3)
    mean = r.uniform(0.4, 0.6, 64)
    chosen = []
    for n in (1000, 50_000, 10 ** 8):
        parts = {m: simhash_dedup.parts_of(n, np.outer(mean, mean) * n, m) for m in simhash_dedup.PARTS}
        same = {(m, k): 1e-4 * n * (n - 1) for m in parts for k in range(m)}
        chosen.append(simhash_dedup.plan((n, mean, parts, same), 4))
    assert chosen[0] == chosen[1] == chosen[2]
    assert sum(t + 1 for _, t in chosen[0]) == 5 and sum(len(simhash_dedup.masks(p, t)) for p, t in chosen[0]) < 100


# --- 5 ---------------------------------------------------------------------------------
def test_warc_round_trip(spark, tmp_path):
    pages = spark.createDataFrame([("http://a/", "<p>One &amp; two</p><script>x</script>"), (None, None), ("http://a/", "ü\r\n\r\nv")], "url string, html string")
    responses = warc.responses(pages, "2024-01-01T00:00:00Z")
    derived = warc.derive(responses.withColumn("extra", F.lit(1)))
    assert derived.count() == 6 and derived.join(responses, derived.refers_to == responses.record_id).count() >= 6
    text = {x.block for x in derived.where("warc_type = 'conversion'").collect()}
    assert text == {"One & two", "", "ü\nv"}
    both = responses.unionByName(derived)
    warc.write_warc(both, str(tmp_path / "w"))
    columns = both.columns
    blank = lambda df: rows(df.select(*[F.coalesce(c, F.lit("")).alias(c) for c in columns]))
    assert blank(warc.read_warc(spark, str(tmp_path / "w") + "/*.txt")) == blank(both)
    assert warc.derive(responses.where("false")).collect() == []


# --- 6 ---------------------------------------------------------------------------------
def padding(histogram, bounds):
    return sum(n * (min(b for b in bounds if b >= x) - x) for x, n in histogram.items())


def test_bucket_bounds_are_optimal():
    r = random.Random(6)
    for _ in range(60):
        h = {r.randrange(20): r.randrange(1, 9) for _ in range(r.randrange(1, 8))}
        k = r.randrange(1, 5)
        got = packing.boundaries(h, k)
        tops = [c for n in range(1, k + 1) for c in itertools.combinations(sorted(h), n) if c[-1] == max(h)]
        assert len(got) <= k and padding(h, got) == min(padding(h, c) for c in tops)


def test_pack(spark, odd):
    docs = spark.createDataFrame([(i, " ".join(["w"] * (i * 7 % 50))) for i in range(200)], "doc_id long, text string")
    got = packing.pack(docs, max_tokens=20, n_buckets=3, token_budget=100).collect()
    assert sum(x.n_tokens for x in got) == sum(i * 7 % 50 for i in range(200))
    for bucket in {x.bucket for x in got}:
        part = [x for x in got if x.bucket == bucket]
        fit = max(1, 100 // max(1, part[0].padded_to))
        assert sorted(x.batch * fit + x.place for x in part) == list(range(len(part)))
        assert all(x.n_tokens <= x.padded_to for x in part)
    assert packing.pack(odd).where("piece = 0").count() == len(ODD)
    assert packing.pack(odd.where("false")).collect() == []


# --- 7 ---------------------------------------------------------------------------------
def test_nearest_is_exact():
    r = np.random.default_rng(0)
    vectors = []
    for _ in range(700):
        at = np.sort(r.choice(12, r.integers(1, 5), replace=False)).astype(np.int32)
        w = r.integers(1, 4, len(at)).astype(float)
        vectors.append((at, w / np.sqrt((w * w).sum())))
    dense = np.zeros((700, 12))
    for i, (at, w) in enumerate(vectors):
        dense[i, at] = w
    index = toxicity.Index(list(range(700)), [0] * 700, vectors)
    for i in range(100):
        places, cosines = index.nearest(*vectors[i], 25, without=i)
        want = np.minimum(1.0, dense @ dense[i])
        want[i] = -1
        best = sorted(range(700), key=lambda j: (-round(want[j], 12), j))[:25]
        best = [j for j in best if want[j] > 0]
        assert index.ids[places].tolist() == best and np.allclose(cosines, want[best])


def test_toxicity_equals_brute_force(spark):
    """The whole classification, by dense vectors over all examples."""
    import math
    import zlib
    from collections import Counter
    out = lambda i: zlib.crc32(str(i).encode()) % 3 == 1
    texts = {i: prose(i, 15 + i % 30) + (" slurword vilething" if i % 6 == 0 else " slurs" if i % 11 == 0 else "") for i in range(240)}
    toxic = {i: int(i % 6 == 0) for i in texts}
    train = [i for i in texts if not out(i)]
    held, bad = Counter(), Counter()
    for i in train:
        held.update(set(toxicity.terms(texts[i])))
        if toxic[i]:
            bad.update(set(toxicity.terms(texts[i])))
    n, n1 = len(train), sum(toxic[i] for i in train)
    share = {t: (bad[t] + n1 / n) / (held[t] + 1) for t in held}
    space = sorted(t for t in held if bad[t] >= 2 and share[t] >= 2 * n1 / n)
    dense = {}
    for i, text in texts.items():
        found = toxicity.terms(text)
        v = np.array([(1 + math.log(found[t])) * (math.log((1 + n) / (1 + held[t])) + 1) * share[t] if t in found else 0.0 for t in space])
        dense[i] = v / (np.sqrt((v * v).sum()) or 1)
    examples = [i for i in train if dense[i].any()]

    def vote(i):
        near = sorted(((-round(min(1.0, float(dense[i] @ dense[j])), 12), j) for j in examples if j != i))[:25]
        w = np.array([c * c for c, _ in near])
        return float((sum(c * c * toxic[j] for c, j in near) + 0.25 * n1 / n) / (w.sum() + 0.25))

    steps = toxicity.isotonic(np.array([vote(i) for i in examples]), np.array([float(toxic[i]) for i in examples]))
    rest = [i for i in train if not dense[i].any()]
    none = (sum(toxic[i] for i in rest) + 1) / (len(rest) + 2)
    want = {i: float(np.interp(vote(i), *steps)) if dense[i].any() else none for i in texts}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    got = toxicity.classify(docs, spark.createDataFrame(list(toxic.items()), "doc_id long, toxic int")).collect()
    assert len(space) > 20 and len(got) == len(texts)
    assert all(x.score == pytest.approx(want[x.doc_id], abs=1e-6) for x in got)
    assert all(str(x.doc_id) != near.split()[1].rstrip(":") for x in got for near in x.neighbours)


def test_toxicity(spark, odd):
    docs = [(i, prose(i, 40) + (" slurword slurwort" if i % 5 == 0 else ""), "s") for i in range(600)]
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(600)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    got = toxicity.classify(spark.createDataFrame(docs, SHAPE), labels).collect()
    assert all(x.predicted == int(x.doc_id % 5 == 0) and 0 <= x.score <= 1 for x in got)
    alone = toxicity.classify(odd, labels).collect()
    assert len(alone) == len(ODD) and all(x.predicted == 0 for x in alone)
    assert {x.score for x in toxicity.classify(odd, labels.where("false")).collect()} == {0.5}
    assert toxicity.classify(odd.where("false"), labels).collect() == []


# --- 8 ---------------------------------------------------------------------------------
def test_attention_gradients_and_normalisation():
    model = attention_lm.Attention(np.random.default_rng(0).integers(0, 50, 1000))
    model.p = {k: v.astype(float) for k, v in model.p.items()}
    model.later, model.bias = model.later.astype(float), [b.astype(float) for b in model.bias]
    inputs, held, targets = attention_lm.windows_of(np.random.default_rng(1).integers(0, 1000, 75))
    assert (targets >= 0).sum() == 75
    _, g = model.gradients(inputs, held, targets)
    for name, w in model.p.items():
        at = np.unravel_index(np.abs(g[name]).argmax(), w.shape)
        old, losses = w[at], []
        for step in (1e-4, -1e-4):
            w[at] = old + step
            losses.append(model.gradients(inputs, held, targets)[0])
        w[at] = old
        assert (losses[0] - losses[1]) / 2e-4 == pytest.approx(g[name][at], rel=1e-3, abs=1e-7)
    assert np.allclose(model.hidden(inputs, held)[0], model.hidden(inputs, held, fast=True)[0])
    h = model.hidden(inputs, held)[0][0, :1]
    total = sum(np.exp(sum(float(attention_lm._at(logits, right)[0]) for _, _, logits, right in model.levels(h.copy(), np.array([5]), np.array([c])))) for c in range(1000))
    assert total == pytest.approx(1, abs=1e-5)


def test_attention_is_causal():
    model = attention_lm.Attention(np.arange(1000))
    ids = np.random.default_rng(3).integers(0, 1000, 60)
    changed = ids.copy()
    changed[50:-1] = 7  # the last one is the end token, which also stands before the first
    one, other = (model.log_probabilities(*attention_lm.windows_of(x)).ravel()[:50] for x in (ids, changed))
    assert np.allclose(one, other)


def test_every_training_window_is_learned_from(spark, monkeypatch):
    ranks = attention_lm.read_ranks()
    end, subwords = len(ranks), attention_lm.Subwords(ranks)
    texts = [prose(i, 30 + 40 * i) for i in range(12)] + ["", None, prose(3, 2000)]
    encoded = [attention_lm.encode(t, subwords, end) for t in texts]
    model = attention_lm.Attention(np.bincount(np.concatenate(encoded), minlength=end + 1))
    with monkeypatch.context() as small:
        small.setattr(attention_lm, "HELD_WINDOWS", 8)
        small.setattr(attention_lm, "BATCH", 4)
        seen, learned, losses = attention_lm.learn(model.copy(), texts, subwords, end)
    assert learned == sum(map(len, encoded))
    assert seen.sum() == sum(there.sum() for _, there, _ in map(attention_lm.windows_of, encoded))
    assert np.mean(losses[-3:]) < np.mean(losses[:3])

    # over Spark: one partition in one round is the plain run; more partitions are weighted averages
    monkeypatch.setattr(attention_lm, "ROUNDS", 1)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    shared = spark.sparkContext.broadcast(ranks)
    alone, plain = model.copy(), model.copy()
    attention_lm.train_model(alone, docs.coalesce(1), shared)
    attention_lm.learn(plain, [r.text for r in docs.coalesce(1).collect()], subwords, end, seed=0)
    assert all(np.allclose(alone.p[k], plain.p[k], atol=1e-5) for k in plain.p)
    halves, dealt = [], docs.repartition(2, "doc_id")
    for rows in dealt.rdd.glom().collect():
        half = model.copy()
        halves.append((half, *attention_lm.learn(half, [r.text for r in rows], subwords, end, seed=0)[:2]))
    both = model.copy()
    attention_lm.train_model(both, dealt, shared)
    assert np.allclose(both.p["q"], sum(m.p["q"] * n for m, _, n in halves) / learned, atol=1e-5)
    weight = sum(s for _, s, _ in halves)
    at = np.flatnonzero(weight)
    mean = sum(m.p["e"][at] * s[at, None] for m, s, _ in halves) / weight[at, None]
    assert np.allclose(both.p["e"][at], mean, atol=1e-5)


def test_pairs_and_frequent_words_are_counted(spark):
    ranks = attention_lm.read_ranks()
    end, subwords = len(ranks), attention_lm.Subwords(ranks)
    texts = [prose(i, 50) for i in range(30)] + [None, "", "one"]
    single = np.minimum(np.arange(end + 1), attention_lm.SINGLES)
    want = np.zeros((attention_lm.SINGLES + 1,) * 2)
    for t in texts:
        before = end
        for i in attention_lm.encode(t, subwords, end):
            want[single[before], single[i]] += 1
            before = i
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(4)
    assert np.array_equal(attention_lm.count_pairs(docs, spark.sparkContext.broadcast(ranks), single), want)
    counts = spark.createDataFrame([(f"w{k}", k + 1) for k in range(500)], "word string, n long")
    top = attention_lm.most_frequent(counts, 100)
    assert 50 <= len(top) <= 100 and min(top.values()) > max(k + 1 for k in range(500) if f"w{k}" not in top)
    assert attention_lm.most_frequent(counts, 0) == {} and len(attention_lm.most_frequent(counts, 500)) == 500


def test_lm_scores(spark, odd, monkeypatch):
    monkeypatch.setattr(attention_lm, "TOP_WORDS", 3)
    import math
    import zlib
    from collections import Counter
    docs = [(i, prose(i, 20).replace("alpha", "ALPHA")) for i in range(60)] + [(90, None), (91, "")]
    got = {x.doc_id: x for x in attention_lm.score(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    words = lambda t: (t or "").lower().split() + [""]
    out = {d: zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in docs}
    counts = Counter(w for d, t in docs if not out[d] for w in words(t))
    n, v = counts.total(), len(counts)
    for d, t in docs:
        x = got[d]
        assert (x.held_out, x.n_tokens, x.train_tokens) == (out[d], len(words(t)), n)
        assert x.n_known == sum(counts[w] > 0 for w in words(t))
        assert x.base_score == pytest.approx(sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words(t)))
        assert math.isfinite(x.score) and x.score < 0
    assert len(attention_lm.score(odd).collect()) == len(ODD)
    assert attention_lm.score(odd.where("false")).collect() == []


# --- 9 ---------------------------------------------------------------------------------
def test_license_scan(spark, odd):
    texts = ["Released under the MIT License.", "x mit   LICENSE y\nmit-license", "mit licenses", "license mit",
             "foo\nThis work is licensed under the GNU General Public License, version 3. bar", "Licensed under the Apache License, Version 2.0",
             "is licensed this work under a Creative International Commons Attribution 4.0 License!", "émit license"]
    got = {x.doc_id: x for x in license_scan.scan(spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], SHAPE)).collect()}
    assert [(got[i].n_base, got[i].first_word, got[i].last_word, got[i].labels) for i in range(8)] == [
        (1, 3, 3, "mit"), (2, 1, 4, "mit"), (0, None, None, ""), (0, None, None, ""), (1, 8, 8, "gpl"), (1, 3, 3, "apache"),
        (0, None, None, "cc-by"), (0, None, None, "")]
    assert got[0].score == 1.0 and got[1].score == license_scan.PHRASE_SCORE and got[3].score == 0.0
    assert len(license_scan.scan(odd).collect()) == len(ODD)
    assert license_scan.scan(odd.where("false")).collect() == []


# --- 10 --------------------------------------------------------------------------------
def test_decontaminate(spark, odd):
    items = [(1, prose(1, 40)), (2, prose(2, 60)), (2, prose(2, 60)), (3, "too short"), (None, None)]
    w = prose(2, 60).split(" ")
    w[30] = "edit"
    docs = [(10, prose(50, 30) + " " + prose(1, 40) + " " + prose(51, 30), "s"), (11, " ".join(w).upper(), "s"), (12, prose(52, 90), "s"),
            (13, " ".join(prose(1, 40).split(" ")[:12]) + prose(53, 40), "s"), (14, prose(1, 40), "s")]
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))
    got = decontaminate.contaminated(spark.createDataFrame(docs, SHAPE), benchmark).collect()
    assert sorted((x.doc_id, x.item_id) for x in got) == [(10, 1), (11, 2), (14, 1)]
    assert decontaminate.contaminated(odd, benchmark).collect() == []
    assert decontaminate.contaminated(odd.where("false"), benchmark.where("false")).collect() == []


def test_decontaminate_beyond_the_radius(spark):
    """One inner word of 50 changed: similarity 41 / 51, which fingerprints do not always show."""
    items = [(i, prose(2000 + i, 50)) for i in range(400)]
    docs = [(i, " ".join([*t.split(" ")[:25], "edit", *t.split(" ")[26:]]), "s") for i, t in items]
    benchmark, docs = spark.createDataFrame(items, "item_id long, text string"), spark.createDataFrame(docs, SHAPE)
    for radius in (15, 3):
        got = decontaminate.contaminated(docs, benchmark, radius=radius).collect()
        assert sorted((x.doc_id, x.item_id) for x in got) == [(i, i) for i in range(400)]


def similar_windows(items, docs):
    """Brute force: the greatest weighted similarity over all windows of item size, where it is 0.8 or more."""
    shingles = lambda t: [tuple(w[i:i + 5]) for w in [t.lower().split()] for i in range(len(w) - 4)]
    known = {i: shingles(t) for i, t in items}
    holds = Counter(g for s in known.values() for g in set(s))
    weight = lambda g: math.log(1 + len(known) / holds[g]) if g in holds else math.log(1 + len(known))
    best = {}
    for d, text in docs:
        s = shingles(text)
        for item, want in known.items():
            b, n = Counter(want), len(want)
            for at in range(max(1, len(s) - n + 1)):
                a = Counter(s[at:at + n])
                both = sum(min(a[g], b[g]) * weight(g) for g in a.keys() & b.keys())
                got = both / sum(max(a[g], b[g]) * weight(g) for g in a.keys() | b.keys()) if a else 0
                if round(got, 9) >= 0.8:
                    best[d, item] = max(best.get((d, item), 0), round(got, 9))
    return best


def test_decontaminate_tries_every_window(spark):
    """Items with common ends, and passages with words put in, left out, changed or halves swapped: as over all windows."""
    r = random.Random(5)
    opening, closing = prose(800, 14), prose(801, 14)
    items = [(i, f"{opening} {prose(810 + i, 20 + i % 4)} {closing}") for i in range(28)]
    docs = []
    for i, text in items:
        w = text.split(" ")
        half, put = len(w) // 2, ["one", "two"]
        made = [[*w[:half], *put, *w[half:]], [*w[:half - 1], *w[half + 1:]], [*w[half:], *w[:half]], [*w[:9], "x", *w[9:]],
                w[2:], w[:-3], [*w[:half], *put * 3, *w[half:]]]
        for k, edited in enumerate(made):
            around = [prose(9000 + 100 * i + k, r.choice((0, 3, 40))), prose(9050 + 100 * i + k, r.choice((0, 2, 50)))]
            docs.append((100 * i + k, " ".join([around[0], *edited, around[1]]).strip()))
    want = similar_windows(items, docs)
    assert len(want) > 60
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contaminated(spark.createDataFrame([(d, t, "s") for d, t in docs], SHAPE), benchmark).collect()
    assert {(x.doc_id, x.item_id): x.similarity for x in got} == pytest.approx(want, abs=2e-9)


def test_decontaminate_looks_up_few_items(spark):
    """300 items of one size: wide blocks meet few pairs, not one for each window and item."""
    items = spark.createDataFrame([(i, prose(5000 + i, 30)) for i in range(300)], "item_id long, text string")
    held = decontaminate.items_of(items).select("item_id", F.explode(decontaminate.blocks(F.col("_fp"), decontaminate.RADIUS)).alias("_b"))
    assert held.join(held.withColumnRenamed("item_id", "other"), "_b").where("item_id <> other").count() < 300


# --- pipeline ----------------------------------------------------------------------------
def test_pipeline_stages(spark, odd, tmp_path):
    import corpus_pipeline

    labels = spark.createDataFrame([(i, 0, int(i % 5 == 0)) for i in range(300)], "doc_id long, quality int, toxic int")
    benchmark = spark.createDataFrame([(1, prose(901, 40))], "item_id long, text string")
    docs = [(i, prose(i, 40) + (" slurword slurwort" if i % 5 == 0 else ""), "s") for i in range(300)]
    docs += [(400, docs[1][1], "s"), (401, prose(902, 20) + " " + prose(901, 40), "s"), (402, docs[2][1][:150] + prose(903, 60), "s")]
    docs = spark.createDataFrame(docs, SHAPE).withColumn("lang", F.lit("en")).withColumn("n_chars", F.length("text").cast("long"))
    for name, df in (("labels", labels), ("benchmark", benchmark), ("documents", docs)):
        df.write.parquet(str(tmp_path / f"{name}.parquet"))
    final = corpus_pipeline.run(spark, str(tmp_path)).collect()
    left = {x.doc_id for x in final}
    assert left == {i for i in range(300) if i % 5} | {402}
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, odd, str(tmp_path))
        assert kept.columns == odd.columns and {900, 901, 903} & {x.doc_id for x in kept.select("doc_id").collect()}
        assert stage(spark, odd.where("false"), str(tmp_path)).count() == 0


def test_near_copies_leave_the_pipeline(spark):
    import corpus_pipeline

    w = prose(71, 900).split(" ")
    w[450] = "edit"
    docs = [(1, prose(71, 900), "s"), (2, " ".join(w), "s"), (3, prose(72, 60), "s"), (3, prose(72, 60), "s")]
    assert 0 < (fingerprint_brute(docs[0][1]) ^ fingerprint_brute(docs[1][1])).bit_count() <= 4
    assert [x.doc_id for x in corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(docs, SHAPE), "").orderBy("doc_id").collect()] == [1, 3]
