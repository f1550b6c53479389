"""Named queries of the operators, each over its whole table, with checking SQL where SQL can express them."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from airlens.llm import (attention_lm, decontaminate, host_rules, html_extract, lexical_search, license_scan, line_dedup, packing,
                         phrase_mining, simhash_dedup, suffix_dedup, toxicity, warc)
from airlens.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build
    return add


@query("op1_host_rules", """
WITH w AS (SELECT doc_id, source, coalesce(text, '') AS text,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\t-\\r]+'), lambda x: x <> '') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ \\t-\\r]')) AS l FROM documents),
g AS (SELECT doc_id, source, unnest(list_transform(range(1, len(w) - 3), lambda i: i)) AS i, w FROM w),
k AS (SELECT doc_id, source, i, w[i] || ' ' || w[i+1] || ' ' || w[i+2] || ' ' || w[i+3] || ' ' || w[i+4] AS k FROM g),
t AS (SELECT doc_id, source, i, count(*) OVER (PARTITION BY doc_id, k) AS c FROM k),
p AS (SELECT DISTINCT doc_id, source, unnest([i, i + 1, i + 2, i + 3, i + 4]) AS p FROM t WHERE c > 1),
r AS (SELECT doc_id, source, count(*) AS n FROM p GROUP BY ALL),
m AS (SELECT w.doc_id, w.source, CAST(len(w.w) AS BIGINT) AS n_words, CAST(length(array_to_string(w.w, '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(w.text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
    CAST(len(w.l) - len(list_distinct(w.l)) AS BIGINT) AS n_dup_lines, len(w.l) AS n_lines,
    CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN r ON w.doc_id = r.doc_id AND w.source = r.source),
f AS (SELECT *, n_words < 10 AS f1, 100 * n_repeat_words > 20 * n_words AS f2, 10 * n_symbols > word_chars AS f3,
    10 * n_dup_lines > 3 * n_lines AS f4 FROM m),
h AS (SELECT source, count(*) AS n, unnest([1, 2, 3, 4]) AS rule, unnest([sum(f1::INT), sum(f2::INT), sum(f3::INT), sum(f4::INT)]) AS x
  FROM f GROUP BY source),
mu AS (SELECT rule, sum(x) / sum(n) AS mu FROM h GROUP BY rule),
v AS (SELECT rule, any_value(mu) AS mu, avg(pow(x / n - mu, 2) - mu * (1 - mu) / n) AS v FROM h JOIN mu USING (rule) GROUP BY rule),
s AS (SELECT rule, mu, CASE WHEN v > 0 THEN greatest(1.0, least(10000.0, mu * (1 - mu) / v - 1)) ELSE 10000.0 END AS s FROM v),
b AS (SELECT source, any_value(n) AS n, max((x + mu * s) / (n + s)) > 0.5 AS bad FROM h JOIN s USING (rule) GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, f1 OR f2 AS base_failed,
  NOT (f1 OR f2) AND NOT bad AS kept, f.source, b.n AS host_docs, bad AS host_failed
FROM f JOIN b ON f.source = b.source""")
def op1(spark, sf):
    return host_rules.judge(table(spark, sf, "documents"))


def _license_sql() -> str:
    words = r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    templates = ", ".join(
        f"({number}, '{label}', {sorted(set(license_scan.plain_tokens(text)))!r})"
        for number, (label, text) in enumerate(license_scan.TEMPLATES))
    cases = " ".join(
        "WHEN " + " AND ".join(f"w[i + {k}] = '{part}'" for k, part in enumerate(phrase.split())) + f" THEN '{label}'"
        for phrase, label in license_scan.PHRASES.items())
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {words.format("coalesce(text, '')")} AS w FROM documents),
i AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d),
p AS (SELECT doc_id, i - 1 AS start, CASE {cases} END AS label FROM i),
b AS (SELECT doc_id, count(*) AS n_base, min(start) AS first_word, max(start) AS last_word,
    list_sort(list(DISTINCT label)) AS l FROM p WHERE label IS NOT NULL GROUP BY doc_id),
t(template, label, held) AS (VALUES {templates}),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d),
blocks AS (SELECT doc_id, {words.format("line")} AS w FROM lines WHERE regexp_matches(line, '(?i)licen|permi|source|redistr')),
m AS (SELECT doc_id, label, len(list_intersect(held, w)) / len(held) AS c FROM blocks, t
  WHERE len(list_intersect(held, w)) >= ceil({license_scan.CONTAINMENT} * len(held) - 1e-9)),
f AS (SELECT doc_id, list(DISTINCT label) AS l, max(c) AS c FROM m GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, first_word, last_word,
  coalesce(array_to_string(b.l, ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(b.l, []), coalesce(f.l, [])))), ','), '') AS labels,
  coalesce(f.c, CASE WHEN n_base > 0 THEN {license_scan.PHRASE_SCORE} END, 0.0) AS score
FROM d LEFT JOIN b USING (doc_id) LEFT JOIN f USING (doc_id)"""


@query("op9_license_scan", _license_sql())
def op9(spark, sf):
    return license_scan.scan(table(spark, sf, "documents"))


@query("op10_decontaminate", """
WITH i AS (SELECT DISTINCT item_id, list_filter(regexp_split_to_array(lower(text), '[ \\t-\\r]+'), lambda x: x <> '') AS w FROM benchmark),
d AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[ \\t-\\r]+'), lambda x: x <> '') AS w FROM documents),
gi AS (SELECT item_id, len(w) - 4 AS n, list_transform(range(1, len(w) - 3), lambda k: array_to_string(w[k:k + 4], ' ')) AS s FROM i WHERE len(w) >= 5),
gd AS (SELECT doc_id, list_transform(range(1, len(w) - 3), lambda k: array_to_string(w[k:k + 4], ' ')) AS s FROM d WHERE len(w) >= 5),
total AS (SELECT count(*) AS items FROM gi),
ei AS (SELECT item_id, n, unnest(s) AS g, unnest(range(len(s))) AS at FROM gi),
weight AS (SELECT g, ln(1 + (SELECT items FROM total) / count(DISTINCT item_id)) AS w FROM ei GROUP BY g),
ed AS (SELECT doc_id, unnest(s) AS g, unnest(range(len(s))) AS at, len(s) AS size FROM gd),
aligned AS (SELECT DISTINCT doc_id, n, greatest(0, least(ed.at - ei.at, size - n)) AS start FROM ed JOIN ei USING (g)),
place AS (SELECT doc_id, n, unnest(range(start, CASE WHEN following - start <= n / 0.8 THEN following ELSE start + 1 END)) AS start
  FROM (SELECT *, lead(start) OVER (PARTITION BY doc_id, n ORDER BY start) AS following FROM aligned)),
pair AS (SELECT p.doc_id, item_id, p.n, start, gd.s[start + 1:start + p.n] AS win, gi.s
  FROM place p JOIN gd USING (doc_id) JOIN gi ON gi.n = p.n
  WHERE len(list_intersect(gd.s[start + 1:start + p.n], gi.s)) > 0),
a AS (SELECT doc_id, item_id, n, start, g, count(*) AS a FROM (SELECT doc_id, item_id, n, start, unnest(win) AS g FROM pair) GROUP BY ALL),
b AS (SELECT item_id, g, count(*) AS b FROM ei GROUP BY ALL),
bt AS (SELECT item_id, sum(b * w) AS total FROM b JOIN weight USING (g) GROUP BY item_id),
m AS (SELECT a.doc_id, a.item_id, a.n, start, sum(least(a, coalesce(b, 0)) * coalesce(w, 0)) AS both_sides,
    sum(a - least(a, coalesce(b, 0))) AS extra
  FROM a LEFT JOIN b ON a.item_id = b.item_id AND a.g = b.g LEFT JOIN weight ON weight.g = b.g GROUP BY ALL),
v AS (SELECT doc_id, item_id, n, start, round(both_sides / (total + extra * ln(1 + (SELECT items FROM total))), 9) AS similarity
  FROM m JOIN bt USING (item_id))
SELECT doc_id, item_id, max(similarity) AS similarity, count(*) AS n_windows, CAST(min(start) AS BIGINT) AS first_word
FROM v WHERE similarity >= 0.8 GROUP BY doc_id, item_id""")
def op10(spark, sf):
    return decontaminate.contaminated(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query("op6_length_buckets")
def op6(spark, sf):
    return packing.pack(table(spark, sf, "documents"))


CRAWLED = "2024-01-01T00:00:00Z"


def _warc_sql() -> str:
    text = "payload"
    for pattern, by in warc.DROPPED:
        text = f"regexp_replace({text}, '{pattern}', {'chr(10)' if by == chr(10) else repr(by)}, 'g')"
    for entity, char in warc.ENTITIES:
        text = f"replace({text}, '{entity}', '{char.replace(chr(39), chr(39) * 2)}')"
    text = f"regexp_replace({text}, '[ \\t\\r]+', ' ', 'g')"
    text = f"regexp_replace(regexp_replace({text}, ' ?\\n[ \\n]*', chr(10), 'g'), '^[ \\n]+|[ \\n]+$', '', 'g')"
    uuid = lambda e: (f"'<urn:uuid:' || substr(md5({e}), 1, 8) || '-' || substr(md5({e}), 9, 4) || '-' || substr(md5({e}), 13, 4) "  # noqa: E731
                      f"|| '-' || substr(md5({e}), 17, 4) || '-' || substr(md5({e}), 21, 12) || '>'")
    return f"""
WITH p AS (SELECT coalesce(url, '') AS url, url AS target_uri, coalesce(html, '') AS payload FROM pages),
r AS (SELECT *, {uuid(f"'response' || chr(10) || url || chr(10) || '{CRAWLED}'")} AS id, 'sha256:' || sha256(payload) AS pd, {text} AS t FROM p),
m AS (SELECT *, 'metadata' AS warc_type, 'application/warc-fields' AS content_type,
    'http-status: 200' || chr(13) || chr(10) || 'http-content-type: text/html' || chr(13) || chr(10) || 'payload-length: ' || strlen(payload)
    || chr(13) || chr(10) || 'payload-digest: ' || pd || chr(13) || chr(10) || 'text-length: ' || strlen(t) || chr(13) || chr(10) AS block FROM r
  UNION ALL SELECT *, 'conversion', 'text/plain; charset=utf-8', t FROM r)
SELECT warc_type, {uuid("warc_type || chr(10) || id")} AS record_id, id AS refers_to, target_uri, '{CRAWLED}' AS warc_date, content_type,
  'sha256:' || sha256(block) AS block_digest, pd AS payload_digest, 'WARC-IP-Address: 192.0.2.1' AS headers, block FROM m"""


@query("op5_warc_derivatives", _warc_sql())
def op5(spark, sf):
    return warc.derive(warc.responses(table(spark, sf, "pages"), CRAWLED))


@query("op4_simhash")
def op4(spark, sf):
    return simhash_dedup.near_duplicates(table(spark, sf, "documents"))


@query("op7_toxicity")
def op7(spark, sf):
    return toxicity.classify(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query("op2_html_main_text")
def op2(spark, sf):
    return html_extract.extract(table(spark, sf, "pages"))


@query("op3_suffix_dedup")
def op3(spark, sf):
    return suffix_dedup.dedup(table(spark, sf, "documents"))


@query("op8_attention_lm")
def op8(spark, sf):
    return attention_lm.score(table(spark, sf, "documents"))


@query("op11_phrase_mining", r"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda x: x <> '') AS w FROM pieces),
n AS (SELECT lang, sum(len(w)) AS n FROM w GROUP BY lang),
g AS (SELECT lang, 1 AS k, unnest(w) AS phrase FROM w
  UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM w WHERE len(w) > 1
  UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM w WHERE len(w) > 2),
f AS (SELECT lang, k, phrase, string_split(phrase, ' ') AS p, CAST(count(*) AS HUGEINT) AS a FROM g GROUP BY ALL HAVING count(*) >= 10),
cut AS (SELECT lang, phrase, 1 AS place, k, a, p[1] AS one, array_to_string(p[2:], ' ') AS two FROM f WHERE k > 1
  UNION ALL SELECT lang, phrase, 2, k, a, array_to_string(p[:2], ' '), p[3] FROM f WHERE k = 3),
s AS (SELECT c.lang, c.phrase, place, c.k, c.a, x.a AS l, y.a AS r, 1000000 * c.a * c.a // (x.a * y.a) AS score
  FROM cut c JOIN f x ON x.lang = c.lang AND x.phrase = one JOIN f y ON y.lang = c.lang AND y.phrase = two),
best AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, place) = 1),
around AS (SELECT lang, part, max(a) AS longer FROM (
    SELECT lang, unnest([p[1] || ' ' || p[2], p[2] || ' ' || p[3]]) AS part, a FROM f WHERE k = 3) GROUP BY ALL),
kept AS (SELECT b.* FROM best b LEFT JOIN around o ON b.k = 2 AND o.lang = b.lang AND o.part = b.phrase
  WHERE longer IS NULL OR 100 * longer < 50 * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n,
  CAST(score AS BIGINT) AS score
FROM ranked JOIN n USING (lang) WHERE rank <= 2000""")
def op11(spark, sf):
    return phrase_mining.collocations(table(spark, sf, "documents"))


@query("op12_line_dedup", r"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i FROM documents),
k AS (SELECT doc_id, i, line, translate(regexp_replace(line, '^[ \t-\r]+|[ \t-\r]+$', '', 'g'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM l),
c AS (SELECT k, count(DISTINCT doc_id) AS n FROM k WHERE k <> '' GROUP BY k HAVING count(DISTINCT doc_id) >= 10),
m AS (SELECT doc_id, i, line, c.n FROM k LEFT JOIN c USING (k))
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(n) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE n IS NULL), '')) AS kept_sha256,
  CAST(coalesce(max(n), 0) AS BIGINT) AS most_docs
FROM m GROUP BY doc_id""")
def op12(spark, sf):
    return line_dedup.drop_common_lines(table(spark, sf, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"), "most_docs")


_TERMS = r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"


@query("op13_lexical_search", f"""
WITH d AS (SELECT doc_id, {_TERMS.format("coalesce(text, '')")} AS w FROM documents),
s AS (SELECT count(*) FILTER (WHERE len(w) > 0) AS docs, CAST(sum(len(w)) AS BIGINT) AS total FROM d),
tf AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(w) AS n, unnest(w) AS term FROM d) GROUP BY ALL),
q AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({_TERMS.format("coalesce(text, '')")}) AS term FROM benchmark) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, s GROUP BY term),
x AS (SELECT doc_id, term, (1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * docs) // total)) AS x FROM tf, s),
r AS (SELECT item_id, doc_id, CAST(sum(times * w * x) AS BIGINT) AS score FROM q JOIN w USING (term) JOIN x USING (term) GROUP BY ALL),
o AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM r WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM o WHERE rank <= 20""")
def op13(spark, sf):
    return lexical_search.rank(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
