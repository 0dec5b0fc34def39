"""The registered queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import content_store, fingerprint, mixing, ngram_join, packing, quality, resampling, rules, simhash, suffix_dedup, token_scan, toxicity, whitening
from .common import read


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, read(spark, sf_dir, "labels")))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(read(spark, sf_dir, "documents"))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op4_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare(read(spark, sf_dir, "documents"))


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(read(spark, sf_dir, "documents"), width=4, percent=85).select("doc_id", "n_shingles", "component_id")


def op5_ngram_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(read(spark, sf_dir, "documents"), width=4, percent=85)


def op6_content_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_store.read_back(content_store.write(read(spark, sf_dir, "documents")))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, read(spark, sf_dir, "labels")))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_scan.count_tokens(read(spark, sf_dir, "documents")).select("doc_id", "n_tokens")


def op9_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(read(spark, sf_dir, "documents")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    lost = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return suffix_dedup.dedupe(read(spark, sf_dir, "documents")).select(
        "doc_id", F.col("n_bytes"), lost.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read(spark, sf_dir, "embeddings"))


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_quality, op2_mixing, op3_packing, op4_fingerprint, op5_ngram_join, op5_ngram_links, op6_content_store, op7_toxicity, op8_token_counts, op9_rules,
    op10_suffix_dedup, op11_whitening, op12_simhash, op13_resampling, pipeline)}

_WORDS = r"regexp_extract_all(t, '[^\x20\x09-\x0D]+')"

OP5 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT doc_id, {_WORDS} AS ws FROM d),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i : i + 3], ' ') AS sh
      FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, least(len(ws), 1)) + 1)) AS i FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
l AS (SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id
      JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
      GROUP BY 1, 2, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id
FROM w LEFT JOIN n USING (doc_id) JOIN (SELECT a, min(b) AS component_id FROM r GROUP BY 1) c ON c.a = w.doc_id
"""

OP5_LINKS = f"""
{OP5.partition("SELECT w.doc_id, coalesce")[0]}
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, coalesce(k.n_links, 0) AS n_links
FROM w LEFT JOIN n USING (doc_id) JOIN (SELECT a, min(b) AS component_id FROM r GROUP BY 1) c ON c.a = w.doc_id
LEFT JOIN (SELECT l.a, count(DISTINCT y.text) AS n_links FROM l JOIN documents x ON x.doc_id = l.a JOIN documents y ON y.doc_id = l.b
           WHERE x.text <> y.text GROUP BY 1) k ON k.a = w.doc_id
"""

_RATIO = "CASE r WHEN 'word_length' THEN word_chars * 100 WHEN 'symbols' THEN n_symbols * 1000 WHEN 'dup_lines' THEN n_dup_lines * 1000 ELSE n_repeat_words * 1000 END"
_SLACK = "CASE r WHEN 'dup_lines' THEN 30 ELSE 150 END"


def _fences(keys: str) -> str:
    by = f"{keys}, " if keys else ""
    q = lambda p: f"min(CASE WHEN upto * 1000 >= tot * {p} THEN val END)"
    return f"""(SELECT {by}r, max(tot) AS docs, {q(100)} - 3 * ({q(500)} - {q(100)}) - {_SLACK} AS low, {q(900)} + 3 * ({q(900)} - {q(500)}) + {_SLACK} AS high
 FROM (SELECT {by}r, val, sum(n) OVER (PARTITION BY {by}r ORDER BY val) AS upto, sum(n) OVER (PARTITION BY {by}r) AS tot
       FROM (SELECT {by}r, val, sum(n) AS n FROM cells GROUP BY {by}r, val)) GROUP BY {by}r)"""


OP9 = rf"""
WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, {_WORDS} AS ws, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(ws[i : i + 4], ' ')) AS k
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w)),
p AS (SELECT doc_id, count(DISTINCT j) AS c FROM (SELECT doc_id, unnest(range(i, i + 5)) AS j FROM g WHERE k > 1) GROUP BY 1),
b AS (SELECT w.doc_id, lang, source, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
      length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(p.c, 0) AS n_repeat_words
      FROM w LEFT JOIN p ON p.doc_id = w.doc_id),
f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM b),
v AS (SELECT f.*, r, ({_RATIO}) // greatest(n_words, 1) AS x FROM f CROSS JOIN (VALUES ('word_length'), ('symbols'), ('dup_lines'), ('repeats')) AS q(r)),
cells AS (SELECT lang, source, r, (x >> greatest(length(bin(x)) - 6, 0)) << greatest(length(bin(x)) - 6, 0) AS val, count(*) AS n FROM v WHERE NOT base_failed GROUP BY ALL),
one AS {_fences('lang, source')}, two AS {_fences('lang')}, three AS {_fences('')},
lim AS (SELECT one.lang, one.source, one.r, CASE WHEN one.docs >= 100 THEN one.low WHEN two.docs >= 100 THEN two.low ELSE three.low END AS low,
        CASE WHEN one.docs >= 100 THEN one.high WHEN two.docs >= 100 THEN two.high ELSE three.high END AS high
        FROM one JOIN two ON one.lang IS NOT DISTINCT FROM two.lang AND one.r = two.r JOIN three ON one.r = three.r),
j AS (SELECT doc_id, bool_and(coalesce(x BETWEEN low AND high, true)) AS ok FROM v LEFT JOIN lim ON v.lang IS NOT DISTINCT FROM lim.lang AND v.source IS NOT DISTINCT FROM lim.source AND v.r = lim.r GROUP BY 1)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND ok AS kept FROM f JOIN j USING (doc_id)
"""

OP10 = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
k AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS m FROM (SELECT doc_id, h, unnest(range(0, strlen(h) // 2 - 49)) AS i FROM d)),
g AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY m) AS least FROM k) WHERE least < doc_id),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS j FROM g),
a AS (SELECT doc_id, count(*) AS n_removed, sum(CASE WHEN j = before + 1 THEN 0 ELSE 1 END) AS n_spans
      FROM (SELECT doc_id, j, lag(j) OVER (PARTITION BY doc_id ORDER BY j) AS before FROM c) GROUP BY 1),
b AS (SELECT doc_id, unnest(range(0, strlen(h) // 2)) AS j, h FROM d WHERE doc_id IN (SELECT doc_id FROM a)),
t AS (SELECT b.doc_id, string_agg(substr(h, 2 * b.j + 1, 2), '' ORDER BY b.j) AS h FROM b ANTI JOIN c ON b.doc_id = c.doc_id AND b.j = c.j GROUP BY 1)
SELECT d.doc_id, strlen(d.h) // 2 AS n_bytes, coalesce(a.n_removed, 0) AS n_removed, coalesce(a.n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(CASE WHEN a.doc_id IS NULL THEN d.h ELSE coalesce(t.h, '') END)) AS kept_sha256
FROM d LEFT JOIN a USING (doc_id) LEFT JOIN t USING (doc_id)
"""

_P = [11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261]  # fixed values: the primes of XXH64
_MOD = 1 << 64


def _xxh64(seed: int) -> str:
    """CTEs that make xx(sh, x), the XXH64 of each sh of s, in wide whole numbers modulo 2^64: four lanes over stripes of 32 bytes,
    their merge, and what is left in steps of eight, four and one byte."""
    one, two, three, four, five = _P
    num = lambda n: f"{n % _MOD}::UHUGEINT"
    low = lambda x: f"(({x}) % {_MOD}::UHUGEINT)"
    turn = lambda x, r: low(f"(({x}) << {r}) | (({x}) >> {64 - r})")
    times = lambda x, p: low(f"({x}) * {num(p)}")
    byte = lambda i: f"substr(h, 2 * ({i}) + 1, 2)"
    word = lambda i, n=8: f"('0x' || {' || '.join(byte(f'{i} + {k}') for k in reversed(range(n)))})::UBIGINT::UHUGEINT"
    mixed = lambda w: times(turn(times(w, two), 31), one)
    lane = lambda j, begin: f"list_reduce(list_prepend({num(begin)}, list_transform(range(0, n // 32), lambda i: {word(f'32 * i + {8 * j}')})), lambda a, w: {times(turn(low(f'a + {times('w', two)}'), 31), one)})"
    merged = ["a1", "m1", "m2", "m3", "m4"]
    steps = "".join(f"{merged[k]} AS (SELECT * REPLACE ({low(f'{times(f'xor(c, {mixed(f'v{k}')})', one)} + {num(four)}')} AS c) FROM {merged[k - 1]}),\n" for k in range(1, 5))
    return f"""a0 AS (SELECT sh, h, n, {lane(0, seed + one + two)} AS v1, {lane(1, seed + two)} AS v2, {lane(2, seed)} AS v3, {lane(3, seed - one)} AS v4 FROM (SELECT sh, hex(encode(sh)) AS h, strlen(sh) AS n FROM (SELECT DISTINCT sh FROM s))),
a1 AS (SELECT *, {low(f"{turn('v1', 1)} + {turn('v2', 7)} + {turn('v3', 12)} + {turn('v4', 18)}")} AS c FROM a0),
{steps}c0 AS (SELECT sh, h, n, n // 32 * 32 AS p, {low(f"(CASE WHEN n >= 32 THEN c ELSE {num(seed + five)} END) + n::UHUGEINT")} AS c FROM m4),
c1 AS (SELECT sh, h, n, p + (n - p) // 8 * 8 AS p, list_reduce(list_prepend(c, list_transform(range(0, (n - p) // 8), lambda i: {mixed(word('p + 8 * i'))})), lambda a, k: {low(f"{times(turn('xor(a, k)', 27), one)} + {num(four)}")}) AS c FROM c0),
c2 AS (SELECT sh, h, n, p + (n - p) // 4 * 4 AS p, CASE WHEN n - p >= 4 THEN {low(f"{times(turn(f'xor(c, {times(word('p', 4), one)})', 23), two)} + {num(three)}")} ELSE c END AS c FROM c1),
c3 AS (SELECT sh, list_reduce(list_prepend(c, list_transform(range(p, n), lambda i: {times(f"('0x' || {byte('i')})::UBIGINT::UHUGEINT", five)})), lambda a, k: {times(turn('xor(a, k)', 11), one)}) AS c FROM c2),
c4 AS (SELECT sh, {times('xor(c, c >> 33)', two)} AS c FROM c3), c5 AS (SELECT sh, {times('xor(c, c >> 29)', three)} AS c FROM c4), xx AS (SELECT sh, xor(c, c >> 32)::UBIGINT AS x FROM c5)"""


_BITS = " + ".join(f"(CASE WHEN 2 * sum(k * ((x >> {b}) & 1)) > sum(k) THEN {1 << b} ELSE 0 END)::UBIGINT" for b in range(64))

OP12 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT doc_id, {_WORDS} AS ws FROM d),
s AS (SELECT doc_id, array_to_string(ws[i : i + 2], ' ') AS sh FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, least(len(ws), 1)) + 1)) AS i FROM w)),
{_xxh64(42)},
b AS (SELECT doc_id, {_BITS} AS f FROM (SELECT doc_id, sh, count(*) AS k FROM s GROUP BY ALL) JOIN xx USING (sh) GROUP BY 1),
p AS (SELECT w.doc_id, coalesce(f, 0::UBIGINT) AS f FROM w LEFT JOIN b USING (doc_id)), u AS (SELECT f, min(doc_id) AS least FROM p GROUP BY 1),
l AS (SELECT x.f AS a, y.f AS b FROM u x JOIN u y ON bit_count(xor(x.f, y.f)::HUGEINT) BETWEEN 1 AND 2),
r AS (SELECT f AS a, f AS b FROM u UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT doc_id, lower(lpad(hex(p.f), 16, '0')) AS fingerprint, c.component_id FROM p JOIN (SELECT a, min(least) AS component_id FROM r JOIN u ON u.f = r.b GROUP BY 1) c ON c.a = p.f
"""

OP13 = r"""
WITH RECURSIVE step(i, k, c) AS (SELECT i, 0, i FROM range(256) AS r(i) UNION ALL SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM step WHERE k < 8),
tab AS (SELECT list(c ORDER BY i) AS crcs FROM step WHERE k = 8),
texts AS (SELECT 0 AS part, doc_id AS id, coalesce(text, '') AS t FROM documents UNION ALL SELECT 1, item_id, coalesce(text, '') FROM benchmark),
w AS (SELECT part, id, regexp_extract_all(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM texts),
f AS (SELECT part, id, unnest(list_concat(ws, list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]))) AS feature FROM w),
n AS (SELECT part, id, feature, count(*) AS n FROM f GROUP BY ALL),
b AS (SELECT feature, xor(list_reduce(list_prepend(4294967295, list_transform(range(0, strlen(feature)), lambda i: ('0x' || substr(hex(encode(feature)), 2 * i + 1, 2))::BIGINT)), lambda a, x: xor(a >> 8, crcs[(xor(a, x) & 255) + 1])), 4294967295) % 10000 AS bucket
      FROM (SELECT DISTINCT feature FROM n), tab),
m AS (SELECT part, id, bucket, n FROM n JOIN b USING (feature)),
s AS (SELECT bucket, sum(CASE WHEN part = 0 THEN n ELSE 0 END)::DOUBLE AS s, sum(CASE WHEN part = 1 THEN n ELSE 0 END)::DOUBLE AS t FROM m GROUP BY 1),
g AS (SELECT bucket, floor(1000 * ln((t + 1) * (sum(s) OVER () + 10000) / ((s + 1) * (sum(t) OVER () + 10000))))::BIGINT AS gain FROM s),
x AS (SELECT id, sum(n)::BIGINT AS n_features, floor(sum(n * gain)::DOUBLE / sum(n))::BIGINT AS weight FROM m JOIN g USING (bucket) WHERE part = 0 GROUP BY 1),
y AS (SELECT id AS doc_id, len(ws) >= 20 AS able, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
      coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || id), 1, 8))::BIGINT::DOUBLE + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM w LEFT JOIN x USING (id) WHERE part = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY able ORDER BY score DESC, doc_id) AS place, count(*) FILTER (able) OVER () AS many FROM y)
SELECT doc_id, n_features, weight, score, CASE WHEN able AND place <= 25 * many // 100 THEN place END AS rank FROM r
"""

ORACLE_SQL = {"op5_ngram_join": OP5, "op5_ngram_links": OP5_LINKS, "op9_rules": OP9, "op10_suffix_dedup": OP10, "op12_simhash": OP12, "op13_resampling": OP13}
