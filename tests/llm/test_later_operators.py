"""Whitening, SimHash and resampling against brute force, with nulls, empty and long texts, ties, repeated rows, empty
tables and columns with clashing names."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from snapquarry.llm import queries, resampling, simhash, whitening
from snapquarry.llm.common import read

DATA = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, fp long, tile int, rank long, score long, part int, pos long, component_id long, row long, m long"


# ---- whitening


def whitened_by_numpy(vectors):
    x = [tuple(math.floor(256 * c) for c in v) for v in vectors]
    fit = np.array(sorted(set(x)), dtype=float)
    mean = fit.mean(axis=0)
    y = fit - mean
    cov = y.T @ y / len(fit)
    values, turn = np.linalg.eigh(cov)
    order = np.argsort(-values)[:4]
    sums = [sum(int(c) for c in column) for column in zip(*set(x))]
    n = len(fit)
    deviation = [sum((n * a - s) ** 2 for a, s in zip(row, sums)) for row in x]
    return n, deviation, (np.array(x) - mean) @ turn[:, order] / np.sqrt(values[order]), values[order] / np.trace(cov)


def held(got, vectors, ids):
    n, deviation, white, explained = whitened_by_numpy(vectors)
    place = {i: k for k, i in enumerate(ids)}
    by = defaultdict(dict)
    for r in got:
        assert (r.n, r.deviation) == (n, deviation[place[r.vec_id]])
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-9) and r.identity_error < 1e-9
        by[r.component][place[r.vec_id]] = r.whitened
    for c, told in by.items():
        mine, want = np.array([told[k] for k in sorted(told)]), white[sorted(told), c - 1]
        assert np.abs(mine * np.sign(mine @ want) - want).max() < 1e-8
    return by


def test_whitening_table(spark):
    rows = read(spark, DATA, "embeddings").collect()
    got = queries.op11_whitening(spark, DATA).collect()
    assert len(got) == 4 * len(rows)
    held(got, [r.embedding for r in rows], [r.vec_id for r in rows])


def test_whitening_odd(spark):
    rng = np.random.default_rng(3)
    good = [[float(v) for v in rng.normal(0, 0.2, 6)] for _ in range(40)]
    bad = [None, [], [1.0, None, 0.0, 0.0, 0.0, 0.0], [float("nan")] * 6, [float("inf")] + [0.0] * 5, [1.0, 2.0]]
    schema = "vec_id long, embedding array<double>, x int, d string, n long, component int"
    rows = [(i, v, 1, "d", 5, 9) for i, v in enumerate(good + good[:5] * 30)] + [(1000 + i, v, 1, "d", 5, 9) for i, v in enumerate(bad)]
    frame = spark.createDataFrame(rows, schema)
    got = whitening.whiten(frame.repartition(5)).collect()
    assert len(got) == 4 * (40 + 150) and {r.vec_id for r in got} == set(range(190))
    held(got, good + good[:5] * 30, list(range(190)))
    again = {(r.vec_id, r.component): abs(r.whitened) for r in whitening.whiten(frame.repartition(2)).collect()}
    assert all(abs(abs(r.whitened) - again[r.vec_id, r.component]) < 1e-9 for r in got)
    null = whitening.whiten(spark.createDataFrame([(None, v, 1, "d", 5, 9) for v in good], schema)).collect()
    assert len(null) == 160 and all(r.vec_id is None for r in null)
    assert whitening.whiten(spark.createDataFrame([], schema)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, good[0], 1, "d", 5, 9)] * 3, schema)).collect() == []  # no variance
    flat = [(i, [float(i), 2.0 * i, 1.0], 1, "d", 5, 9) for i in range(9)]  # variance in one direction alone
    assert {r.component for r in whitening.whiten(spark.createDataFrame(flat, schema)).collect()} == {1}
    far = spark.createDataFrame([(i, [2.0**50 * i, float(i % 7)], 1, "d", 5, 9) for i in range(16)], schema)
    assert all(r.deviation is None for r in whitening.whiten(far).collect())


@pytest.mark.parametrize("seed", range(4))
def test_spectrum(seed):
    """Rank-one updates and merges, with equal eigenvalues, untouched directions and repeated vectors to deflate."""
    rng = np.random.default_rng(seed)
    x = np.floor(256 * rng.normal(0, 0.13, (300, 12)))
    if seed == 1:
        x[:, 4:7], x[:, 8] = 0, x[:, 9]
    if seed == 2:
        x = np.repeat(x[:20], 15, axis=0)
    if seed == 3:
        x = np.concatenate([np.eye(12) * 5, -np.eye(12) * 5, np.eye(12) * 5])
    parts = [whitening.Spectrum.empty(12) for _ in range(4)]
    for k, row in enumerate(x):
        parts[k % 3].add(row)
    total = whitening.Spectrum.empty(12)
    for p in parts:
        total.merge(p)
    y = x - x.mean(axis=0)
    want = y.T @ y
    top = max(np.linalg.eigvalsh(want)[-1], 1)
    assert total.n == len(x) and np.abs(total.mean - x.mean(axis=0)).max() < 1e-9
    assert np.abs(total.values - np.linalg.eigvalsh(want)).max() < 1e-11 * top
    assert np.abs(total.vectors.T @ total.vectors - np.eye(12)).max() < 1e-11
    assert np.abs(want @ total.vectors - total.vectors * total.values).max() < 1e-11 * top


def test_spectra_combined_over_levels(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN", 2)
    rng = np.random.default_rng(8)
    x = np.floor(256 * rng.normal(0, 0.13, (200, 5))).astype(int)
    frame = spark.createDataFrame([(r.tolist(),) for r in x], "x array<long>").repartition(9)
    total = whitening.grow(frame, 5)
    y = x - x.mean(axis=0)
    assert total.n == 200 and np.abs(total.values - np.linalg.eigvalsh(y.T @ y)).max() < 1e-6


# ---- simhash


def simhash_of(text):
    words = WORD.findall((text or "").translate(LOWER))
    runs = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64(r.encode(), seed=42).intdigest() for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in h) > len(h))


def components_of(names, radius=2):
    """names: (id, fingerprint)."""
    prints = sorted({f for _, f in names})
    root = {f: f for f in prints}

    def top(f):
        while root[f] != f:
            f = root[f]
        return f

    values = np.array(prints, dtype=np.uint64)
    for i, f in enumerate(prints):
        for j in np.flatnonzero(np.bitwise_count(values[:i] ^ values[i]) <= radius):
            root[top(f)] = top(prints[j])
    least = {}
    for d, f in names:
        if d is not None:
            least[top(f)] = min(d, least.get(top(f), d))
    return {f: least.get(top(f)) for f in prints}


def odd_texts():
    rng = random.Random(9)
    words = ["the", "Of", "and", "é", "word", "ing", "a", "x1", "länge", "zu", "ist", "gar", "nicht"]
    base = [" ".join(rng.choice(words) + rng.choice("abcdefghij") for _ in range(80)) for _ in range(4)]
    out = [None, "", " \n ", "one", "one two", "One Two", "one two three", base[0], base[0], base[0].upper(), "\t" + base[1].replace(" ", "\n\n"), "q " * 4000, "x" * 100_000, "nul \0 in it 　 y"]
    for b in base:
        for k in (1, 2, 9):
            w = b.split(" ")
            for _ in range(k):
                w[rng.randrange(len(w))] = "new" + str(rng.randrange(99))
            out.append(" ".join(w))
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rest = (1, 2, 3, 4, 5, 6, 7, 8, 9)
    rows = [(i, t, *rest) for i, t in enumerate(odd_texts())]
    rows += [rows[7], rows[7], (None, rows[8][1], *rest), (None, "alone in the world", *rest), (None, None, *[None] * 9)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


def test_simhash(spark, docs):
    for frame in (docs, read(spark, DATA, "documents")):
        rows = [(r.doc_id, simhash_of(r.text)) for r in frame.collect()]
        want = components_of(rows)
        got = simhash.near_duplicates(frame).collect()
        assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got), key=repr) == sorted(((d, f"{f:016x}", want[f]) for d, f in rows), key=repr)
    assert simhash.near_duplicates(docs.limit(0)).collect() == []


def test_simhash_links(spark, monkeypatch):
    """Fingerprints crowded around a few centres, so that tiles are hot and cut into many lots and parts."""
    rng = random.Random(5)
    centres = [rng.getrandbits(64) for _ in range(5)] + [0, 2**64 - 1]
    prints = {c ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(9))) for c in centres for _ in range(150)}
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in sorted(x & (2**64 - 1) for x in prints)]
    frame = spark.createDataFrame(signed, "fp long")
    want = components_of([(f & (2**64 - 1), f & (2**64 - 1)) for (f,) in signed])
    for own, others in ((4096, 1 << 18), (8, 16)):
        monkeypatch.setattr(simhash, "OWN", own)
        monkeypatch.setattr(simhash, "OTHERS", others)
        found = simhash.links(frame, 2).collect()
        assert all((r.a ^ r.b).bit_count() <= 2 or ((r.a ^ r.b) & (2**64 - 1)).bit_count() <= 2 for r in found)
        root = {f & (2**64 - 1): f & (2**64 - 1) for (f,) in signed}

        def top(f):
            while root[f] != f:
                f = root[f]
            return f

        for r in found:
            a, b = top(r.a & (2**64 - 1)), top(r.b & (2**64 - 1))
            root[max(a, b)] = min(a, b)
        assert {f: top(f) for f in root} == want


def test_neighbours():
    near = simhash.neighbours(2)
    assert len(near) == 20 and len({*near, *(tuple(-k for k in o) for o in near)}) == 40


def test_simhash_copies(spark):
    """A third of all rows are one text, without ids."""
    frame = spark.range(30_000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("same words in all of these")).otherwise(F.concat(F.lit("some other words "), F.col("id"))).alias("text"))
    got = simhash.near_duplicates(frame)
    assert got.count() == 30_000 and got.filter("doc_id is null").select("component_id").distinct().count() == 1


# ---- resampling


def resampled(rows, target, buckets=10_000, percent=25, least=20):
    def told(text):
        words = TERM.findall((text or "").translate(LOWER))
        return words, [zlib.crc32(f.encode()) % buckets for f in words + [f"{a} {b}" for a, b in zip(words, words[1:])]]

    source, goal = Counter(), Counter()
    for _, t in rows:
        source.update(told(t)[1])
    for t in target:
        goal.update(told(t)[1])
    s, g = sum(source.values()), sum(goal.values())
    gain = [math.floor(1000 * math.log((goal[b] + 1) * (s + buckets) / ((source[b] + 1) * (g + buckets)))) for b in range(buckets)]
    out = []
    for d, t in rows:
        words, found = told(t)
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        out.append([len(words), d, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    able = sorted((-r[4], r[1] is None, r[1] or 0) for r in out if r[0] >= least)
    drawn = percent * len(able) // 100
    return out, {(d if not null else None, -score): k + 1 for k, (score, null, d) in enumerate(able[:drawn])}, drawn


def test_resampling_table(spark):
    rows = [(r.doc_id, r.text) for r in read(spark, DATA, "documents").collect()]
    target = [r.text for r in read(spark, DATA, "benchmark").collect()]
    out, rank, _ = resampled(rows, target)
    got = queries.op13_resampling(spark, DATA)
    assert [t for _, t in got.dtypes] == ["bigint"] * 5
    assert sorted(map(tuple, got.collect())) == sorted((d, n, w, s, rank.get((d, s))) for _, d, n, w, s in out)


def test_resampling_odd(spark, docs):
    texts = spark.createDataFrame([(1, None), (2, "the word, new1 NEW2 éj"), (3, "")], "item_id long, text string")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    out, rank, drawn = resampled(rows, [r.text for r in texts.collect()])
    got = resampling.resample(docs, texts).collect()
    key = lambda r: repr(r[:4])
    assert sorted([tuple(r)[:4] for r in got], key=key) == sorted([(d, n, w, s) for _, d, n, w, s in out], key=key)
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, drawn + 1))
    once = Counter((r.doc_id, r.score) for r in got)
    assert all(r["rank"] == rank.get((r.doc_id, r.score)) for r in got if once[r.doc_id, r.score] == 1)
    none = resampling.resample(docs, texts.limit(0)).collect()
    assert len(none) == len(rows) and resampling.resample(docs.limit(0), texts).collect() == []


def test_joined_crc():
    rng = random.Random(2)
    pairs = [(rng.randbytes(rng.randrange(40)), rng.randbytes(rng.randrange(5000))) for _ in range(50)] + [(b"a", b""), (b"", b"b" * 70_000)]
    crc = lambda k: np.array([zlib.crc32(p[k]) for p in pairs], dtype=np.uint32)
    got = resampling.joined_crc(crc(0), crc(1), np.array([len(b) for _, b in pairs]))
    assert got.tolist() == [zlib.crc32(a + b) for a, b in pairs]


def test_dictionary():
    """The automaton's words, those beyond its bounds and new ones get the same payloads."""
    for known in (resampling.Dictionary(), resampling.Dictionary(most=300, longest=4)):
        rng = random.Random(1)
        for _ in range(6):
            words = [rng.choice(["é", "a", "ab", "abc", "länger", "x" * 200]) + str(rng.randrange(400)) for _ in range(2000)]
            text = (" " + "  ".join(words) + " ").encode()
            spans = [m.span() for m in re.finditer(rb"[^ ]+", text)]
            crc, length = known.payloads(np.frombuffer(text, dtype=np.uint8), *(np.array(s) for s in zip(*spans)))
            assert crc.tolist() == [zlib.crc32(text[a:b]) for a, b in spans] and length.tolist() == [b - a for a, b in spans]
        assert known.inside and len(known.words) <= known.most
    assert known.inside == 300
