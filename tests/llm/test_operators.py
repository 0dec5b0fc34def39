"""The training-data operators against brute force on small tables, with nulls, empty and long texts, ties, repeated
rows, empty tables and columns with clashing names."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from snapquarry.llm import content_store, fingerprint, mixing, ngram_join, packing, quality, queries, rules, suffix_array, suffix_dedup, token_scan, toxicity
from snapquarry.llm.common import read

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, copies long, part int, row string, n int, sig long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def texts():
    rng = random.Random(4)
    words = ["the", "Of", "and", "é", "word", "ing", "a", "x1", "länge", "zu", "ist", "gar", "nicht"]
    base = [" ".join(rng.choice(words) + rng.choice("abcdefghij") for _ in range(60)) for _ in range(4)]
    out = [None, "", " \n ", "one two", base[0], base[0], base[0].upper(), base[1] + "\nline\nline", "q " * 4000, "aaaa" * 400]
    for b in base:
        for k in (1, 3, 8):
            w = b.split(" ")
            for _ in range(k):
                w[rng.randrange(len(w))] = "new" + str(rng.randrange(99))
            out.append(" ".join(w))
    out += ["x <|endoftext|> y", "x <|startoftext|> y<|endoftext|>", "two  blanks\n\nfeeds \n x\u00a0y\u3000z tail ", "don't 12345 naïve—quote’s\nend", "nul \0 in it"]
    out += ["prefix " + base[2][40:160] + " suffix", "other " + base[2][60:200] + " end"]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if i % 3 else None, f"s{i % 4}" if i % 5 else None, len(t or ""), 7, 8, 9, "r", 1, 2) for i, t in enumerate(texts())]
    rows += [rows[4], rows[9], (None, texts()[4], "en", "s1", 1, 7, 8, 9, "r", 1, 2), (None, None, None, None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def rows(docs):
    return [(r.doc_id, r.text or "") for r in docs.collect()]


def test_mixing(docs, none):
    planned = mixing.plan(docs).collect()
    again = {(r.doc_id, r.size, r.source): r.taken for r in mixing.plan(docs.repartition(5)).collect()}
    assert len(planned) == docs.count() and all(r.taken <= 3 * r["size"] for r in planned)
    assert {(r.doc_id, r.size, r.source): r.taken for r in planned} == again
    assert sum({r.source: r.target for r in planned}.values()) == pytest.approx(sum(r["size"] for r in planned))
    by = defaultdict(list)
    for r in planned:
        by[r.source].append(r)
    for part in by.values():
        assert abs(sum(r.taken for r in part) - part[0].target) <= max(r["size"] for r in part)
    # the copies themselves: of the seeded offsets, that which brings a source's words nearest to its target
    draws = docs.select("source", *[(F.pmod(F.xxhash64(F.lit(17), F.lit(k), F.coalesce(F.concat(F.lit("v"), "source"), F.lit("n"))), F.lit(1_000_003)) / 1_000_003.0).alias(f"o{k}") for k in range(32)]).distinct().collect()
    order = {(r.doc_id, r.text_hash): r.draw for r in docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.xxhash64(F.lit(17), "doc_id").alias("draw")).collect()}
    for offsets in draws:
        part = sorted(by[offsets.source], key=lambda r: (r["size"], order[r.doc_id, r.text_hash], r.doc_id is not None, r.doc_id or 0, r.text_hash))
        each, tried = part[0].target / max(part[0].source_size, 1), []
        for k in range(32):
            total, crossed = offsets[f"o{k}"], []
            for i in range(len(part)):
                crossed.append(min(3, int(total + (i + 1) * each) - int(total + i * each)))
            tried.append((abs(sum(c * r["size"] for c, r in zip(crossed, part)) - part[0].target), total, crossed))
        assert [r.copies for r in part] == min(tried)[2]
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.copies for r in planned)
    assert mixing.plan(none).count() == 0 and mixing.mix(none).count() == 0


def test_targets():
    got = mixing.targets({"a": 10, "b": 100, None: 1})
    assert got[None] == 3 and got["a"] == 30 and got["b"] == pytest.approx(111 - 33)


def test_packing(docs, none, rows):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.tokenizer_path("word_bpe_49k.json"))
    want = sorted(((i, t) for i, t in rows), key=repr)
    pieces = []
    for i, t in want:
        ids = np.array(tok.encode(t, add_special_tokens=False).ids + [0], dtype="<u4")
        pieces += [(i, k // 2048, k, len(ids[k : k + 2048]), zlib.crc32(ids[k : k + 2048].tobytes())) for k in range(0, len(ids), 2048)]
    got = packing.pack_documents(docs, with_ids=True).cache()
    assert sorted((tuple(r)[:5] for r in got.select("doc_id", "piece", "start", "length", "ids_crc32").collect()), key=repr) == sorted(pieces, key=repr)
    bins = defaultdict(list)
    for r in got.collect():
        bins[r.sequence_id].append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(bins) == -(-sum(p[3] for p in pieces) // 2048)
    assert all(len(r.ids) == 4 * r.length for r in packing.sequences(got).collect())
    clash = packing.pieces(docs).withColumn("sequence_id", F.lit(1)).withColumn("offset", F.lit(1)).withColumn("_group", F.lit(7)).withColumn("pieces", F.lit(1))
    assert packing.pack(clash).agg(F.sum("length")).first()[0] == sum(p[3] for p in pieces)
    with pytest.raises(ValueError, match="longer"):
        packing.search([3000])
    assert packing.pack_documents(none).count() == 0


def test_packed_ids(docs, rows, spark):
    from tokenizers import Tokenizer

    import corpus_pipeline

    tok = Tokenizer.from_file(packing.tokenizer_path("word_bpe_49k.json"))
    whole = {i: np.array(tok.encode(t, add_special_tokens=False).ids + [0], dtype="<u2").tobytes() for i, t in rows if i is not None}
    last = corpus_pipeline.pack_sequences(spark, docs, "").collect()
    assert all(len(r.ids) == 2 * r.length for r in last)
    for r in last:
        if r.doc_id is not None:
            assert bytes(r.ids) == whole[r.doc_id][2 * r.start : 2 * (r.start + r.length)]
    made = packing.pack(packing.pieces(docs)).collect()
    assert sum(r.length for r in made) == sum(r.length for r in last) and all(len(r.ids) == 2 * r.length <= 4096 for r in made)
    for r in made:
        at = 0
        for p in r.pieces:
            if p.doc_id is not None:
                assert bytes(r.ids)[2 * at : 2 * (at + p.length)] == whole[p.doc_id][2 * p.start : 2 * (p.start + p.length)]
            at += p.length
        assert at == r.length


def test_packed_wide_ids(spark):
    many = [np.array([70_000, 1, k], dtype="<u4").tobytes() if k % 2 else np.array([5, k], dtype="<u2").tobytes() for k in range(9)]
    cut = spark.createDataFrame([(k, 0, 0, 3 if k % 2 else 2, k, bytearray(b)) for k, b in enumerate(many)], "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary")
    got = packing.members(packing.pack(cut, room=16)).collect()
    assert sorted((r.doc_id, packing.widen(bytes(r.ids), r.length)) for r in got) == [(k, packing.widen(b, 3 if k % 2 else 2)) for k, b in enumerate(many)]
    assert all(r.ids_crc32 == zlib.crc32(packing.widen(bytes(r.ids), r.length)) for r in got)


def test_local_search():
    rng = random.Random(2)
    sizes = [rng.randint(1, 1400) for _ in range(300)]
    bins = packing.search(sizes)
    assert sorted(i for b in bins for i in b) == list(range(300)) and all(sum(sizes[i] for i in b) <= 2048 for b in bins)
    assert len(bins) <= -(-sum(sizes) // 2048) + 4
    assert packing.search([]) == []
    # best fit alone needs three bins here
    assert len(packing.search([6, 5, 4, 4, 4, 3, 2, 2], 15)) == 2
    for k in range(30):  # pieces made by cutting full bins: the search comes close to them, and never over best fit
        cut = [n for _ in range(40) for n in np.diff([0, *sorted(rng.sample(range(1, 100), rng.randint(1, 3))), 100]).tolist()]
        found = packing.search(cut, 100)
        assert sorted(i for b in found for i in b) == list(range(len(cut))) and all(sum(cut[i] for i in b) <= 100 for b in found)
        assert len(found) <= min(len(packing.best_fit(cut, 100)[0]), 42)


def test_fingerprint(docs, none, spark, rows):
    only = sorted({(i, t) for i, t in rows if i is not None})
    got = {r.doc_id: r for r in fingerprint.compare(spark.createDataFrame(only, "doc_id long, text string")).collect()}
    down = only[::-1]
    for k, (i, t) in enumerate(down):
        after = down[(k + 1) % len(down)][1]
        n = len(t) // 3
        edited = t[: len(t) - n] + after[:n]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert got[4].fingerprint == got[5].fingerprint
    assert fingerprint.compare(docs).count() == docs.count() and fingerprint.compare(none).count() == 0
    alone = fingerprint.compare(spark.createDataFrame([(1, "abcdef")], "doc_id long, text string")).first()
    assert alone.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest()


def test_edit_distance():
    def plain(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a):
            new = [i + 1]
            for j, y in enumerate(b):
                new.append(min(new[j] + 1, row[j + 1] + 1, row[j] + (x != y)))
            row = new
        return row[-1]

    rng = random.Random(3)
    a = ["".join(rng.choice("abc") for _ in range(rng.randint(0, 9))) for _ in range(60)]
    b = ["".join(rng.choice("abc") for _ in range(rng.randint(0, 9))) for _ in range(60)]
    assert fingerprint.edit_distances(a, b).tolist() == [plain(x, y) for x, y in zip(a, b)]


def word_sets(rows, width):
    out = []
    for _, t in rows:
        w = [bytes(c + 32 if 65 <= c <= 90 else c for c in x) for x in t.encode().split()]
        out.append(frozenset(tuple(w[k : k + width]) for k in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else []))
    return out


@pytest.mark.parametrize(("width", "percent"), [(4, 85), (5, 80), (2, 60)])
def test_ngram_join(docs, none, rows, width, percent):
    sets = word_sets(rows, width)
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[top(i)] = min(least.get(top(i), d), d)
    want = sorted(((d, len(sets[i]), least.get(top(i))) for i, (d, _) in enumerate(rows)), key=repr)
    got = ngram_join.join(docs, width=width, percent=percent).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=repr) == want
    assert ngram_join.join(none).count() == 0


@pytest.mark.parametrize("block", [256, 3])
def test_ngram_join_links(spark, docs, rows, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    base = [f"w{i}" for i in range(60)]
    close = [(i, " ".join([*base, f"tail{i}"])) for i in range(4)]  # each links with the three others
    close += [(4, close[0][1]), (5, close[0][1].upper()), (6, "alone in the whole table"), (7, None), (8, " ")]
    for given, width, percent in ((close, 5, 80), (rows, 2, 60)):
        sets = word_sets([(i, t or "") for i, t in given], width)
        linked = lambda a, b: bool(sets[a] and sets[b]) and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
        want = [(d, len({u for b, (_, u) in enumerate(given) if u != t and linked(a, b)})) for a, (d, t) in enumerate(given)]
        table = spark.createDataFrame(close, "doc_id long, text string").repartition(3) if given is close else docs
        got = [(r.doc_id, r.n_links) for r in ngram_join.join(table, width=width, percent=percent).collect()]
        assert sorted(got, key=repr) == sorted(want, key=repr)
        if given is close:
            assert dict(got) == {0: 4, 1: 4, 2: 4, 3: 4, 4: 4, 5: 4, 6: 0, 7: 0, 8: 0}


def test_ngram_join_hot(spark, monkeypatch):
    """More holders of a token than are listed, and a family of more members than two blocks take."""
    monkeypatch.setattr(ngram_join, "BLOCK", 64)
    base = [f"common{i}" for i in range(20)]
    far = [(k, " ".join([*base, *[f"own{k}x{i}" for i in range(14)]])) for k in range(200)]  # share a passage, don't link
    near = [(1000 + k, " ".join([*[f"near{i}" for i in range(60)], f"tail{k % 150}"])) for k in range(300)]  # all link
    got = {r.doc_id: (r.component_id, r.n_links) for r in ngram_join.join(spark.createDataFrame(far + near, "doc_id long, text string").repartition(4)).collect()}
    assert got == {**{k: (k, 0) for k in range(200)}, **{1000 + k: (1000, 149) for k in range(300)}}


def test_long_text(spark):
    """One text of 20 MB among short ones, through the operators that look into texts."""
    rng = np.random.default_rng(5)
    long = bytes(np.where(rng.random(20_000_000) < 0.16, 32, rng.integers(97, 123, 20_000_000)).astype(np.uint8)).decode()
    table = spark.createDataFrame([(1, long), (2, long[5_000_000:5_000_400]), (3, "short text")], "doc_id long, text string").withColumn("lang", F.lit("en")).withColumn("source", F.lit("s"))
    cut = {r.doc_id: (r.n_bytes, len(r.kept)) for r in suffix_dedup.dedupe(table).select("doc_id", "n_bytes", "kept").collect()}
    assert cut[1] == (20_000_000, 20_000_000) and cut[2] == (400, 0)
    assert {r.doc_id: r.n_chars for r in fingerprint.compare(table).collect()}[1] == 20_000_000
    assert {r.doc_id: r.n_words for r in rules.judge(table).collect()}[1] == len(long.split())
    model = toxicity.Model(rng.normal(size=1 << toxicity.BITS), 0.0)
    assert toxicity.score(table, model).count() == 3


def test_keep_one(docs):
    kept = ngram_join.keep_one(docs)
    ids = [r.doc_id for r in kept.collect() if r.doc_id is not None]
    assert kept.columns == docs.columns and len(ids) == len(set(ids)) and 4 in ids and 5 not in ids


def test_content_store(docs, none, rows):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.tokenizer_path("byte_bpe_50k.json"))
    kept = content_store.write(docs)
    chunks, recipes, manifest = kept
    got = content_store.read_back(kept).collect()
    assert len(got) == len(rows)
    by = sorted(got, key=lambda r: r.start)
    assert [r.doc_id for r in by if r.doc_id is not None] == sorted(d for d, _ in rows if d is not None)
    at = 0
    for r in by:
        assert r.start == at
        at += r.n_tokens
    want = sorted(((d, zlib.crc32(np.array(tok.encode(t, add_special_tokens=False).ids + [2], dtype="<u4").tobytes())) for d, t in rows), key=repr)
    assert sorted(((r.doc_id, r.ids_crc32) for r in got), key=repr) == want
    whole = {r.doc_id: r.ids for r in content_store.documents(kept).collect()}
    assert whole[4] == tok.encode(dict(rows)[4], add_special_tokens=False).ids + [2]
    assert chunks.count() == chunks.select("digest").distinct().count()
    assert sum(r.documents for r in manifest.collect()) == len(rows)
    assert content_store.read_back(content_store.write(none)).count() == 0
    payloads = [r.payload for r in chunks.collect()]
    lost = recipes.filter("doc_id = 4").select(F.explode("digests").alias("digest"))
    for broken, said in (
        (kept._replace(chunks=chunks.withColumn("payload", F.concat("payload", F.lit(b"xx")))), "damaged"),
        (kept._replace(chunks=chunks.withColumn("payload", F.lit(payloads[0]))), "damaged"),  # exchanged
        (kept._replace(chunks=chunks.join(lost, "digest", "left_anti")), "lost"),
        (kept._replace(chunks=chunks.limit(0)), "lost"),
        (kept._replace(recipes=recipes.filter("doc_id <> 4 or doc_id is null")), "manifest"),
        (kept._replace(recipes=recipes.withColumn("start", F.col("start") + 1)), "manifest"),
        (kept._replace(recipes=recipes.withColumn("digests", F.reverse("digests")).filter("size(digests) > 1 or doc_id > 0")), "recipe|manifest"),
    ):
        with pytest.raises(Exception, match=said):
            content_store.read_back(broken).collect()
    with pytest.raises(Exception, match="lost"):
        content_store.documents(kept._replace(chunks=chunks.limit(0))).collect()


def test_chunks():
    rng = np.random.default_rng(3)
    for sizes in ([1, 30_000, 5], [4096, 4097, 1], [1]):
        ids, bounds = rng.integers(0, 9, sum(sizes)).astype("<u4"), np.cumsum([0, *sizes])
        ends = content_store.cuts(ids, bounds)
        assert set(bounds[1:]) <= set(ends.tolist()) and np.diff(np.append(0, ends)).max() <= content_store.MOST
        for k in range(len(sizes)):  # a stream is cut alike wherever it stands
            alone = content_store.cuts(ids[bounds[k] : bounds[k + 1]], np.array([0, sizes[k]]))
            assert (alone + bounds[k]).tolist() == [e for e in ends.tolist() if bounds[k] < e <= bounds[k + 1]]


def test_token_scan(docs, none, rows, spark, tmp_path):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.tokenizer_path("byte_bpe_50k.json"))
    tok.encode_special_tokens = True  # their strings are text here
    want = sorted(((d, len(tok.encode(t, add_special_tokens=False).ids)) for d, t in rows), key=repr)
    assert sorted(((r.doc_id, r.n_tokens) for r in token_scan.count_tokens(docs).collect()), key=repr) == want
    assert token_scan.count_tokens(none).count() == 0
    ids = np.array([5, 6, 9, 9, 1, 2, 3, 4, 5, 6, 7, 9, 8], dtype="<u2")
    (tmp_path / "a.bin").write_bytes(ids.tobytes())
    for small in (1 << 20, 4):  # read whole, or as records of a fixed length
        got = token_scan.scan(token_scan.read_flat(spark, str(tmp_path), block=6, small=small), end_id=9).orderBy("ordinal").collect()
        assert [r.n_tokens for r in got] == [2, 0, 7]


def test_token_scan_ranges(spark, monkeypatch):
    monkeypatch.setattr(token_scan, "RANGE", 3)
    rng = np.random.default_rng(1)
    data, want = [], []
    for f in ("a", "b"):
        ids = np.where(rng.random(4000) < 0.01, 9, 1).astype("<u2")
        ids[1000:2500] = 1
        raw = ids.tobytes()
        data += [(f, i // 40, bytearray(raw[i : i + 40])) for i in range(0, len(raw), 40)]
        at = np.flatnonzero(ids == 9)
        want += [(f, k, int(n)) for k, n in enumerate(np.diff(np.append(-1, at)) - 1)]
    got = token_scan.scan(spark.createDataFrame(data, "file string, block long, payload binary").repartition(5), end_id=9).collect()
    assert sorted((r.file, r.ordinal, r.n_tokens) for r in got) == want


def test_rules(docs, none, rows):
    got = sorted(([r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed] for r in rules.judge(docs).collect()), key=repr)
    want = []
    for d, t in rows:
        w = WORD.findall(t)
        lines = [x for x in t.split("\n") if WORD.search(x)]
        runs = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
        twice = {j for i, r in enumerate(runs) if runs.count(r) > 1 for j in range(i, i + 5)} if len(w) < 500 else set(range(len(w)))
        want.append([d, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(twice), len(w) < 10 or 100 * len(twice) > 20 * len(w)])
    assert got == sorted(want, key=repr)
    kept = rules.filter_documents(docs)
    assert kept.columns == docs.columns and kept.count() == rules.judge(docs).filter("kept").count()
    assert rules.judge(none).count() == 0


@pytest.mark.parametrize("hot", [2000, 1])
def test_suffix_dedup(docs, none, rows, hot):
    data = [((1 << 62) if d is None else d, d, t.encode()) for d, t in rows]
    first = {}
    for k, _, t in sorted(data):
        for i in range(len(t) - 49):
            first.setdefault(t[i : i + 50], k)
    want = []
    for k, d, t in data:
        gone = np.zeros(len(t), dtype=bool)
        for i in range(len(t) - 49):
            if first[t[i : i + 50]] < k:
                gone[i : i + 50] = True
        edge = np.diff(np.concatenate([[0], gone.view(np.int8), [0]]))
        want.append((d, len(t), [tuple(x) for x in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist())], bytes(c for c, g in zip(t, gone) if not g)))
    got = [(r.doc_id, r.n_bytes, [(s.start, s.end) for s in r.spans], bytes(r.kept)) for r in suffix_dedup.dedupe(docs, hot=hot, block_bytes=4000).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert any(w[2] for w in want)
    cut = suffix_dedup.cut_documents(docs)
    assert cut.columns == docs.columns and cut.count() == docs.count() and cut.filter("n_chars <> length(text)").count() == 0
    assert suffix_dedup.dedupe(none).count() == 0


def test_suffix_array():
    rng = np.random.default_rng(1)
    texts = [rng.integers(0, int(rng.integers(1, 6)), int(rng.integers(0, 60))) for _ in range(200)]
    texts += [np.zeros(300, dtype=int), np.tile([0, 1], 200), np.tile([1, 0, 2, 0], 150), rng.integers(0, 100_000, 800), np.tile(rng.integers(0, 3, 37), 20)]
    for t in texts:
        t = np.append(t + 1, 0).astype(np.int64 if t.max(initial=0) > 250 else np.uint8)
        s = t.tolist()
        order = suffix_array.suffix_array(t)
        assert order.tolist() == sorted(range(len(s)), key=lambda i: s[i:])
        if t.dtype == np.uint8 and 1 < len(t) < 64:
            common = suffix_array.permuted_prefixes(t, order, np.zeros(1, dtype=np.int64), most=64)
            for a, b in zip(order[:-1].tolist(), order[1:].tolist()):
                k = 0
                while max(a, b) + k < len(s) and s[a + k] == s[b + k]:
                    k += 1
                assert common[b] == k or min(common[b], k) >= 64
    strings = [bytes(rng.integers(97, 99, int(rng.integers(8, 20))).tolist()) for _ in range(60)]
    group, at, seen = suffix_array.shared_windows(strings, 8), 0, {}
    for s in strings:
        for i in range(len(s) + 1):
            if i + 8 <= len(s):
                assert seen.setdefault(s[i : i + 8], group[at + i]) == group[at + i] >= 0
            else:
                assert group[at + i] == -1
        at += len(s) + 1
    assert len(set(seen.values())) == len(seen)


def test_patterned_words_differ(spark):
    """Words and lines whose polynomial hashes mod 2^64 are equal under any base are still told apart."""
    one = "a"
    while len(one) < 2048:
        one += one.translate({97: "b", 98: "a"})
    two = one.translate({97: "b", 98: "a"})
    table = spark.createDataFrame([(1, one), (2, two), (3, f"{one}\n{two}")], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in ngram_join.join(table).collect()} == {1: 1, 2: 2, 3: 3}
    counted = {r.doc_id: r.n_dup_lines for r in rules.judge(table.withColumn("lang", F.lit("en")).withColumn("source", F.lit("s"))).collect()}
    assert counted == {1: 0, 2: 0, 3: 0}


@pytest.mark.parametrize("module", [fingerprint, suffix_dedup, token_scan, packing, content_store])
def test_text_ids(spark, docs, module):
    """doc_id as text, in the order of texts."""
    named = docs.filter("doc_id is not null").dropDuplicates(["doc_id"]).withColumn("doc_id", F.lpad(F.col("doc_id").cast("string"), 4, "0"))
    plain = named.withColumn("doc_id", F.col("doc_id").cast("long"))
    run = {fingerprint: fingerprint.compare, suffix_dedup: suffix_dedup.dedupe, token_scan: token_scan.count_tokens, packing: packing.pieces, content_store: lambda d: content_store.read_back(content_store.write(d))}[module]
    drop = ["file", "ordinal"] if module is token_scan else []
    told = lambda df: sorted((tuple(r) for r in df.drop(*drop).withColumn("doc_id", F.col("doc_id").cast("long")).collect()), key=repr)
    assert told(run(named)) == told(run(plain))


def test_fingerprint_parts(spark, docs):
    """The same for any number of parts."""
    table = docs.dropDuplicates(["doc_id"])
    told = lambda df: sorted(map(tuple, df.collect()), key=repr)
    assert told(fingerprint.compare(table, part_bytes=600)) == told(fingerprint.compare(table))


def test_signature(rows):
    """Against a plain reading of the rule, byte by byte."""
    from snapquarry.llm.common import hash_spans, mix

    for _, t in rows[:40]:
        data = t.encode()
        size, one, two = fingerprint.signatures(np.frombuffer(data, dtype=np.uint8), np.array([0, len(data)]))
        levels = []
        for end in range(1, len(data) + 1):
            part = data[max(0, end - 7) : end]
            roll = mix(np.array([(int.from_bytes(part, "little") + len(part) * 0x9E3779B97F4A7C15) % 2**64], dtype=np.uint64))
            value = int(mix(roll)[0])
            levels.append(-1 if int(roll[0]) % 3 else 30 if not value else min((value & -value).bit_length() - 1, 30))
        k = next(k for k in range(31) if sum(x >= k for x in levels) < 64)
        assert k == size[0]
        for got, at in ((one[0], k), (two[0], k + 1)):
            ends = sorted({i + 1 for i, x in enumerate(levels) if x >= at} | ({len(data)} if data else set()))
            chunks = [data[a:b] for a, b in zip([0, *ends[:-1]], ends)]
            digits = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
            hashes = [int(hash_spans(np.frombuffer(c, dtype=np.uint8), np.array([0]), np.array([len(c)]))[0]) for c in chunks]
            assert got == bytes(digits[h & 63] for h in hashes)


def accuracy(scored, labels, label):
    j = scored.filter("held_out").join(labels, "doc_id").select("predicted", label).collect()
    return sum(r.predicted == r[label] for r in j) / len(j)


def test_stretches():
    rng = random.Random(1)
    model = toxicity.Model(np.random.default_rng(0).normal(size=1 << toxicity.BITS), 0.1)
    text = " ".join(rng.choice("abcdefg") * rng.randint(1, 9) for _ in range(5000)).encode()
    buf, offs = np.frombuffer(text, dtype=np.uint8), np.array([0, len(text)])
    whole = model.windows(toxicity.subwords(buf, offs))[0].max()
    tops = []
    for part, edges, last in toxicity.stretches(buf, offs, most=1000):
        z = model.windows(toxicity.subwords(part, edges))[0]
        tops.append(z[: len(z) if last else len(z) - toxicity.WIDTH + 1].max())
    assert len(tops) > 5 and max(tops) == pytest.approx(whole)


def test_scores_against_plain_code():
    """Scores of both classifiers against a reading of the model word by word."""
    rng = random.Random(7)
    texts = [" ".join(rng.choice(["Good", "bad", "ugly!", "mis-spelt", "é", "x" * 20]) for _ in range(rng.randint(0, 12))) for _ in range(40)]
    y = np.array([i % 2 for i in range(40)])
    import pyarrow as pa

    model = toxicity.fit([t + (" vile scum" if k else "") for t, k in zip(texts, y)], y, epochs=2)
    column = pa.array(texts)
    alone = [model.logits(pa.array([t]))[0] for t in texts]
    assert model.logits(column).tolist() == pytest.approx(alone)
    for t, z in zip(texts, alone):
        words = t.split()
        each = []
        for w in words:
            g = toxicity.subwords(np.frombuffer(w.encode(), dtype=np.uint8), np.array([0, len(w.encode())]))
            padded = b" " + w.lower().encode() + b" " if w.isascii() else None
            if padded:
                assert len(g.ids) == 1 + sum(max(len(padded) - n + 1, 0) for n in toxicity.GRAMS)
            each.append([model.worth[i] for i in g.ids])
        windows = [sum(each[i : i + toxicity.WIDTH], []) for i in range(len(each))]
        assert z == pytest.approx(max((sum(v) / len(v) + model.bias for v in windows), default=-30.0))
    ranker = quality.fit(quality.features(column), y, rounds=30)
    x = quality.features(column)
    for row, got in zip(x, ranker.raw(x)):
        plain = sum(ranker.weights[i][sum(e <= v for e in ranker.edges[i])] for i, v in enumerate(row))
        assert got == pytest.approx(plain)


def test_models(spark, docs, none):
    data = "/root/testdata/sf0.01"
    documents, labels = read(spark, data, "documents"), read(spark, data, "labels")
    for module, label, fold, of in ((quality, "quality", 0, 5), (toxicity, "toxic", 2, 4)):
        model = module.train(documents, labels)
        out = module.score(documents, model).cache()
        assert accuracy(out, labels, label) >= 0.95
        assert out.filter("score < 0 or score > 1 or predicted <> int(score >= 0.3)").count() == 0
        held = {r.doc_id for r in out.filter("held_out").collect()}
        assert held == {i for i in range(out.count()) if zlib.crc32(str(i).encode()) % of == fold}
        assert module.score(docs, model).count() == docs.count() and module.score(none, model).count() == 0
        module.train(none, labels.limit(0))


def test_sql(spark):
    data = "/root/testdata/sf0.001"
    db = duckdb.connect()
    db.sql(f"CREATE VIEW documents AS SELECT * FROM '{data}/documents.parquet'")
    for name, sql in queries.ORACLE_SQL.items():
        want = db.sql(sql)
        columns = sorted(want.columns)
        got = queries.QUERIES[name](spark, data)
        assert sorted(got.columns) == columns
        assert sorted(map(tuple, got.select(*columns).collect())) == sorted(want.select(*columns).fetchall()), name
