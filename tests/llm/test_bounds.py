"""Repeated rows and rows without ids in number spread over groups; samples and files keep their bounds."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from snapquarry.llm import mixing, packing, quality, suffix_dedup, token_scan, toxicity
from snapquarry.llm.common import store

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def alike(spark):
    """A third each: one repeated row, rows without id and text, and different rows."""
    n = F.col("id") % 3
    text = F.when(n == 0, F.lit("the same words in every one of these rows, time and again and without an end")).when(n == 2, F.concat(F.lit("row "), F.col("id")))
    df = spark.range(30_000).select(F.when(n == 0, F.lit(7)).when(n == 2, F.col("id") + 10).alias("doc_id"), text.alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(1).cast("long").alias("n_chars"))
    return store(df, "alike")


def test_packing_groups(alike):
    """No group of pieces gets far more than its share."""
    packed = packing.pack(store(packing.pieces(alike), "pieces"), group=1000)
    per = [r.n for r in packed.groupBy(F.shiftright("sequence_id", 24)).agg(F.sum(F.size("pieces")).alias("n")).collect()]
    assert sum(per) == 30_000 and len(per) == 30 and max(per) < 1300


def test_suffix_blocks(alike, monkeypatch):
    """Rows with equal ids stay alike wherever they are dealt to, and blocks are even."""
    sizes = []
    real = type(alike).repartition

    def spy(self, n, *columns):
        if columns == ("block",):
            sizes.extend(r["count"] for r in self.groupBy("block").count().collect())
        return real(self, n, *columns)

    monkeypatch.setattr(type(alike), "repartition", spy)
    out = suffix_dedup.dedupe(alike, block_bytes=1 << 16)
    assert len(sizes) > 8 and max(sizes) < 1.5 * sum(sizes) / len(sizes)
    same = out.filter("doc_id = 7").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("kept").alias("k"), F.sum(F.size("spans")).alias("s")).first()
    assert (same.n, same.k, same.s) == (10_000, 1, 0) and out.filter("doc_id is null").count() == 10_000


def test_samples(spark):
    rows = [(1, "x" * 50, "en", "a", 1)] * 500 + [(k, "y" * (10 * k), "en", "a", 1) for k in range(2, 60)]
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(k, k % 2, k % 2) for k in range(60)] + [(2, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    take = lambda **k: quality.sample(docs, labels, "quality", 0, 5, **k).collect()
    assert len(take(most=5, most_bytes=1 << 20)) <= 5
    assert len(take(most=1000, most_bytes=1 << 20)) == len({r.text for r in take(most=1000, most_bytes=1 << 20)}) < 60
    few = take(most=1000, most_bytes=700)
    assert few and sum(len(r.text) for r in few) <= 700
    assert take(most=1000, most_bytes=1 << 20) == take(most=1000, most_bytes=1 << 20) or sorted(take(most=1000, most_bytes=1 << 20)) == sorted(take(most=1000, most_bytes=1 << 20))
    assert quality.sample(docs.limit(0), labels, "toxic", 0, 5, 10, 10).count() == 0
    model = toxicity.train(docs, labels, most_bytes=700)
    assert toxicity.score(docs, model).count() == len(rows)


def test_copies_bound(spark):
    """A bound on copies that is no whole number lets sources reach their target."""
    docs = spark.createDataFrame([(k, "a b c", "en", "small", 1) for k in range(100)] + [(k, "a b c", "en", "t" * 3, 1) for k in range(100, 4000)], SCHEMA)
    got = mixing.plan(docs, most=2.5).groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()
    for r in got:
        assert abs(r.taken - r.target) <= 6, r


def test_damaged_files(spark, tmp_path):
    (tmp_path / "odd").mkdir()
    (tmp_path / "odd" / "a.bin").write_bytes(b"\1\0\2")
    with pytest.raises(ValueError, match=r"a\.bin: 3 bytes"):
        token_scan.read_flat(spark, str(tmp_path / "odd"))
    (tmp_path / "prime").mkdir()
    ids = np.where(np.arange(10_007) % 100 == 99, 9, 1).astype("<u2")  # twice a prime
    (tmp_path / "prime" / "p.bin").write_bytes(ids.tobytes())
    got = token_scan.scan(token_scan.read_flat(spark, str(tmp_path / "prime"), block=1 << 12, small=1000), end_id=9)
    assert got.count() == 100 and got.filter("n_tokens <> 99").count() == 0
