"""Quality scores by Bradley-Terry ranking of document pairs."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded, slices
from .textstats import counts_of, per_doc, repeats

_KINDS = {"upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58), "high": range(128, 256), "stop": b".!?", "bang": b"!", "comma": b",;:", "mark": b"#*$%&<>", "bar": b"|", "at": b"@", "feed": b"\n"}
_MASKS = {k: np.isin(np.arange(256), list(v)) for k, v in _KINDS.items()}
FEATURES = ["log_words", "log_bytes", "word_length", "symbols", "dup_lines", "repeats", "distinct", "same_next", "long_words", *_KINDS]


def features(column: pa.Array) -> np.ndarray:
    """One row of features per text, over the whole text; empty and null texts get zeros."""
    out = []
    for _, _, buf, offs in slices(column):
        counts, words, whash = counts_of(buf, offs)
        size, n = np.maximum(np.diff(offs), 1), np.maximum(counts["n_words"], 1)
        rows = len(offs) - 1
        _, first = repeats(words.doc, whash)
        pair = np.flatnonzero((words.doc[1:] == words.doc[:-1]) & (whash[1:] == whash[:-1]))
        out.append(np.column_stack([
            np.log1p(counts["n_words"]), np.log1p(np.diff(offs)), counts["word_chars"] / n, counts["n_symbols"] / n, counts["n_dup_lines"] / n, counts["n_repeat_words"] / n,
            np.bincount(words.doc[first], minlength=rows) / n, np.bincount(words.doc[pair], minlength=rows) / n,
            np.bincount(words.doc[words.end - words.start > 16], minlength=rows) / n, *[per_doc(_MASKS[k][buf], offs) / size for k in _KINDS],
        ]))
    return np.concatenate(out) if out else np.zeros((0, len(FEATURES)))


@dataclass
class Ranker:
    """edges: bin bounds per feature; weights: worth of each bin; cut: the score at which documents count as good;
    spread: width of the scores."""

    edges: np.ndarray
    weights: np.ndarray
    cut: float
    spread: float

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, i], side="right") for i, e in enumerate(self.edges)], axis=1)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.weights[np.arange(x.shape[1]), self.bins(x)].sum(axis=1)

    def score(self, x: np.ndarray, at_cut: float = 0.3) -> np.ndarray:
        z = (self.raw(x) - self.cut) / self.spread + np.log(at_cut / (1 - at_cut))
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(x: np.ndarray, y: np.ndarray, *, n_bins: int = 12, n_pairs: int = 60_000, rounds: int = 300, seed: int = 5) -> Ranker:
    """Bradley-Terry worths: a good document beats a bad one with the logistic of the difference of their scores, and
    the score adds one weight for each feature's bin. The cut is the score quantile that tells the labels apart best."""
    rng = np.random.default_rng(seed)
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    edges = np.quantile(x, np.linspace(0, 1, n_bins + 1)[1:-1], axis=0).T if len(x) else np.zeros((x.shape[1], n_bins - 1))
    model = Ranker(edges, np.zeros((x.shape[1], n_bins)), 0.0, 1.0)
    if not len(good) or not len(bad):
        model.cut = -1.0 if len(good) or not len(bad) else 1.0
        return model
    width = x.shape[1] * n_bins
    hot = np.zeros((len(x), width), dtype=np.float32)
    np.put_along_axis(hot, model.bins(x) + np.arange(x.shape[1]) * n_bins, 1, axis=1)
    a, b = rng.choice(good, n_pairs), rng.choice(bad, n_pairs)
    w, speed = np.zeros(width), np.full(width, 1e-6)
    for _ in range(rounds):
        part = rng.integers(0, n_pairs, 2048)
        diff = hot[a[part]] - hot[b[part]]
        slope = -diff.T @ (1 / (1 + np.exp(diff @ w))) / len(part) + 1e-4 * w
        speed += slope**2
        w -= 0.3 * slope / np.sqrt(speed)
    model.weights = w.reshape(x.shape[1], n_bins)
    s = model.raw(x)
    cuts = np.unique(np.quantile(s, np.linspace(0, 1, 401)))
    right = [((s >= c) == (y == 1)).mean() for c in cuts]
    best = np.flatnonzero(np.asarray(right) >= max(right) - 1e-12)
    model.cut = float((cuts[best[len(best) // 2]] + s[s < cuts[best[len(best) // 2]]].max(initial=s.min())) / 2)
    model.spread = float(max(np.std(s), 1e-6)) / 2
    return model


def held_out(fold: int, of: int):
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(of)) == fold


def sample(docs: DataFrame, labels: DataFrame, label: str, fold: int, of: int, most: int, most_bytes: int) -> DataFrame:
    """At most `most` different labelled documents outside the held-out fold, of `most_bytes` bytes in all: text and y.
    Documents are taken in the order of a hash of their id, then id, then hash of the text, as long as they fit; rows with
    equal id and text count once, and an id with several labels has the greatest. What goes through the driver is a row of fixed size for each
    of them, and only these rows are broadcast."""
    spark = docs.sparkSession
    ids = labels.filter(F.col(label).isNotNull() & ~held_out(fold, of)).groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("y"))
    ids = ids.orderBy(F.xxhash64(F.lit(3), "doc_id"), "doc_id").limit(most)
    named = docs.select("doc_id", "text").withColumn("named", F.xxhash64("text"))
    known = named.join(F.broadcast(ids), "doc_id").select("doc_id", "named", "y", F.coalesce(F.octet_length("text"), F.lit(0)).alias("size")).distinct()
    chosen, left = [], most_bytes
    for r in known.orderBy(F.xxhash64(F.lit(3), "doc_id"), "doc_id", "named").limit(most).collect():
        if r["size"] <= left:
            chosen.append((r.doc_id, r.named, r.y))
            left -= r["size"]
    keys = spark.createDataFrame(chosen, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, named long, y int")
    return named.join(F.broadcast(keys), ["doc_id", "named"]).dropDuplicates(["doc_id", "named"]).select("text", "y")


def train(docs: DataFrame, labels: DataFrame, *, fold: int = 0, of: int = 5, most: int = 6000, most_bytes: int = 1 << 30) -> Ranker:
    """Fit on at most `most` labelled rows of `most_bytes` bytes outside the fold; their features are made on the executors."""
    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = features(batch.column("text"))
            yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.list_(pa.float64())), batch.column("y").cast(pa.int32())], names=["x", "y"])

    rows = sample(docs, labels, "quality", fold, of, most, most_bytes).mapInArrow(vectors, "x array<double>, y int").collect()
    rows = sorted((r.y, tuple(r.x)) for r in rows)
    x = np.array([r[1] for r in rows], dtype=float).reshape(-1, len(FEATURES))
    return fit(x, np.array([r[0] for r in rows], dtype=int))


def score(docs: DataFrame, model: Ranker, *, fold: int = 0, of: int = 5) -> DataFrame:
    """doc_id, held_out, score (0 to 1), predicted. Null and empty texts are scored by their zero features, a null
    doc_id counts as empty for the fold, repeated rows score alike, equal scores are cut alike, an empty table gives no
    rows; a text of any length is read whole, in about 30 times its bytes; other columns are ignored, whatever their
    names."""
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = ["doc_id", "held_out"]
            s = model.score(features(batch.column("text")))
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(s), pa.array((s >= 0.3).astype(np.int32))], names=[*names, "score", "predicted"])

    kept = bounded(docs).select("doc_id", held_out(fold, of).alias("held_out"), "text")
    return kept.mapInArrow(scored, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, held_out boolean, score double, predicted int")
