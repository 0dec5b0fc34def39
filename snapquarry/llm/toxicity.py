"""Toxicity by averaged subword embeddings under a linear softmax, trained jointly in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import _BLANK, bounded, lower_ascii, mix, prefix_hash, slices, span_hash
from .quality import held_out, sample

GRAMS = (3, 4, 5)
BITS = 15
#: Words in a window; a document is as toxic as its worst window.
WIDTH = 4


@dataclass
class Subwords:
    """ids: n-gram buckets of all words, one after another; at: index of each word's first; first: each row's first word."""

    ids: np.ndarray
    at: np.ndarray
    first: np.ndarray


def subwords(buf: np.ndarray, offs: np.ndarray) -> Subwords:
    """Character n-grams (as bytes, ASCII lower-cased) of each word with a blank on either side, and the whole word."""
    rows = len(offs) - 1
    n = len(buf) + rows + 1
    text = np.full(n, 32, dtype=np.uint8)
    text[np.arange(len(buf)) + 1 + np.repeat(np.arange(rows), np.diff(offs))] = np.where(_BLANK[buf], 32, lower_ascii(buf))
    blank = text == 32
    start = np.flatnonzero(blank[:-1] & ~blank[1:])  # the blank before each word
    end = np.flatnonzero(~blank[:-1] & blank[1:]) + 2  # after the blank behind it
    edge = offs + np.arange(rows + 1)
    first = np.searchsorted(start, edge)
    word_of = np.cumsum(blank) - 1
    index = np.full(n + 1, -1, dtype=np.int64)
    index[word_of[start]] = np.arange(len(start))
    where, ids = [np.arange(len(start))], []
    inner = np.concatenate([[0], np.cumsum(blank)])
    value = np.zeros(n, dtype=np.uint64)
    for size in range(1, min(max(GRAMS), n) + 1):
        value[: n - size + 1] = value[: n - size + 1] * np.uint64(257) + text[size - 1 :]
        if size in GRAMS:
            p = np.arange(n - size + 1)
            own = index[word_of[p]]
            ok = (inner[p + size - 1] - inner[p + 1] == 0) & ((~blank[p]) | ~blank[np.minimum(p + 1, n - 1)]) & (own >= 0)
            p = p[ok]
            where.append(own[p] if len(p) else np.zeros(0, dtype=np.int64))
            ids.append((mix(value[p] + np.uint64(size << 56)) >> np.uint64(64 - BITS)).astype(np.int64))
    whole = span_hash(prefix_hash(text), start, end)
    ids = np.concatenate([(whole >> np.uint64(64 - BITS)).astype(np.int64), *ids])
    where = np.concatenate(where)
    order = np.argsort(where, kind="stable")
    return Subwords(ids[order], np.searchsorted(where[order], np.arange(len(start) + 1)), first)


def stretches(buf: np.ndarray, offs: np.ndarray, most: int = 1 << 18) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """Bytes and offsets as they are, or, for one long row, stretches of about `most` bytes cut at white space, each
    beginning WIDTH - 1 words before the end of the one before it; and whether it is the last. A single word is never
    cut."""
    if len(offs) != 2 or len(buf) <= 2 * most:
        yield buf, offs, True
        return
    opens = np.flatnonzero(_BLANK[buf[:-1]] & ~_BLANK[buf[1:]]) + 1  # where words begin
    at = 0
    while len(buf) - at > 2 * most:
        k = int(np.searchsorted(opens, at + most))
        if k >= len(opens) or k < WIDTH or opens[k - WIDTH + 1] <= at:
            break
        yield buf[at : opens[k]], np.array([0, opens[k] - at]), False
        at = int(opens[k - WIDTH + 1])
    yield buf[at:], np.array([0, len(buf) - at]), True


@dataclass
class Model:
    """worth: for each n-gram bucket, its embedding times the softmax weights' difference; bias: the classes' difference."""

    worth: np.ndarray
    bias: float
    cut: float = 0.0

    def windows(self, grams: Subwords) -> tuple[np.ndarray, np.ndarray]:
        """Logit of the window that starts at each word (fewer words at a row's end), and each word's row."""
        n = len(grams.at) - 1
        total = np.zeros(n + 1)
        for lo in range(0, n, 1 << 16):
            part = grams.at[lo : lo + (1 << 16) + 1]
            total[lo + 1 : lo + len(part)] = np.add.reduceat(self.worth[grams.ids[part[0] : part[-1]]], part[:-1] - part[0])
        total = np.cumsum(total)
        row = np.repeat(np.arange(len(grams.first) - 1), np.diff(grams.first))
        last = np.minimum(np.arange(n) + WIDTH, grams.first[1:][row]) if n else np.zeros(0, dtype=np.int64)
        size = np.maximum(grams.at[last] - grams.at[:-1], 1)
        return (total[last] - total[:-1]) / size + self.bias, row

    def logits(self, column: pa.Array) -> np.ndarray:
        """Largest window logit of each text; texts without words get the lowest."""
        out = []
        for _, _, buf, offs in slices(column):
            top = np.full(len(offs) - 1, -30.0)
            for part, edges, last in stretches(buf, offs):
                z, row = self.windows(subwords(part, edges))
                whole = len(z) if last else max(len(z) - WIDTH + 1, 0)  # windows cut short by the end of a stretch come whole in the next
                np.maximum.at(top, row[:whole], z[:whole])
            out.append(top)
        return np.concatenate(out) if out else np.zeros(0)

    def score(self, column: pa.Array, at_cut: float = 0.3) -> np.ndarray:
        z = self.logits(column) - self.cut + np.log(at_cut / (1 - at_cut))
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(texts: list[str], y: np.ndarray, *, dim: int = 16, epochs: int = 8, seed: int = 11) -> Model:
    """Embeddings and softmax weights learned together. A label belongs to a whole text: in each epoch it is given to
    the text's worst window so far (for clean texts also to a random one). Which windows of toxic texts come first is
    told from how many clean texts hold their words' n-grams."""
    rng = np.random.default_rng(seed)
    size = 1 << BITS
    a, b = np.zeros(size, dtype=np.int64), np.zeros(size, dtype=np.int64)
    ids, at, first = [], [np.zeros(1, dtype=np.int64)], [np.zeros(1, dtype=np.int64)]
    for row, _, buf, offs in slices(pa.array(texts, pa.string()), 1 << 19):
        g = subwords(buf, offs)
        of_gram = np.repeat(np.repeat(np.arange(len(g.first) - 1), np.diff(g.first)), np.diff(g.at))
        pairs = np.unique(of_gram * size + g.ids)
        bad = y[row + pairs // size] == 1
        a += np.bincount((pairs % size)[bad], minlength=size)
        b += np.bincount((pairs % size)[~bad], minlength=size)
        ids.append(g.ids.astype(np.uint16))
        at.append(g.at[1:] + at[-1][-1])
        first.append(g.first[1:] + first[-1][-1])
    grams = Subwords(np.concatenate(ids) if ids else np.zeros(0, dtype=np.uint16), np.concatenate(at), np.concatenate(first))
    del ids
    start = np.log((a + 0.2) / (max((y == 1).sum(), 1) + 1)) - np.log((b + 0.2) / (max((y == 0).sum(), 1) + 1))
    model = Model(np.where(a + b >= 2, start, 0.0), 0.0)
    embed = np.concatenate([model.worth[:, None] * 0.5, rng.normal(0, 0.05, (size, dim - 1))], axis=1)
    soft, bias = np.zeros((dim, 2)), np.zeros(2)
    soft[0] = -0.5, 0.5
    ge, gs, gb = np.full(embed.shape, 0.1), np.full(soft.shape, 0.1), np.full(2, 0.1)
    used = np.flatnonzero(np.diff(grams.first) > 0)
    for epoch in range(epochs if len(used) else 0):
        z, row = model.windows(grams)
        order = np.lexsort((z, row))
        worst = order[np.cumsum(np.diff(grams.first))[used] - 1]
        some = grams.first[used] + (rng.random(len(used)) * np.diff(grams.first)[used]).astype(np.int64)
        clean = y[used] == 0
        begin = np.concatenate([worst, some[clean], worst[~clean], worst[~clean]])
        label = np.concatenate([y[used], np.zeros(clean.sum()), np.ones(2 * (~clean).sum())]).astype(int)
        for part in np.array_split(rng.permutation(len(begin)), max(1, len(begin) // 256)):
            w, t = begin[part], label[part]
            last = np.minimum(w + WIDTH, grams.first[1:][row[w]])
            lo, n = grams.at[w], grams.at[last] - grams.at[w]
            which = np.repeat(np.arange(len(w)), n)
            g = grams.ids[np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
            mean = np.add.reduceat(embed[g], np.cumsum(n) - n) / n[:, None]
            p = mean @ soft + bias
            p = np.exp(p - p.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(t)), t] -= 1
            slope, down = mean.T @ p / len(w), (p @ soft.T) / np.maximum(n, 1)[:, None]
            gs += slope**2
            gb += p.mean(axis=0) ** 2
            soft -= 0.2 * slope / np.sqrt(gs)
            bias -= 0.2 * p.mean(axis=0) / np.sqrt(gb)
            hit, place = np.unique(g, return_inverse=True)
            step = np.stack([np.bincount(place, weights=down[which, d], minlength=len(hit)) for d in range(dim)], axis=1)
            ge[hit] += step**2
            embed[hit] -= 0.3 * step / np.sqrt(ge[hit])
        model.worth, model.bias = embed @ (soft[:, 1] - soft[:, 0]), float(bias[1] - bias[0])
    return model


def train(docs: DataFrame, labels: DataFrame, *, fold: int = 2, of: int = 4, most: int = 4000, most_bytes: int = 64 << 20) -> Model:
    """Fit on at most `most` labelled texts of `most_bytes` bytes outside the fold, which the driver holds; the cut is set on
    a third of them that the fit leaves out."""
    rows = sorted((r.text or "", r.y) for r in sample(docs, labels, "toxic", fold, of, most, most_bytes).toLocalIterator())
    texts, y = [r[0] for r in rows], np.array([r[1] for r in rows], dtype=int)
    later = np.arange(len(y)) % 3 == 0
    trial = fit([t for t, x in zip(texts, later) if not x], y[~later])
    z, told = trial.logits(pa.array([t for t, x in zip(texts, later) if x], pa.string())), y[later]
    model = fit(texts, y)
    if (told == 1).any() and (told == 0).any():
        cuts = np.unique(z)
        mid = np.concatenate([cuts[:1] - 1, (cuts[1:] + cuts[:-1]) / 2, cuts[-1:] + 1])
        f1 = [2 * ((z >= c) & (told == 1)).sum() / max((z >= c).sum() + (told == 1).sum(), 1) for c in mid]
        best = np.flatnonzero(np.asarray(f1) >= max(f1) - 0.002)
        model.cut = float(mid[best].mean())
    else:
        model.cut = 30.0 if not (y == 1).any() else -30.0
    return model


def score(docs: DataFrame, model: Model, *, fold: int = 2, of: int = 4) -> DataFrame:
    """doc_id, held_out, score (0 to 1), predicted; null and empty texts have no window and score lowest. Repeated
    rows score alike, equal scores are cut alike, an empty table gives no rows; a text of any length is read whole, in
    stretches of whole words; other columns are ignored, whatever their names."""
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = model.score(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(s), pa.array((s >= 0.3).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    kept = bounded(docs).select("doc_id", held_out(fold, of).alias("held_out"), "text")
    return kept.mapInArrow(scored, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, held_out boolean, score double, predicted int")
