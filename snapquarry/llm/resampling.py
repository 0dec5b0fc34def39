"""Importance resampling towards a target distribution, over hashed word n-grams that an automaton reads off."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded, running, slices, spans_of, store

#: Every byte of a word as it is lower-cased, every other one as the delimiter (a space).
_AS = np.full(256, 32, dtype=np.uint8)
_AS[48:58], _AS[97:123], _AS[128:] = np.arange(48, 58), np.arange(97, 123), np.arange(128, 256)
_AS[65:91] = np.arange(97, 123)
_LENGTH_BITS = 31
_SPACE = zlib.crc32(b" ")


def _zero_bytes() -> np.ndarray:
    """Tables that append 2^k zero bytes to a CRC, for k up to 30: entry [k, p, v] is what byte v at place p of it becomes.
    Appending is linear, so each is the one before, applied twice."""
    one = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        one = np.where(one & 1, (one >> 1) ^ np.uint32(0xEDB88320), one >> 1)
    shift = lambda c: (c >> np.uint32(8)) ^ one[c & np.uint32(255)]
    places = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
    out = np.zeros((_LENGTH_BITS, 4, 256), dtype=np.uint32)
    out[0] = shift(places)
    for k in range(1, _LENGTH_BITS):
        out[k] = _append(out[k - 1], out[k - 1])
    return out


def _append(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    eight, low = np.uint32(8), np.uint32(255)
    return table[0][crc & low] ^ table[1][(crc >> eight) & low] ^ table[2][(crc >> (eight + eight)) & low] ^ table[3][crc >> np.uint32(24)]


_ZEROS = _zero_bytes()


def joined_crc(first: np.ndarray, second: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32 of two byte strings put together, from theirs and the second one's length."""
    out = first.copy()
    for k in range(int(length.max(initial=0)).bit_length()):
        at = np.flatnonzero((length >> k) & 1)
        out[at] = _append(_ZEROS[k], out[at])
    return out ^ second


class Dictionary:
    """Words met so far, each between two delimiters, with their CRC and length as the payload, in an Aho-Corasick
    automaton. A scan gives the payloads of all words that it knows; others are worked out one by one and join it as long as
    it has fewer than `most` words and they have at most `longest` bytes, so its size is bounded, and what it
    knows decides the speed, never the result. It lives as long as its Python worker and grows by a quarter at a time."""

    def __init__(self, most: int = 1 << 17, longest: int = 64):
        self.most, self.longest = most, longest
        self.words: dict[bytes, int] = {}
        self.automaton = ahocorasick.Automaton()
        self.inside = 0

    def payloads(self, text: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """CRC and length of each word of `text`, which has delimiters alone between words, and before the first and
        after the last one."""
        raw = text.tobytes()
        at = np.full(len(text), -1, dtype=np.int64)
        if self.inside:
            found = np.fromiter(chain.from_iterable(self.automaton.iter(raw.decode("latin-1"))), dtype=np.int64).reshape(-1, 2)
            at[found[:, 0]] = found[:, 1]
        out = at[end]
        new: dict[bytes, int] = {}
        for i in np.flatnonzero(out < 0).tolist():
            word = raw[start[i] : end[i]]
            value = self.words.get(word, new.get(word))
            if value is None:
                value = new[word] = zlib.crc32(word) << _LENGTH_BITS | len(word)
            out[i] = value
        self._learn(new)
        return (out >> _LENGTH_BITS).astype(np.uint32), out & ((1 << _LENGTH_BITS) - 1)

    def _learn(self, new: dict[bytes, int]) -> None:
        for word, value in new.items():
            if len(self.words) >= self.most:
                break
            if len(word) <= self.longest:
                self.words[word] = value
        if len(self.words) > self.inside + max(256, self.inside // 4) or (len(self.words) >= self.most > self.inside):
            for word in list(self.words)[self.inside :]:
                self.automaton.add_word(f" {word.decode('latin-1')} ", self.words[word])
            self.automaton.make_automaton()
            self.inside = len(self.words)


_known = Dictionary()


def features(buf: np.ndarray, offs: np.ndarray, buckets: int, known: Dictionary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and row of each feature (words, and pairs of words that follow each other in a row), and words per row."""
    rows = len(offs) - 1
    text = np.full(len(buf) + rows + 1, 32, dtype=np.uint8)
    text[np.arange(len(buf)) + np.repeat(np.arange(1, rows + 1), np.diff(offs))] = _AS[buf]
    words = spans_of(text != 32, np.append(offs[:-1] + np.arange(rows), len(text)))
    crc, length = known.payloads(text, words.start, words.end)
    pair = np.flatnonzero(words.doc[1:] == words.doc[:-1]) if len(crc) else np.zeros(0, dtype=np.int64)
    space = np.full(len(pair), _SPACE, dtype=np.uint32)
    spaced = joined_crc(crc[pair], space, np.ones(len(pair), dtype=np.int64))
    both = joined_crc(spaced, crc[pair + 1], length[pair + 1])
    bucket = np.concatenate([crc, both]) % np.uint32(buckets)
    return bucket.astype(np.int64), np.concatenate([words.doc, words.doc[pair]]), np.diff(words.first)


def bucket_counts(table: DataFrame, buckets: int) -> np.ndarray:
    """Features of all texts by bucket: each task counts its own, Spark adds them up; `buckets` rows reach the driver."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for _, _, buf, offs in slices(batch.column("text"), 1 << 19):
                out += np.bincount(features(buf, offs, buckets, _known)[0], minlength=buckets)
        some = np.flatnonzero(out)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(out[some])], names=["bucket", "n"])

    made = bounded(table).select("text").mapInArrow(counted, "bucket int, n long")
    total = np.zeros(buckets, dtype=np.int64)
    for r in made.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        total[r.bucket] = r.n
    return total


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln of how much likelier a bucket is in the target), both smoothed by one feature a bucket."""
    width = len(source)
    top, low = (target + 1.0) * float(source.sum() + width), (source + 1.0) * float(target.sum() + width)
    return np.floor(1000 * np.log(top / low)).astype(np.int64)


def score(docs: DataFrame, worth: np.ndarray, *, seed: int = 7) -> DataFrame:
    """doc_id, n_words, n_features, weight, score: the floored mean of a text's gains, and that with Gumbel noise drawn from
    the hash of its id."""
    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            many, total, count = [], [], []
            for a, b, buf, offs in slices(batch.column("text"), 1 << 19):
                bucket, row, words = features(buf, offs, len(worth), _known)
                count.append(words)
                many.append(np.bincount(row, minlength=b - a))
                total.append(np.bincount(row, weights=worth[bucket], minlength=b - a).astype(np.int64))
            if many:
                n = np.concatenate(many)
                weight = np.concatenate(total) // np.maximum(n, 1)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.concatenate(count)), pa.array(n), pa.array(weight)], names=["doc_id", "n_words", "n_features", "weight"])

    made = bounded(docs).select("doc_id", "text").mapInArrow(weighed, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words long, n_features long, weight long")
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")
    return made.withColumn("score", F.col("weight") + noise)


def resample(docs: DataFrame, target: DataFrame, *, buckets: int = 10_000, percent: int = 25, least: int = 20, seed: int = 7) -> DataFrame:
    """doc_id, n_features, weight, score, rank: of the N documents with at least `least` words the floor(percent * N / 100)
    with the highest scores are drawn, rank 1 first, ties to the smaller doc_id (null last); rank is null for all others.

    Both tables are read in full, once to count features and docs once more to score them; what is between is `buckets`
    numbers. Texts that are null or have no words have no features and weight 0. Rows that share a score and an id are
    ranked in the order in which they lie; repeated rows are drawn each for itself; a null id counts as an empty one for
    the noise; an empty target counts as one feature a bucket, an empty docs gives no rows; other columns of both are
    ignored, whatever their names. A text of any length is read whole, by one task in about 60 times its bytes.

    Scored rows are dealt by ranges of the order and sorted, and a rank is a row's place in its range plus the rows before
    it: one number a range goes through the driver, and no single task sees all rows."""
    worth = gains(bucket_counts(docs, buckets), bucket_counts(target, buckets))
    scored = store(score(docs, worth, seed=seed), "scored")
    columns = ["doc_id", "n_features", "weight", "score"]
    able = scored.filter(F.col("n_words") >= least).select(*columns, F.monotonically_increasing_id().alias("row"))
    placed = running(able, [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("row")], "ranked")
    sizes = sorted((r.part, r["count"]) for r in placed.groupBy("part").count().collect())
    draw = percent * sum(n for _, n in sizes) // 100
    before = np.cumsum([0, *(n for _, n in sizes)]).tolist()
    starts = docs.sparkSession.createDataFrame([(p, b) for (p, _), b in zip(sizes, before)], "part int, before long")
    rank = F.col("before") + F.col("pos") + 1
    drawn = placed.join(F.broadcast(starts), "part").select(*columns, F.when(rank <= draw, rank).alias("rank"))
    short = scored.filter(F.col("n_words") < least).select(*columns, F.lit(None).cast("long").alias("rank"))
    return drawn.unionByName(short)
