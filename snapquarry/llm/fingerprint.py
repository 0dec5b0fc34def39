"""Document fingerprints by context-triggered piecewise hashing."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import blocks_for, bounded, hash_spans, mix, slices, store, tasks_for, text_bytes

_MASKS = np.array([(1 << 8 * k) - 1 for k in range(8)], dtype=np.uint64)
_DIGITS = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", dtype=np.uint8)
#: Bytes of context that trigger a boundary, signature length aimed at, smallest block size.
CONTEXT, LENGTH, LEAST = 7, 64, 3
#: Bytes of text whose rolling hashes are held at a time.
WINDOW = 1 << 19


def signatures(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, list[bytes], list[bytes]]:
    """Block size of each text and its signatures at that size and at twice that size. A chunk ends where the hash of
    the last CONTEXT bytes hits the block size; each chunk gives one character. The block size is the smallest power of
    two times LEAST at which the text gives at most LENGTH chunks, so it follows from the text alone."""
    rows = len(offs) - 1
    table = np.zeros((rows, 31), dtype=np.int64)
    for at, level, row in _hits(buf, offs):
        np.add.at(table, (row, level), 1)
    at_least = np.cumsum(table[:, ::-1], axis=1)[:, ::-1]
    size = np.argmax(at_least < LENGTH, axis=1)
    cut: tuple[list, list] = ([], [])
    for at, level, row in _hits(buf, offs):  # made again rather than kept: a text gives few boundaries, and many hashes
        for more in (0, 1):
            cut[more].append(at[level >= (size + more)[row]])
    out: list[list[bytes]] = []
    last = offs[1:][np.diff(offs) > 0]
    for more in (0, 1):
        stops = np.union1d(np.concatenate(cut[more]) + 1, last) if cut[more] else last
        owner = np.searchsorted(offs, stops - 1, side="right") - 1
        starts = np.concatenate([[0], stops[:-1]]) if len(stops) else stops
        starts = np.maximum(starts, offs[owner]) if len(stops) else starts
        chars = _DIGITS[(hash_spans(buf, starts, stops) & np.uint64(63)).astype(np.int64)].tobytes()
        bound = np.searchsorted(owner, np.arange(rows + 1))
        out.append([chars[a:b] for a, b in zip(bound[:-1], bound[1:])])
    return size, out[0], out[1]


def _hits(buf: np.ndarray, offs: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Window by window: places after which a chunk may end, how often 2 divides their hash after LEAST does (a boundary
    at size LEAST * 2^k is one at each smaller size), and their rows. The hash is that of the CONTEXT bytes that end
    there, or of those since the text's begin."""
    padded = np.zeros(len(buf) + 8, dtype=np.uint8)
    padded[: len(buf)] = buf
    eight = np.ndarray(shape=(len(buf) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    for low in range(0, len(buf), WINDOW):
        end = np.arange(low + 1, min(low + WINDOW, len(buf)) + 1)
        row = np.searchsorted(offs, end - 1, side="right") - 1
        begin = np.maximum(end - CONTEXT, offs[row])
        roll = mix((eight[begin] & _MASKS[end - begin]) + (end - begin).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        hit = np.flatnonzero(roll % np.uint64(LEAST) == 0)
        value = mix(roll[hit])
        value = value & (~value + np.uint64(1))
        level = np.where(value == 0, 30, np.minimum(np.log2(np.maximum(value, 1).astype(np.float64)), 30)).astype(np.int64)
        yield end[hit] - 1, level, row[hit]


def fingerprints(column: pa.Array) -> list[str]:
    """"block size:signature:signature at twice the size" of each text."""
    out = []
    for _, _, buf, offs in slices(column):
        size, one, two = signatures(buf, offs)
        out += [f"{LEAST << int(s)}:{a.decode()}:{b.decode()}" for s, a, b in zip(size, one, two)]
    return out


def edit_distances(a: list[str], b: list[str]) -> np.ndarray:
    """Edit distance (insert, delete, substitute) of each pair of short strings, all pairs of the batch in step."""
    n = len(a)
    if not n:
        return np.zeros(0, dtype=np.int64)
    la, lb = np.array([len(x) for x in a]), np.array([len(x) for x in b])
    wide = lambda xs, w, fill: np.frombuffer(b"".join(x.encode().ljust(w, fill) for x in xs), dtype=np.uint8).reshape(n, w)
    wa, wb = max(int(la.max()), 1), max(int(lb.max()), 1)
    ca, cb = wide(a, wa, b"\0").T.copy(), wide(b, wb, b"\1").T.copy()
    out = np.where(la == 0, lb, 0)
    step = np.arange(wb + 1, dtype=np.int16)[:, None]
    row = np.repeat(step, n, axis=1)
    for i in range(wa):
        new = np.empty_like(row)
        new[0] = i + 1
        new[1:] = np.minimum(row[1:] + 1, row[:-1] + (cb != ca[i]))
        row = np.minimum.accumulate(new - step, axis=0) + step
        done = la == i + 1
        out[done] = row[lb[done], np.flatnonzero(done)]
    return out


def likeness(a: list[str], b: list[str]) -> np.ndarray:
    """0 to 1: 1 less the edit distance over the longer signature, at equal block sizes or where one is twice the
    other; 0 for sizes further apart. Two empty texts are alike."""
    left, right, place = [], [], []
    for i, (x, y) in enumerate(zip(a, b)):
        (p, x1, x2), (q, y1, y2) = x.split(":"), y.split(":")
        p, q = int(p), int(q)
        pairs = [(x1, y1), (x2, y2)] if p == q else [(x2, y1)] if q == 2 * p else [(x1, y2)] if p == 2 * q else []
        for u, v in pairs:
            left.append(u)
            right.append(v)
            place.append(i)
    d = edit_distances(left, right)
    out = np.zeros(len(a))
    longest = np.array([max(len(u), len(v), 1) for u, v in zip(left, right)])
    np.maximum.at(out, np.array(place, dtype=np.int64), 1 - d / longest if len(d) else np.zeros(0))
    return out


def edited(text: str, following: str) -> str:
    """text with its last third replaced by as many leading characters of the following text, or all of them."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


_RESULT = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_NAMES = [c.split(" ")[0] for c in _RESULT.split(", ")]


def _results(text: list[str], following: list[str]) -> list[pa.Array]:
    changed = [edited(a, b) for a, b in zip(text, following)]
    own, other, after = (fingerprints(pa.array(x, pa.large_string())) for x in (text, changed, following))
    return [pa.array([len(t) for t in text], pa.int64()), pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()),
            pa.array(own, pa.string()), pa.array(other, pa.string()), pa.array(likeness(own, other)), pa.array(likeness(own, after))]


def _within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of all rows of a part but its last, and the part's first and last row with their texts (edge 0 and 1)."""
    def told(ids: list, text: list, after: list, kind: pa.DataType) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(ids, kind), *_results(text, after), pa.nulls(len(ids), pa.int32()), pa.nulls(len(ids), pa.string())], names=["doc_id", *_NAMES, "edge", "text"])

    held: tuple | None = None
    first: tuple | None = None
    kind = None
    for batch in batches:
        kind = batch.schema.field("doc_id").type
        ids, text, after, size = [], [], [], 0
        for row in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            first = first or row
            if held is not None:
                ids.append(held[0])
                text.append(held[1])
                after.append(row[1])
                size += len(row[1])
            held = row
            if size > 1 << 20:
                yield told(ids, text, after, kind)
                ids, text, after, size = [], [], [], 0
        if ids:
            yield told(ids, text, after, kind)
    if held is not None:
        nothing = [pa.nulls(2, t) for t in (pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())]
        yield pa.RecordBatch.from_arrays([pa.array([first[0], held[0]], kind), *nothing, pa.array([0, 1], pa.int32()), pa.array([first[1], held[1]], pa.string())], names=["doc_id", *_NAMES, "edge", "text"])


def _between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *_results(batch.column("text").to_pylist(), batch.column("next_text").to_pylist())], names=["doc_id", *_NAMES])


def compare(docs: DataFrame, part_bytes: int = 4 << 20) -> DataFrame:
    """Fingerprint of each text and of its edited text (see `edited`), and likenesses: doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next.

    Texts are dealt once, by Spark's range partitioning of doc_id, which may be of any orderable type; each part compares
    neighbours within it, and gives its first and last text out, so that the last of a part meets the first of the next
    one that isn't empty (of the first part after all). Null texts count as empty; null ids come last, rows with equal
    ids are ordered by text; a table of one row follows itself; an empty table gives no rows; other columns are ignored,
    whatever their names. Rolling hashes are held WINDOW bytes at a time, so a text takes a few times its own size."""
    n = tasks_for(docs.sparkSession, blocks_for(text_bytes(docs), part_bytes))
    order = F.col("doc_id").desc_nulls_last()
    rows = bounded(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    dealt = rows.repartitionByRange(n, order).sortWithinPartitions(order, "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    made = store(dealt.mapInArrow(_within, f"doc_id {kind}, {_RESULT}, edge int, text string").withColumn("part", F.spark_partition_id()), "fingerprints")
    edges = made.filter("edge is not null").groupBy("part").agg(*[F.max(F.when(F.col("edge") == e, F.struct("doc_id", "text"))).alias(f"e{e}") for e in (0, 1)])
    ring = Window.orderBy("part")  # one number a part
    around = ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = edges.select("part").withColumn("next_part", F.coalesce(F.lead("part").over(ring), F.first("part").over(around)))
    firsts = edges.select(F.col("part").alias("next_part"), F.col("e0.text").alias("next_text"))
    lasts = edges.select("part", F.col("e1.doc_id").alias("doc_id"), F.col("e1.text").alias("text")).join(after, "part").join(firsts, "next_part").select("doc_id", "text", "next_text")
    return made.filter("edge is null").select("doc_id", *_NAMES).unionByName(lasts.mapInArrow(_between, f"doc_id {kind}, {_RESULT}"))
