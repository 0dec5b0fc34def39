"""Packing token pieces into sequences of fixed length, bettered by local search."""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded, discard, grouped, store, tasks_for
from .tokens import encoded, tokenizer_path

ROOM = 2048


def narrow(ids: bytes) -> bytes:
    """Ids given in four bytes each, in two bytes each where all of them fit."""
    wide = np.frombuffer(ids, dtype="<u4")
    return wide.astype("<u2").tobytes() if wide.max(initial=0) < 1 << 16 else ids


def widen(ids: bytes, length: int) -> bytes:
    """`length` ids of two or four bytes each, as little-endian unsigned 32-bit."""
    return np.frombuffer(ids, dtype="<u2").astype("<u4").tobytes() if len(ids) == 2 * length else ids


def pieces(docs: DataFrame, *, path: str | None = None, room: int = ROOM, end_id: int = 0) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (of little-endian unsigned 32-bit) and ids, little-endian, of two bytes
    each where they fit, else four: each text's ids and the end id, cut every `room` ids. Null texts are empty, that is
    the end id alone; repeated rows are cut alike; other columns of docs are ignored, whatever their names; texts of any
    length are encoded whole."""
    path = path or tokenizer_path("word_bpe_49k.json")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_ids = batch.column("doc_id")
            for a, _, ids, bounds in encoded(batch.column("text"), path, end_id):
                size = np.diff(bounds)
                many = -(-size // room)
                row = np.repeat(np.arange(len(size)), many)
                k = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
                begin = bounds[row] + k * room
                length = np.minimum(bounds[row + 1] - begin, room)
                wide, fits = ids.tobytes(), ids < 1 << 16
                slim = ids.astype("<u2").tobytes() if fits.all() else None
                crc, own = [], []
                for x, n in zip(begin.tolist(), length.tolist()):
                    part = wide[4 * x : 4 * (x + n)]
                    crc.append(zlib.crc32(part))
                    own.append(slim[2 * x : 2 * (x + n)] if slim is not None else narrow(part))
                columns = [doc_ids.take(pa.array(row + a)), pa.array(k, pa.int32()), pa.array(k * room, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array(own, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"])

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long, ids binary"
    return bounded(docs).select("doc_id", "text").mapInArrow(cut, schema)


def best_fit(lengths: list[int], room: int = ROOM) -> tuple[list[list[int]], list[int]]:
    """(bins of indices, their fills): the longest pieces first, each into the fullest bin that has room for it. Ties go to
    the earlier piece; a length over `room` is an error."""
    if lengths and max(lengths) > room:
        raise ValueError(f"a piece is longer than {room}")
    bins: list[list[int]] = []
    fill: list[int] = []
    at: dict[int, list[int]] = {}
    left: list[int] = []  # the gaps that some bin has, sorted
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        n = lengths[i]
        k = bisect.bisect_left(left, n)
        if k < len(left):
            gap = left[k]
            b = at[gap].pop()
            if not at[gap]:
                del at[gap]
                left.pop(k)
        else:
            b, gap = len(bins), room
            bins.append([])
            fill.append(0)
        bins[b].append(i)
        fill[b] += n
        if gap > n:
            if gap - n not in at:
                at[gap - n] = []
                bisect.insort(left, gap - n)
            at[gap - n].append(b)
    return bins, fill


def search(lengths: list[int], room: int = ROOM) -> list[list[int]]:
    """Bins of indices, each with at most `room` in sum. Starts from best fit by falling length, then exchanges
    between all underfull bins, one for one, two for one, or one moved, always from a bin to a fuller one, so that the sum
    of squared fills grows; a bin that runs empty goes. Ends when no exchange is left (each grows the sum, so there is an
    end) or when no fewer bins are possible."""
    bins, fill = best_fit(lengths, room)
    least, used, again = -(-sum(lengths) // room), len(bins), True
    while again and used > least:
        again, inside = False, None
        for low in sorted((b for b in range(len(bins)) if 0 < fill[b] < room), key=lambda b: fill[b]):
            while fill[low] and used > least:
                inside = inside or _Inside(bins, fill, lengths, room)
                found = inside.partner(low)
                if found is None:
                    break
                high, up, down = found
                _swap(bins, fill, lengths, low, high, up, down)
                again, inside = True, None
                used -= not fill[low]
    return [b for b in bins if b]


class _Inside:
    """What stands in underfull bins, as arrays, with a piece of no length in each, for which one may be moved in."""

    def __init__(self, bins: list, fill: list, lengths: list, room: int):
        self.bins, self.fill, self.lengths = bins, fill, lengths
        under = [b for b in range(len(bins)) if 0 < fill[b] < room]
        self.owner = np.array([b for b in under for _ in range(len(bins[b]) + 1)], dtype=np.int64)
        self.item = np.array([i for b in under for i in (-1, *bins[b])], dtype=np.int64)
        self.size = np.where(self.item >= 0, np.array(lengths, dtype=np.int64)[self.item], 0)
        self.own_fill = np.array(fill, dtype=np.int64)[self.owner]
        self.space = room - self.own_fill + self.size  # the most that may come in for each

    def partner(self, low: int) -> tuple[int, list, list] | None:
        """The fuller bin that takes most from bin `low`, what goes up to it and what comes down."""
        able = np.flatnonzero((self.owner != low) & (self.own_fill >= self.fill[low]))
        size, space = self.size[able], self.space[able]
        small = sorted({self.lengths[i]: i for i in reversed(self.bins[low])}.items(), reverse=True)
        twice = {n: [i for i in self.bins[low] if self.lengths[i] == n] for n, _ in small}
        ups = {n: [i] for n, i in small}
        for x, (n, i) in enumerate(small):
            if len(twice[n]) > 1:
                ups.setdefault(2 * n, twice[n][:2])
            for m, j in small[x + 1 :]:
                ups.setdefault(n + m, [i, j])
        best: tuple[int, int, list] = (0, -1, [])
        for n, up in sorted(ups.items(), reverse=True):
            if n <= best[0]:
                break
            gain = np.where((space >= n) & (size < n), n - size, 0)
            k = int(gain.argmax()) if len(gain) else 0
            if len(gain) and gain[k] > best[0]:
                best = (int(gain[k]), int(able[k]), up)
        if not best[0]:
            return None
        down = [int(self.item[best[1]])] if self.item[best[1]] >= 0 else []
        return int(self.owner[best[1]]), best[2], down


def _swap(bins: list, fill: list, lengths: list, low: int, high: int, up: list, down: list) -> None:
    for one, other, moved in ((low, high, up), (high, low, down)):
        for i in moved:
            bins[one].remove(i)
            bins[other].append(i)
            fill[one] -= lengths[i]
            fill[other] += lengths[i]


def pack(cut: DataFrame, *, room: int = ROOM, group: int = 4096, n_pieces: int | None = None) -> DataFrame:
    """One row a packed sequence: sequence_id, length, ids (the joined ids of its pieces, two bytes each where all fit,
    else four) and pieces, array of (doc_id, piece, start, length) in the order in which they stand. Pieces are dealt by a
    hash of their running number over groups of about `group`, which are packed apart, so equal ones spread as others do (a `cut` that isn't a stored
    table is stored first, so that numbers stay when a task is run again); a group leaves about one bin underfull, so the
    sequences exceed the fewest possible by about one in a thousand. A group takes at most 16 MB of ids. A piece longer
    than `room` is an error; pieces without a document keep a null id; other columns of `cut` are left out; equal pieces
    are packed each for itself; no pieces give no sequences."""
    cut = cut if getattr(cut, "_stored_at", "") else store(cut, "pieces")
    n = cut.count() if n_pieces is None else n_pieces
    groups, names = max(1, round(n / group)), ["doc_id", "piece", "start", "length"]
    dealt = cut.select(*names, "ids", F.col("ids_crc32").alias("_crc"), F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)).alias("_group"))
    dealt = dealt.repartition(tasks_for(cut.sparkSession, groups), "_group").sortWithinPartitions("_group", "doc_id", "piece", "_crc")

    def filled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g, rows in grouped(batches, "_group"):
            lengths, ids = rows.column("length").to_pylist(), rows.column("ids").to_pylist()
            bins = search(lengths, room)
            joined = []
            for b in bins:
                same = len({len(ids[i]) == 2 * lengths[i] for i in b}) == 1
                joined.append(b"".join(ids[i] if same else widen(ids[i], lengths[i]) for i in b))
            inner = rows.select(names).take(pa.array([i for b in bins for i in b], pa.int64())).combine_chunks()
            structs = pa.StructArray.from_arrays([inner.column(c).combine_chunks() for c in names], names=names)
            ends = pa.array(np.cumsum([0, *map(len, bins)]), pa.int32())
            made = [pa.array([(g << 24) + k for k in range(len(bins))], pa.int64()), pa.array([sum(lengths[i] for i in b) for b in bins], pa.int64()), pa.array(joined, pa.binary()), pa.ListArray.from_arrays(ends, structs)]
            yield pa.RecordBatch.from_arrays(made, names=["sequence_id", "length", "ids", "pieces"])

    inside = ", ".join(f"{c}: {cut.schema[c].dataType.simpleString()}" for c in names)
    return dealt.mapInArrow(filled, f"sequence_id long, length long, ids binary, pieces array<struct<{inside}>>")


def members(packed: DataFrame) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, ids, sequence_id, offset: the pieces as they are found in packed
    sequences, ids cut out of the sequence's own (and as wide), from which the crc is taken."""
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("pieces")
            inner, counts = lists.flatten(), np.diff(lists.offsets.to_numpy())
            lengths = iter(inner.field("length").to_pylist())
            ids, crc, offset = [], [], []
            for whole, total, k in zip(batch.column("ids").to_pylist(), batch.column("length").to_pylist(), counts.tolist()):
                width, at = len(whole) // total, 0
                for _ in range(k):
                    n = next(lengths)
                    own = whole[width * at : width * (at + n)]
                    ids.append(own)
                    crc.append(zlib.crc32(widen(own, n)))
                    offset.append(at)
                    at += n
                if at != total or width * total != len(whole):
                    raise ValueError("a sequence's pieces don't fill it")
            names = ["doc_id", "piece", "start", "length"]
            seq = np.repeat(batch.column("sequence_id").to_numpy(), counts)
            yield pa.RecordBatch.from_arrays([*[inner.field(c) for c in names], pa.array(crc, pa.int64()), pa.array(ids, pa.binary()), pa.array(seq, pa.int64()),
                pa.array(offset, pa.int64())], names=[*names, "ids_crc32", "ids", "sequence_id", "offset"])

    kind = packed.schema["pieces"].dataType.elementType["doc_id"].dataType.simpleString()
    return packed.mapInArrow(found, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, ids binary, sequence_id long, offset long")


def sequences(found: DataFrame) -> DataFrame:
    """sequence_id, length, ids (little-endian unsigned 32-bit): sequences put together again from rows of members."""
    whole = F.udf(lambda parts: b"".join(widen(bytes(p["ids"]), p["length"]) for p in parts), "binary")
    parts = F.array_sort(F.collect_list(F.struct("offset", "length", "ids")))
    return found.groupBy("sequence_id").agg(F.sum("length").alias("length"), parts.alias("parts")).select("sequence_id", "length", whole("parts").alias("ids"))


def pack_documents(docs: DataFrame, *, path: str | None = None, with_ids: bool = True) -> DataFrame:
    """Cut and pack whole texts. Tokens are made once; the packed sequences are written to the shared folder with their
    ids, and what is returned is read from these. Nulls, empty and long texts, repeated rows, empty tables and further
    columns as in `pieces`."""
    cut = store(pieces(docs, path=path), "pieces")
    packed = store(pack(cut), "sequences")
    discard(cut)
    found = members(packed)
    return found if with_ids else found.drop("ids")
