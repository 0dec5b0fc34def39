"""Removal of passages that a document with a smaller id holds too, by suffix arrays over shards of shared windows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import blocks_for, bounded, grouped, mix, prefix_hash, running, slices, span_hash, tasks_for, text_bytes
from .suffix_array import shared_windows

#: Bytes of a match, of the grams whose smallest hash names a window, most windows in one string.
MATCH, GRAM, RUN = 50, 20, 31
#: Different strings under one name above which its windows are dealt one by one.
HOT = 2000
#: Bytes that one suffix array takes.
SHARD = 1 << 18
#: Bytes of text looked at in one go.
SLICE = 1 << 17
_LAST = np.iinfo(np.int64).max


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each `width` neighbours."""
    out, have = values, 1
    while 2 * have <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    more = width - have
    return np.minimum(out[:-more], out[more:]) if more else out


class Runs:
    """The windows of some rows, as strings: neighbouring windows with one name (the smallest gram hash in them) and
    one row, RUN at most. Equal windows have equal names, wherever they stand. begin, count: first window and number of
    windows of each string; row: its row; name: its name; content: hash of its bytes; parent: see split."""

    def __init__(self, buf: np.ndarray, offs: np.ndarray):
        n = len(buf) - MATCH + 1
        self.prefix = prefix_hash(buf)
        if n <= 0:
            self.begin = self.count = self.row = np.zeros(0, dtype=np.int64)
            self.name = self.content = self.parent = np.zeros(0, dtype=np.uint64)
            return
        at = np.arange(len(buf) - GRAM + 1)
        name = mix(_smallest(span_hash(self.prefix, at, at + GRAM), MATCH - GRAM + 1))  # a smallest hash is small: spread over all shards
        new = np.ones(n, dtype=bool)
        new[1:] = name[1:] != name[:-1]
        ends = np.minimum(offs[1:] - MATCH + 1, n)
        fits = np.zeros(len(buf) + 1, dtype=np.int64)
        long = ends > offs[:-1]
        fits[offs[:-1][long]] += 1
        fits[ends[long]] -= 1
        inside = np.cumsum(fits)[:n] > 0
        new[offs[:-1][long]] = True
        new[ends[ends < n]] = True
        begin = np.flatnonzero(new)
        count = np.diff(np.append(begin, n))
        keep = inside[begin]
        begin, count = begin[keep], count[keep]
        pieces = -(-count // RUN)
        k = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        self.begin = np.repeat(begin, pieces) + k * RUN
        self.count = np.minimum(np.repeat(count, pieces) - k * RUN, RUN)
        self.row = np.searchsorted(offs, self.begin, side="right") - 1
        self.name = name[self.begin]
        self.content = self._content(self.begin, self.count)
        self.parent = np.zeros(len(self.begin), dtype=np.uint64)

    def _content(self, begin: np.ndarray, count: np.ndarray) -> np.ndarray:
        return span_hash(self.prefix, begin, begin + count + MATCH - 1)

    def only(self, keep: np.ndarray) -> "Runs":
        out = object.__new__(Runs)
        out.prefix = self.prefix
        for c in ("begin", "count", "row", "name", "content", "parent"):
            setattr(out, c, getattr(self, c)[keep])
        return out

    def split(self, names: np.ndarray) -> "Runs":
        """The strings, those of the given (sorted) names taken apart into single windows that are their own names
        (parent: the name that they had)."""
        apart = _among(self.name, names)
        if not apart.any():
            return self
        one, whole = self.only(apart), self.only(~apart)
        begin = np.repeat(one.begin, one.count) + np.arange(one.count.sum()) - np.repeat(np.cumsum(one.count) - one.count, one.count)
        single = np.ones(len(begin), dtype=np.int64)
        content = self._content(begin, single)
        out = object.__new__(Runs)
        out.prefix = self.prefix
        out.begin, out.count = np.concatenate([whole.begin, begin]), np.concatenate([whole.count, single])
        out.row = np.concatenate([whole.row, np.repeat(one.row, one.count)])
        out.name, out.content = np.concatenate([whole.name, mix(content)]), np.concatenate([whole.content, content])
        out.parent = np.concatenate([whole.parent, np.repeat(one.name, one.count)])
        return out


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(values), dtype=bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def _shards(names: np.ndarray, shards: int) -> np.ndarray:
    return ((names >> np.uint64(40)) * np.uint64(shards) >> np.uint64(24)).astype(np.int64)


def _stretched(values: np.ndarray) -> list[tuple[int, int, int]]:
    """(value, begin, end) of each run of a sorted array."""
    if not len(values):
        return []
    at = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
    return list(zip(values[at].tolist(), at.tolist(), np.append(at[1:], len(values)).tolist()))


def _low(names: np.ndarray) -> np.ndarray:
    return names & np.uint64((1 << 40) - 1)


def _ids(column: pa.Array) -> np.ndarray:
    """Places of rows in the order of ids."""
    return column.to_numpy(zero_copy_only=False)


def _packed5(low: np.ndarray) -> bytes:
    return np.ascontiguousarray(low.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def _unpacked5(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 5, 8), dtype=np.uint8)
    out[:, :5] = np.frombuffer(data, dtype=np.uint8).reshape(-1, 5)
    return out.view("<u8").ravel()


def _groups(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by the keys (the last is the first sort key), and where each new value begins in it."""
    order = np.lexsort(keys)
    new = np.ones(len(order), dtype=bool)
    if len(order):
        new[1:] = np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0)
    return order, np.flatnonzero(new)


def _named(shards: int):
    """For each block and shard: the names in the block, five bytes each (the shard tells the rest); `plain` ones occur
    in one string of one document, `more` ones come with a count of different strings, made odd if several documents
    have the name."""
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, rows in grouped(batches, "block"):
            ids, found = _ids(rows.column("_place").combine_chunks()), []
            for a, b, buf, offs in slices(rows.column("text"), SLICE):
                r = Runs(buf, offs)
                found.append((r.name, r.content, ids[a:b][r.row]))
            name, content, doc = (np.concatenate([f[k] for f in found]) for k in range(3))
            order, at = _groups(content, name)
            texts_of = name[order][at]
            one, first = np.unique(texts_of, return_index=True)
            strings = np.diff(np.append(first, len(texts_of)))
            by_name, at = _groups(name)
            low_id, high_id = (f.reduceat(doc[by_name], at) if len(at) else doc for f in (np.minimum, np.maximum))
            several = low_id != high_id
            mark = np.minimum(strings, 30_000) * 2 + several
            out: list[tuple] = []
            for s, a, b in _stretched(_shards(one, shards)):
                part = slice(a, b)
                names, marks = _low(one[part]), mark[part]
                plain = marks == 2
                out.append((s, _packed5(names[plain]), _packed5(names[~plain]), marks[~plain].astype("<u2").tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int32()), pa.array([block] * len(out), pa.int32()),
                *[pa.array([o[k] for o in out], pa.binary()) for k in (1, 2, 3)]], names=["shard", "block", "plain", "more", "marks"])
    return made


def _repeated(hot: int):
    """Back to each block: those of its names that more than one document has; of these, apart, the very common ones."""
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, rows in grouped(batches, "shard"):
            names, marks, owner = [], [], []
            for i, (plain, more, mark) in enumerate(zip(*[rows.column(c).to_pylist() for c in ("plain", "more", "marks")])):
                p, m = _unpacked5(plain), _unpacked5(more)
                names += [p, m]
                marks += [np.full(len(p), 2), np.frombuffer(mark, dtype="<u2").astype(np.int64)]
                owner.append(np.full(len(p) + len(m), i))
            name, mark, owner = np.concatenate(names), np.concatenate(marks), np.concatenate(owner)
            order, at = _groups(name)
            size = np.diff(np.append(at, len(order)))
            strings = np.add.reduceat(mark[order] >> 1, at)
            dup = (size > 1) | (np.maximum.reduceat(mark[order] & 1, at) > 0)
            often = np.repeat(dup & (strings > hot), size)
            dup = np.repeat(dup, size)
            name, owner = name[order], owner[order]
            blocks = rows.column("block").to_pylist()
            by = np.argsort(owner[dup], kind="stable")
            name, owner, often = name[dup][by], owner[dup][by], often[dup][by]
            edge = np.searchsorted(owner, np.arange(len(blocks) + 1))
            out = [(blocks[i], _packed5(name[a:b]), _packed5(name[a:b][often[a:b]])) for i, (a, b) in enumerate(zip(edge[:-1], edge[1:])) if b > a]
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int32()), pa.array([shard] * len(out), pa.int32()), *[pa.array([o[k] for o in out], pa.binary()) for k in (1, 2)]], names=["block", "shard", "names", "often"])
    return made


def _full_names(table: pa.Table, column: str, shards: int) -> np.ndarray:
    """(shard, low 40 bits) of the names, as one sorted number."""
    parts = [np.uint64(s) << np.uint64(40) | _unpacked5(d) for s, d in zip(table.column("shard").to_pylist(), table.column(column).to_pylist()) if d]
    return np.sort(np.concatenate(parts)) if parts else np.zeros(0, dtype=np.uint64)


def _short(names: np.ndarray, shards: int) -> np.ndarray:
    return _shards(names, shards).astype(np.uint64) << np.uint64(40) | _low(names)


def _chosen(buf, offs, names: np.ndarray, often: np.ndarray, shards: int) -> Runs:
    runs = Runs(buf, offs)
    short = _short(runs.name, shards)
    runs = runs.only(_among(short, names))
    if len(often):
        return runs.split(np.unique(runs.name[_among(_short(runs.name, shards), often)]))
    return runs


def _strings(shards: int):
    """For each block and shard: each different string of a repeated name once, with the smallest and largest id."""
    def made(rows: pa.Table, told: pa.Table) -> pa.Table:
        names, often = _full_names(told, "names", shards), _full_names(told, "often", shards)
        ids, found, data = _ids(rows.column("_place").combine_chunks()), [], []
        block = rows.column("block")[0].as_py() if rows.num_rows else 0
        for a, b, buf, offs in slices(rows.column("text"), SLICE) if len(names) else ():
            r = _chosen(buf, offs, names, often, shards)
            doc = ids[a:b][r.row]
            order, at = _groups(r.content, r.name)
            if not len(at):
                continue
            first = order[at]
            found.append((r.name[first], r.content[first], np.minimum.reduceat(doc[order], at), np.maximum.reduceat(doc[order], at), r.parent[first]))
            raw = buf.tobytes()
            data += [raw[x:y] for x, y in zip(r.begin[first].tolist(), (r.begin[first] + r.count[first] + MATCH - 1).tolist())]
        columns: dict[str, list] = {k: [] for k in ("shard", "block", "heads", "sizes", "data")}
        if found:
            name, content, low, high, parent = (np.concatenate([f[k] for f in found]) for k in range(5))
            order, at = _groups(content, name)
            first, low, high = order[at], np.minimum.reduceat(low[order], at), np.maximum.reduceat(high[order], at)
            name, content = name[first], content[first]
            heads = np.stack([name, content, low.astype(np.uint64), high.astype(np.uint64), parent[first]], axis=1)
            for s, a, b in _stretched(_shards(name, shards)):
                own = [data[i] for i in first[a:b].tolist()]
                for k, v in zip(columns, (s, block, heads[a:b].astype("<u8").tobytes(), np.array([len(x) for x in own], dtype="<u2").tobytes(), pa.compress(b"".join(own), codec="zstd", asbytes=True))):
                    columns[k].append(v)
        return pa.table([pa.array(columns["shard"], pa.int32()), pa.array(columns["block"], pa.int32()), *[pa.array(columns[k], pa.binary()) for k in ("heads", "sizes", "data")]], names=list(columns))
    return made


#: An answer on a string whose windows all have one smallest document; its bytes as they are sent.
_ONE = np.dtype([("content", "<u8"), ("doc", "<i8"), ("parent", "<u8")])


def _owners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each shard: the smallest document of every window, by suffix arrays over its different strings, and back to
    each block what it loses: strings with one smallest document (`ones`), and strings in several stretches (`many`:
    content, parent, number of stretches, and for each its first window and its smallest document)."""
    for _, rows in grouped(batches, "shard"):
        heads = [np.frombuffer(h, dtype="<u8").reshape(-1, 5) for h in rows.column("heads").to_pylist()]
        edge = np.concatenate([[0], np.cumsum([len(h) for h in heads])])
        head = np.concatenate(heads)
        data = rows.column("data").to_pylist()
        each = [np.frombuffer(x, dtype="<u2").astype(np.int64) for x in rows.column("sizes").to_pylist()]
        data = [pa.decompress(d, decompressed_size=int(x.sum()), codec="zstd", asbytes=True) for d, x in zip(data, each)]
        sizes = np.concatenate(each)
        owner = np.repeat(np.arange(len(heads)), np.diff(edge))
        begin = np.cumsum(sizes) - sizes
        begin -= begin[np.minimum(edge[:-1], len(sizes) - 1)][owner]
        order, at = _groups(head[:, 1], head[:, 0])
        least = np.minimum.reduceat(head[order, 2].astype(np.int64), at)
        which = np.empty(len(order), dtype=np.int64)  # of the different strings
        which[order] = np.repeat(np.arange(len(at)), np.diff(np.append(at, len(order))))
        first = order[at]

        def string(i: int) -> bytes:
            j = first[i]  # noqa: B023
            return data[owner[j]][begin[j] : begin[j] + sizes[j]]  # noqa: B023

        many = _stretches(string, sizes[first], least, head[first, 0])
        lowest = least.copy()
        for i, (_, docs) in many.items():
            lowest[i] = docs.min()
        several = np.zeros(len(at), dtype=bool)
        several[list(many)] = True
        told = lowest[which] < head[:, 3].astype(np.int64)
        out: list[tuple[int, bytes, bytes]] = []
        for i, block in enumerate(rows.column("block").to_pylist()):
            own = np.arange(edge[i], edge[i + 1])[told[edge[i] : edge[i + 1]]]
            one = own[~several[which[own]]]
            ones = np.empty(len(one), dtype=_ONE)
            ones["content"], ones["doc"], ones["parent"] = head[one, 1], least[which[one]], head[one, 4]
            parts = []
            for j in own[several[which[own]]].tolist():
                starts, docs = many[int(which[j])]
                parts.append(head[j, [1, 4]].tobytes() + bytes([len(starts)]) + starts.astype(np.uint8).tobytes() + docs.astype("<i8").tobytes())
            if len(own):
                out.append((block, ones.tobytes(), b"".join(parts)))
        yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int32()), *[pa.array([o[k] for o in out], pa.binary()) for k in (1, 2)]], names=["block", "ones", "many"])


def _stretches(string, sizes: np.ndarray, least: np.ndarray, name: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Of the different strings, those whose windows differ in smallest document: where its stretches begin and these
    documents. `least` is set to the smallest of those in one stretch. A different string whose name no other has
    shares windows with none, so its smallest document is known already; all others go through suffix arrays of about
    SHARD bytes, strings with one name, which alone can share windows, kept together."""
    out: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    _, place, count = np.unique(name, return_inverse=True, return_counts=True)
    todo = np.flatnonzero(count[place] > 1)
    todo = todo[np.argsort(name[todo], kind="stable")]
    total, last = np.cumsum(sizes[todo]), np.flatnonzero(np.append(name[todo][1:] != name[todo][:-1], True)) if len(todo) else np.zeros(0, dtype=np.int64)
    at = 0
    while at < len(todo):
        full = int(np.searchsorted(total, (total[at - 1] if at else 0) + SHARD))
        end = int(last[min(np.searchsorted(last, min(full, len(todo) - 1)), len(last) - 1)]) + 1
        part = todo[at:end]
        group = shared_windows([string(i) for i in part.tolist()], MATCH)
        doc = np.full(len(group), _LAST)
        doc[: int((sizes[part] + 1).sum())] = np.repeat(least[part], sizes[part] + 1)
        smallest = np.full(len(group) + 1, _LAST)
        np.minimum.at(smallest, group, doc)  # places without a window have group -1, the last entry
        value = smallest[group]
        begins = np.cumsum(sizes[part] + 1) - sizes[part] - 1
        windows = sizes[part] - MATCH + 1
        change = np.zeros(len(group) + 1, dtype=np.int64)
        change[1:-1] = np.cumsum(value[1:] != value[:-1])
        change[0] = 0
        least[part] = value[begins]
        for k in np.flatnonzero(change[begins + windows - 1] != change[begins]).tolist():
            v = value[begins[k] : begins[k] + windows[k]]
            first = np.flatnonzero(np.append(True, v[1:] != v[:-1]))
            out[int(part[k])] = (first, v[first])
        at = end
    return out


def _cut(keep: list[str], shards: int):
    def made(rows: pa.Table, told: pa.Table) -> pa.Table:
        ones = np.frombuffer(b"".join(told.column("ones").to_pylist()), dtype=_ONE)
        ones = ones[np.argsort(ones["content"], kind="stable")]
        many: dict[int, tuple[list, list]] = {}
        parents = [ones["parent"]]
        for data in told.column("many").to_pylist():
            at = 0
            while at < len(data):
                content, parent, n = int.from_bytes(data[at : at + 8], "little"), data[at + 8 : at + 16], data[at + 16]
                many[content] = list(data[at + 17 : at + 17 + n]), np.frombuffer(data, dtype="<i8", count=n, offset=at + 17 + n).tolist()
                parents.append(np.frombuffer(parent, dtype="<u8"))
                at += 17 + 9 * n
        several = np.sort(np.fromiter(many, dtype=np.uint64, count=len(many)))
        apart = np.unique(np.concatenate(parents))
        apart = apart[apart > 0]
        contents = np.ascontiguousarray(ones["content"])
        ids = _ids(rows.column("_place").combine_chunks())
        n_bytes, spans, kept = [], [], []
        for a, b, buf, offs in slices(rows.column("text"), SLICE):
            cover = np.zeros(len(buf) + 1, dtype=np.int32)
            if len(ones) or many:
                runs = Runs(buf, offs)
                if len(apart):
                    runs = runs.split(apart)
                doc = ids[a:b][runs.row] if len(runs.row) else runs.row
                hit = np.flatnonzero(_among(runs.content, contents))
                if len(hit):
                    hit = hit[ones["doc"][np.searchsorted(contents, runs.content[hit])] < doc[hit]]
                    np.add.at(cover, runs.begin[hit], 1)
                    np.add.at(cover, runs.begin[hit] + runs.count[hit] + MATCH - 1, -1)
                for j in np.flatnonzero(_among(runs.content, several)).tolist():
                    first, least = many[int(runs.content[j])]
                    first = [*first, int(runs.count[j])]
                    for k, d in enumerate(least):
                        if d < doc[j]:
                            cover[runs.begin[j] + first[k]] += 1
                            cover[runs.begin[j] + first[k + 1] + MATCH - 1] -= 1
            gone = np.cumsum(cover)[:-1] > 0
            for x, y in zip(offs[:-1].tolist(), offs[1:].tolist()):
                part = gone[x:y]
                n_bytes.append(y - x)
                if part.any():
                    mark = np.diff(np.concatenate([[0], part.view(np.int8), [0]]))
                    spans.append([{"start": s, "end": e} for s, e in zip(np.flatnonzero(mark == 1).tolist(), np.flatnonzero(mark == -1).tolist())])
                    kept.append(buf[x:y][~part].tobytes())
                else:
                    spans.append([])
                    kept.append(buf[x:y].tobytes())
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.table([*[rows.column(c) for c in keep], pa.array(n_bytes, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())], names=[*keep, "n_bytes", "spans", "kept"])
    return made


def dedupe(docs: DataFrame, *keep: str, block_bytes: int = 8 << 20, hot: int = HOT) -> DataFrame:
    """doc_id, further kept columns, n_bytes, spans (array of start, end: maximal removed byte runs) and kept (the other
    bytes): every byte is removed that a 50-byte string covers which also starts in a document with a smaller doc_id.

    Texts are dealt once, by a hash of their running number, over blocks of about `block_bytes`; so repeated rows and rows without ids
    spread as others do. The number is that of a row in the table as it is read, which is the same when a task is run again; docs that
    come out of a shuffle are to be stored first. A window of 50 bytes is named by the smallest hash of its
    20-byte grams; neighbouring windows of one name form a string. Blocks send names alone to their shards and hear
    which of them several documents have; they send the strings of these, each different one once, with its smallest
    document. A shard sorts the suffixes of the different strings of shared names, reads off equal windows from their
    common prefixes and answers with the smallest document of each window. What very many strings share in name alone
    is dealt window by window, so neither common phrases nor groups of copies meet in one task as a whole.

    Null texts are empty; texts under 50 bytes stay; a text of any length is one row of its block and taken in by one task,
    in about 50 times its bytes. doc_id may be of any orderable type; a null comes after all others, and rows with equal
    ids don't cut each other, so repeated rows stay alike; an empty table gives no rows; only doc_id, text and the kept
    columns are read.
    """
    size, spark = text_bytes(docs), docs.sparkSession
    blocks, shards = blocks_for(size, block_bytes), max(16, blocks_for(size, 3 << 20))
    n_blocks, n_shards = tasks_for(spark, blocks), tasks_for(spark, shards)
    cols = list(dict.fromkeys(["doc_id", *keep]))
    block = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks)).cast("int")
    dealt = _placed(bounded(docs).select(*cols, "text", block.alias("block"))).repartition(n_blocks, "block")
    # all columns go along each time, so that the texts are shuffled once and the exchange is used again
    named = dealt.sortWithinPartitions("block").mapInArrow(_named(shards), "shard int, block int, plain binary, more binary, marks binary")
    told = named.repartition(n_shards, "shard").sortWithinPartitions("shard").mapInArrow(_repeated(hot), "block int, shard int, names binary, often binary")
    strings = dealt.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(_strings(shards), "shard int, block int, heads binary, sizes binary, data binary")
    replies = strings.repartition(n_shards, "shard").sortWithinPartitions("shard").mapInArrow(_owners, "block int, ones binary, many binary")
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in cols)
    return dealt.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(_cut(cols, shards), f"{schema}, n_bytes long, spans array<struct<start: long, end: long>>, kept binary")


def _placed(rows: DataFrame) -> DataFrame:
    """rows with _place, a whole number in the order of doc_id: the id itself where it is one, else its rank (ids alone are
    sorted, and joined). A null comes after all."""
    if isinstance(rows.schema["doc_id"].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return rows.withColumn("_place", F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)))
    ids = running(rows.select("doc_id").filter("doc_id is not null").distinct(), ["doc_id"], "ids")
    parts = ids.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))  # one row a part
    ranks = ids.join(before, "part").select(F.col("doc_id").alias("_id"), (F.col("before") + F.col("pos")).alias("_place"))
    return rows.join(ranks, rows["doc_id"] == ranks["_id"], "left").drop("_id").withColumn("_place", F.coalesce("_place", F.lit(_LAST)))


def cut_documents(docs: DataFrame) -> DataFrame:
    """docs with the passages cut out of text (a character cut in two goes) and n_chars made anew; no row is dropped."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    rows = docs.select("doc_id", "text", F.struct(F.when(F.col("text").isNull(), True).alias("_null"), *others).alias("_row"))
    valid = F.regexp_replace(F.make_valid_utf8(F.col("kept").cast("string")), "\ufffd", "")
    text = F.when(F.coalesce("_row._null", F.lit(False)), F.lit(None)).when(F.size("spans") == 0, F.col("kept").cast("string")).otherwise(valid)
    made = {"doc_id": F.col("doc_id"), "text": text, "n_chars": F.length(text).cast("long")}
    return dedupe(rows, "_row").select(*[made.get(c, F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])
