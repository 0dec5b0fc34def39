"""Near-duplicates by SimHash: fingerprints of word shingles, compared exactly in tiles of like bit counts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import blocks_for, bounded, discard, grouped, lower_ascii, slices, store, tasks_for, words_of
from .graph import components

#: Fingerprints that one group holds against others, and others in a group: both bound what a task holds.
OWN, OTHERS = 4096, 1 << 18
#: Fingerprints are tiled by the bit counts of their quarters, each from 0 to 16.
QUARTERS, SIDE = 4, 17
_LANES = np.uint64(0x0101010101010101)


def shingle_hashes(buf: np.ndarray, offs: np.ndarray, width: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of each row's shingles, repeats included, row after row, and the rows' bounds in them. Words are lower-cased
    (A-Z), joined by one space; a row with fewer than `width` words has one shingle, a row without words none."""
    low = lower_ascii(buf)
    words = words_of(low, offs)
    if not len(words.start):
        return np.zeros(0, dtype=np.uint64), np.zeros(len(offs), dtype=np.int64)
    size = words.end - words.start
    begin = np.cumsum(size + 1) - size - 1
    joined = np.full(int(begin[-1] + size[-1]), 32, dtype=np.uint8)
    inner = np.repeat(begin - words.start, size) + (at := np.repeat(words.start - np.cumsum(size) + size, size) + np.arange(int(size.sum())))
    joined[inner] = low[at]
    counts = np.diff(words.first)
    many = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    bounds = np.concatenate([[0], np.cumsum(many)])
    row = np.repeat(np.arange(len(counts)), many)
    first = words.first[row] + np.arange(len(row)) - bounds[row]
    last = np.minimum(first + width - 1, words.first[row + 1] - 1)
    raw, digest = joined.tobytes(), xxhash.xxh64_intdigest
    pairs = zip(begin[first].tolist(), (begin[last] + size[last]).tolist())
    return np.fromiter((digest(raw[a:b], seed) for a, b in pairs), dtype=np.uint64, count=len(first)), bounds


def majority(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One fingerprint a row: a bit is 1 if more than half of the row's hashes have it; without hashes it is zero. Bits
    are added up eight at a time, in the bytes of whole words, over stretches of at most 255 hashes."""
    many = np.diff(bounds)
    parts = -(-many // 255)
    owner = np.repeat(np.arange(len(many)), parts)
    start = bounds[owner] + 255 * (np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts))
    out = np.zeros((len(many), 64), dtype=np.int64)
    if len(start):
        full = np.flatnonzero(parts)
        edges = (np.cumsum(parts) - parts)[full]
        for bit in range(8):
            lanes = np.add.reduceat((hashes >> np.uint64(bit)) & _LANES, start).astype("<u8").view(np.uint8).reshape(-1, 8)
            out[full, bit::8] = np.add.reduceat(lanes.astype(np.int64), edges, axis=0)
    return np.packbits(2 * out > many[:, None], axis=1, bitorder="little").view("<u8").reshape(-1)


def fingerprints(docs: DataFrame, *, width: int = 3, seed: int = 42) -> DataFrame:
    """doc_id and fp, the fingerprint as a long, of each row's whole text; null texts count as empty and get zero."""
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [majority(*shingle_hashes(buf, offs, width, seed)) for _, _, buf, offs in slices(batch.column("text"), 1 << 19)]
            fp = np.concatenate(found).view(np.int64) if found else np.zeros(0, dtype=np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fp)], names=["doc_id", "fp"])

    return bounded(docs).select("doc_id", "text").mapInArrow(made, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fp long")


def _tile(fp: str) -> Column:
    counts = [F.bit_count(F.shiftrightunsigned(fp, 16 * q).bitwiseAND(0xFFFF)).cast("int") * SIDE**q for q in range(QUARTERS)]
    return sum(counts[1:], counts[0])


def neighbours(radius: int) -> list[tuple[int, ...]]:
    """Differences of two tiles' counts that add up to `radius` at most, one of each two opposite ones, without zero."""
    out: list[tuple[int, ...]] = [()]
    for _ in range(QUARTERS):
        out = [o + (k,) for o in out for k in range(-radius, radius + 1) if sum(map(abs, o)) + abs(k) <= radius]
    return [o for o in out if next((k for k in o if k), 0) > 0]


def links(distinct: DataFrame, radius: int) -> DataFrame:
    """a, b: links between different fingerprints of distinct(fp) that differ in `radius` bits at most, enough of them to
    connect all that are connected.

    Two such fingerprints differ by no more in the sum over their quarters' bit counts, so tiles (all fingerprints with the
    same four counts, of which there are at most 17^4) are compared with those tiles alone that are as near. A tile's
    fingerprints come in lots of about OWN; each lot meets the later lots of its tile and the tiles after it, dealt over
    groups of about OTHERS, so no group grows with a tile. Of the pairs found in a group a spanning forest is given out."""
    spark = distinct.sparkSession
    tiled = store(distinct.withColumn("tile", _tile("fp")), "tiled")
    sizes = tiled.groupBy("tile").agg(F.count(F.lit(1)).alias("m"))
    digits = [F.floor(F.col("tile") / SIDE**q) % SIDE for q in range(QUARTERS)]
    steps = F.array(*[F.array(*map(F.lit, o)) for o in neighbours(radius)])
    moved = sizes.select("tile", *[d.alias(f"d{q}") for q, d in enumerate(digits)], F.explode(steps).alias("step"))
    to = [F.col(f"d{q}") + F.col("step")[q] for q in range(QUARTERS)]
    able = moved
    for t in to:
        able = able.filter((t >= 0) & (t < SIDE))
    near = able.select("tile", sum((t * SIDE**q for q, t in enumerate(to)), F.lit(0)).cast("int").alias("other"))
    near = near.join(F.broadcast(sizes.select(F.col("tile").alias("other"), F.col("m").alias("more"))), "other")
    met = near.groupBy("tile").agg(F.sum("more").alias("more"))
    lots = F.ceil(F.col("m") / OWN).cast("int")
    rest = F.coalesce("more", F.lit(0)) + F.when(lots > 1, F.col("m")).otherwise(0)
    tiles = sizes.join(F.broadcast(met), "tile", "left").select("tile", "m", lots.alias("lots"), F.greatest(F.ceil(rest / OTHERS), F.lit(1)).cast("int").alias("parts"), rest.alias("rest"))
    tiles = store(tiles, "tiles")  # at most 17^4 rows
    owners = near.select("tile", F.col("other").alias("at")).join(F.broadcast(tiles), "tile").groupBy(F.col("at").alias("tile")).agg(F.collect_list(F.struct(F.col("tile").alias("u"), "lots", "parts")).alias("owners"))
    sends = store(tiles.select("tile", "lots", "parts").join(F.broadcast(owners), "tile", "left"), "sends")
    placed = tiled.join(F.broadcast(sends), "tile").withColumn("lot", F.pmod(F.xxhash64("fp"), F.col("lots")).cast("int"))

    gid = lambda tile, lot, part: F.xxhash64(tile, lot, part).alias("gid")
    part = lambda parts: F.pmod(F.xxhash64("fp", F.lit(1)), parts).cast("int")
    own = placed.select("fp", "tile", "lot", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("p"))
    own = own.select(gid("tile", "lot", "p"), F.when(F.col("p") == 0, F.lit(0)).otherwise(F.lit(1)).cast("byte").alias("role"), "fp")
    later = placed.filter("lot > 0").select("fp", "tile", part(F.col("parts")).alias("p"), F.explode(F.sequence(F.lit(0), F.col("lot") - 1)).alias("earlier"))
    later = later.select(gid("tile", "earlier", "p"), F.lit(2).cast("byte").alias("role"), "fp")
    sent = placed.select("fp", F.explode("owners").alias("o")).select("fp", "o.u", part(F.col("o.parts")).alias("p"), F.explode(F.sequence(F.lit(0), F.col("o.lots") - 1)).alias("i"))
    sent = sent.select(gid("u", "i", "p"), F.lit(2).cast("byte").alias("role"), "fp")

    work = tiles.agg(F.sum("m").alias("rows"), F.sum(F.col("m") * (F.col("rest") + F.col("m"))).alias("looks")).first()
    tasks = tasks_for(spark, max(blocks_for(work.rows or 0, 1 << 16), blocks_for(work.looks or 0, 1 << 31)))
    dealt = own.unionByName(later).unionByName(sent).repartition(tasks, "gid").sortWithinPartitions("gid", "role", "fp")
    found = store(dealt.mapInArrow(_compare(radius), "a long, b long").distinct(), "links")
    discard(tiled, tiles, sends)
    return found


def _compare(radius: int, cells: int = 1 << 20):
    """In each group: own fingerprints (role 0, or 1 where another group compares these among themselves) against the
    others (role 2), by exclusive-or and bit count, at most about `cells` pairs at a time."""
    def hits(one: np.ndarray, two: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        rows = max(1, cells // max(1, len(one)))
        for at in range(0, len(two), rows):
            i, j = np.nonzero(np.bitwise_count(one[:, None] ^ two[None, at : at + rows]) <= radius)
            yield i, j + at

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a: list[int] = []
        b: list[int] = []
        for _, rows in grouped(batches, "gid"):
            fp, role = rows.column("fp").to_numpy().view(np.uint64), rows.column("role").to_numpy()
            own, others = fp[role < 2], fp[role == 2]
            root = list(range(len(fp)))

            def top(k: int) -> int:
                while root[k] != k:
                    root[k] = root[root[k]]
                    k = root[k]
                return k

            among = ((i[i < j], j[i < j]) for i, j in (hits(own, own) if (role == 0).any() else ()))
            across = ((i, j + len(own)) for i, j in hits(own, others))
            for i, j in (*among, *across) if len(own) else ():
                for x, y in zip(i.tolist(), j.tolist()):
                    p, q = top(x), top(y)
                    if p != q:
                        root[q] = p
                        a.append(x)
                        b.append(y)
            if a:
                names = np.concatenate([own, others]).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(names[a]), pa.array(names[b])], names=["a", "b"])
                a, b = [], []
    return made


def near_duplicates(docs: DataFrame, *, width: int = 3, seed: int = 42, radius: int = 2) -> DataFrame:
    """doc_id, fingerprint (16 lowercase hex digits), component_id: the smallest doc_id that links of at most `radius`
    differing bits reach, the row's own included.

    Equal fingerprints go on as one, so copies cost nothing more. Null and empty texts have fingerprint zero and link like
    any other; a text of any length is read whole, by one task in about 60 times its bytes; null ids count last, so a
    component_id is null only if all its ids are; repeated rows are given out each; an empty table gives no rows; other
    columns of docs are ignored, whatever their names."""
    rows = store(fingerprints(docs, width=width, seed=seed), "fingerprints")
    names = store(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "names")
    tree = components(links(names.select("fp"), radius)).withColumnRenamed("node", "fp")
    linked = tree.join(names, "fp")
    smallest = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    told = linked.select("fp", "root").join(smallest, "root").select("fp", "component_id")
    known = names.join(told, "fp", "left").select("fp", F.coalesce("component_id", "least").alias("component_id"))
    return rows.join(known, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
