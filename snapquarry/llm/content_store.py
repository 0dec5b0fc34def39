"""A content-addressed store of token ids: chunks stored once, recipes of documents, Merkle roots that verify them."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded, discard, mix, running, store
from .tokens import encoded, tokenizer_path

#: Ids of context that decide a cut, one cut in so many places, most ids in a chunk.
CONTEXT, EVERY, MOST = 8, 512, 4096
#: Documents under one node of the manifest.
NODE = 4096
_WEIGHTS = mix(np.arange(1, CONTEXT + 1, dtype=np.uint64)) | np.uint64(1)


class Store(NamedTuple):
    """The stored tables: chunks(digest, payload); recipes(part, pos, doc_id, start, n_tokens, digests, sizes, root);
    manifest(part, node, documents, ids, root)."""

    chunks: DataFrame
    recipes: DataFrame
    manifest: DataFrame


def cuts(ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Ends of the chunks of id streams that stand one behind the other (from bounds[k] to bounds[k + 1]): where the
    hash of a stream's last CONTEXT ids says so, MOST further at the latest, and at its end."""
    n = len(ids)
    begin, place = np.repeat(bounds[:-1], np.diff(bounds)), np.arange(n)
    own, h = mix(ids.astype(np.uint64) + np.uint64(1 << 33)), np.zeros(n, dtype=np.uint64)
    for back in range(min(CONTEXT, n)):
        h[back:] += np.where(place[back:] - back >= begin[back:], own[: n - back] * _WEIGHTS[back], np.uint64(0))
    ends = np.union1d(np.flatnonzero(mix(h) % np.uint64(EVERY) == 0) + 1, bounds[1:])
    size = np.diff(np.append(0, ends))
    more = (size - 1) // MOST
    extra = np.repeat(ends - size, more) + MOST * (np.arange(more.sum()) - np.repeat(np.cumsum(more) - more, more) + 1)
    return np.union1d(ends, extra)


def packed(ids: np.ndarray) -> bytes:
    """A chunk's bytes: two bytes an id where that is enough (first byte 2), else four (first byte 4)."""
    return b"\2" + ids.astype("<u2").tobytes() if not len(ids) or ids.max() < 1 << 16 else b"\4" + ids.astype("<u4").tobytes()


def unpacked(payload: bytes) -> np.ndarray:
    return np.frombuffer(payload, dtype="<u2" if payload[0] == 2 else "<u4", offset=1).astype("<u4")


def digest(payload: bytes) -> bytes:
    return hashlib.blake2b(payload, digest_size=16).digest()


def merkle_root(leaves: list[bytes]) -> bytes:
    """Root of the binary tree over the leaves; an odd one out is carried up."""
    level = [hashlib.blake2b(b"\0" + x, digest_size=16).digest() for x in leaves] or [digest(b"")]
    while len(level) > 1:
        level = [hashlib.blake2b(b"\1" + b"".join(level[i : i + 2]), digest_size=16).digest() if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
    return level[0]


def spool(docs: DataFrame, *, path: str, end_id: int) -> DataFrame:
    """doc_id, n_tokens, root and the chunks of each text's ids with the end id; made once, kept in the shared folder."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, ids, bounds in encoded(batch.column("text"), path, end_id):
                ends = cuts(ids, bounds)
                begins, data = np.append(0, ends[:-1]), ids.astype("<u2").tobytes() if ids.max(initial=0) < 1 << 16 else None
                parts = [b"\2" + data[2 * x : 2 * y] if data is not None else packed(ids[x:y]) for x, y in zip(begins.tolist(), ends.tolist())]
                names = [digest(p) for p in parts]
                edge = np.searchsorted(begins, bounds)
                roots = [merkle_root(names[x:y]) for x, y in zip(edge[:-1].tolist(), edge[1:].tolist())]
                lists = lambda values, kind: pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pa.array(values, kind))  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), pa.array(np.diff(bounds), pa.int64()), pa.array(roots, pa.binary()), lists(names, pa.binary()), lists(ends - begins, pa.int32()), lists(parts, pa.binary())],
                    names=["doc_id", "n_tokens", "root", "digests", "sizes", "payloads"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    made = bounded(docs).select("doc_id", "text").mapInArrow(cut, f"doc_id {kind}, n_tokens long, root binary, digests array<binary>, sizes array<int>, payloads array<binary>")
    return store(made, "spool")


def write(docs: DataFrame, *, path: str | None = None, end_id: int = 2) -> Store:
    """The three tables of a store, written. chunks has each different chunk once. recipes, in ascending doc_id order
    (ties by content, null ids first), say from which chunks a document is put together, how many ids stand before it
    (start), and its Merkle root. manifest has the counts of each NODE documents of a recipe file, and the Merkle root over
    their roots and starts.

    Null texts are the end id alone; texts of any length are cut into chunks; repeated rows have recipes of their own
    and share all chunks; an empty table gives empty files; other columns of docs are ignored, whatever their names."""
    spooled = spool(docs, path=path or tokenizer_path("byte_bpe_50k.json"), end_id=end_id)
    pairs = spooled.select(F.explode(F.arrays_zip("digests", "payloads")).alias("c")).select(F.col("c.digests").alias("digest"), F.col("c.payloads").alias("payload"))
    chunks = store(pairs.groupBy("digest").agg(F.min("payload").alias("payload")), "chunks")
    rows = running(spooled.select("doc_id", "n_tokens", "root", "digests", "sizes"), ["doc_id", "root"], "ordered")
    discard(spooled)
    sums = rows.groupBy("part").agg(F.sum("n_tokens").alias("own"))
    before = sums.withColumn("before", F.sum("own").over(Window.orderBy("part")) - F.col("own")).drop("own")  # one row a part
    inside = Window.partitionBy("part").orderBy("pos")
    placed = rows.join(before, "part").withColumn("start", F.col("before") + F.sum("n_tokens").over(inside) - F.col("n_tokens"))
    recipes = store(placed.select("part", "pos", "doc_id", "start", "n_tokens", "digests", "sizes", "root"), "recipes")
    discard(rows)
    return Store(chunks, recipes, store(manifest(recipes), "manifest"))


def manifest(recipes: DataFrame) -> DataFrame:
    """part, node, documents, ids, root: the Merkle root over start and root of each NODE documents of a recipe file."""
    @F.udf("binary")
    def root(leaves):
        return merkle_root([x["start"].to_bytes(8, "little") + bytes(x["root"]) for x in leaves])

    node = F.floor(F.col("pos") / NODE).cast("long")
    leaves = F.array_sort(F.collect_list(F.struct("pos", "start", "root")))
    return recipes.groupBy("part", node.alias("node")).agg(F.count(F.lit(1)).alias("documents"), F.sum("n_tokens").alias("ids"), leaves.alias("leaves")).select("part", "node", "documents", "ids", root("leaves").alias("root"))


def _check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """digest, crc of the chunk's ids as 32-bit integers, number of ids. Fails where bytes don't match their digest."""
    for batch in batches:
        names, crc, n = [], [], []
        for d, p in zip(batch.column("digest").to_pylist(), batch.column("payload").to_pylist()):
            if digest(p) != d:
                raise ValueError(f"chunk {d.hex()} is damaged")
            ids = unpacked(p)
            names.append(d)
            crc.append(zlib.crc32(ids.tobytes()))
            n.append(len(ids))
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(crc, pa.int64()), pa.array(n, pa.int64())], names=["digest", "crc", "n"])


def joined_crc(parts: list[tuple[int, int]]) -> int:
    """crc32 of the joined bytes of parts given as (crc32, number of ids)."""
    out = 0
    for crc, n in parts:
        zeros = bytes(4 * n)
        out = zlib.crc32(zeros, out) ^ zlib.crc32(zeros) ^ crc
    return out


def read_back(kept: Store) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document, from the files alone. Each stored chunk is read, held
    against its digest and summed up once; what a document's chunks sum up to is joined in recipe order, and its
    Merkle root is made again from the chunks that were found. What has been read is held against the manifest. A chunk
    that is damaged, exchanged or lost, and a recipe that is changed or lost, is an error. Ids travel nowhere."""
    known = kept.chunks.mapInArrow(_check, "digest binary, crc long, n long")
    entries = kept.recipes.select("part", "pos", "doc_id", "start", "n_tokens", "root", F.posexplode("digests").alias("seq", "digest"))
    found = entries.join(known, "digest", "left")
    lists = found.groupBy("part", "pos", "doc_id", "start", "n_tokens", "root").agg(F.array_sort(F.collect_list(F.struct("seq", "digest", "crc", "n"))).alias("parts"))

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            crc = []
            for root, want, parts in zip(*[batch.column(c).to_pylist() for c in ("root", "n_tokens", "parts")]):
                if any(p["crc"] is None for p in parts):
                    raise ValueError("a chunk is lost")
                if sum(p["n"] for p in parts) != want or merkle_root([p["digest"] for p in parts]) != root:
                    raise ValueError("a document's chunks don't match its recipe")
                crc.append(joined_crc([(p["crc"], p["n"]) for p in parts]))
            names = ["part", "pos", "doc_id", "start", "n_tokens", "root"]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(crc, pa.int64())], names=[*names, "ids_crc32"])

    kind = kept.recipes.schema["doc_id"].dataType.simpleString()
    seen = store(lists.mapInArrow(joined, f"part int, pos long, doc_id {kind}, start long, n_tokens long, root binary, ids_crc32 long"), "read")
    told, now = kept.manifest, manifest(seen)
    same = told["documents"].eqNullSafe(now["documents"]) & told["ids"].eqNullSafe(now["ids"]) & told["root"].eqNullSafe(now["root"])
    if not told.join(now, (told["part"] == now["part"]) & (told["node"] == now["node"]), "full").filter(~same).isEmpty():
        raise ValueError("what was read doesn't match the manifest")
    return seen.select("doc_id", "start", "n_tokens", "ids_crc32")


def documents(kept: Store) -> DataFrame:
    """doc_id, ids: the documents' ids themselves, put together from their chunks; a lost chunk is an error."""
    recipes = kept.recipes
    entries = recipes.select("part", "pos", "doc_id", F.posexplode("digests").alias("seq", "digest")).join(kept.chunks, "digest", "left")
    entries = entries.withColumn("payload", F.coalesce("payload", F.raise_error(F.lit("a chunk is lost")).cast("binary")))
    parts = entries.groupBy("part", "pos", "doc_id").agg(F.expr("transform(array_sort(collect_list(struct(seq, payload))), x -> x.payload)").alias("payloads"))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [np.concatenate([unpacked(p) for p in ps]).tolist() for ps in batch.column("payloads").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.list_(pa.int64()))], names=["doc_id", "ids"])

    return parts.select("doc_id", "payloads").mapInArrow(whole, f"doc_id {recipes.schema['doc_id'].dataType.simpleString()}, ids array<long>")
