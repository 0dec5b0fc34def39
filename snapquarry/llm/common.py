"""Shared helpers of the training-data operators: input access, shared storage, vectorised word spans."""

from __future__ import annotations

import ctypes
import hashlib
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F



def _give_back() -> None:
    """Python workers live on between tasks: let large arrays go back to the system when they are freed, so that idle
    workers don't hold the most that any task of theirs once took."""
    pa.set_memory_pool(pa.system_memory_pool())
    try:
        libc = ctypes.CDLL("libc.so.6")
        libc.mallopt(-3, 4 << 20)  # M_MMAP_THRESHOLD
        libc.mallopt(-1, 8 << 20)  # M_TRIM_THRESHOLD
    except (OSError, AttributeError):  # another C library: it keeps its own ways
        return


_give_back()

#: A word is a run of characters other than these six (ASCII space, and tab to carriage return).
WORD = r"[^\x20\x09-\x0D]+"
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_TABLE = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)
_powers: dict[str, np.ndarray] = {}


#: Bytes in one Arrow batch on its way to Python.
BATCH_BYTES = 4 << 20


def bounded(df: DataFrame) -> DataFrame:
    """df, after making sure that Arrow batches are bounded by bytes, as some texts are long: the session's bound is lowered
    to BATCH_BYTES if it is above, and never raised."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    now = as_bytes(conf.get(key))
    if not 0 < now <= BATCH_BYTES:
        conf.set(key, str(BATCH_BYTES))
    return df


def as_bytes(text: str) -> int:
    """Bytes of a setting such as 64MB or 4194304; -1 if it isn't such a number."""
    found = re.fullmatch(r"(\d+)\s*([kmgt]?)i?b?", text.strip().lower())
    return int(found[1]) << 10 * " kmgt".index(found[2] or " ") if found else -1


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table."""
    return bounded(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share (spark.checkpoint.dir). Where it isn't set, a local session takes one of its
    own; a cluster would lose what executors write to their own disks, so it is an error there."""
    root = spark.conf.get("spark.checkpoint.dir", "")
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/snapquarry-stored"
    return root.rstrip("/")


def store(df: DataFrame, name: str) -> DataFrame:
    """Write df to the folder that the cluster shares and read it back: cuts the lineage, so a lost executor costs no
    recomputation of what came before. The files stay until `discard` or the cluster's own cleaning, as lazily
    computed results still read them."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete stored tables that nothing reads any more."""
    for df in tables:
        if path := getattr(df, "_stored_at", ""):
            jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(conf).delete(where, True)


def blocks_for(n_bytes: int, each: int) -> int:
    return max(1, -(-int(n_bytes) // each))


def tasks_for(spark: SparkSession, groups: int) -> int:
    """Partitions for a shuffle by a key with so many values: it grows with the input, and is no less than the cores."""
    return max(int(groups), spark.sparkContext.defaultParallelism)


def text_bytes(docs: DataFrame) -> int:
    """Bytes of all texts: the figure from which block and bucket counts are set."""
    return int(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0)


def slices(column: pa.Array, most: int = 1 << 17) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive rows with about `most` bytes of text; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    at = 0
    while at < len(column):
        end = max(at + 1, int(np.searchsorted(offs, offs[at] + most, side="right")) - 1)
        yield at, end, raw[offs[at] : offs[end]], offs[at : end + 1] - offs[at]
        at = end


def lower_ascii(buf: np.ndarray) -> np.ndarray:
    return _LOWER[buf]


@dataclass
class Spans:
    """Byte spans [start, end), in order; doc: row of each; first: index of each row's first span, and the count at the end."""

    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    first: np.ndarray


def spans_of(inside: np.ndarray, offs: np.ndarray) -> Spans:
    """Maximal runs of `inside` that don't cross rows."""
    n = len(inside)
    edge = np.zeros(n + 1, dtype=bool)
    edge[offs] = True
    before = np.empty(n + 1, dtype=bool)
    before[0], before[1:] = False, inside
    after = np.append(inside, False)
    start = np.flatnonzero(after & (~before | edge))
    end = np.flatnonzero(before & (~after | edge))
    first = np.searchsorted(start, offs)
    return Spans(start, end, np.repeat(np.arange(len(offs) - 1), np.diff(first)), first)


def words_of(buf: np.ndarray, offs: np.ndarray) -> Spans:
    return spans_of(~_BLANK[buf], offs)


def lines_of(buf: np.ndarray, offs: np.ndarray) -> Spans:
    """Lines between line feeds; empty ones are left out."""
    return spans_of(buf != 10, offs)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _power(name: str, base: int, n: int) -> np.ndarray:
    if len(_powers.get(name, ())) < n:
        out = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        out[0] = 1
        _powers[name] = np.cumprod(out, dtype=np.uint64)
    return _powers[name]


def prefix_hash(buf: np.ndarray) -> np.ndarray:
    """Running polynomial hash of bytes or whole numbers (mod 2^64), one entry more than bytes. For spans of some hundred bytes at most:
    patterned ones from about a thousand bytes on can collide, see hash_spans."""
    out = np.zeros(len(buf) + 1, dtype=np.uint64)
    values = _TABLE[buf] if buf.dtype == np.uint8 else mix(buf.astype(np.uint64) + np.uint64(1))
    np.cumsum(values * _power("up", _BASE, len(buf) + 1)[: len(buf)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each span's bytes, wherever it stands."""
    down = _power("down", pow(_BASE, -1, 1 << 64), len(prefix) + 1)
    return mix((prefix[end] - prefix[start]) * down[start] + (end - start).astype(np.uint64))


def hash_spans(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each span's bytes, wherever it stands: eight bytes at a time go through `mix`, so no texts are known
    to collide by their pattern (as they do under a polynomial mod 2^64); long spans are left to blake2b."""
    size = end - start
    out = mix(size.astype(np.uint64) + np.uint64(0x51AFD7ED558CCD25))
    padded = np.zeros(len(buf) + 8, dtype=np.uint8)
    padded[: len(buf)] = buf
    eight = np.ndarray(shape=(len(buf) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    live, at, left = np.flatnonzero(size > 0), None, None
    for step in range(32):
        if not len(live):
            return out
        at, left = start[live] + 8 * step, size[live] - 8 * step
        value = eight[at] & _MASKS[np.minimum(left, 8)]
        out[live] = mix((out[live] ^ value) + np.uint64(0x9E3779B97F4A7C15))
        live = live[left > 8]
    for i in live.tolist():
        name = hashlib.blake2b(memoryview(buf[start[i] : end[i]]), digest_size=8).digest()
        out[i] = int.from_bytes(name, "little")
    return out


def windows_of(values: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of `width` neighbouring values; shorter input gives none."""
    if len(values) < width:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(len(values) - width + 1, dtype=np.uint64)
    for k in range(width):
        out = out * np.uint64(0x100000001B3) + mix(values[k : len(values) - width + 1 + k] + np.uint64(k))
    return mix(out)


def running(df: DataFrame, order: list, name: str) -> DataFrame:
    """df in a total order dealt over range partitions, each sorted, with part and pos (place in the part)."""
    out = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return store(out.withColumn("part", F.spark_partition_id()).withColumn("pos", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)), name)


#: Most bits of a filter: 16 MB. With more keys than it has room for, more rows pass it to the exact join behind. PROBES: most bits of a key.
MOST_BITS, BIT_SLICES, PROBES = 1 << 27, 64, 4


def maybe_among(keys: DataFrame, most: int = MOST_BITS):
    """A Boolean column function over xxhash64 of the columns of `keys`: false for no row whose columns equal a row of
    keys, true for few others. The bits are set by executors, each slice is put together by one task, and their size is
    bounded, so the driver gets at most `most` / 8 bytes. What passes is to be joined exactly."""
    n = keys.count()
    bits = 1 << max(16, min((16 * n).bit_length(), most.bit_length() - 1))
    each, probes = bits // BIT_SLICES, max(1, min(PROBES, bits // (2 * max(n, 1))))

    def places(h: np.ndarray) -> Iterator[np.ndarray]:
        step = (h >> 40) | 1
        for _ in range(probes):
            yield h & (bits - 1)
            h = h + step

    def set_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.zeros(bits, dtype=bool)
        for batch in batches:
            for at in places(batch.column(0).to_numpy()):
                flags[at] = True
        used = [k for k in range(BIT_SLICES) if flags[k * each : (k + 1) * each].any()]
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array([np.packbits(flags[k * each : (k + 1) * each]).tobytes() for k in used], pa.binary())], names=["slice", "bits"])

    def united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, rows in grouped(batches, "slice"):
            total = np.zeros(each // 8, dtype=np.uint8)
            for part in rows.column("bits").to_pylist():
                total |= np.frombuffer(part, dtype=np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["slice", "bits"])

    made = keys.select(F.xxhash64(*keys.columns).alias("h")).coalesce(64).mapInArrow(set_bits, "slice int, bits binary")
    rows = made.repartition(BIT_SLICES, "slice").sortWithinPartitions("slice").mapInArrow(united, "slice int, bits binary").collect()
    packed = np.zeros(bits // 8, dtype=np.uint8)
    for r in rows:
        packed[r["slice"] * each // 8 : (r["slice"] + 1) * each // 8] = np.frombuffer(r["bits"], dtype=np.uint8)

    @F.pandas_udf("boolean")
    def maybe(h: pd.Series) -> pd.Series:
        found = np.ones(len(h), dtype=bool)
        for at in places(h.to_numpy()):
            found &= ((packed[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).astype(bool)
        return pd.Series(found)

    return lambda *columns: maybe(F.xxhash64(*columns))


def grouped(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple]:
    """(key, rows) of batches that come sorted by a whole-number key."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        edges = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for a, b in zip(edges[:-1], edges[1:]):
            if held and held[0].column(key)[0].as_py() != int(keys[a]):
                yield held[0].column(key)[0].as_py(), pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield held[0].column(key)[0].as_py(), pa.Table.from_batches(held)
