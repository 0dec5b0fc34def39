"""Token counts of documents in flat token files without an index, found by scanning for the end-of-document id."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bounded, store
from .tokens import encoded, tokenizer_path

#: Bytes of a block (blocks are cut without regard to documents), blocks under one running sum, and the largest file that
#: one task reads whole.
BLOCK, RANGE, SMALL = 1 << 20, 1024, 64 << 20
#: Least bytes of a record of a large file.
LEAST = 1 << 12


def write_flat(docs: DataFrame, *, path: str | None = None, end_id: int = 50256, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(blocks, names), written to the shared folder. blocks(file, block, payload): each task's ids, two bytes each,
    as one stream cut every `block` bytes, with the end id behind each document. names(file, ordinal, doc_id): which
    document is the how-manieth of its file; the scan doesn't see it. Null texts are the end id alone; the strings of
    special tokens are ordinary text here, so that the end id occurs behind documents alone."""
    path = path or tokenizer_path("byte_bpe_50k.json")
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["block", "payload", "ordinal", "doc_id"]

    def flat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending, number, ordinal, id_type = bytearray(), 0, 0, None
        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            for _, _, ids, bounds in encoded(batch.column("text"), path, end_id, ordinary=True):
                if ids.max(initial=0) >= 1 << 16 or np.count_nonzero(ids == end_id) != len(bounds) - 1:
                    raise ValueError("an id of a text is the end id, or too large for two bytes")
                pending += ids.astype("<u2").tobytes()
                full = []
                while len(pending) >= block:
                    full.append(bytes(pending[:block]))
                    del pending[:block]
                if full:
                    n = len(full)
                    yield pa.RecordBatch.from_arrays([pa.array(range(number, number + n), pa.int64()), pa.array(full, pa.binary()), pa.nulls(n, pa.int64()), pa.nulls(n, id_type)], names=names)
                    number += n
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()), pa.array(range(ordinal, ordinal + n), pa.int64()), batch.column("doc_id")], names=names)
            ordinal += n
        if pending:
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([bytes(pending)], pa.binary()), pa.nulls(1, pa.int64()), pa.nulls(1, id_type)], names=names)

    made = bounded(docs).select("doc_id", "text").mapInArrow(flat, f"block long, payload binary, ordinal long, doc_id {kind}").withColumn("file", F.spark_partition_id().cast("string"))
    kept = store(made, "flat")
    return kept.filter("block is not null").select("file", "block", "payload"), kept.filter("block is null").select("file", "ordinal", "doc_id")


def read_flat(spark: SparkSession, path: str, *, block: int = BLOCK, small: int = SMALL, width: int = 2) -> DataFrame:
    """blocks(file, block, payload) of flat token files in any store that Spark reads. Names and lengths are listed (one
    row per file comes to the driver, no content). A file of up to `small` bytes is read and cut by one task; a larger
    one is read as records of a fixed length, each range of them by its own task, so files may exceed what a row or a
    task holds. The record is the largest divisor of the file's length that fits a block. Where that is under LEAST bytes (the length
    is nearly a prime), the file is read by one task, which is an error beyond 2 GB: pad such files by end ids. A file whose length isn't
    a multiple of `width` is damaged, and an error that names it."""
    whole = spark.read.format("binaryFile").load(path)
    damaged = whole.filter(F.col("length") % width != 0).select("path", "length").first()
    if damaged:
        raise ValueError(f"{damaged.path}: {damaged.length} bytes are no whole number of {width}-byte ids")
    records = [(r.path, next((d for d in range(block - block % width, 0, -width) if r.length % d == 0))) for r in whole.filter(F.col("length") > small).select("path", "length").toLocalIterator()]
    large = {p: d for p, d in records if d >= min(LEAST, block)}
    if too_large := whole.filter((F.col("length") >= 1 << 31) & ~F.col("path").isin(*large or [""])).select("path").first():
        raise ValueError(f"{too_large.path}: its length has no divisor to cut it by; pad it with end ids")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                for i in range(0, len(data), block):
                    yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([i // block], pa.int64()), pa.array([data[i : i + block]], pa.binary())], names=["file", "block", "payload"])

    out = whole.filter(~F.col("path").isin(*large or [""])).select("path", "content").mapInArrow(cut, "file string, block long, payload binary")
    for name, record in large.items():
        conf = {"org.apache.spark.input.FixedLengthBinaryInputFormat.recordLength": str(record)}
        ranges = spark.sparkContext.newAPIHadoopFile(name, "org.apache.spark.input.FixedLengthBinaryInputFormat", "org.apache.hadoop.io.LongWritable", "org.apache.hadoop.io.BytesWritable", conf=conf)
        rows = spark.createDataFrame(ranges.map(lambda kv: (kv[0], bytearray(kv[1]))), "block long, payload binary")
        out = out.unionByName(rows.select(F.lit(name).alias("file"), "block", "payload"))
    return out


def scan(blocks: DataFrame, *, end_id: int = 50256, width: int = 2) -> DataFrame:
    """file, ordinal, n_tokens (without the end id) of each document. Every block is searched by itself, and what it
    found is stored. The prefix scan goes over one small row a block, in ranges of RANGE blocks and then over the ranges
    of a file: it numbers the documents and finds where the first of each block began. The lengths inside a block meet
    the sums by (file, block) alone. Ids behind the last end id of a file are no document."""
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, first, last, inner = [], [], [], []
            for payload in batch.column("payload").to_pylist():
                ids = np.frombuffer(payload, dtype=f"<u{width}")
                at = np.flatnonzero(ids == end_id)
                size.append(len(ids))
                first.append(int(at[0]) if len(at) else None)
                last.append(int(at[-1]) if len(at) else None)
                inner.append(np.diff(at) - 1)
            yield pa.RecordBatch.from_arrays([batch.column("file"), batch.column("block"), pa.array(size, pa.int64()), pa.array(first, pa.int64()), pa.array(last, pa.int64()),
                pa.array(inner, pa.list_(pa.int64()))], names=["file", "block", "size", "first", "last", "inner"])

    marks = store(bounded(blocks).mapInArrow(found, "file string, block long, size long, first long, last long, inner array<long>"), "marks")
    zero = lambda c: F.coalesce(c, F.lit(0))
    ends = F.when(F.col("first").isNull(), 0).otherwise(F.size("inner") + 1).cast("long")
    small = marks.select("file", "block", F.floor(F.col("block") / RANGE).cast("long").alias("range"), "size", "first", "last", ends.alias("ends"))
    upto = Window.partitionBy("file", "range").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    run = small.withColumn("begin", zero(F.sum("size").over(upto))).withColumn("base", zero(F.sum("ends").over(upto)))
    run = run.withColumn("since", F.max(F.col("begin") + F.col("last") + 1).over(upto))  # places within the range
    total = run.groupBy("file", "range").agg(F.sum("size").alias("size"), F.sum("ends").alias("ends"), F.max(F.col("begin") + F.col("last") + 1).alias("since"))
    before = Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    total = total.withColumn("r_begin", zero(F.sum("size").over(before))).withColumn("r_base", zero(F.sum("ends").over(before)))
    total = total.withColumn("r_since", zero(F.max(F.col("r_begin") + F.col("since")).over(before))).select("file", "range", "r_begin", "r_base", "r_since")
    placed = run.filter("first is not null").join(total, ["file", "range"])
    opened = F.col("r_begin") + F.col("begin") + F.col("first") - F.coalesce(F.col("r_begin") + F.col("since"), F.col("r_since"))
    placed = placed.select("file", "block", (F.col("r_base") + F.col("base")).alias("base"), opened.alias("opened"))
    lengths = F.concat(F.array("opened"), F.col("inner"))
    out = marks.select("file", "block", "inner").join(placed, ["file", "block"])
    return out.select("file", "base", F.posexplode(lengths).alias("at", "n_tokens")).select("file", (F.col("base") + F.col("at")).alias("ordinal"), "n_tokens")


def count_tokens(docs: DataFrame, *, path: str | None = None) -> DataFrame:
    """doc_id, file, ordinal, n_tokens: writes the ids of all texts as flat files and counts them from these.
    Null texts have no tokens; texts of any length may span blocks; repeated rows count each for themselves, ids may be
    of any type, equal or null; an empty table gives no rows; other columns of docs are ignored, whatever their names."""
    blocks, names = write_flat(docs, path=path)
    return names.join(scan(blocks), ["file", "ordinal"]).select("doc_id", "file", "ordinal", "n_tokens")
