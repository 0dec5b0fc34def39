"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

import math
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, running


def targets(sizes: dict[str | None, int], cycle: tuple[float, ...] = (1, 2, 3), most: float = 3.0) -> dict[str | None, float]:
    """Words to take from each source. Sources in code point order (null last) weigh `cycle`, repeating; a target
    stops at `most` times the source, and the excess is shared again by weight until no source is above.
    `sizes` has one entry per source, never per document."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: cycle[i % len(cycle)] for i, s in enumerate(names)}
    out: dict[str | None, float] = {}
    left, free = float(sum(sizes.values())), list(names)
    while free:
        total = sum(weight[s] for s in free)
        share = {s: left * weight[s] / total for s in free}
        over = [s for s in free if share[s] > most * sizes[s]]
        if not over:
            return out | share
        for s in over:
            out[s] = most * sizes[s]
            left -= out[s]
        free = [s for s in free if s not in out]
    return out


def sized(docs: DataFrame) -> DataFrame:
    return docs.withColumn("size", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long"))


def plan(docs: DataFrame, *, cycle: tuple[float, ...] = (1, 2, 3), most: float = 3.0, seed: int = 17, tries: int = 32) -> DataFrame:
    """How often each document goes into the mix: doc_id, source, size, source_size, target, copies, taken, text_hash.

    Every document of a source expects target / source_size copies. The running sum of these, in order of size
    within the source and shifted by one random offset, emits a copy at each integer it crosses (as all documents of a
    source expect the same, the sum before a document is its rank times that). In this order the taken words differ
    from the target by little more than one document; of `tries` random offsets each source takes the one that brings
    its words nearest to the target. Ranks come from range partitions with their counts, so a source with a third of all
    rows is dealt over many tasks. What reaches the driver is one row for each source, as targets are shared among all
    of them: the number of sources is taken to be bounded (a million takes about 100 MB). A null text has size 0, a null
    source is a source of its own, repeated rows and ties in size are sampled separately (ties by a hash of id, then id,
    then text), a text of any length is only counted, an empty table gives no rows; further columns of docs are
    ignored, whatever their names."""
    spark = docs.sparkSession
    rows = sized(docs.select("doc_id", "source", "text")).select(
        "doc_id", "source", "size", F.coalesce(F.concat(F.lit("v"), "source"), F.lit("n")).alias("skey"), F.xxhash64(F.lit(seed), "doc_id").alias("draw"), F.xxhash64("text").alias("text_hash"),
    )
    rows = running(rows, ["skey", "size", "draw", "doc_id", "text_hash"], "mix")
    parts = rows.groupBy("part", "skey").agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("at"), F.sum("size").alias("words"))
    parts = parts.withColumn("before", F.sum("n").over(Window.partitionBy("skey").orderBy("part")) - F.col("n"))
    totals = {r.skey: int(r.words) for r in parts.groupBy("skey").agg(F.sum("words").alias("words")).collect()}
    wanted = targets({None if k == "n" else k[1:]: n for k, n in totals.items()}, cycle, most)
    shares = spark.createDataFrame(
        [(k, n, float(wanted[None if k == "n" else k[1:]])) for k, n in totals.items()], "skey string, source_size long, target double",
    )
    known = parts.select("part", "skey", "at", "before").join(shares, "skey")
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rank = F.col("before") + F.col("pos") - F.col("at")
    out = rows.join(known, ["part", "skey"]).withColumn("each", each).withColumn("rank", rank)

    def copies(shift: Column) -> Column:
        return F.least(F.floor(shift + (F.col("rank") + 1) * F.col("each")) - F.floor(shift + F.col("rank") * F.col("each")), F.lit(math.ceil(most)))

    offset = lambda k: F.pmod(F.xxhash64(F.lit(seed), F.lit(k), "skey"), F.lit(1_000_003)) / F.lit(1_000_003.0)
    tried = out.groupBy("skey").agg(F.first("target").alias("goal"), *[F.sum(copies(offset(k)) * F.col("size")).alias(f"t{k}") for k in range(tries)])
    nearest = F.array_min(F.array(*[F.struct(F.abs(F.col(f"t{k}") - F.col("goal")).alias("off"), offset(k).alias("shift")) for k in range(tries)]))
    out = out.join(tried.select("skey", nearest["shift"].alias("shift")), "skey")
    return out.withColumn("copies", copies(F.col("shift")).cast("long")).select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"), "text_hash",
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with all columns of docs. A row is known again by its id,
    source and text; equal rows share the copies that they are given."""
    planned = plan(docs, **options).groupBy("doc_id", "source", "size", "text_hash").agg(F.sum("copies").alias("_mix_copies"), F.count(F.lit(1)).alias("_mix_alike"))
    names = {"doc_id": "_mix_id", "source": "_mix_source", "text_hash": "_mix_hash"}
    planned = planned.filter("_mix_copies > 0").drop("size").withColumnsRenamed(names)
    rows = docs.withColumn("_mix_own", F.xxhash64("text"))
    same = F.col("doc_id").eqNullSafe(F.col("_mix_id")) & F.col("source").eqNullSafe(F.col("_mix_source")) & (F.col("_mix_own") == F.col("_mix_hash"))
    one = Window.partitionBy("_mix_id", "_mix_source", "_mix_hash").orderBy("_mix_hash")
    turn = rows.join(planned, same).withColumn("_mix_n", F.row_number().over(one))
    upto = lambda n: F.floor(F.col("_mix_copies") * n / F.col("_mix_alike"))
    times = (upto(F.col("_mix_n")) - upto(F.col("_mix_n") - 1)).cast("int")
    return turn.withColumn("_mix_copy", F.explode(F.array_repeat(F.lit(1), times))).select(*docs.columns)
