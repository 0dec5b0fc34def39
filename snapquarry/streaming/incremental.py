"""Incremental re-use (X01-X04). State lives in version folders of a table, one for each batch, so a batch that is run
again writes the same result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.quality import snapshot_health
from ..operators.relational import upsert


def new_or_changed(pages: DataFrame, state: DataFrame) -> DataFrame:
    """Valid pages whose (page_id, hash) is not known yet."""
    good = snapshot_health(pages).filter("health = 'valid'").withColumn("hash", F.sha2("content", 256))
    return good.join(state.select("page_id", "hash"), ["page_id", "hash"], "left_anti")


def incremental_pages(stream: DataFrame, state_path: str, checkpoint: str) -> StreamingQuery:
    """A stream of page rows of which only new or changed ones are written on, in append-only batches."""
    def batch(rows: DataFrame, number: int) -> None:
        spark = rows.sparkSession
        target = f"{state_path}/batch={number}"
        before = _earlier(spark, state_path, number, "page_id long, hash string")
        new_or_changed(rows, before).dropDuplicates(["page_id", "hash"]).select("page_id", "hash", "content").write.mode("overwrite").parquet(target)

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _earlier(spark: SparkSession, path: str, number: int, schema: str) -> DataFrame:
    if number == 0:
        return spark.createDataFrame([], schema)
    try:
        return spark.read.parquet(path).filter(F.col("batch") < number)
    except Exception as error:
        if "PATH_NOT_FOUND" in str(error) or "UNABLE_TO_INFER_SCHEMA" in str(error):
            return spark.createDataFrame([], schema)
        raise


def resume(results: DataFrame, candidates: DataFrame, key: str, stable: list[str]) -> DataFrame:
    """Candidates without a stable result."""
    return candidates.join(results.filter(F.col("status").isin(*stable)).select(key), key, "left_anti")


#: Parts of a keyed state; a batch rewrites those that its keys fall into.
BUCKETS = 64


def rejected_routes(spark: SparkSession, state_path: str, before: int | None = None) -> DataFrame:
    """Route, reason, bucket as the last batch (or the last one before a number) left them: of each bucket the newest version."""
    state = spark.read.schema("route string, reason string, bucket int, version int").parquet(state_path)
    state = state if before is None else state.filter(F.col("version") < before)
    newest = state.select("bucket", "version").distinct().groupBy("bucket").agg(F.max("version").alias("version"))  # at most BUCKETS rows
    return state.join(F.broadcast(newest), ["bucket", "version"]).select("route", "reason", "bucket")


def rejected_state(stream: DataFrame, state_path: str, checkpoint: str) -> StreamingQuery:
    """Keyed upsert of rejected routes. The state is cut into BUCKETS by a hash of the route; a batch reads and writes only the
    buckets of its own routes, each as a version of its own, so a batch that is run again writes the same."""
    def batch(rows: DataFrame, number: int) -> None:
        spark = rows.sparkSession
        dealt = rows.withColumn("bucket", F.pmod(F.xxhash64("route"), F.lit(BUCKETS)).cast("int")).persist()
        touched = [r.bucket for r in dealt.select("bucket").distinct().collect()]
        if touched:
            state = rejected_routes(spark, state_path, number).filter(F.col("bucket").isin(touched)) if number else dealt.select("route", "reason", "bucket").limit(0)
            merged = upsert(state.select("route", "reason"), dealt.select("route", "reason", "seq"), "route").withColumn("bucket", F.pmod(F.xxhash64("route"), F.lit(BUCKETS)).cast("int")).withColumn("version", F.lit(number))
            merged.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "version").parquet(state_path)
        dealt.unpersist()

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def carry_forward(previous: DataFrame, refs: DataFrame) -> DataFrame:
    """Assets of before and of now, identity kept, counts made anew. previous(url, asset_id, type), refs(url, type)."""
    now = refs.groupBy("url").agg(F.count(F.lit(1)).alias("ref_count"), F.min("type").alias("_type"))
    j = previous.join(now, "url", "full_outer")
    return j.select("url", F.coalesce("asset_id", F.sha2("url", 256)).alias("asset_id"), F.coalesce("type", "_type").alias("type"), F.coalesce("ref_count", F.lit(0)).alias("ref_count"))
