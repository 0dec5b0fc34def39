"""Sinks (S09-S11)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def publish(df: DataFrame, path: str, version: str, gates: list[Callable[[DataFrame], None]] = ()) -> str:
    """Writes df as a new version under path, checks what was written, and then names it as the current one: the
    name is added beside the older ones, and the newest counts. A failed write or gate leaves the old version current."""
    spark = df.sparkSession
    target = f"{path.rstrip('/')}/version={version}"
    df.write.mode("errorifexists").parquet(target)
    written = spark.read.parquet(target)
    for gate in gates:
        gate(written)
    named = spark.createDataFrame([(version,)], "version string").withColumn("at", F.unix_micros(F.current_timestamp()))
    named.coalesce(1).write.mode("append").json(f"{path.rstrip('/')}/_current")
    return target


def current(spark: SparkSession, path: str) -> DataFrame:
    """The current version."""
    names = spark.read.schema("version string, at long").json(f"{path.rstrip('/')}/_current")
    version = names.agg(F.max_by("version", F.struct("at", "version")).alias("version")).first().version
    return spark.read.parquet(f"{path.rstrip('/')}/version={version}")


def write_catalog(search_pages: DataFrame, path: str) -> None:
    """Catalog (what a list shows) and search index (with texts) of one table."""
    search_pages.select("page_id", "route", "title", "category").write.mode("overwrite").parquet(f"{path}/catalog")
    search_pages.select("page_id", "title", "text", "category", "visibility").write.mode("overwrite").json(f"{path}/search")


def export_partitioned(df: DataFrame, by: str, path: str) -> DataFrame:
    """Rows in one folder for each value of `by`; returns file, bytes and SHA-256 of what was written."""
    df.write.mode("overwrite").partitionBy(by).json(path)
    files = df.sparkSession.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(path)
    return files.select(F.regexp_extract("path", rf"({by}=[^/]*/[^/]+)$", 1).alias("file"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
