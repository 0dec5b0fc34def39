"""Readers (S01-S08, S12)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read_pages(spark: SparkSession, root: str) -> DataFrame:
    """Page snapshot tree <root>/<system>/raw_html/<quoted slug>.html: system_id, slug, content, html, error. A file
    that is no UTF-8 becomes a row with an error and no html."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.html").load(root)
    valid = F.is_valid_utf8(F.col("content").cast("string"))
    return files.select(
        F.regexp_extract("path", r"([^/]+)/raw_html/[^/]+$", 1).alias("system_id"), F.coalesce(F.try_url_decode(F.regexp_extract("path", r"([^/]+)\.html$", 1)), F.regexp_extract("path", r"([^/]+)\.html$", 1)).alias("slug"),
        "content", F.when(valid, F.col("content").cast("string")).alias("html"), F.when(~valid, "invalid encoding").alias("error"))


def with_base_url(pages: DataFrame, meta: DataFrame, site: str) -> DataFrame:
    """Url: the first of final_url, url and source_url, else one built of site and slug."""
    j = pages.join(meta.select("system_id", "slug", *[F.nullif(F.trim(c), F.lit("")).alias(f"_{c}") for c in ("final_url", "url", "source_url")]), ["system_id", "slug"], "left")
    return j.withColumn("url", F.coalesce("_final_url", "_url", "_source_url", F.concat(F.lit(site.rstrip("/") + "/"), F.url_encode("slug")))).drop("_final_url", "_url", "_source_url")


MANIFEST = "system_id string, discovery_status string, entries array<struct<id:string,slug:string,name:string,url:string,source_order:int,validation:struct<status:string,http_status:int>>>"


def read_entries(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(entries of confirmed systems, those of them that were not found)."""
    rows = spark.read.schema(MANIFEST).json(path, multiLine=True).filter("discovery_status = 'confirmed'").select("system_id", F.explode("entries").alias("e")).select("system_id", "e.*")
    lost = F.coalesce(F.col("validation.status") == "not_found", F.lit(False))
    return rows.filter(~lost), rows.filter(lost)


def union_sources(main: DataFrame, extra: DataFrame, kind: str) -> DataFrame:
    """Main and a supplement, told apart by source_type."""
    return main.withColumn("source_type", F.lit("manifest")).unionByName(extra.withColumn("source_type", F.lit(kind)), allowMissingColumns=True)


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Value, file, line (from 1) of text files of any size, which are read in byte ranges: a first look counts the lines of each range,
    and a line's number is its place in its range plus the lines of the ranges before. One row a range is broadcast."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_start"), F.monotonically_increasing_id().alias("_at"))
    ranges = lines.groupBy("file", "_start").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy("file").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    known = ranges.select("file", "_start", (before - F.col("_first") + 1).alias("_shift"))
    return lines.join(F.broadcast(known), ["file", "_start"]).select("value", "file", (F.col("_at") + F.col("_shift")).alias("line"))


def read_occurrences(spark: SparkSession, path: str, schema: str, strict: bool = True) -> DataFrame:
    """JSON lines; blank lines go. strict: a bad line is an error that names its file and line; else it is kept in
    _corrupt_record, with _file and _line."""
    rows = numbered_lines(spark, path).filter(F.trim("value") != "")
    told = F.from_json("value", f"{schema}, _corrupt_record string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    rows = rows.select(told.alias("j"), F.col("file").alias("_file"), F.col("line").alias("_line"), "value").select("j.*", "_file", "_line")
    if not strict:
        return rows
    said = F.concat(F.lit("bad line "), "_file", F.lit(":"), F.col("_line").cast("string"), F.lit(": "), "_corrupt_record")
    ok = F.when(F.col("_corrupt_record").isNotNull(), F.raise_error(said).cast("boolean")).otherwise(True)
    return rows.filter(ok).drop("_corrupt_record", "_file", "_line")


TREE = "categories array<struct<id:string,visible:boolean,children:array<struct<id:string,systems:array<string>>>>>"


def load_content_tree(spark: SparkSession, path: str) -> DataFrame:
    """system_id, category_id, child_id; a system in two places is an error when it is read."""
    rows = spark.read.schema(TREE).json(path, multiLine=True).select(F.explode("categories").alias("c")).select(F.col("c.id").alias("category_id"),
        F.explode("c.children").alias("k")).select("category_id", F.col("k.id").alias("child_id"), F.explode("k.systems").alias("system_id"))
    g = rows.groupBy("system_id").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("category_id", "child_id")).alias("p"))
    one = F.when(F.col("n") > 1, F.raise_error(F.concat(F.lit("system in two categories: "), "system_id")).cast("boolean")).otherwise(True)
    return g.filter(one).select("system_id", "p.*")


def load_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """Key (one case), value of a flat JSON object, Han values only."""
    text = spark.read.text(path, wholetext=True)
    return text.select(F.explode(F.from_json("value", "map<string,string>")).alias("k", "value")).select(F.lower("k").alias("key"), "value").filter(F.col("value").rlike(r"[\x{3400}-\x{9fff}]"))


def read_modules(spark: SparkSession, registry: dict[str, tuple[str, bool]], record_schema: str, *, version: int, season: str) -> DataFrame:
    """Records of all registered modules, name -> (path, required), with `module`. Files have schema_version, season,
    record_count and records; a wrong version, season or count, no records, or a record without id is an error. A file
    that is missing fails unless it is optional."""
    schema = f"schema_version int, season string, record_count long, records array<struct<{record_schema}>>"
    out = None
    for name, (path, required) in registry.items():
        try:
            doc = spark.read.schema(schema).json(path, multiLine=True)
        except Exception as error:
            if required or "PATH_NOT_FOUND" not in str(error):
                raise
            continue
        fits = (F.col("schema_version") == version) & (F.col("season") == season) & (F.size("records") > 0) & (F.size("records") == F.col("record_count")) & ~F.exists("records", lambda r: F.coalesce(r["record_id"], F.lit("")) == "")
        ok = F.when(F.coalesce(fits, F.lit(False)), True).otherwise(F.raise_error(F.lit(f"module {name} has a wrong header")).cast("boolean"))
        rows = doc.filter(ok).select(F.explode("records").alias("r")).select("r.*", F.lit(name).alias("module"))
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        raise ValueError("no module was found")
    return out


def season_scope(df: DataFrame, season: str, default: str, legacy: DataFrame | None = None, keys: list[str] | None = None) -> DataFrame:
    """Rows of a season; for the default season keys that it lacks are taken from the legacy table."""
    own = df.filter(F.col("season") == season)
    if legacy is None or season != default:
        return own
    return own.unionByName(legacy.join(own.select(*keys), keys, "left_anti").withColumn("season", F.lit(season)), allowMissingColumns=True)
