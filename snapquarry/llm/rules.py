"""Quality rules with thresholds that adapt to each language and source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded, store
from .textstats import COUNTS, count_batches

#: Ratios that the rules look at, each a whole number: name -> (numerator, factor). The denominator is n_words.
RATIOS = {"word_length": ("word_chars", 100), "symbols": ("n_symbols", 1000), "dup_lines": ("n_dup_lines", 1000), "repeats": ("n_repeat_words", 1000)}
#: Allowance added outside the fences, in the ratio's own unit.
SLACK = {"word_length": 150, "symbols": 150, "dup_lines": 30, "repeats": 150}


def bucket(value: Column, bits: int = 6) -> Column:
    """Cell of a non-negative whole number: exact below 2^bits, then of relative width 2^(1-bits). The cells and
    their counts are a quantile sketch; sketches of two tables merge by adding counts."""
    shift = F.greatest(F.length(F.bin(value)) - bits, F.lit(0))
    return F.call_function("shiftright", value, shift) + shift.cast("long") * F.lit(1 << (bits - 1))


def cell_value(cell: Column, bits: int = 6) -> Column:
    """Least value of a cell."""
    half = 1 << (bits - 1)
    shift = F.greatest(F.floor(cell / half) - 1, F.lit(0)).cast("int")
    return F.call_function("shiftleft", (cell - shift * half).cast("long"), shift)


def base_counts(docs: DataFrame, *keep: str) -> DataFrame:
    """doc_id, lang, source, further kept columns, and the five counts; whole texts, null as empty."""
    kept = bounded(docs).select("doc_id", "lang", "source", *keep, "text")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema if f.name != "text")
    return kept.mapInArrow(count_batches, f"{schema}, " + ", ".join(f"{c} long" for c in COUNTS))


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def sketches(counts: DataFrame) -> DataFrame:
    """Mergeable quantile sketches: count per language, source, ratio and cell, of documents that pass the base rules."""
    good = counts.filter(~base_failed())
    stacked = F.explode(F.array(*[
        F.struct(F.lit(n).alias("ratio"), bucket(F.floor(F.col(c) * k / F.col("n_words")).cast("long")).alias("cell")) for n, (c, k) in RATIOS.items()
    ]))
    return good.select("lang", "source", stacked.alias("r")).groupBy("lang", "source", "r.ratio", "r.cell").agg(F.count(F.lit(1)).alias("n"))


def thresholds(cells: DataFrame, *, least: int = 100) -> DataFrame:
    """lang, source, ratio, low, high. Groups of fewer than `least` documents use the merged sketch of their language,
    and that of all documents if it is small too. The fences lie beyond the first and the last tenth by three
    times its distance from the median, and SLACK more."""
    def fences(keys: list[str]) -> DataFrame:
        own = cells.groupBy(*keys, "ratio", "cell").agg(F.sum("n").alias("n"))
        run = Window.partitionBy(*keys, "ratio").orderBy("cell")
        share = own.withColumn("upto", F.sum("n").over(run)).withColumn("all", F.sum("n").over(Window.partitionBy(*keys, "ratio")))
        q = lambda p: F.min(F.when(F.col("upto") * 1000 >= F.col("all") * p, cell_value(F.col("cell"))))
        found = share.groupBy(*keys, "ratio").agg(F.max("all").alias("docs"), *[q(p).alias(f"q{p}") for p in (100, 500, 900)])
        slack = F.element_at(F.create_map(*[x for n, s in SLACK.items() for x in (F.lit(n), F.lit(s))]), F.col("ratio"))
        low = F.col("q100") - 3 * (F.col("q500") - F.col("q100")) - slack
        high = F.col("q900") + 3 * (F.col("q900") - F.col("q500")) + slack
        return found.select(*keys, "ratio", "docs", low.alias("low"), high.alias("high"))

    one, by_lang, whole = fences(["lang", "source"]), fences(["lang"]), fences([])
    a, b, c = one.alias("a"), by_lang.alias("b"), whole.alias("c")
    joined = a.join(b, F.col("a.lang").eqNullSafe(F.col("b.lang")) & (F.col("a.ratio") == F.col("b.ratio")), "left").join(c, F.col("a.ratio") == F.col("c.ratio"), "left")
    pick = lambda x: F.when(F.col("a.docs") >= least, F.col(f"a.{x}")).when(F.col("b.docs") >= least, F.col(f"b.{x}")).otherwise(F.col(f"c.{x}"))
    return joined.select("a.lang", "a.source", "a.ratio", pick("low").alias("low"), pick("high").alias("high"))


def verdicts(counts: DataFrame, limits: DataFrame) -> DataFrame:
    """counts with base_failed and kept. A group without thresholds (all its documents fail the base rules) keeps nothing else."""
    wide = limits.groupBy("lang", "source").pivot("ratio", list(RATIOS)).agg(F.first("low").alias("low"), F.first("high").alias("high"))
    wide = wide.withColumnRenamed("lang", "_lang").withColumnRenamed("source", "_source")
    joined = counts.join(wide, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")), "left")
    within = F.lit(True)
    for n, (c, k) in RATIOS.items():
        value = F.floor(F.col(c) * k / F.greatest("n_words", F.lit(1)))
        within = within & value.between(F.col(f"{n}_low"), F.col(f"{n}_high"))
    return joined.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & F.coalesce(within, F.lit(True))).drop(
        "_lang", "_source", *[f"{n}_{x}" for n in RATIOS for x in ("low", "high")])


def judge(docs: DataFrame) -> DataFrame:
    """Counts and verdict of each document. Null texts have no words and fail; null languages and sources are groups
    of their own; repeated rows are judged alike, ties at a threshold are kept; a text of any length is read whole, in
    about 25 times its bytes; an empty table gives no rows; other columns are ignored, whatever their names."""
    counts = store(base_counts(docs), "rules")
    return verdicts(counts, store(thresholds(sketches(counts)), "limits"))


def filter_documents(docs: DataFrame) -> DataFrame:
    """The documents that pass, with their own columns. Texts are not shuffled: the counts are made anew beside them."""
    limits = store(thresholds(sketches(base_counts(docs))), "limits")
    renamed = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "lang", "source", "text")
    return verdicts(base_counts(renamed, "row"), limits).filter("kept").select("row.*")
