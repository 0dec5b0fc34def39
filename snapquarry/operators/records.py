"""Structured records: extractors over section rows and nodes, with rule tables (R01, R04, R06, R08, R10, R12-R15, V01, Q02, Q03);
`regions` has those of cards and panes."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import record_id, signature
from ..functions.text import clean, extract_number

# Tiers as they are written and as they are named; the required fields of a record.
TIERS = {"0+": "t0_plus", "0": "t0", "1": "t1", "2": "t2"}
REQUIRED = ["record_id", "entity_id", "record_type", "section_name", "text", "route"]
CONFIDENCE, LEVELS = ["low", "medium", "high"], ["page", "section", "record"]


def tier_name(tier: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in TIERS.items() for x in kv]), tier)


def locator(section: Column, row: Column, key: Column, tab: Column | None = None) -> Column:
    """Where a record stands; it is found by its key if it has one."""
    return F.struct(
        section.alias("section_key"), section.alias("dom_id"), (tab if tab is not None else F.lit(None).cast("string")).alias("tab_target"), row.cast("int").alias("row_index"),
        key.alias("stable_key"), F.when(key.startswith("row:"), "medium").otherwise("high").alias("locator_confidence"), F.lit("record").alias("locator_level"))


def stable_key(key: Column, row: Column) -> Column:
    """Modifier:<id> where the row has one, else row:<n>."""
    return F.when(F.coalesce(key, F.lit("")) != "", F.concat(F.lit("modifier:"), key)).otherwise(F.concat(F.lit("row:"), row.cast("string")))


def _finish(df: DataFrame, kind: Column, *more: str) -> DataFrame:
    rid = record_id("record", entity=F.col("page_id").cast("string"), kind=kind, section=F.col("section_name"), key=F.col("key"), table=F.coalesce(F.col("table_no"), F.lit(0)).cast("string"))
    return df.select(rid.alias("record_id"), F.col("page_id").cast("string").alias("entity_id"), kind.alias("record_type"), "section_name", "text", "key",
                     locator(F.col("section_name"), F.col("row_index"), F.col("key")).alias("source_locator"), *more)


def affix_records(rows: DataFrame, defs: DataFrame) -> DataFrame:
    """Records of table sections. defs(section_id, record_type, text_column) is a rule table: which
    sections hold records, of which type, in which cell. Rows without text give none."""
    joined = rows.join(defs, "section_id").withColumn("key", stable_key(F.col("stable_key"), F.col("row_index")))
    text = clean(F.get("cells", F.col("text_column")))
    out = joined.withColumn("text", text).withColumn("section_name", F.col("section_id")).withColumn("tier", tier_name(F.col("tier_value"))).filter("text <> ''")
    return _finish(out, F.col("record_type"), "tier")


def section_affixes(rows: DataFrame, section: str) -> DataFrame:
    """The records of one section, text in the first cell."""
    defs = rows.sparkSession.createDataFrame([(section, "affix", 0)], "section_id string, record_type string, text_column int")
    return affix_records(rows, defs)


def merged_page_records(records: DataFrame, entity: str) -> DataFrame:
    """Records of several pages under one entity; the same key in two sections stays apart by its section."""
    return records.withColumn("entity_id", F.lit(entity)).withColumn("record_id", record_id("record", entity=F.lit(entity), kind=F.col("record_type"), section=F.col("section_name"), key=F.col("key")))






def nested_key_records(rows: DataFrame, nested: DataFrame | Column) -> DataFrame:
    """Rows whose outer key is required, with the keys nested in them as an array. nested: one key a row (page_id, section_id, row_index,
    nested_key), or an array of keys that stands in the rows themselves, which needs no join."""
    out = rows.filter(F.coalesce("stable_key", F.lit("")) != "")
    if isinstance(nested, Column):
        out = out.withColumn("nested_keys", F.array_sort(nested))
    else:
        inner = nested.groupBy("page_id", "section_id", "row_index").agg(F.array_sort(F.collect_list("nested_key")).alias("nested_keys"))
        out = out.join(inner, ["page_id", "section_id", "row_index"], "left")
    out = out.withColumn("key", stable_key(F.col("stable_key"), F.col("row_index"))).withColumn("text", clean(F.get("cells", 0))).withColumn("section_name", F.col("section_id"))
    return _finish(out, F.lit("prism"), "nested_keys")



def effect_or_description(cards: DataFrame) -> DataFrame:
    """One record a page: the first effect of its current cards (by node_id, where they have one, then by text), else
    the first description, located by section."""
    at = F.col("node_id") if "node_id" in cards.columns else F.lit(0)
    first = lambda c: F.min(F.when(F.col(c).isNotNull(), F.struct(at.alias("at"), F.col(c).alias("text"))))["text"].alias(c)
    best = cards.groupBy("page_id").agg(first("effect"), first("description"))
    text, level = F.coalesce("effect", "description"), F.when(F.col("effect").isNotNull(), "record").otherwise("section")
    return best.select("page_id", text.alias("text"), level.alias("locator_level")).filter("text is not null")


def record_documents(records: DataFrame, entities: DataFrame) -> DataFrame:
    """Records with their entity's title and category, landing, and text to search in."""
    out = records.join(entities.select("entity_id", "title", "category", "route"), "entity_id", "left")
    return out.withColumn("landing", landing()).withColumn("search_text", F.concat_ws(" ", "title", "section_name", "text"))


def landing() -> Column:
    """Anchor (the locator's id, else its tab), level and key of the place to go to."""
    loc = lambda f: F.col(f"source_locator.{f}")
    anchor = F.coalesce(F.nullif(loc("dom_id"), F.lit("")), F.regexp_replace(loc("tab_target"), "^#", ""))
    return F.struct(anchor.alias("anchor"), loc("locator_level").alias("level"), loc("stable_key").alias("key"))


def structure_signature(descriptor: DataFrame) -> DataFrame:
    """Signature of each page's sections, without their texts."""
    parts = F.array_sort(F.collect_list(F.struct("section_id", "tables", F.size("headers").alias("columns"))))
    return descriptor.groupBy("page_id").agg(parts.alias("_p")).select("page_id", signature(sections=F.col("_p")).alias("signature"))


def validate_records(records: DataFrame) -> DataFrame:
    """Q02: records with the reasons why they break the contract (none: an empty array)."""
    loc = lambda f: F.col(f"source_locator.{f}")
    reasons = [F.when(F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) == "", F.lit(f"{c} missing")) for c in REQUIRED if c in records.columns]
    reasons += [F.when(~F.coalesce(loc("locator_confidence").isin(*CONFIDENCE), F.lit(False)), F.lit("locator_confidence")),
        F.when(~F.coalesce(loc("locator_level").isin(*LEVELS), F.lit(False)), F.lit("locator_level")), F.when(F.coalesce(loc("row_index"), F.lit(-1)) < 0, F.lit("row_index"))]
    return records.withColumn("reasons", F.filter(F.array(*reasons), lambda x: x.isNotNull()))


def structure_check(observed: DataFrame, rules: dict[str, str], warnings: tuple[str, ...] = ()) -> DataFrame:
    """Q03: page_id, check, expected, value, severity (mismatch or warning) where what was observed differs from the rule,
    or is absent. rules names the expected value of each check; observed(page_id, check, value)."""
    seen = observed.groupBy("page_id").agg(F.collect_list(F.when(F.col("check").isin(*rules), F.struct("check", "value"))).alias("seen"))
    rule = lambda c, e: F.struct(F.lit(c).alias("check"), F.lit(e).alias("expected"), F.lit("warning" if c in warnings else "mismatch").alias("severity"))
    each = seen.select("page_id", "seen", F.explode(F.array(*[rule(c, e) for c, e in rules.items()])).alias("r"))
    values = F.transform(F.filter("seen", lambda x: x["check"] == F.col("r.check")), lambda x: x["value"])
    rows = each.select("page_id", "r.*", F.explode_outer(values).alias("value"))
    return rows.filter(~F.col("value").eqNullSafe(F.col("expected")))


@dataclass(frozen=True)
class Extractor:
    """What a family of pages is read by: descriptor query, rule table, record query."""

    name: str
    version: str
    describe: Callable[[DataFrame], DataFrame]
    rules: dict[str, str]
    records: Callable[[DataFrame], DataFrame]
    warnings: tuple[str, ...] = ()

    def run(self, pages: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(records of the pages that fit the rules, what differs); a warning doesn't keep a page's records back."""
        wrong = structure_check(self.describe(pages), self.rules, self.warnings)
        fit = pages.join(wrong.filter("severity = 'mismatch'").select("page_id").distinct(), "page_id", "left_anti")
        return self.records(fit).withColumn("parser", F.lit(f"{self.name}@{self.version}")), wrong
