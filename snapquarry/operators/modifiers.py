"""Modifier aggregation: filters, sums in groups, products over groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def filter_reason() -> Column:
    """the first filter that rejects a modifier in a context (all, any, none, type), null if it matches."""
    given = lambda c: F.coalesce(F.size(F.col(c)), F.lit(0)) > 0
    tags = F.coalesce("tags", F.array().cast("array<string>"))
    any_filter = given("tags_all") | given("tags_any") | given("tags_none") | given("damage_types")
    return (
        F.when(F.col("context_id").isNull() & any_filter, "no_context").when(given("tags_all") & (F.size(F.array_except("tags_all", tags)) > 0), "tags_all")
        .when(given("tags_any") & ~F.arrays_overlap("tags_any", tags), "tags_any").when(given("tags_none") & F.arrays_overlap("tags_none", tags), "tags_none")
        .when(given("damage_types") & ~F.coalesce(F.array_contains("damage_types", F.col("damage_type")), F.lit(False)), "damage_type"))


#: Most contexts that modifiers are put to at once.
MOST_CONTEXTS = 1000


def _literal(value, kind: str) -> Column:
    return (F.array(*[F.lit(v) for v in value]) if isinstance(value, (list, tuple)) else F.lit(value)).cast(kind)


def match_filters(modifiers: DataFrame, contexts: DataFrame) -> DataFrame:
    """Every modifier in every context with matched and reason; a trace keeps the rejected ones. contexts is a
    stated set that each modifier is put to: its rows become a literal, from which each modifier is spread without a join; more than
    MOST_CONTEXTS are an error."""
    rows = contexts.limit(MOST_CONTEXTS + 1).collect()
    if len(rows) > MOST_CONTEXTS:
        raise ValueError(f"more than {MOST_CONTEXTS} contexts")
    kinds = dict(contexts.dtypes)
    each = F.array(*[F.struct(*[_literal(r[c], k).alias(c) for c, k in kinds.items()]) for r in rows]).cast(f"array<{contexts.schema.simpleString()}>")
    pairs = modifiers.withColumn("_context", F.explode(each)).select(*modifiers.columns, "_context.*")
    return pairs.withColumn("reason", filter_reason()).withColumn("matched", F.col("reason").isNull())


def aggregate_modifiers(matched: DataFrame) -> DataFrame:
    """Signed sum of matched modifiers for each context, node and key."""
    signed = F.when(F.col("operation") == "subtract", -F.col("value")).otherwise(F.col("value"))
    return matched.filter("matched").groupBy("context_id", "target_node", "aggregation_key").agg(F.sum(signed).alias("total"), F.count(F.lit(1)).alias("n"))


def node_totals(sums: DataFrame) -> DataFrame:
    """Sum over the keys of a node."""
    return sums.groupBy("context_id", "target_node").agg(F.sum("total").alias("total"))


def extra_multiplier(sums: DataFrame, keys: list[str], total: str = "total") -> DataFrame:
    """Product over groups of 1 plus the group's sum; a factor below 0 is an error."""
    factor = 1 + F.col(total)
    ok = F.when(factor < 0, F.raise_error(F.lit("negative multiplier")).cast("double")).otherwise(factor)
    return sums.groupBy(*keys).agg(F.product(ok).alias("multiplier"))


def resolve_mechanics(mechanics: DataFrame, sources: DataFrame, modifiers: DataFrame) -> DataFrame:
    """mechanic_id, maximum (base plus the deltas), acquired, assumed (the maximum if a source matched, else 0)."""
    got = sources.groupBy("mechanic_id").agg(F.bool_or("matched").alias("acquired"))
    more = modifiers.groupBy("mechanic_id").agg(F.sum("delta").alias("delta"))
    out = mechanics.join(got, "mechanic_id", "left").join(more, "mechanic_id", "left")
    maximum = F.col("base_maximum") + F.coalesce("delta", F.lit(0))
    acquired = F.coalesce("acquired", F.lit(False))
    return out.select("mechanic_id", maximum.alias("maximum"), acquired.alias("acquired"), F.when(acquired, maximum).otherwise(0).alias("assumed"))


def convert(components: DataFrame, rules: DataFrame) -> DataFrame:
    """Each component split by its hit's rule (at most one): what is converted takes the new type at the end of its
    history, what is left keeps its own; parts of 0 go."""
    ratio = F.when(F.col("current_type") == F.col("from_type"), F.col("ratio")).otherwise(0.0)
    j = components.join(rules, "hit_id", "left").withColumn("_r", F.coalesce(ratio, F.lit(0.0)))
    rest = F.struct((F.col("base_value") * (1 - F.col("_r"))).alias("base_value"), F.col("current_type"), F.col("history"))
    conv = F.struct((F.col("base_value") * F.col("_r")).alias("base_value"), F.col("to_type").alias("current_type"), F.array_union("history", F.array("to_type")).alias("history"))
    return j.select("hit_id", "component_id", F.explode(F.filter(F.array(rest, conv), lambda p: p["base_value"] > 0)).alias("p")).select("hit_id", "component_id", "p.*")


def component_match() -> Column:
    """all required tags are among the hit's, and the required types are none or overlap the whole history."""
    tags = F.size(F.array_except(F.coalesce("required_tags", F.array().cast("array<string>")), "hit_tags")) == 0
    return tags & ((F.coalesce(F.size("required_types"), F.lit(0)) == 0) | F.arrays_overlap("required_types", "history"))


def hit_totals(components: DataFrame, modifiers: DataFrame) -> DataFrame:
    """hit_id, total: the sum over components of base x (1 + sum of increased) x product over extra groups of
    (1 + sum). components(hit_id, component_id, base_value, current_type, history, hit_tags), modifiers(hit_id, kind,
    extra_group, value, required_tags, required_types); a null group is one shared group; a hit's component_id, type and value name one component.
    Components meet modifiers once, and all that follows stays with the hit's task."""
    key = ["hit_id", "component_id", "current_type", "base_value"]
    hits = components.join(modifiers.withColumnRenamed("hit_id", "_hit"), (F.col("hit_id") == F.col("_hit")) & component_match(), "left")
    sums = hits.groupBy(*key, "kind", "extra_group").agg(F.sum("value").alias("total"))
    factor = F.when(F.col("kind") == "extra", 1 + F.col("total"))
    ok = F.when(factor < 0, F.raise_error(F.lit("negative multiplier")).cast("double")).otherwise(factor)
    parts = sums.groupBy(*key).agg(F.sum(F.when(F.col("kind") == "increased", F.col("total"))).alias("increased"), F.product(ok).alias("multiplier"))
    value = F.col("base_value") * (1 + F.coalesce("increased", F.lit(0.0))) * F.coalesce("multiplier", F.lit(1.0))
    return parts.groupBy("hit_id").agg(F.sum(value).alias("total"))


def trace_lines(matched: DataFrame) -> DataFrame:
    """One line for each modifier that was looked at."""
    said = F.when(F.col("matched"), F.format_string("%s: %s %s to %s", "id", "operation", F.col("value").cast("string"), "target_node")).otherwise(F.format_string("%s: rejected by %s", "id", "reason"))
    return matched.select("context_id", "id", said.alias("line"))
