"""Arrays, maps and JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def flatten_effects(docs: DataFrame, nodes: str = "nodes") -> DataFrame:
    """One row for each effect of each level of each node of nested documents, with its three places."""
    a = docs.select("*", F.posexplode_outer(nodes).alias("node_no", "node")).drop(nodes)
    b = a.select("*", F.posexplode_outer("node.levels").alias("level_no", "level"))
    return b.select("*", F.posexplode_outer("level.effects").alias("effect_no", "effect"))


def distinct_nonempty(values: Column) -> Column:
    """Non-empty values, each once, in first-seen order."""
    return F.array_distinct(F.filter(values, lambda x: x.isNotNull() & (x != "")))


def first_sorted(values: Column, n: int) -> Column:
    """The n smallest values in order."""
    return F.slice(F.array_sort(values), 1, n)


def missing_from(values: Column, known: Column) -> Column:
    """Values that are not known."""
    return F.array_except(values, known)


def looked_up(pairs: Column, key: Column, default: Column) -> Column:
    """The value of a key, or a default."""
    return F.coalesce(F.try_element_at(pairs, key), default)


def merged(one: Column, two: Column) -> Column:
    """Both maps, the second one's values first."""
    rest = F.map_filter(one, lambda k, v: ~F.map_contains_key(two, k))
    return F.map_concat(rest, two)


def parsed(text: Column, schema: str) -> Column:
    """JSON text to columns; null where it is no JSON of this kind."""
    return F.from_json(text, schema, {"mode": "PERMISSIVE"})


def canonical_json(values: dict[str, Column]) -> Column:
    """JSON of a struct with its keys in order."""
    return F.to_json(F.struct(*[values[k].alias(k) for k in sorted(values)]), {"ignoreNullFields": "false"})
