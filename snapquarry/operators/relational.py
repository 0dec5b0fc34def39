"""Joins, set operations, ranking and order.

Small dimensions are left to Spark's size check (spark.sql.autoBroadcastJoinThreshold) instead of a broadcast hint.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_dimension(df: DataFrame, dim: DataFrame, on: list[str]) -> DataFrame:
    """Left join to a dimension with one row a key; rows without one get nulls."""
    return df.join(dim, on, "left")


def mismatches(left: DataFrame, right: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Keys of `left` that `right` lacks, or has with another value."""
    other = right.select(*keys, F.col(value).alias("_other"), F.lit(True).alias("_there"))
    out = left.select(*keys, value).join(other, keys, "left")
    reason = F.when(F.col("_there").isNull(), "missing").when(~F.col(value).eqNullSafe(F.col("_other")), "different")
    return out.withColumn("reason", reason).filter("reason is not null").drop("_there").withColumnRenamed("_other", "other")


def with_existence(df: DataFrame, known: DataFrame, key: str, flag: str = "known") -> DataFrame:
    """Whether the key is among the known ones."""
    return df.join(known.select(key).distinct().withColumn(flag, F.lit(True)), key, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


def not_in(df: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is not known."""
    return df.join(known.select(*keys), keys, "left_anti")


def compared(left: DataFrame, right: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """Full outer comparison: status (only_left, only_right, changed, same) and the fields that differ."""
    a = left.select(*keys, F.struct(*fields).alias("_a"))
    b = right.select(*keys, F.struct(*fields).alias("_b"))
    differ = F.filter(F.array(*[F.when(~F.col(f"_a.{f}").eqNullSafe(F.col(f"_b.{f}")), F.lit(f)) for f in fields]), lambda x: x.isNotNull())
    status = F.when(F.col("_b").isNull(), "only_left").when(F.col("_a").isNull(), "only_right").when(F.size(differ) > 0, "changed").otherwise("same")
    return a.join(b, keys, "full_outer").select(*keys, status.alias("status"), F.when(status == "changed", differ).otherwise(F.array().cast("array<string>")).alias("changed"))


def with_fallbacks(df: DataFrame, lookups: list[DataFrame], key: str, value: str) -> DataFrame:
    """The value of the first look-up table that has the key, and its number."""
    out = df
    for i, t in enumerate(lookups):
        out = out.join(t.select(key, F.col(value).alias(f"_v{i}")), key, "left")
    got = [F.col(f"_v{i}") for i in range(len(lookups))]
    which = reduce(lambda acc, i: acc.when(got[i].isNotNull(), i), range(1, len(got)), F.when(got[0].isNotNull(), 0))
    return out.withColumn(value, F.coalesce(*got)).withColumn("from_lookup", which).drop(*[f"_v{i}" for i in range(len(got))])


def owned_elsewhere(section_keys: DataFrame, owners: DataFrame) -> DataFrame:
    """page_id, section, owned: a section is owned elsewhere iff all its keys are known, they have one single owner,
    and this owner's route is another page. section_keys(page_id, route, section, key), owners(key, owner, owner_route). Of a key's owners
    the least, the greatest and their routes tell all that a section asks, so no key is joined with more than one row."""
    whose = owners.groupBy("key").agg(F.min("owner").alias("_least"), F.max("owner").alias("_most"), F.bool_and(F.col("owner").isNotNull()).alias("_known"),
        F.collect_set("owner_route").alias("_routes"), F.bool_or(F.col("owner_route").isNull()).alias("_unrouted"))
    joined = section_keys.join(whose, "key", "left")
    same = F.when(F.col("route").isNull(), F.coalesce("_unrouted", F.lit(True))).otherwise(F.coalesce(F.array_contains("_routes", F.col("route")), F.lit(False)))
    return joined.groupBy("page_id", "section").agg((F.bool_and(F.coalesce("_known", F.lit(False))) & (F.min("_least") == F.max("_most")) & ~F.bool_or(same)).alias("owned"))


def with_exclusions(entries: DataFrame, excluded: DataFrame, keys: list[str]) -> DataFrame:
    """A validation struct on the entries that a list of known-missing keys names."""
    return entries.join(excluded.select(*keys, F.lit("not_found").alias("_status")), keys, "left").withColumn(
        "validation", F.when(F.col("_status").isNotNull(), F.struct(F.col("_status").alias("status")))).drop("_status")


def unique_paths(pages: DataFrame, key: str, path: str) -> tuple[DataFrame, DataFrame]:
    """(key to path where only one page has it, keys that several have with their number)."""
    each = pages.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.min(path).alias(path))
    return each.filter("n = 1").select(key, path), each.filter("n > 1").select(key, "n")


def union_unique(tables: dict[str, DataFrame], key: str) -> tuple[DataFrame, DataFrame]:
    """(union of all tables with their name in `module`, keys that occur more than once with the modules)."""
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [t.withColumn("module", F.lit(n)) for n, t in tables.items()])
    twice = whole.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_set("module")).alias("modules")).filter("n > 1")
    return whole, twice


def merged_evidence(tables: dict[str, DataFrame], key: str) -> DataFrame:
    """Each key once, with the set of tables that have it."""
    whole = reduce(lambda a, b: a.unionByName(b), [t.select(key).withColumn("_from", F.lit(n)) for n, t in tables.items()])
    return whole.groupBy(key).agg(F.array_sort(F.collect_set("_from")).alias("sources"))


def set_difference(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys of one table only, told as missing (not in b) or extra (not in a)."""
    left, right = a.select(key).distinct(), b.select(key).distinct()
    return left.join(right, key, "left_anti").withColumn("side", F.lit("missing")).unionByName(right.join(left, key, "left_anti").withColumn("side", F.lit("extra")))


def set_common(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys of both tables."""
    return a.select(key).intersect(b.select(key))


def upsert(state: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """State with the rows' values put over it; of several new rows with a key the last by `seq` counts."""
    columns = [c for c in state.columns if c != key]
    both = state.select(key, F.lit(-1).cast("long").alias("seq"), *columns).unionByName(rows.select(key, F.col("seq").cast("long").alias("seq"), *columns))
    best = both.groupBy(key).agg(F.max_by(F.struct(*columns), "seq").alias("_v"))
    return best.select(key, *[F.col(f"_v.{c}").alias(c) for c in columns])


def append_missing(base: DataFrame, extra: DataFrame, key: str) -> DataFrame:
    """Base, and the rows of extra whose key is new."""
    return base.unionByName(extra.join(base.select(key), key, "left_anti"))


def first_by(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key in a stated order, which must be total for the result to be settled."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def owner(sources: DataFrame, keys: list[str], rank: list[str], value: str) -> DataFrame:
    """The value of the source with the smallest rank tuple, as an aggregate that is summed up before the shuffle."""
    return sources.groupBy(*keys).agg(F.min_by(value, F.struct(*rank, value)).alias(value))


def with_title(df: DataFrame, candidates: list[tuple[str, str]]) -> DataFrame:
    """Title from the first non-empty candidate column, and which it was. candidates: (name, column)."""
    blank = lambda c: F.nullif(F.trim(F.col(c)), F.lit(""))
    which = reduce(lambda acc, nc: acc.when(blank(nc[1]).isNotNull(), nc[0]), candidates[1:], F.when(blank(candidates[0][1]).isNotNull(), candidates[0][0]))
    return df.withColumn("title", F.coalesce(*[blank(c) for _, c in candidates])).withColumn("title_from", which)


def occurrence_index(df: DataFrame, keys: list[str], order: list, name: str = "occurrence", start: int = 0) -> DataFrame:
    """Running number of a row within its key."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1 + start)


def unique_ids(df: DataFrame, key: str, order: list) -> DataFrame:
    """Ids made unique by _2, _3 and so on."""
    n = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn(key, F.when(n > 1, F.concat_ws("_", F.col(key), n)).otherwise(F.col(key)))


def reindexed(df: DataFrame, group: list[str], order: list, name: str = "source_order") -> DataFrame:
    """Order numbers made anew within each group."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*group).orderBy(*order)) - 1)


def published_order(df: DataFrame, *keys: str | Column) -> DataFrame:
    """Total order for publishing, by range partitions."""
    return df.orderBy(*keys)


def examples(df: DataFrame, keys: list[str], value: str, n: int) -> DataFrame:
    """For each group its size and its n smallest different values. Only different values are gathered."""
    total = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("total"))
    some = df.select(*keys, value).distinct()
    some = some.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(value))).filter(F.col("_n") <= n)
    some = some.groupBy(*keys).agg(F.array_sort(F.collect_list(value)).alias("examples"))
    same = reduce(lambda a, b: a & b, [total[k].eqNullSafe(some[k]) for k in keys])
    return total.join(some, same, "left").select(*[total[k] for k in keys], "total", "examples")


def top_keys(df: DataFrame, key: str, k: int) -> DataFrame:
    """The k most frequent keys; ties by key. A report of k rows."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), key).limit(k)


def longest(df: DataFrame, group: list[str], text: str, key: str) -> DataFrame:
    """The row with the longest text in each group; ties by smallest key."""
    return df.groupBy(*group).agg(F.max_by(F.struct(key, text), F.struct(F.length(text), -F.col(key))).alias("_r")).select(*group, f"_r.{key}", F.length(f"_r.{text}").alias("length"))


def confirmed(systems: DataFrame, system_id: str | None = None) -> DataFrame:
    """confirmed systems; with an id, exactly that one, else an error."""
    out = systems.filter("discovery_status = 'confirmed'")
    if system_id is None:
        return out
    out = out.filter(F.col("system_id") == system_id)
    found = len(out.select("system_id").limit(2).collect())
    if found != 1:
        raise ValueError(f"{system_id}: {found} confirmed systems")
    return out
