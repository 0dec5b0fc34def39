"""Entity resolution."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import clean
from .relational import first_by


def route_sources(entries: DataFrame) -> DataFrame:
    """The first entry of each (route, manifest), and per route its sources in order.
    entries(route, system_id, role, title, category, title_hash, body_hash, source_order)."""
    once = first_by(entries, ["route", "system_id"], ["source_order", "title"])
    return once.groupBy("route").agg(F.array_sort(F.collect_list(F.struct("source_order", "system_id", "role", "title", "category", "title_hash", "body_hash"))).alias("sources"), F.count(F.lit(1)).alias("n"))


def confidence(sources: Column) -> Column:
    """High iff every source has both hashes and they all agree; else medium."""
    whole = ~F.exists(sources, lambda s: s["title_hash"].isNull() | s["body_hash"].isNull())
    one = (F.size(F.array_distinct(F.transform(sources, lambda s: s["title_hash"]))) == 1) & (F.size(F.array_distinct(F.transform(sources, lambda s: s["body_hash"]))) == 1)
    return F.when(whole & one, "high").otherwise("medium")


def group_category(sources: Column) -> Column:
    """The single category of a group, `mixed`, or null."""
    named = F.array_distinct(F.filter(F.transform(sources, lambda s: s["category"]), lambda c: c.isNotNull()))
    return F.when(F.size(named) == 1, F.get(named, 0)).when(F.size(named) > 1, "mixed")


def medium_class(sources: Column) -> Column:
    """A (merge: one category, two or more primary sources of one title), B (review), C (conflict: mixed category)."""
    primary = F.filter(sources, lambda s: s["role"] == "primary")
    same = F.size(F.array_distinct(F.transform(primary, lambda s: s["title"]))) == 1
    category = group_category(sources)
    return F.when(category == "mixed", "C").when(category.isNotNull() & (F.size(primary) >= 2) & same, "A").otherwise("B")


def source_role(system: Column, recovered: list[str], secondary: list[str], support: list[str], primary: list[str]) -> Column:
    """Recovered, secondary, support, primary or source, the first that applies; the lists are rule tables."""
    return F.when(system.isin(*recovered), "recovered").when(system.isin(*secondary), "secondary").when(system.isin(*support), "support").when(system.isin(*primary), "primary").otherwise("source")


def build_entities(entries: DataFrame) -> DataFrame:
    """Entities from listings: routes with two or more sources that are high or class A, and routes with a primary
    source; with confidence, owner (smallest order, then system), title of the category's owner first, and sources."""
    g = route_sources(entries).withColumn("level", confidence(F.col("sources"))).withColumn("category", group_category(F.col("sources"))).withColumn("class", medium_class(F.col("sources")))
    primary = F.filter("sources", lambda s: s["role"] == "primary")
    merged = (F.col("n") >= 2) & ((F.col("level") == "high") | (F.col("class") == "A"))
    kept = g.withColumn("confidence", F.when(merged, F.col("level")).when((F.col("n") == 1) & (F.size(primary) > 0), "primary")).filter("confidence is not null")
    # sources are in order of source_order, so the first is the owner
    own = F.coalesce(F.get(primary, 0), F.get("sources", 0))
    return kept.select(F.col("route"), own["title"].alias("title"), own["system_id"].alias("owner"), "category", "confidence",
        F.transform("sources", lambda s: F.struct(s["system_id"].alias("system_id"), s["role"].alias("role"))).alias("sources"))


def with_uncovered(entities: DataFrame, primary_pages: DataFrame) -> DataFrame:
    """N06 (second version): and primary pages that no entity covers, as entities of their own."""
    extra = primary_pages.join(entities.select("route"), "route", "left_anti")
    return entities.unionByName(extra.select("route", "title", F.col("system_id").alias("owner"), "category", F.lit("primary").alias("confidence"), F.array(F.struct("system_id", F.lit("primary").alias("role"))).alias("sources")))


def coverage(pages: DataFrame, entities: DataFrame) -> DataFrame:
    """Why each page is no new entity, or that it is a candidate.
    pages(page_id, route, title, system_id, hidden, role, category)."""
    j = pages.join(entities.select("route", F.lit(True).alias("_e")).distinct(), "route", "left")
    n = F.row_number().over(Window.partitionBy("route").orderBy("page_id"))
    reason = (F.when(F.col("hidden"), "hidden_system").when(F.col("role") != "primary", "not_primary").when(F.col("category").isNull(), "not_in_tree").when(F.col("route").isNull(), "invalid_route")
              .when(F.coalesce(F.trim("title"), F.lit("")) == "", "no_title").when(F.col("_e"), "already_entity").when(n > 1, "duplicate").otherwise("candidate"))
    return j.withColumn("reason", reason).drop("_e")


def dedup_report(groups: DataFrame) -> DataFrame:
    """Groups of two or more sources by confidence, class and category."""
    g = groups.filter("n >= 2")
    level = confidence(F.col("sources"))
    return g.groupBy(level.alias("confidence"), F.when(level == "medium", medium_class(F.col("sources"))).alias("class"),
        F.coalesce(group_category(F.col("sources")), F.lit("null")).alias("category")).agg(F.count(F.lit(1)).alias("groups"), F.sum("n").alias("sources"))


@dataclass(frozen=True)
class Kind:
    """What a kind of entity says of the entities that are of it. Of several kinds an entity is of the first in the table.
    shows: it is visible whatever its route is; names: its title is put over the shown title; titles: over the entity's title too. A fact may name another
    subcategory."""

    name: str
    entity_type: str
    category: str
    subcategory: str
    sources: tuple[tuple[str, str], ...] = ()
    shows: bool = True
    names: bool = True
    titles: bool = False


# Kinds in order of precedence.
KINDS = (
    Kind("fate", "fate", "pact_spirit", "pact_spirit_destiny", shows=False, names=False),
    Kind("pact_spirit", "pact_spirit", "pact_spirit", "pact_spirit_entity", shows=False, names=False),
    Kind("equipment", "equipment", "equipment", "equipment_craft", (("inventory", "base_equipment"), ("craft", "craft_affixes")), shows=False, names=False),
    Kind("legendary", "legendary_equipment", "equipment", "equipment_legendary", (("legendary_gear", "main_effect"), ("corrosion", "corrosion"))),
    Kind("vorax", "equipment", "equipment", "equipment_vorax", (("vorax", "equipment_data"),)),
    Kind("talent", "talent", "talent_board", "talent_hero", (("talent", "talent_effects"),)),
    Kind("prism", "talent_system", "talent_board", "talent_ethereal_prism", (("ethereal_prism", "system_data"),)),
    Kind("hero", "hero", "hero", "hero_trait", (("hero", "hero_trait"),), titles=True),
    Kind("memory", "memory_system", "memory", "hero_memory", (("hero_memory", "base_memory_affixes"), ("revival", "revival_affixes")), titles=True),
    Kind("related_system", "equipment_related_system", "equipment_related", "equipment_related", (("help", "affix_system"),)),
)


def record_facts(records: DataFrame, titles: DataFrame, kind: str, parts: dict[str, list[str]], labels: dict[str, str] | None = None, needed: list[str] | None = None) -> DataFrame:
    """A fact of a kind for each entity: route, kind, title, summary (the title, then for each part its label, if it has one, and the
    different texts of its record types, in order) and counts (rows of each part). An entity for which a needed part has
    no text has none. records(route, record_type, row_index, text), titles(route, title)."""
    labels = labels or {}
    rows = records.withColumn("text", clean(F.col("text"))).filter("text <> ''")
    every = [t for types in parts.values() for t in types]
    listed = {p: F.transform(F.array_sort(F.collect_list(F.when(F.col("record_type").isin(*types), F.struct("row_index", "record_type", "text")))), lambda r: r["text"]).alias(f"_{p}") for p, types in parts.items()}
    g = rows.filter(F.col("record_type").isin(*every)).groupBy("route").agg(*listed.values())
    for p in needed or []:
        g = g.filter(F.size(f"_{p}") > 0)
    said = [F.when(F.size(f"_{p}") > 0, F.concat(F.array(F.lit(labels[p])) if p in labels else F.array().cast("array<string>"), F.array_distinct(f"_{p}"))).otherwise(F.array().cast("array<string>")) for p in parts]
    j = g.join(titles.select("route", "title"), "route")
    counts = F.map_from_entries(F.array(*[F.struct(F.lit(p), F.size(f"_{p}").cast("long")) for p in parts]))
    return j.select("route", F.lit(kind).alias("kind"), "title", F.lit(None).cast("string").alias("subcategory"), clean(F.array_join(F.flatten(F.array(F.array("title"), *said)), " ")).alias("summary"), counts.alias("counts"))


def enrich(entities: DataFrame, facts: DataFrame, kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """entities(route, title, owner, category, confidence, sources) with what the first of their kinds says:
    entity_type, title, shown_title, category, subcategory, clean_summary, sources (system_id, role), shows and counts. facts(route, kind, title,
    subcategory, summary, counts map of long); of several facts of a kind the smallest title counts, then summary. A fact's
    null leaves the entity's own value; facts of no known kind and of no entity are passed over. All kinds are one table, and one aggregate finds
    each entity's fact."""
    rule = F.create_map(*[x for i, k in enumerate(kinds) for x in (F.lit(k.name), F.struct(
        F.lit(i).alias("rank"), F.lit(k.entity_type).alias("entity_type"), F.lit(k.category).alias("category"), F.lit(k.subcategory).alias("subcategory"), F.lit(k.shows).alias("shows"),
            F.lit(k.names).alias("names"), F.lit(k.titles).alias("titles"),
        F.array(*[F.struct(F.lit(s).alias("system_id"), F.lit(r).alias("role")) for s, r in k.sources]).cast("array<struct<system_id:string,role:string>>").alias("sources")))])
    known = facts.withColumn("r", F.try_element_at(rule, F.col("kind"))).filter("r is not null")
    # maps have no order, so the rest of a fact is carried, not compared
    best = known.groupBy("route").agg(F.min_by(F.struct("title", "subcategory", "summary", "counts", "r"),
        F.struct("r.rank", F.coalesce("title", F.lit("")), F.coalesce("summary", F.lit("")), F.coalesce("subcategory", F.lit("")))).alias("f"))
    j = entities.join(best, "route", "left")
    name = F.nullif(F.trim("f.title"), F.lit(""))
    return j.select(
        "route", F.coalesce(F.when(F.col("f.r.titles"), name), "title").alias("title"), F.coalesce(F.when(F.col("f.r.names") | F.col("f.r.titles"), name), "title").alias("shown_title"),
            "owner", F.col("f.r.entity_type").alias("entity_type"),
        F.coalesce("f.r.category", "category").alias("category"), F.coalesce("f.subcategory", "f.r.subcategory").alias("subcategory"), "confidence", F.nullif(F.trim("f.summary"), F.lit("")).alias("clean_summary"),
        F.when(F.size("f.r.sources") > 0, F.col("f.r.sources")).otherwise(F.col("sources")).alias("sources"), F.coalesce("f.r.shows", F.lit(False)).alias("shows"), "f.counts")


def entity_visibility(entities: DataFrame, directories: DataFrame) -> DataFrame:
    """An entity is hidden iff its route is a directory page, unless its kind shows it (column `shows`, if there is one)."""
    j = entities.join(directories.select("route", F.lit(True).alias("_d")).distinct(), "route", "left")
    shows = F.coalesce("shows", F.lit(False)) if "shows" in entities.columns else F.lit(False)
    return j.withColumn("visibility", F.when(F.coalesce("_d", F.lit(False)) & ~shows, "hidden").otherwise("visible")).drop("_d")


def classify(pages: DataFrame) -> DataFrame:
    """Category of each page and which rule gave it. pages(system_id, entity_category, agreeing (primary sources that
    agree with it), route_category, system_category, ...)."""
    reason = (F.when(F.col("entity_category").isNotNull() & ((F.col("system_id") != "inventory") | (F.col("agreeing") >= 2)), "entity_override").when(F.col("route_category").isNotNull(), "route_override")
              .when(F.col("system_id") == "craft", "craft_rejected").when(F.col("system_id") == "inventory", "inventory_unclassified").when(F.col("system_category").isNotNull(), "system_fallback"))
    value = F.when(reason == "entity_override", F.col("entity_category")).when(reason == "route_override", F.col("route_category")).when(reason == "system_fallback", F.col("system_category"))
    return pages.withColumn("reason", reason).withColumn("category", value)
