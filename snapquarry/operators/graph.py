"""Iteration to a fixed point over link and asset graphs (I01, I02). Each round is checkpointed or written."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.urls import canonical_page, resolve_url
from ..sources.scratch import new_folder


def frontier(links: DataFrame, manifested: DataFrame, available: DataFrame, rejected: DataFrame) -> DataFrame:
    """I01, one round: route, state (manifested, recovered, rejected, pending), referring pages and links of each linked route."""
    each = links.groupBy("route").agg(F.count(F.lit(1)).alias("links"), F.count_distinct("page_id").alias("pages"), F.min("page_id").alias("first_page"))
    for name, t in (("m", manifested), ("a", available), ("r", rejected)):
        each = each.join(t.select("route", F.lit(True).alias(f"_{name}")).distinct(), "route", "left")
    state = F.when(F.col("_m"), "manifested").when(F.col("_a"), "recovered").when(F.col("_r"), "rejected").otherwise("pending")
    return each.select("route", state.alias("state"), "links", "pages", "first_page")


class NotConverged(RuntimeError):
    """A fixed point was not reached."""


class _Rounds:
    """Tables of one kind, one for each round, in one folder: a round writes its own rows and reads all rounds'."""

    def __init__(self, spark, name: str, schema) -> None:
        self.spark, self.path, self.schema = spark, new_folder(spark, name), schema

    def add(self, df: DataFrame, number: int) -> DataFrame:
        df.write.parquet(f"{self.path}/round={number}")
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/round={number}")

    def all(self) -> DataFrame:
        return self.spark.read.schema(self.schema).option("recursiveFileLookup", "true").parquet(self.path)


def reachable(edges: DataFrame, start: DataFrame, max_rounds: int | None = None, *, cut: bool = False) -> DataFrame:
    """Node, depth of everything reached from start(node) over edges(src, dst). Each round follows only what the one
    before found, and writes only what it finds. With max_rounds, work that is left after so many rounds is an error
    (NotConverged), unless `cut` says that deeper nodes are not asked for."""
    first = start.select("node").distinct().withColumn("depth", F.lit(0))
    seen = _Rounds(edges.sparkSession, "reached", first.schema)
    last = seen.add(first, 0)
    for depth in count(1):
        new = edges.join(last.select(F.col("node").alias("src")), "src").select(F.col("dst").alias("node")).distinct()
        new = new.join(seen.all().select("node"), "node", "left_anti").withColumn("depth", F.lit(depth))
        if max_rounds is not None and depth > max_rounds:
            if not cut and not new.isEmpty():
                raise NotConverged(f"nodes are left after {max_rounds} rounds")
            break
        last = seen.add(new, depth)
        if last.isEmpty():
            break
    return seen.all()


@dataclass
class Recovery:
    """What `converge` gives: routes(route, state, round): manifested (linked and in a manifest), recovered or rejected, and
    the round that settled it; provenance(route, system_id, page_id, source_url, raw_href): every different link to a route; pages: what was
    recovered; rounds that were run."""

    routes: DataFrame
    provenance: DataFrame
    pages: DataFrame
    rounds: int


def page_links(pages: DataFrame) -> DataFrame:
    """route, system_id, page_id, source_url, raw_href: the different links of pages(system_id, page_id, url, html) to pages of their
    own site, by pattern."""
    href = r"""(?i)<a\s(?:[^>]*?\s)?href\s*=\s*["']([^"']*)["']"""
    rows = pages.select("system_id", "page_id", F.col("url").alias("source_url"), F.explode(F.regexp_extract_all("html", F.lit(href), F.lit(1))).alias("raw_href"))
    target = resolve_url(F.col("raw_href"), F.col("source_url"))
    own = F.regexp_extract("source_url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)", 1)
    rows = rows.withColumn("target", target).filter(F.lower(F.regexp_extract("target", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)", 1)) == F.lower(own))
    return rows.select(canonical_page(F.col("target")).alias("route"), "system_id", "page_id", "source_url", "raw_href").filter("route is not null and route <> '/'").distinct()


def signature_of(routes: DataFrame) -> tuple[int, int, int]:
    """Tells sets of routes apart without regard to order: their number, and sum and exclusive-or of their hashes; parts of a
    set can be added up."""
    h = F.xxhash64("route")
    row = routes.agg(F.count(F.lit(1)).alias("n"), F.sum(h.cast("decimal(38,0)")).alias("s"), F.bit_xor(h).alias("x")).first()
    return row.n, int(row.s or 0), row.x or 0


def converge(pages: DataFrame, manifested: DataFrame, fetch: Callable[[DataFrame], DataFrame], *, rejected: DataFrame | None = None, max_rounds: int = 8) -> Recovery:
    """Recovers pages that others link to, until nothing is pending. pages(system_id, page_id, url, html) are those that are
    there, manifested(route) what manifests own already; fetch takes pending(route) and gives (route, status, page_id, url, html)
    for them: status available, not_found, redirected or invalid settles a route, network_error (or no row) leaves it pending.

    A round parses only the pages that the round before recovered, and looks only at routes that no round has seen, besides
    those still pending. It ends when none is pending. If the pending routes are the same as in the round before, so that
    fetching them again would change nothing, or if max_rounds are over, NotConverged is raised with their number. Provenance
    is kept as rows, as a route may be linked from any number of pages; rounds write only their own."""
    spark = pages.sparkSession
    links = page_links(pages.withColumn("system_id", F.col("system_id").cast("string")))
    every = _Rounds(spark, "links", links.schema)
    settled = _Rounds(spark, "settled", "route string, state string, at int")
    own = manifested.select("route").distinct()
    refused = rejected.select("route").distinct() if rejected is not None else own.limit(0)
    fresh, before, found = every.add(links, 1), None, None
    waiting = spark.createDataFrame([], "route string")
    recovered: _Rounds | None = None
    for number in range(1, max_rounds + 2):
        new = fresh.select("route").distinct()
        if number > 1:
            new = new.join(settled.all().select("route"), "route", "left_anti").join(waiting, "route", "left_anti")
        told = new.join(own.withColumn("_own", F.lit("manifested")), "route", "left").join(refused.withColumn("_no", F.lit("rejected")), "route", "left")
        told = told.select("route", F.coalesce("_own", "_no").alias("state"))
        path = new_folder(spark, "told")
        told.write.parquet(path)
        told = spark.read.schema(told.schema).parquet(path)
        pending = told.filter("state is null").select("route").unionByName(waiting)
        now = signature_of(pending)
        known = told.filter("state is not null").select("route", "state", F.lit(number).alias("at"))
        if not now[0]:
            settled.add(known, number)
            break
        if now == before:
            raise NotConverged(f"{now[0]} routes are pending and unchanged after {number - 1} rounds")
        if number > max_rounds:
            raise NotConverged(f"{now[0]} routes are pending after {max_rounds} rounds")
        before = now
        got = fetch(pending)
        got = pending.join(got.select("route", "status", "page_id", "url", "html"), "route", "left")
        if recovered is None:
            recovered = _Rounds(spark, "recovered", got.schema)
        found = recovered.add(got, number)
        state = F.when(F.col("status") == "available", "recovered").when(F.coalesce("status", F.lit("network_error")) != "network_error", "rejected")
        outcome = found.select("route", state.alias("state"), F.lit(number).alias("at")).distinct()
        settled.add(known.unionByName(outcome.filter("state is not null")), number)
        path = new_folder(spark, "waiting")
        outcome.filter("state is null").select("route").write.parquet(path)
        waiting = spark.read.schema("route string").parquet(path)
        fresh = every.add(page_links(found.filter("status = 'available'").withColumn("system_id", F.lit("recovered"))), number + 1)
    there = recovered.all().filter("status = 'available'") if recovered is not None else pages.limit(0)
    return Recovery(settled.all().select("route", "state", F.col("at").alias("round")), every.all().distinct(), there, number)


def asset_closure(page_refs: DataFrame, sheet_refs: DataFrame, max_rounds: int | None = None) -> DataFrame:
    """Assets that pages(url) refer to, and those that style sheets among them refer to, until none is new; with
    max_rounds, at most so many steps deep."""
    return reachable(sheet_refs.select(F.col("url").alias("src"), F.col("ref").alias("dst")), page_refs.select(F.col("url").alias("node")), max_rounds, cut=True)
