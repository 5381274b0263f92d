"""Link extraction, acceptance, routing counts, bounded breadth-first traversal, exact URL dedupe."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import html_blocks
from ..functions.batches import slices
from ..functions.urls import domain_allowed, shard_owner, url_fits
from ..storage import materialize


def seed_tasks(spark: SparkSession, urls: Iterable[str], shards: int = 1) -> DataFrame:
    """(url, depth, shard) of the seeds, at depth 0 with their owner; seeds pass no filter."""
    seeds = spark.createDataFrame([(u,) for u in urls], "url string")
    return seeds.select("url", F.lit(0).cast("smallint").alias("depth"), shard_owner(F.col("url"), shards).alias("shard"))


def extract_links(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, page_url, pos, link) of each a[href], in document order, resolved against the page's URL.

    Null pages and hrefs that do not resolve to a host give no rows. Rows that repeat an id are pages of their own. A page's HTML is
    not copied to its links.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 2):
            found = [html_blocks.links(u, h) for u, h in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)]
            at = [i for i, x in enumerate(found) for _ in x]
            if at:
                at = pa.array(at)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(at), b.column(1).take(at), pa.array([k for x in found for k in range(len(x))], pa.int64()), pa.array([u for x in found for u in x], pa.string())], ["page_id", "page_url", "pos", "link"]
                )

    picked = pages.select(F.col(id_col).cast("bigint").alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return picked.mapInArrow(run, "page_id bigint, page_url string, pos bigint, link string")


def accept_links(links: DataFrame, domains: Iterable[str] | None = None, url_filter: Callable[[Column], Column] | None = None, max_links: int | None = None) -> DataFrame:
    """links whose URL fits, whose host is allowed (None allows every host), that pass url_filter; the first max_links of a page.

    The cap counts accepted links before any dedupe; without it no shuffle is needed.
    """
    url = F.col("link")
    ok = url_fits(url)
    if domains is not None:
        ok &= domain_allowed(url, domains)
    if url_filter is not None:
        ok &= F.coalesce(url_filter(url), F.lit(False))
    kept = links.where(ok)
    if max_links is None:
        return kept
    w = Window.partitionBy("page_id", "page_url").orderBy("pos")
    return kept.withColumn("nth", F.row_number().over(w)).where(F.col("nth") <= max_links).drop("nth")


def next_tasks(links: DataFrame, seen: DataFrame, depth: int = 0) -> DataFrame:
    """(url, depth) of the linked URLs that are not in the only column of seen; each once. The exact form of a seen-set filter."""
    urls = links.select(F.col("link").alias("url")).distinct()
    return urls.join(seen.toDF("seen_url"), F.col("url") == F.col("seen_url"), "left_anti").withColumn("depth", F.lit(depth + 1).cast("smallint"))


def route_counts(links: DataFrame, shards: int, batch_size: int = 32) -> DataFrame:
    """(shard, local, remote, batches): links that stay with their page's owner, go elsewhere, and in how many batches."""
    owned = links.select(shard_owner(F.col("page_url"), shards).alias("shard"), shard_owner(F.col("link"), shards).alias("owner"))
    by_target = owned.groupBy("shard", "owner").agg(F.count("*").alias("n"))
    local = F.col("shard") == F.col("owner")
    return by_target.groupBy("shard").agg(
        F.coalesce(F.sum(F.when(local, F.col("n"))), F.lit(0)).alias("local"),
        F.coalesce(F.sum(F.when(~local, F.col("n"))), F.lit(0)).alias("remote"),
        F.coalesce(F.sum(F.when(~local, F.ceil(F.col("n") / batch_size))), F.lit(0)).alias("batches"),
    )


def crawl_metrics(pages: DataFrame, links: DataFrame, url_col: str = "url") -> DataFrame:
    """One row (fetched, discovered, enqueued, duplicates): discovered = enqueued + duplicates, pages themselves are seen."""
    counts = links.agg(F.count("*").alias("discovered"))
    fresh = next_tasks(links, pages.select(url_col).distinct()).agg(F.count("*").alias("enqueued"))
    both = pages.agg(F.count("*").alias("fetched")).crossJoin(counts).crossJoin(fresh)
    return both.withColumn("duplicates", F.col("discovered") - F.col("enqueued"))


def bfs(edges: DataFrame, seeds: DataFrame, max_depth: int = 4) -> DataFrame:
    """(node, depth) of what seeds reach over (src, dst) within max_depth steps, each node at its least depth.

    A level is one join, distinct and anti-join with what is seen; every level is written to the shared folder. Null ends lead
    nowhere, null seeds are left out, a seed that no edge knows is reached at 0.
    """
    links = edges.toDF("src", "dst").where("src is not null and dst is not null")
    level = materialize(seeds.toDF("node").where("node is not null").distinct().withColumn("depth", F.lit(0).cast("bigint")))
    seen = level
    for d in range(1, max_depth + 1):
        targets = level.join(links, F.col("node") == F.col("src")).select(F.col("dst").alias("node")).distinct()
        level = materialize(targets.join(seen.select(F.col("node").alias("had")), F.col("node") == F.col("had"), "left_anti").withColumn("depth", F.lit(d).cast("bigint")))
        if level.isEmpty():
            break
        seen = seen.unionByName(level)
    return seen


def dedupe_exact(rows: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The least id of each distinct text. Grouping goes by a 256-bit digest, so texts are not shuffled; null texts are one group."""
    return rows.groupBy(F.sha2(F.col(text_col).cast("binary"), 256).alias("digest")).agg(F.min(id_col).alias(id_col)).select(id_col)


class Crawl(NamedTuple):
    """tasks: (url, depth, politeness_delay_ms, fetched) of every URL that was taken up; links: (page_url, link, depth), those accepted."""

    tasks: DataFrame
    links: DataFrame


def fetch(tasks: DataFrame, pages: DataFrame) -> DataFrame:
    """tasks (url, ...) with the page (url, status, html) that stands under their URL; those without a page, or with a status beyond 2xx, go."""
    there = pages.where("status between 200 and 299").select(F.col("url").alias("f_url"), "html")
    return tasks.join(there, F.col("url") == F.col("f_url")).drop("f_url")


def crawl(
    seeds: DataFrame,
    pages: DataFrame,
    max_depth: int = 4,
    domains: Iterable[str] | None = None,
    url_filter: Callable[[Column], Column] | None = None,
    max_links: int | None = None,
    politeness_ms: int = 250,
) -> Crawl:
    """A breadth-first crawl of pages (url, status, html; one row a URL) from seeds (url), which pass no filter.

    A level fetches its tasks, takes the accepted links of pages above max_depth, and makes tasks of those not seen before, each
    once. Every level is written to the shared folder, so its lineage is short and a lost executor costs a level at most. Null
    seeds are left out; a URL without a page is a task that was not fetched.
    """
    links_of = lambda level: accept_links(extract_links(level.select(F.lit(0).alias("page_id"), "url", "html")), domains, url_filter, max_links)
    level = materialize(seeds.select("url").where("url is not null").distinct().withColumn("depth", F.lit(0).cast("smallint")))
    seen, links = level, []
    depth = 0
    while True:
        got = fetch(level, pages)
        if depth >= max_depth:
            break
        found = materialize(links_of(got).select("page_url", "link").withColumn("depth", F.lit(depth).cast("smallint")))
        links.append(found)
        level = materialize(next_tasks(found, seen.select("url"), depth))
        if level.isEmpty():
            break
        seen = seen.unionByName(level)
        depth += 1
    ok = pages.where("status between 200 and 299").select(F.col("url").alias("ok_url")).distinct()
    tasks = seen.join(ok, F.col("url") == F.col("ok_url"), "left").select("url", "depth", F.lit(politeness_ms).cast("bigint").alias("politeness_delay_ms"), F.col("ok_url").isNotNull().alias("fetched"))
    if not links:
        return Crawl(tasks, seen.limit(0).select(F.col("url").alias("page_url"), F.col("url").alias("link"), "depth"))
    every = links[0]
    for x in links[1:]:
        every = every.unionByName(x)
    return Crawl(tasks, every)


def crawl_report(done: Crawl, pages: DataFrame, shards: int = 1, batch_size: int = 32, window_s: float | None = None, wall_s: float | None = None) -> DataFrame:
    """One row of counters: fetched, discovered, enqueued, duplicates, rejects, http_errors, parse_errors, normalised, local, remote, batches.

    discovered = enqueued + duplicates, since seeds are not enqueued; rejects is 0, since no queue is bounded. A fetched page with an
    empty body is a parse error, any other is normalised. With the seconds of the crawl's window and of all, two rates are told too.
    """
    null = F.lit(None).cast("double")
    tasks = done.tasks.agg(F.count_if(F.col("fetched")).alias("fetched"), F.count_if(~F.col("fetched")).alias("http_errors"), F.count_if(F.col("depth") > 0).alias("enqueued"))
    empty = done.tasks.where("fetched").join(pages.where(F.coalesce(F.octet_length("html"), F.lit(0)) == 0).select("url"), "url", "left_semi").agg(F.count("*").alias("parse_errors"))
    routed = route_counts(done.links, shards, batch_size).agg(*(F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in ("local", "remote", "batches")))
    row = tasks.crossJoin(done.links.agg(F.count("*").alias("discovered"))).crossJoin(empty).crossJoin(routed)  # a row each
    rate = lambda s: F.round(F.col("fetched") / F.lit(s), 2) if s else null
    return row.select(
        "fetched", "discovered", "enqueued", (F.col("discovered") - F.col("enqueued")).alias("duplicates"), F.lit(0).cast("bigint").alias("rejects"), "http_errors", "parse_errors",
        (F.col("fetched") - F.col("parse_errors")).alias("normalised"), "local", "remote", "batches", rate(window_s).alias("rate_window"), rate(wall_s).alias("rate_wall"),
    )


def heartbeat(events: DataFrame, ts_ms: Column, every_ms: int = 10_000) -> DataFrame:
    """(tick, events, total): what came in each tick of every_ms, and up to its end; ticks without any have no row. Null times are left out."""
    per = events.select(F.floor(ts_ms / every_ms).cast("bigint").alias("tick")).where("tick is not null").groupBy("tick").agg(F.count("*").alias("events"))
    # Ticks are few: a day has 8640 of ten seconds.
    return per.withColumn("total", F.sum("events").over(Window.orderBy("tick")))
