"""Streams: change marks kept by URL, URL dedupe, a token bucket, and bounded runs."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import BooleanType, StructField, StructType

from ..storage import new_path


def _mark(key: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    rows = pd.concat(list(pdfs)).sort_values(["url", "seq"], kind="stable")
    last = dict(zip(*state.get, strict=True)) if state.exists else {}
    first = rows["url"] != rows["url"].shift()
    before = rows["checksum"].shift().where(~first, rows["url"].map(last))
    rows["changed"] = before.isna() | (rows["checksum"] != before)
    end = rows["url"] != rows["url"].shift(-1)
    last |= {u: None if pd.isna(c) else c for u, c in zip(rows.loc[end, "url"], rows.loc[end, "checksum"], strict=True)}
    state.update((list(last), list(last.values())))
    yield rows[["url", "seq", "checksum", "changed"]]


def mark_changed_stream(fetches: DataFrame, buckets: int = 1024) -> DataFrame:
    """(url, seq, checksum, changed) of a stream with url, seq and checksum (a string): changed against the URL's last checksum.

    One checksum a URL is kept as state; rows of a micro-batch go by seq, and a row that comes in a later one is compared with the
    last that came before, whatever its seq. Null URLs are left out, since they have no key.

    URLs of a bucket are one group of the stream, since a call of Python for each URL takes longer than the marks. A task holds a
    bucket's rows of a micro-batch and its state, so buckets should grow with both; a checkpoint goes with its number of buckets.
    """
    bucket = F.pmod(F.xxhash64("url"), F.lit(buckets)).cast("int").alias("bucket")
    picked = fetches.where("url is not null").select("url", F.col("seq").cast("bigint"), F.col("checksum").cast("string"), bucket)
    out, kept = "url string, seq bigint, checksum string, changed boolean", "urls array<string>, checksums array<string>"
    return picked.groupBy("bucket").applyInPandasWithState(_mark, out, kept, "append", GroupStateTimeout.NoTimeout)


def dedupe_urls_stream(tasks: DataFrame, url_col: str = "url", ts_col: str | None = None, within: str = "7 days") -> DataFrame:
    """Each URL once, at its first arrival: the exact seen set as state.

    The set grows with the URLs. With an event time column a URL counts as seen for ``within`` after it came, and the state is bounded.
    """
    if ts_col is None:
        return tasks.dropDuplicates([url_col])
    return tasks.withWatermark(ts_col, within).dropDuplicatesWithinWatermark([url_col])


def run_available(stream: DataFrame, path: str | None = None) -> DataFrame:
    """Runs a stream over what there is, writes it to the shared folder, and reads the result as a table."""
    spark = stream.sparkSession
    path = path or new_path(spark, "stream")
    query = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", path + "-state").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def rate_limit(requests: DataFrame, per_minute: float, burst: float, key_col: str = "client", ts_col: str = "ts_ms") -> DataFrame:
    """requests (bigint ts_col, milliseconds) with allowed: a token bucket for each key, of burst tokens, refilled by per_minute / 60 a second, one a request.

    Requests of a key go in the order of their time. Rows of one time are alike.
    """
    schema = StructType([*requests.schema.fields, StructField("allowed", BooleanType())])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(ts_col, kind="stable")
        tokens, last = burst, None
        out: list[Any] = []
        for t in pdf[ts_col]:
            if last is not None:
                tokens = min(burst, tokens + (t - last) / 1000 * per_minute / 60)
            last = t
            out.append(tokens >= 1)
            tokens -= out[-1]
        pdf["allowed"] = out
        return pdf

    return requests.groupBy(key_col).applyInPandas(run, schema)


def rate_limit_stream(requests: DataFrame, per_minute: float, burst: float) -> DataFrame:
    """(client, ts_ms, request, allowed) of a stream with these columns: the bucket of rate_limit() kept as state over micro-batches.

    Rows of a micro-batch go by time, then by request. A row that comes in a later micro-batch than rows of later times finds the
    bucket as they left it, without a refill. Null clients and times are left out.
    """

    def run(key: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(pdfs)).sort_values(["ts_ms", "request"], kind="stable")
        tokens, last = state.get if state.exists else (float(burst), None)
        out: list[bool] = []
        for t in rows["ts_ms"]:
            if last is not None and t > last:
                tokens = min(float(burst), tokens + (t - last) / 1000 * per_minute / 60)
            last = t if last is None else max(last, t)
            out.append(bool(tokens >= 1))
            tokens -= out[-1]
        state.update((tokens, int(last)))
        rows["allowed"] = out
        yield rows[["client", "ts_ms", "request", "allowed"]]

    picked = requests.where("client is not null and ts_ms is not null").select("client", F.col("ts_ms").cast("bigint"), F.col("request").cast("bigint"))
    out = StructType([*picked.schema.fields, StructField("allowed", BooleanType())])
    return picked.groupBy("client").applyInPandasWithState(run, out, "tokens double, last bigint", "append", GroupStateTimeout.NoTimeout)


def progress(query: StreamingQuery) -> dict[str, Any]:
    """The heartbeat of a running stream: batch, rows in so far told by its last progress, rows a second, and whether it waits."""
    last = query.lastProgress or {}
    return {"batch": last.get("batchId", -1), "rows": last.get("numInputRows", 0), "rows_per_second": last.get("processedRowsPerSecond", 0.0), "waiting": not query.status["isDataAvailable"]}
