"""Embedding columns: a client protocol, batching with retries, and a deterministic offline client."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .batches import slices


class RetryableError(Exception):
    """A failure that may pass: too many requests, a server error, a lost connection."""


class EmbeddingClient(Protocol):
    """embed_batch gives a vector for each text in their order, or (index, vector) pairs in any order."""

    def embed_batch(self, texts: list[str]) -> list[list[float]] | list[tuple[int, list[float]]]: ...


class HashingClient:
    """Unit vectors of signed word hashes: offline and equal everywhere."""

    def __init__(self, dim: int = 64):
        self.dim = dim

    def embed_batch(self, texts: list[str]) -> list[list[float]]:
        from hashlib import md5

        out = np.zeros((len(texts), self.dim))
        for i, t in enumerate(texts):
            for w in t.lower().split():
                h = int.from_bytes(md5(w.encode()).digest()[:8], "big")
                out[i, (h >> 4) % self.dim] += 1 if h & 8 else -1
        norm = np.sqrt((out * out).sum(axis=1, keepdims=True))
        return (out / np.where(norm > 0, norm, 1)).astype(np.float32).tolist()


def call(client: EmbeddingClient, texts: list[str], max_retries: int = 5, first_delay: float = 0.5, sleep: Callable[[float], None] = time.sleep) -> list[list[float]]:
    """One batch; retries RetryableError with delays that double up to the sixth. The count of vectors must match."""
    for attempt in range(max(1, max_retries)):
        try:
            got = client.embed_batch(texts)
            break
        except RetryableError:
            if attempt + 1 >= max(1, max_retries):
                raise
            sleep(first_delay * 2 ** min(attempt, 5))
    if got and isinstance(got[0], tuple):
        got = sorted(got, key=lambda x: x[0])
        if [i for i, _ in got] != list(range(len(got))):
            raise ValueError("indices of vectors are not those of the texts")
        got = [v for _, v in got]
    if len(got) != len(texts):
        raise ValueError(f"{len(texts)} texts gave {len(got)} vectors")
    return got


def embed(chunks: DataFrame, make_client: Callable[[], EmbeddingClient] = HashingClient, text_col: str = "text", out_col: str = "embedding", batch_size: int = 32, max_retries: int = 5) -> DataFrame:
    """chunks with out_col array<float>; a null text has a null vector. Each task makes one client and sends batch_size texts at a time."""
    from pyspark.sql import types as T

    at = chunks.columns.index(text_col)
    names = [*chunks.columns, out_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        client = make_client()
        for b in slices(batches, at):
            texts = b.column(at).to_pylist()
            there = [i for i, t in enumerate(texts) if t is not None]
            vectors: list[list[float] | None] = [None] * len(texts)
            for lo in range(0, len(there), batch_size):
                some = there[lo : lo + batch_size]
                for i, v in zip(some, call(client, [texts[i] for i in some], max_retries), strict=True):
                    vectors[i] = v
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(vectors, pa.list_(pa.float32()))], names)

    return chunks.mapInArrow(run, T.StructType([*chunks.schema.fields, T.StructField(out_col, T.ArrayType(T.FloatType()))]))


def embed_totals(pages: DataFrame, kept: DataFrame, chunks: DataFrame) -> DataFrame:
    """One row (pages, skipped, chunks) of a run that embedded the chunks of the pages in kept."""
    from pyspark.sql import functions as F

    row = pages.agg(F.count("*").alias("pages")).crossJoin(kept.agg(F.count("*").alias("k"))).crossJoin(chunks.agg(F.count("*").alias("chunks")))  # a row each
    return row.select("pages", (F.col("pages") - F.col("k")).alias("skipped"), "chunks")
