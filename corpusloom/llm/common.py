"""What the operators share: tables, shared storage, names, and grouping of Arrow streams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship
from ..storage import mark, materialize, release, release_since

__all__ = ["anti", "fresh", "mark", "materialize", "partitions", "release", "release_since", "table", "whole_groups"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def anti(docs: DataFrame, gone: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """docs without the ids in the only column of gone; rows of a null id stay."""
    key = fresh(docs, "gone_id")
    gone = gone.toDF(key)
    return docs.join(gone, docs[id_col] == gone[key], "left_anti")


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Regroup a stream sorted by key so that no key's rows are split between two tables."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        k = b.column(key).to_numpy(zero_copy_only=False)
        last = int(np.flatnonzero(k != k[-1])[-1]) + 1 if k[0] != k[-1] else 0
        if held and held[-1].column(key)[-1].as_py() != k[0].item() or last:
            yield pa.Table.from_batches([*held, b.slice(0, last)])
            held = [b.slice(last)]
        else:
            held.append(b)
    if held:
        yield pa.Table.from_batches(held)
