"""Canonical reversed-host URL keys, as Spark columns and as DuckDB SQL, and range splits over them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)"
REST = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^#]*)"


def url_key(url: Column) -> Column:
    """``com,example,sub)/path?query``: scheme, user, port, fragment and a leading www. go, the host is lower-cased and reversed.

    Null for a null URL and for one without scheme and host.
    """
    host = F.regexp_replace(F.lower(F.regexp_extract(url, HOST, 1)), r"^www\.", "")
    rest = F.regexp_extract(url, REST, 1)
    path = F.when(rest.startswith("/"), rest).otherwise(F.concat(F.lit("/"), rest))
    return F.when(host != "", F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), path))


def url_key_sql(url: str) -> str:
    host = f"regexp_replace(lower(regexp_extract({url}, '{HOST}', 1)), '^www\\.', '')"
    rest = f"regexp_extract({url}, '{REST}', 1)"
    path = f"CASE WHEN starts_with({rest}, '/') THEN {rest} ELSE '/' || {rest} END"
    return f"CASE WHEN {host} <> '' THEN array_to_string(list_reverse(string_split({host}, '.')), ',') || ')' || ({path}) END"


def range_splits(rows: DataFrame, columns: list[str], parts: int, n: int, per_part: int = 64) -> list[tuple]:
    """At most parts - 1 tuples of the columns that cut rows (n of them) into ranges of about equal size.

    They come from a sample of about parts * per_part rows picked by a hash of the columns, which is sorted on the cluster; the
    driver gets every per_part-th of it. Like the splits of any range partitioning they decide where rows go, never what the
    result is.
    """
    share = min(1.0, parts * per_part / max(1, n))
    sample = rows.select(*columns)
    if share < 1:
        sample = sample.where(F.pmod(F.xxhash64(*columns), F.lit(1 << 30)) < int(share * (1 << 30)))
    step = max(1, min(n, parts * per_part) // parts)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = step // 2
        for b in batches:
            at = np.arange(-seen % step, b.num_rows, step)
            seen += b.num_rows
            if len(at):
                yield b.take(pa.array(at))

    ranged = sample.repartitionByRange(min(parts, max(1, parts * per_part // 8192)), *columns).sortWithinPartitions(*columns)
    return sorted({tuple(r) for r in ranged.mapInArrow(pick, sample.schema).collect()})[: parts - 1]
