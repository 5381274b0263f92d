"""JSON-lines sinks, striped output, table helpers."""

from __future__ import annotations

import re
from collections.abc import Iterator
from uuid import uuid4
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from ..functions.batches import slices
from ..functions.urls import hash_shard
from ..storage import open_fs, qualified

WORD = re.compile(r"[^\W_]+")


def write_jsonl(df: DataFrame, path: str, append: bool = False, keep_nulls: bool = True) -> None:
    """A folder of JSON lines; overwritten unless append. keep_nulls writes null fields as nulls."""
    df.write.mode("append" if append else "overwrite").option("ignoreNullFields", not keep_nulls).json(path)


def write_plan(plan: DataFrame, path: str) -> None:
    write_jsonl(plan, path, keep_nulls=False)


def append_ledger(entries: DataFrame, path: str) -> None:
    """Appends entries; nothing is written where there are none."""
    if not entries.isEmpty():
        write_jsonl(entries, path, append=True, keep_nulls=False)


def write_striped(df: DataFrame, path: str, stripes: int, url_col: str = "url", shard_col: str | None = None) -> None:
    """One folder per stripe: by the shard where there is one, else by a hash of the URL."""
    n = max(1, stripes)
    stripe = hash_shard(F.col(url_col), n)
    if shard_col:
        stripe = F.coalesce(F.pmod(F.col(shard_col), F.lit(n)).cast("int"), stripe)
    df.withColumn("part", stripe).repartition(n, "part").write.mode("overwrite").partitionBy("part").json(path)


def write_html(pages: DataFrame, path: str, id_col: str, html_col: str = "html", folders: int = 256) -> None:
    """A file for each row, {path}/{folder}/{id_col}={id}.html; a null page is an empty file, rows of one id leave one file.

    Tasks write files where the rows are. Spark's partitioned writer would open a folder for each file and name them all to the
    driver. A file is there whole or not at all, also where a task is tried again.
    """
    uri = qualified(pages.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_fs(uri)
        made: set[int] = set()
        for b in slices(batches, 1):
            for i, h in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                folder = crc32(i.encode()) % max(1, folders)
                if folder not in made:
                    fs.create_dir(f"{base}/{folder}", recursive=True)
                    made.add(folder)
                part = f"{base}/{folder}/.{uuid4().hex}"
                with fs.open_output_stream(part) as f:
                    f.write(h or b"")
                fs.move(part, f"{base}/{folder}/{id_col}={i}.html")
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], ["n"])

    picked = pages.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("string"), F.col(html_col).cast("binary"))
    picked.mapInArrow(run, "n bigint").agg(F.sum("n")).collect()


def identifier(name: str) -> str:
    """A checked and quoted table name, with or without a database."""
    parts = name.split(".")
    if not 1 <= len(parts) <= 2 or any(not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", p) for p in parts):
        raise ValueError(f"not a table name: {name!r}")
    return ".".join(f"`{p}`" for p in parts)


def save_table(df: DataFrame, name: str, buckets: int = 0, keys: tuple[str, ...] = ("url",)) -> None:
    """df as a parquet table; with buckets, later joins and groupings by keys need no shuffle."""
    identifier(name)
    writer = df.write.mode("overwrite").format("parquet")
    if buckets:
        writer = writer.bucketBy(buckets, *keys).sortBy(*keys)
    writer.saveAsTable(name)


def index_table(df: DataFrame, name: str, text_table: str, analyze: bool = False) -> None:
    """Rebuilds the text index of a chunk table as a table of its own."""
    save_table(df, name)
    if analyze:
        df.sparkSession.sql(f"ANALYZE TABLE {identifier(text_table)} COMPUTE STATISTICS")


def write_ordered(df: DataFrame, path: str, *order: str) -> None:
    """df as JSON lines that read in order, file by file: ranges of order are sorted where they are, no task sorts everything."""
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def chunk_table(chunks: DataFrame, keys: tuple[str, ...] = ("url", "chunk_id"), text_col: str = "text") -> DataFrame:
    """chunks as the store's table: one row a key (a null or repeated key is an error), with lexemes, the text's own index.

    lexemes lists each distinct lower-case word with its positions, which count from 1. Texts are indexed in slices of about 1 MB.
    """
    bad = chunks.groupBy(*keys).count().where(" or ".join(f"`{k}` is null" for k in keys) + " or count > 1").first()
    if bad is not None:
        raise ValueError(f"not a key: {bad.asDict()}")
    at, names = chunks.columns.index(text_col), [*chunks.columns, "lexemes"]
    kind = pa.list_(pa.struct([("lexeme", pa.string()), ("positions", pa.list_(pa.int32()))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, at):
            rows = []
            for text in b.column(at).to_pylist():
                own: dict[str, list[int]] = {}
                for i, w in enumerate(WORD.findall((text or "").lower()), 1):
                    own.setdefault(w, []).append(i)
                rows.append([{"lexeme": w, "positions": own[w]} for w in sorted(own)])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(rows, kind)], names)

    lexemes = StructField("lexemes", ArrayType(StructType([StructField("lexeme", StringType()), StructField("positions", ArrayType(IntegerType()))])))
    return chunks.mapInArrow(run, StructType([*chunks.schema.fields, lexemes]))
