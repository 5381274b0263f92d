"""JSON-lines and text sources with explicit schemas. Blank lines are skipped, a bad line raises."""

from __future__ import annotations

from collections.abc import Iterator
from fnmatch import fnmatchcase

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.batches import SLICE_BYTES
from ..storage import open_fs

PATH = "array<struct<level:smallint,title:string>>"
MANIFEST = "url string, checksum bigint, last_seen_epoch_ms bigint, changed boolean"
EMBEDDED = f"url string, chunk_id bigint, block_index bigint, text string, section_path {PATH}, token_estimate bigint, embedding array<float>, checksum bigint, last_seen_epoch_ms bigint"
METADATA = "struct<url:string,depth:smallint,shard:int,fetched_at_epoch_ms:bigint,status:int,content_type:string,content_language:string,content_length:bigint,checksum:bigint,lossy_decoding:boolean>"
PAGES = (
    f"metadata {METADATA}, body_text string, blocks array<struct<kind:string,text:string,block_index:bigint,char_start:bigint,char_end:bigint,token_estimate:bigint,section_path:{PATH}>>, "
    f"chunks array<struct<chunk_id:bigint,block_index:bigint,text:string,token_estimate:bigint,char_start:bigint,char_end:bigint,section_path:{PATH}>>"
)
CASES = "query string, relevant_urls array<string>, notes string"
QUERIES = "query string, top_k int, max_tokens bigint"
RECORDS = f"text string, url string, chunk_id bigint, section_path string, body_text string, metadata struct<url:string>, chunks array<struct<text:string,chunk_id:bigint,section_path:{PATH}>>"


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def read_jsonl(spark: SparkSession, path: str, schema: str, missing_ok: bool = False) -> DataFrame:
    """Rows of the schema; a missing path is an error, or an empty table if missing_ok."""
    if missing_ok and not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_numbered(spark: SparkSession, path: str, schema: str, missing_ok: bool = False) -> DataFrame:
    """Like read_jsonl(), with file and line_no: the row's place, by which last-wins rules go.

    line_no grows along a file but may leave numbers out: it is the block of the file that a task reads, and the line within it. So
    files of any size are split as ever, and no row is a whole file. Blank lines are skipped.
    """
    if missing_ok and not exists(spark, path):
        return spark.createDataFrame([], f"file string, line_no bigint, {schema}")
    place = F.col("_metadata.file_block_start") * (1 << 20) + F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), place.alias("line_no"), F.regexp_replace("value", r"\r$", "").alias("line"))
    parsed = lines.where(F.trim("line") != "").withColumn("r", F.from_json("line", schema, {"mode": "FAILFAST"}))
    return parsed.select("file", F.col("line_no").cast("bigint").alias("line_no"), "r.*")


def read_manifest(spark: SparkSession, path: str, missing_ok: bool = False) -> DataFrame:
    """The last record of each URL."""
    from ..operators.manifest import latest

    return latest(read_numbered(spark, path, MANIFEST, missing_ok), ["url"], ["file", "line_no"]).drop("file", "line_no")


def read_questions(spark: SparkSession, path: str) -> DataFrame:
    """(query): of JSON lines the question or prompt, of any other line the trimmed line itself."""
    line = F.trim("value")
    got = F.coalesce(F.get_json_object(line, "$.question"), F.get_json_object(line, "$.prompt"), line)
    return spark.read.text(path).where(line != "").select(got.alias("query"))


def read_texts(spark: SparkSession, *paths: str) -> DataFrame:
    """(text) of several JSON-lines (.jsonl: the field text) or text files; missing ones are skipped, blank texts dropped."""
    out = spark.createDataFrame([], "text string")
    for p in paths:
        if exists(spark, p):
            out = out.unionByName(read_jsonl(spark, p, "text string") if p.endswith(".jsonl") else spark.read.text(p).toDF("text"))
    return out.where(F.trim("text") != "")


def read_html(spark: SparkSession, path: str) -> DataFrame:
    """(url, html) of HTML files, the file's path as URL.

    Where the last part of path is a pattern (* and ?), tasks list the folders and read the files, so that neither the list of all
    files nor a task for every few of them is on the driver. Hidden files (. and _) are passed over, as Spark does; empty
    ones are rows here, while Spark's reader, which takes any other path, leaves them out.
    """
    folder, _, pattern = path.rpartition("/")
    if not folder or not set(pattern) & set("*?") or set(pattern) & set("[]{}\\"):
        return spark.read.format("binaryFile").load(path).select(F.col("path").alias("url"), F.col("content").alias("html"))
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found = at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(at)
    folders = [(s.getPath().toString(),) for s in found or [] if s.isDirectory()]

    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow.fs import FileSelector

        for b in batches:
            for uri in b.column(0).to_pylist():
                fs, base = open_fs(uri)
                own = [x.base_name for x in fs.get_file_info(FileSelector(base)) if x.is_file and x.base_name[0] not in "._" and fnmatchcase(x.base_name, pattern)]
                yield pa.RecordBatch.from_arrays([pa.array([f"{uri}/{n}" for n in own], pa.string())], ["url"])

    def contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            urls, bodies, size = [], [], 0
            for uri in b.column(0).to_pylist():
                fs, name = open_fs(uri)
                with fs.open_input_stream(name) as f:
                    bodies.append(f.read())
                urls.append(uri)
                size += len(bodies[-1])
                if size > SLICE_BYTES:
                    yield _files(urls, bodies)
                    urls, bodies, size = [], [], 0
            yield _files(urls, bodies)

    # Few bytes stand for many files: numbers of partitions that AQE leaves as they are.
    parts = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    listed = spark.createDataFrame(folders, "url string").repartition(min(max(1, len(folders)), parts)).mapInArrow(names, "url string")
    return listed.repartition(parts).mapInArrow(contents, "url string, html binary")


def _files(urls: list[str], bodies: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(urls, pa.string()), pa.array(bodies, pa.binary())], ["url", "html"])
