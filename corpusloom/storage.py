"""The folder that all executors share, and tables written there."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` as the session names it; only a local session that names none gets a folder of its own."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    have = spark.sparkContext._jsc.sc().getCheckpointDir()
    if have.isDefined():
        return have.get()
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    made = tempfile.mkdtemp(prefix="corpusloom-")
    atexit.register(shutil.rmtree, made, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(made)
    return f"file://{made}"


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _session_dir(spark: SparkSession) -> str:
    """The session's own folder in the shared one; it goes when the driver's JVM ends, also after spark.stop()."""
    path = os.path.join(shared_dir(spark), f"corpusloom-{spark.sparkContext.applicationId}")
    if path not in _folders:
        fs, p = _fs(spark, path)
        fs.mkdirs(p)
        fs.deleteOnExit(p)
        _folders.add(path)
    return path


_folders: set[str] = set()
_written: list[tuple[SparkSession, str]] = []


def new_path(spark: SparkSession, kind: str = "table") -> str:
    return os.path.join(_session_dir(spark), f"{kind}-{uuid.uuid4().hex}")


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def qualified(spark: SparkSession, path: str) -> str:
    """path with its scheme, as the session's file systems have it."""
    fs, p = _fs(spark, path)
    return fs.makeQualified(p).toString()


def open_fs(uri: str):
    """(pyarrow file system, path in it) of a qualified path, on any worker."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri)


def materialize(df: DataFrame) -> DataFrame:
    """df as a table in the shared folder: lineage ends there and survives lost executors.

    The table goes with release(), or when the driver ends.
    """
    spark = df.sparkSession
    path = new_path(spark)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _written.append((spark, path))
    out.scratch_path = path
    return out


def release(*tables: DataFrame | None) -> None:
    """Deletes tables of materialize() that nothing reads any more; other DataFrames and None are passed over."""
    for t in tables:
        path = t.__dict__.get("scratch_path") if t is not None else None
        if path is not None:
            _delete(t.sparkSession, path)
            _written[:] = [(s, p) for s, p in _written if p != path]


def mark() -> int:
    """A point to go back to with release_since()."""
    return len(_written)


def release_since(point: int, *keep: DataFrame) -> None:
    """Deletes all tables written after a mark() but those in keep."""
    kept = {t.__dict__.get("scratch_path") for t in keep}
    for spark, path in _written[point:]:
        if path not in kept:
            _delete(spark, path)
    _written[point:] = [(s, p) for s, p in _written[point:] if p in kept]
