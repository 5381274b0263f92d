"""Session helpers."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parent.parent)
#: What Spark hands to Python at once, unless the session names it: by its own default a batch is 10,000 rows or 64 MB.
ARROW_BYTES, ARROW_KEY = 4 << 20, "spark.sql.execution.arrow.maxBytesPerBatch"


def ship(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver has it (a no-op where it is installed on PYTHONPATH).

    Arrow batches get ARROW_BYTES at most, or one row: an executor holds some for each worker, in the JVM and in Python.
    """
    if spark.conf.get(ARROW_KEY, None) is None:
        spark.conf.set(ARROW_KEY, str(ARROW_BYTES))
    env = spark.sparkContext.environment
    have = env.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in have:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, have)])
    return spark


def local_session(cpus: str | int = "*", **conf: str) -> SparkSession:
    """A local session for tests and the bench; on a cluster the session comes from outside."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("corpusloom")
    settings = {
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return ship(spark)
