"""The shared working folder of a session."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def working_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder name that every executor can reach.

    The cluster names the shared folder in ``spark.checkpoint.dir``. Only a local
    session, where driver and executors share one disk, may fall back to a
    temporary folder.
    """
    base = spark.conf.get(SETTING, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {SETTING} to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="polderbook-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def with_known_size(frame: DataFrame) -> DataFrame:
    """Run ``frame`` once and read it back as a table in the shared folder.

    For small lookups behind an aggregate: Spark can only guess their size, so it
    would shuffle the large side of a join against them. Once written, their true
    size decides between broadcast and shuffle, and they are not computed twice.
    """
    path = working_folder(frame.sparkSession, "lookup")
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
