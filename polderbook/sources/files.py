"""Path questions answered by the Hadoop file system, so any cluster storage works."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _path(spark: SparkSession, location: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, location: str) -> bool:
    system, path = _path(spark, location)
    return system.exists(path)


def names(spark: SparkSession, folder: str, suffix: str) -> list[str]:
    """Sorted names directly under ``folder`` that end in ``suffix``."""
    system, path = _path(spark, folder)
    if not system.exists(path):
        return []
    listed = [status.getPath().getName() for status in system.listStatus(path)]
    return sorted(name for name in listed if name.endswith(suffix))


def delete(spark: SparkSession, location: str) -> None:
    system, path = _path(spark, location)
    if system.exists(path):
        system.delete(path, True)


def create_if_absent(spark: SparkSession, location: str, text: str) -> bool:
    """Publish a small file under a name nobody else has; False if the name is taken.

    The content is complete before the name appears: a rename that must not overwrite is
    atomic on cluster file systems.
    """
    jvm = spark._jvm
    system, path = _path(spark, location)
    draft = path.suffix(f".{uuid.uuid4().hex}.draft")
    out = system.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    qualified = system.makeQualified(path)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(qualified.toUri(), spark._jsc.hadoopConfiguration())
    no_options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(system.makeQualified(draft), qualified, no_options)
        return True
    except Py4JJavaError as error:
        system.delete(draft, False)
        if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
            return False
        raise
