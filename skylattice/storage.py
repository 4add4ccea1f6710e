"""Shared scratch folder, staging of results, and deletion of folders through Hadoop."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it then gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _own_folder()


@cache
def _own_folder() -> str:
    """One temporary folder for a local session's process."""
    return tempfile.mkdtemp(prefix="skylattice-")


def new_dir(spark: SparkSession, label: str) -> str:
    """A folder name of its own under :func:`shared_dir`; deleted when the program ends."""
    path = f"{shared_dir(spark)}/skylattice-{label}-{uuid.uuid4().hex}"
    atexit.register(_forget, spark, path)
    return path


def _forget(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder if its session can still be reached; a lost one keeps its files."""
    with suppress(Exception):  # the program is ending and its JVM may be gone
        delete(spark, path)


@contextmanager
def staged(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` written once to the shared folder and read back.

    Whatever follows (checks, then the real write) reads the stored rows: the lineage is
    evaluated once and a lost executor does not bring it back.
    """
    spark = df.sparkSession
    path = new_dir(spark, "stage")
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        delete(spark, path)


def _located(spark: SparkSession, path: str):
    """The Hadoop file system that holds ``path``, and the path on it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), target


def exists(spark: SparkSession, path: str) -> bool:
    files, target = _located(spark, path)
    return files.exists(target)


def mark(spark: SparkSession, path: str) -> None:
    """Leave an empty file that says that something is done."""
    files, target = _located(spark, path)
    files.mkdirs(target.getParent())
    files.createNewFile(target)


def delete(spark: SparkSession, path: str) -> None:
    """Delete one folder on whatever file system holds it."""
    files, target = _located(spark, path)
    files.delete(target, True)
