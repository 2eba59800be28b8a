"""Tables and files in the folder that driver and executors share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanloom.session import scratch_path


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends there."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_row_key(docs: DataFrame, label: str = "rows") -> DataFrame:
    """``docs`` with ``__file`` and ``__row``, which name each row of a table for good.

    Ids may repeat or be null; a row's place in its file does not. Files are told
    apart by their whole paths: folders of one table may hold files of equal names. What
    is not read from files is written to the shared folder first.
    """
    keys = {"__file": F.col("_metadata.file_path"), "__row": F.col("_metadata.row_index")}
    try:
        return docs.withColumns(keys)
    except AnalysisException:
        return stored(docs, label).withColumns(keys)


@contextmanager
def small_batches(spark: SparkSession, size: str = "4m") -> Iterator[None]:
    """Jobs run within send whole texts to Python in batches of about ``size`` bytes."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, size)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def folder(spark: SparkSession, label: str) -> str:
    """A new folder below the shared one, as a URI that tasks can open files in."""
    path = scratch_path(spark, label)
    uri = path if "://" in path or path.startswith("file:") else f"file://{path}"
    system, where = fs.FileSystem.from_uri(uri)
    system.create_dir(where, recursive=True)
    return uri


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI and the path in it (any that Arrow knows)."""
    return fs.FileSystem.from_uri(uri)


def attempt_name(prefix: str, suffix: str) -> str:
    """A file name of this attempt alone.

    A retried or speculative task writes another file; only the files named in
    the rows of the attempt that committed are ever read.
    """
    return f"{prefix}-{uuid.uuid4().hex}{suffix}"
