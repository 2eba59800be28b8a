"""Partitioned Parquet tables: one run date in, one run date out."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanloom.operators.keys import latest_per_key
from loanloom.schemas import PARTITION_COLUMNS, conform, schema_of
from loanloom.sources.runs import RunTable


def table_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table.replace('.', '/')}"


def has_table(spark: SparkSession, root: str, table: str) -> bool:
    """Whether the table has been written yet."""
    path = spark._jvm.org.apache.hadoop.fs.Path(table_path(root, table))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A whole table under its declared schema (empty if not written yet)."""
    if not has_table(spark, root, table):
        return spark.createDataFrame([], schema_of(table))
    return spark.read.schema(schema_of(table)).parquet(table_path(root, table))


def on_day(df: DataFrame, as_of: str, column: str = "batch_date") -> DataFrame:
    """One run date; with a literal the filter prunes partitions."""
    return df.filter(F.col(column) == F.lit(as_of).cast("date"))


def read_layer(spark: SparkSession, root: str, table: str, as_of: str, column: str = "batch_date") -> DataFrame:
    """The partition of one run date of a table."""
    return on_day(read_table(spark, root, table), as_of, column)


def incremental_slice(bronze: DataFrame, as_of: str, done: DataFrame | None = None) -> DataFrame:
    """Bronze rows that landed on ``as_of`` or the day before and are not conformed yet.

    What landed later belongs to later runs, so a rerun takes the same rows. The
    day-before overlap re-reads yesterday, so rows found in ``done`` go. A
    row of the slice can only have been conformed in a run of the same two days:
    only those partitions of ``done`` are read.
    """
    day = F.lit(as_of).cast("date")
    since = F.date_sub(day, 1)
    landed = bronze.filter(F.col("ingest_date").between(since, day))
    if done is None:
        return landed
    recent = done.filter(F.col("batch_date") >= since).select("bronze_id")
    return landed.join(recent, "bronze_id", "left_anti")


def write_partitioned(
    df: DataFrame,
    root: str,
    table: str,
    partition_by: Sequence[str] | None = None,
    mode: str = "append",
    as_of: str | None = None,
) -> None:
    """Write under the table's partition columns.

    ``mode="replay"`` replaces exactly the partitions that ``df`` touches, so a
    rerun of a day is safe; with ``as_of`` the day's partition is replaced even by
    an empty result. AQE rebalances the rows by partition first: few files per
    day, and a day that holds most rows is still split over tasks.
    """
    columns = list(partition_by or PARTITION_COLUMNS[table])
    day = f"{table_path(root, table)}/{columns[0]}={as_of}" if mode == "replay" and as_of is not None else None
    before = _files(df.sparkSession, day) if day else set()
    writer = conform(df, table).hint("rebalance", *columns).write.partitionBy(*columns)
    if mode == "replay":
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.mode(mode)
    writer.parquet(table_path(root, table))
    if day and before & _files(df.sparkSession, day):
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(day)  # no row replaced it
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def _files(spark: SparkSession, folder: str) -> set[str]:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return {f.getPath().getName() for f in system.listStatus(path)} if system.exists(path) else set()


def merge_partitioned(df: DataFrame, root: str, table: str, keys: Sequence[str]) -> None:
    """Put rows over those of the same key, wherever those lie, keeping all others.

    For tables that are not partitioned by run date. An index beside the table says in
    which partition each key's row lies, so that a row that moved leaves its old
    partition, and only the partitions of old and new rows are read and written.
    """
    spark, columns = df.sparkSession, list(PARTITION_COLUMNS[table])
    rows = conform(df, table).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        index = RunTable(spark, f"{table_path(root, table)}_places")
        place = [*dict.fromkeys([*keys, *columns])]
        if index.manifest() is None:
            held = read_table(spark, root, table).select(*place).distinct().withColumn("version", F.lit(0).cast("long"))
            index.create(held.schema, keys, ["version"])
            index.append(held)
        wanted = rows.select(*keys).distinct()
        same = [wanted[k].eqNullSafe(F.col(f"__{k}")) for k in keys]
        known = index.read(wanted).select(*[F.col(k).alias(f"__{k}") for k in keys], *[F.col(c).alias(f"__at_{c}") for c in columns])
        old = wanted.join(known, same).select(*[F.col(f"__at_{c}").alias(c) for c in columns])
        touched = old.union(rows.select(*columns)).distinct().collect()  # partitions, at most as many as the table has
        if not touched:
            return
        there = reduce(or_, (reduce(and_, (F.col(c).eqNullSafe(F.lit(r[c])) for c in columns)) for r in touched))
        others = read_table(spark, root, table).filter(there)
        kept = others.join(wanted, [others[k].eqNullSafe(wanted[k]) for k in keys], "left_anti").select(*rows.columns)
        left = {tuple(r) for r in rows.select(*columns).union(kept.select(*columns)).distinct().collect()}
        version = F.lit(index.manifest().version).cast("long")
        write_partitioned(rows.unionByName(kept), root, table, mode="replay")
        index.append(rows.select(*place).withColumn("version", version))
        for row in touched:
            if tuple(row) not in left:  # every row moved away
                escaped = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
                folder = "/".join(f"{c}={'__HIVE_DEFAULT_PARTITION__' if row[c] is None else escaped(str(row[c]))}" for c in columns)
                path = spark._jvm.org.apache.hadoop.fs.Path(f"{table_path(root, table)}/{folder}")
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    finally:
        rows.unpersist()


def export_feature_snapshot(assembled: DataFrame, keys: Sequence[str] = ("application_id",)) -> DataFrame:
    """The latest assembled row of each application, as the serving copy wants it."""
    return latest_per_key(assembled, list(keys), ["batch_date", "assembled_at"])
