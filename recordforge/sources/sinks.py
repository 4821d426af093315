"""Sinks: table writes (S5, S6, S9, S10, S11) and the optional stage audit.

* ``write_table``          create if needed and overwrite, with an explicit schema (S5)
* ``overwrite_existing``   the target must exist; overwrite it in place (S6)
* ``replace_table``        catalog table from a query, built aside and swapped in when complete (S9)
* ``write_partitioned``    partitioned parquet table, clustered across files (S10)
* ``insert_partitions``    insert that replaces only the partitions it has rows for (S11)
* ``audit_stage``          JSON dump of a stage under ``<dir>/<run_id>/<stage>`` (S7/S8)

Writes are plain DataFrame writes: each task writes its own files and the job commits them
at the end, so a lost executor only re-runs its tasks.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from recordforge.schemas import conform


def write_table(df: DataFrame, path: str, schema: StructType | None = None, mode: str = "overwrite") -> None:
    """Cast to ``schema`` (by name) and write parquet, replacing what is there."""
    out = conform(df, schema) if schema is not None else df
    out.write.mode(mode).parquet(path)


def overwrite_existing(spark: SparkSession, df: DataFrame, table: str, schema: StructType | None = None) -> None:
    """Overwrite a catalog table that must already exist (never creates it)."""
    if not spark.catalog.tableExists(table):
        raise ValueError(f"target table {table!r} does not exist; create it first")
    out = conform(df, schema) if schema is not None else df
    out.select(*spark.table(table).columns).write.insertInto(table, overwrite=True)


def clustered(df: DataFrame, partition_by: list[str], sort_by: list[str], files: int | None = None) -> DataFrame:
    """Rows dealt to ``files`` tasks (the session's shuffle partitions by default) by ranges of (partitions, sort columns).

    Every file then holds one range of the sort columns, so the minimum and maximum in the files' footers let a
    reader skip all but a few for a filter on them.  The row's hash comes last, so that a value that makes up much of the
    table is a range that can be cut, too.  Dealing by range samples the rows first, which computes them twice.
    """
    spark = df.sparkSession
    tasks = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [*partition_by, *sort_by]
    hashed = F.xxhash64(*[F.col(c) for c in df.columns])
    return df.repartitionByRange(tasks, *keys, hashed).sortWithinPartitions(*keys)


def write_partitioned(df: DataFrame, path: str, partition_by: list[str], sort_by: list[str] | None = None,
                      mode: str = "overwrite", files: int | None = None) -> None:
    """One folder per partition value (pruned at read), files clustered by ``sort_by``.

    Without ``sort_by`` rows are rebalanced by the partition columns: each task writes few files, and adaptive
    execution splits a large partition value and merges small ones to its advisory size.
    """
    out = clustered(df, partition_by, sort_by, files) if sort_by else df.hint("rebalance", *partition_by)
    out.write.mode(mode).partitionBy(*partition_by).parquet(path)


def insert_partitions(df: DataFrame, path: str, partition_by: list[str], sort_by: list[str] | None = None,
                      schema: StructType | None = None, files: int | None = None) -> None:
    """Insert into a partitioned table, replacing only the partition values ``df`` has rows for.

    Other partitions' files are not touched, and running the same insert again gives the same table.
    The table is created if need be.
    """
    out = conform(df, schema) if schema is not None else df
    dealt = clustered(out, partition_by, sort_by, files) if sort_by else out.hint("rebalance", *partition_by)
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def _folder_of(spark: SparkSession, table: str) -> str | None:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'").collect()
    return rows[0]["data_type"] if rows else None


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def replace_table(spark: SparkSession, df: DataFrame, table: str, path: str, schema: StructType | None = None,
                  partition_by: list[str] | None = None, sort_by: list[str] | None = None) -> DataFrame:
    """CREATE OR REPLACE TABLE ... AS for a catalog table; returns it read back.

    The rows are written to a new folder under ``path`` (shared storage), as a table of another name first, which
    takes over the name only when complete: a failed run leaves the old table as it was, and ``df`` may
    read the table it replaces.  The old table's folder goes last, if it is one of those under ``path``.  A run that stopped
    between the two renames is put right by the next one.
    """
    building, last = f"{table}__building", f"{table}__last"
    root = path.rstrip("/")

    def drop(name: str) -> None:
        if spark.catalog.tableExists(name):
            folder = _folder_of(spark, name)
            spark.sql(f"DROP TABLE {name}")
            if folder and f"{root}/" in folder:
                _delete(spark, folder)

    if spark.catalog.tableExists(last) and not spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {last} RENAME TO {table}")
    drop(last)
    drop(building)
    out = conform(df, schema) if schema is not None else df
    if sort_by:
        out = clustered(out, partition_by or [], sort_by)
    folder = f"{root}/{uuid.uuid4().hex}"
    writer = out.write.format("parquet").option("path", folder)
    try:
        (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(building)
    except Exception:
        drop(building)
        _delete(spark, folder)
        raise
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} RENAME TO {last}")
    spark.sql(f"ALTER TABLE {building} RENAME TO {table}")
    drop(last)
    return spark.table(table)


def write_bucketed_table(spark: SparkSession, df: DataFrame, table: str, path: str, keys: list[str], buckets: int,
                         schema: StructType | None = None) -> DataFrame:
    """A catalog table bucketed and sorted by ``keys`` (files at ``path``); returns it read back.

    Joins on ``keys`` against this table need no shuffle of its side: its scan already
    reports hash partitioning into ``buckets`` partitions, so only the other side is shuffled
    (into the same number of partitions).  Useful for a table joined more than once and too
    large to broadcast.
    """
    out = conform(df, schema) if schema is not None else df
    (out.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys)
     .option("path", path).saveAsTable(table))
    return spark.table(table)


def run_id(now: dt.datetime | None = None) -> str:
    """Run stamp ``%Y_%m_%d_%H_%M_%S``."""
    return (now or dt.datetime.now()).strftime("%Y_%m_%d_%H_%M_%S")


def audit_stage(df: DataFrame, audit_dir: str | None, run: str, stage: str) -> None:
    """Write a stage as JSON lines for inspection; does nothing when ``audit_dir`` is None."""
    if audit_dir:
        df.write.mode("overwrite").json(f"{audit_dir.rstrip('/')}/{run}/{stage}")
