"""Read tab-separated extract files as text lines, dropping the header line.

``spark.read.text`` splits large files across tasks, so "the first line of the file" is not
visible to the task reading a later split.  The header is therefore dropped by content: a
line whose first field is the header's first column name.  This is safe across splits and
across many files, each with its own header.

With ``origin`` every line carries the file it stands in and its line number there (headers count).  A task sees
only its own split, so the number is put together from the line's place in its split and the lines of the
splits before it, which are counted once (one small row per split).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

HEADER_FIRST_FIELD = "CASE_NUMBER"


ORIGIN = ("source_file", "source_split", "source_row")


def read_extract_lines(spark: SparkSession, paths: str | list[str], header_first_field: str = HEADER_FIRST_FIELD,
                       origin: bool = False) -> DataFrame:
    """Lines of one or more extract files (one ``value`` column), header lines removed.

    With ``origin`` the ``ORIGIN`` columns come along; ``with_line_numbers`` makes the line number of them.
    """
    df = spark.read.text(paths)
    if origin:
        # numbered before any line goes, in the order of the split
        df = df.select("value", F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("source_split"),
                       F.monotonically_increasing_id().alias("source_row"))
    first = F.upper(F.btrim(F.substring_index(F.col("value"), "\t", 1)))
    return df.filter(first != header_first_field.upper())


def with_line_numbers(rows: DataFrame, spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Replace the split and row of ``rows`` (some lines read with ``origin``) by ``source_line``, from 1, in their file."""
    every = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("source_split"),
        F.monotonically_increasing_id().alias("_id"))
    splits = every.groupBy("source_file", "source_split").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_lines"))
    before = Window.partitionBy("source_file").orderBy("source_split").rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.withColumn("_before", F.coalesce(F.sum("_lines").over(before), F.lit(0))).drop("_lines")
    line = (F.col("_before") + F.col("source_row") - F.col("_first") + 1).alias("source_line")
    kept = [c for c in rows.columns if c not in ORIGIN]
    return rows.join(starts, ["source_file", "source_split"]).select(*kept, "source_file", line)
