"""Helpers shared by the operators of this subpackage.

Words are maximal runs of characters other than ``[\\x20\\x09-\\x0D]`` and lower-casing touches
A-Z only, unless an operator says otherwise.  Operators pick the columns they use and give them names
of their own (starting with ``__``), so that extra columns of the input cannot clash with them.
"""

from __future__ import annotations

import string
import uuid
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recordforge.session import ensure_checkpoint_dir

BLANKS = " \t\n\x0b\x0c\r"
WORD_BREAK = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(col: Column) -> Column:
    """A-Z lower-cased, all else unchanged.  ``lower`` is the fast path where the text is pure ASCII."""
    return F.when(F.octet_length(col) == F.char_length(col), F.lower(col)).otherwise(
        F.translate(col, string.ascii_uppercase, string.ascii_lowercase))


def line_key(line: Column) -> Column:
    """The comparison form of a line: blanks stripped at both ends, A-Z lower-cased."""
    return F.btrim(ascii_lower(line), F.lit(BLANKS))


def hash128(col: Column) -> tuple[Column, Column]:
    """Two independent 64-bit hashes: at 1e12 distinct values a clash has a chance of about 1e-15."""
    return F.xxhash64(col), F.xxhash64(F.lit("second"), col)


#: tables written by ``cut`` -> (file system, folder)
_FOLDERS: WeakKeyDictionary[DataFrame, tuple] = WeakKeyDictionary()


def cut(df: DataFrame, name: str, replaces: tuple[DataFrame, ...] = ()) -> DataFrame:
    """Cut the lineage: write ``df`` under ``spark.checkpoint.dir`` and read it back.

    A table in the shared folder survives lost executors, is computed once, and is column-pruned
    when read.  It is removed when the session's JVM ends.  ``replaces`` names tables of earlier calls that nothing but ``df``
    reads any more (the last round of an iteration): they are removed once the new table is complete, so
    that the disk an iteration takes does not grow with its rounds.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.deleteOnExit(hadoop_path)
    for old in replaces:
        old_files, old_path = _FOLDERS.pop(old)
        old_files.delete(old_path, True)
    written = spark.read.schema(df.schema).parquet(path)
    _FOLDERS[written] = (files, hadoop_path)
    return written


def fresh(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def with_rank(df: DataFrame, group: list[str], order: list[str], size: Column | None = None,
              name: str = "ranked") -> DataFrame:
    """Add ``__rank`` (from 0, gapless) and ``__before`` (sum of ``size`` of earlier rows) per group.

    The rows are dealt by range of (group, order) and written once; totals per partition give
    each partition its starting point, so that no group, however large, meets in one task.  Rows
    equal in all of ``order`` are told apart by their place in the input.
    """
    size = F.lit(1).cast("long") if size is None else size
    tagged = df.withColumns({"__size": size, "__tie": F.monotonically_increasing_id()})
    keys = [*group, *order, "__tie"]
    dealt = cut(tagged.repartitionByRange(partitions(df.sparkSession), *keys)
                .withColumn("__part", F.spark_partition_id()), name)
    totals = dealt.groupBy("__part", *group).agg(F.count(F.lit(1)).alias("__n"), F.sum("__size").alias("__s"))
    earlier = Window.partitionBy(*group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        F.col("__part").alias("__p"), *[F.col(g).alias(f"__g_{g}") for g in group],
        F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__n0"),
        F.coalesce(F.sum("__s").over(earlier), F.lit(0)).alias("__s0"))
    on = F.col("__part") == F.col("__p")
    for g in group:
        on = on & F.col(g).eqNullSafe(F.col(f"__g_{g}"))
    inside = Window.partitionBy("__part", *group).orderBy(*order, "__tie")
    return (dealt
            .withColumn("__i", F.row_number().over(inside) - 1)
            .withColumn("__run", F.sum("__size").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
            .join(starts, on)
            .withColumn("__rank", F.col("__n0") + F.col("__i"))
            .withColumn("__before", F.col("__s0") + F.col("__run") - F.col("__size"))
            .drop("__p", "__n0", "__s0", "__i", "__run", "__tie", "__part", *[f"__g_{g}" for g in group]))
