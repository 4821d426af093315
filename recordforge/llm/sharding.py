"""Sharding by global byte-size prefix sums: contiguous shards of nearly equal bytes.

Rows are put in id order by range; totals per partition give each partition its starting byte,
a running sum inside the partition gives each row's, and the row's middle byte against equal
targets of the grand total gives its shard.  Cuts are at rows, so a shard misses its target by
at most one row at either end.  DataFrame functions only; text is never shuffled for the cut.

Defined cases: a null text has no bytes (size 1, crc of ''); rows without an id come first; equal ids
are ordered by crc and size, equal rows arbitrarily (they are interchangeable); an empty table
gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordforge.llm.common import with_rank


def shard_by_bytes(docs: DataFrame, n_shards: int = 8, id_col: str = "doc_id", text_col: str = "text",
                   carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: id, size, text_crc32, shard, slot, and the ``carry`` columns asked for."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("__id"), (F.octet_length(text) + 1).cast("long").alias("__bytes"),
                       F.crc32(text.cast("binary")).alias("__crc"), *[F.col(c).alias(f"__c_{c}") for c in carry])
    placed = with_rank(rows, [], ["__id", "__crc", "__bytes"], F.col("__bytes"), "shard")
    total = rows.agg(F.sum("__bytes").alias("__total"))
    middle = 2 * F.col("__before") + F.col("__bytes")
    # integer arithmetic: 2 * n_shards * bytes stays inside 64 bits up to 1e17 bytes for 8 shards
    sharded = (placed.join(F.broadcast(total))  # one row
               .withColumn("__shard", F.least(F.lit(n_shards - 1).cast("long"),
                                              F.floor(middle * n_shards / (2 * F.col("__total")))).cast("int")))
    first = sharded.groupBy("__shard").agg(F.min("__rank").alias("__first")).withColumnRenamed("__shard", "__s")
    return (sharded.join(F.broadcast(first), F.col("__shard") == F.col("__s"))  # n_shards rows
            .select(F.col("__id").alias(id_col), F.col("__bytes").alias("size"), F.col("__crc").alias("text_crc32"),
                    F.col("__shard").alias("shard"), (F.col("__rank") - F.col("__first")).alias("slot"),
                    *[F.col(f"__c_{c}").alias(c) for c in carry]))


def write_shards(docs: DataFrame, path: str, n_shards: int = 8, text_col: str = "text") -> None:
    """Write whole documents as ``path/shard=k/`` files, rows inside each file in slot order."""
    placed = shard_by_bytes(docs, n_shards, text_col=text_col, carry=(text_col,))
    (placed.hint("rebalance", "shard").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").mode("overwrite").parquet(path))
