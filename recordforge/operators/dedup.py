"""Deduplication (A2) and surrogate keys (F1).

The reference keeps "the first record" of each key group, an order it leaves undefined.  Here
the record with the smallest ``order_by`` value wins, which is deterministic because the
surrogate key is a content hash.  ``min_by`` is an ordinary aggregate: Spark combines it
map-side before the shuffle, so a key holding a third of all rows sends one row per map
task across the network, never the whole group to one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordforge.functions.text import text_key


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: str) -> DataFrame:
    """One row per ``keys``: the row with the smallest ``order_by`` (ties broken by content)."""
    others = [c for c in df.columns if c not in keys]
    packed = F.struct(*[F.col(c) for c in others]).alias("_row")
    picked = df.groupBy(*keys).agg(F.min_by(packed, F.col(order_by)).alias("_row"))
    return picked.select(*[F.col(f"_row.{c}").alias(c) if c not in keys else F.col(c) for c in df.columns])


def with_surrogate_key(df: DataFrame, name: str, columns: Sequence[str] | None = None,
                       types: dict[str, str] | None = None) -> DataFrame:
    """Prepend a content-hash key column (stable across recomputation, unlike a random UUID)."""
    cols = list(columns or df.columns)
    return df.select(text_key(cols, types).alias(name), *df.columns)


def random_surrogate_key(df: DataFrame, name: str) -> DataFrame:
    """``generate_uuid()`` semantics.  Random: persist or write the result before reusing it."""
    return df.select(F.expr("uuid()").alias(name), *df.columns)
