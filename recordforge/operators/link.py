"""Joins that attach ids from one table to another.

* ``link_to_first``         J4: co-group link = inner join against one row per key of the
                             right side (the reference takes the first right record of a key)
* ``spread_join``            equi-join whose hot keys can be split, also where one side was aggregated by the key
* ``join_hot_keys_apart``    the same for a side that is not shuffled (bucketed by the key)
* ``left_join_spread_nulls`` J3: left outer equi-join whose null-key rows are spread over
                             the shuffle instead of landing in a single partition

Physical strategy is left to Spark: AQE turns a sort-merge join into a broadcast join when
the runtime size of the right side is below ``spark.sql.autoBroadcastJoinThreshold`` (a
measured bound, not a guess), and splits skewed partitions of a hot key otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordforge.operators.dedup import first_per_key


def _any_null(keys: Sequence[str]) -> Column:
    found = F.lit(False)
    for k in keys:
        found = found | F.col(k).isNull()
    return found


def spread_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` in which AQE can split a hot key of ``left``.

    A side that was aggregated by the keys is already partitioned by them, so a plain join adds no
    exchange to it, and without one AQE has no shuffle to split.  The keys' hash as one more join key
    asks both sides for a partitioning of their own.  The added shuffle is that of the aggregated
    side, one row per key.  Left rows with a null key match nothing; they get their row's hash, so
    a left join spreads them over all partitions.
    """
    name = "_key_hash"
    content = F.xxhash64(*[F.col(c) for c in left.columns])
    by_key = F.xxhash64(*[F.col(k) for k in keys])
    hashed = left.withColumn(name, F.when(_any_null(keys), content).otherwise(by_key))
    return hashed.join(right.withColumn(name, by_key), on=[*keys, name], how=how).drop(name)


def hot_keys(df: DataFrame, keys: Sequence[str], limit: int) -> list[tuple]:
    """The keys that hold more than one ``limit``-th of all rows: fewer than ``limit`` of them, whatever the input."""
    counted = df.filter(~_any_null(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total = df.count()
    return [tuple(r) for r in counted.filter(F.col("_n") * limit > total).select(*keys).collect()]


def join_hot_keys_apart(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner", limit: int = 64) -> DataFrame:
    """Equi-join of ``left`` with a ``right`` that has one row per key and must not be shuffled (bucketed by the keys).

    A join without an exchange on one side cannot be split, so the keys that hold more than one
    ``limit``-th of the left rows are found by a count (fewer than ``limit`` keys) and joined apart,
    their right rows broadcast.
    """
    hot = hot_keys(left, keys, limit)
    if not hot:
        return left.join(right, on=list(keys), how=how)
    spark = left.sparkSession
    named = spark.createDataFrame(hot, left.select(*keys).schema)
    few = F.broadcast(named)  # fewer than ``limit`` rows
    cold = left.join(few, list(keys), "left_anti").join(right, on=list(keys), how=how)
    rows = F.broadcast(right.join(few, list(keys), "left_semi"))  # one row per hot key
    return cold.unionByName(left.join(few, list(keys), "left_semi").join(rows, on=list(keys), how=how))


def link_to_first(left: DataFrame, right: DataFrame, keys: Sequence[str], order_by: str,
                  right_unique: bool = False, salt_buckets: int = 0, spread: bool | None = None) -> DataFrame:
    """Attach the columns of the first right row of each key to every left row with that key.

    Rows whose key has no right row are dropped (an inner join).  With ``right_unique`` the
    caller asserts one right row per key and the dedup aggregate is skipped.  ``spread`` joins through
    ``spread_join``; it is the default where the dedup is made here, and to be asked for where the
    right side comes out of an aggregate by the keys, not out of a written table.

    ``salt_buckets=N`` spreads a hot key without relying on AQE: every left row gets a salt in
    0..N-1 from a hash of its content (stable when a task is recomputed), and the one right row
    of each key is repeated N times, once per salt.  The join key becomes (keys, salt), so a key
    holding a third of all left rows is split over N reducers; the result is unchanged.
    """
    r = right if right_unique else first_per_key(right, keys, order_by)
    if salt_buckets <= 1:
        spread = not right_unique if spread is None else spread
        return spread_join(left, r, keys) if spread else left.join(r, on=list(keys), how="inner")
    salt = "_link_salt"
    l2 = left.withColumn(salt, F.pmod(F.xxhash64(*[F.col(c) for c in left.columns]), F.lit(salt_buckets)).cast("int"))
    r2 = r.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(salt_buckets - 1))))
    return l2.join(r2, on=[*keys, salt], how="inner").drop(salt)


def left_join_spread_nulls(left: DataFrame, right: DataFrame, left_keys: Sequence[str],
                           right_keys: Sequence[str]) -> DataFrame:
    """Left outer equi-join; left rows with a null key are spread over all shuffle partitions.

    A null key never matches, but hash partitioning sends every null-key row to one reducer.
    An extra join key, 0 on both sides for keyed rows and the row's content hash for null-key
    rows, keeps the result identical while spreading those rows as wide as the shuffle is.
    """
    bucket = F.xxhash64(*[F.col(c) for c in left.columns])
    lsalt = "_null_bucket"
    l2 = left.withColumn(lsalt, F.when(_any_null(left_keys), bucket).otherwise(F.lit(0).cast("long")))
    # the right side's 0 is computed from a column so that it is not constant-folded into a filter
    r2 = right.withColumn("_r_bucket", (F.length(F.col(right_keys[0])) * 0).cast("long"))
    cond = [l2[lk] == r2[rk] for lk, rk in zip(left_keys, right_keys)] + [l2[lsalt] == r2["_r_bucket"]]
    return l2.join(r2, on=cond, how="left").drop(lsalt, "_r_bucket")
