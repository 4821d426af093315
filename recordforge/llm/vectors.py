"""Helpers for tables of vectors, shared by the operators on embeddings."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite_vector(vec: Column) -> Column:
    """The vector as array<double>, null if it is null, empty or holds a null, NaN or infinite entry."""
    v = vec.cast("array<double>")
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when((F.size(v) > 0) & ~odd, v)


def comparable(df: DataFrame, vec: str) -> tuple[DataFrame, int]:
    """The rows whose vector has the table's length, and that length (0 for a table without vectors).

    The length is that of most vectors, the longer one on a tie; vectors of another length cannot be
    compared with those and are left out.
    """
    sizes = df.where(F.col(vec).isNotNull()).groupBy(F.size(vec).alias("__len")).agg(F.count(F.lit(1)).alias("__n"))
    dims = sizes.agg(F.max(F.struct("__n", "__len"))["__len"]).first()[0]
    return df.where(F.col(vec).isNotNull() & (F.size(vec) == (dims or -1))), dims or 0


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """A column of equally long lists as rows of a matrix."""
    return np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), dims)


def summed(df: DataFrame, add: Callable[[np.ndarray], np.ndarray], width: int, vec: str, dims: int,
           exact: bool = False) -> list:
    """Elementwise sum over all rows of ``add(rows as matrix)``, an array of ``width`` numbers per batch.

    Each task adds up its batches and passes on one array; the arrays of the tasks are added by position in
    Spark, so no task and no driver holds more than ``width`` numbers per partial sum.  With ``exact``, ``add``
    gives whole numbers (Python ints allowed) and the sum is exact.
    """
    kind = "decimal(38,0)" if exact else "double"

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = add(matrix(batch.column(0), dims))
                total = part if total is None else total + part
        if total is not None:
            values = [str(int(x)) for x in total] if exact else total
            item = pa.string() if exact else pa.float64()
            yield pa.RecordBatch.from_arrays([pa.array([values], pa.list_(item))], ["part"])

    parts = df.select(vec).mapInArrow(partial, f"part array<{'string' if exact else 'double'}>")
    rows = (parts.select(F.posexplode("part").alias("pos", "x")).groupBy("pos")
            .agg(F.sum(F.col("x").cast(kind)).alias("x")).collect())
    out = [0] * width
    for r in rows:
        out[r["pos"]] = int(r["x"]) if exact else r["x"]
    return out
