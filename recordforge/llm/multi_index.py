"""Approximate nearest neighbours by an inverted multi-index.

The two halves of a vector are quantised apart, each to its nearest of ``centroids`` centres fitted on a bounded
sample; the pair of centres is the vector's cell, and every vector is indexed.  For a query the summed
inner product with a pair of centres is what its cell promises.  A heap walks the pairs from the best
promise down, as each half's centres are sorted: first until ``first`` entries are gathered, whose exact products give
the query's k-th best so far; then with the spread of the entries around their centres added (``spread`` standard
deviations), until the cells not yet visited are expected to hold less than ``missed`` times k entries better
than that (entries taken as normally spread around their centres).  So the walk is as long as the table needs at any size:
clustered tables end it soon; in directionless ones it reaches a large share of the cells, which is what
recall costs there.

Work is laid out by index group: neighbouring cells of about ``group_rows`` entries together, larger cells split.
A query goes to the groups that hold its cells, at most ``group_queries`` at a time, so a task holds one such block of
either side, whatever the table or one cell holds.  Equal vectors are one entry that carries the smallest ids
(k + 1 of them: no list can use more), so a vector that makes up a third of the table costs one entry.

Nearness is the inner product in double precision on the original vectors, always added in the same order, so
that equal products tie exactly; ties go to the smaller id.

Defined cases: a vector that is null, empty, all zero or holds a null, NaN or infinite entry takes no part, nor
does one whose length differs from most, nor a row without an id; rows repeated with id and vector count once; an id with
several vectors is several entries and none of them is a neighbour of that id; fewer candidates than k
give a shorter list; an empty table gives an empty table; long vectors only cost memory in proportion;
only the id and the vector are read, so other columns cannot clash.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordforge.llm.common import cut, partitions
from recordforge.llm.vectors import comparable, finite_vector, matrix

#: rows of the sample the centres are fitted on: those of the smallest vector hashes
SAMPLE_ROWS = 16_384


#: chance that a normal variable exceeds z, by z
_GRID = np.linspace(-8, 12, 4001)
_BEYOND = np.array([0.5 * math.erfc(z / math.sqrt(2)) for z in _GRID])


@dataclass
class Codebook:
    """Centres of both halves and the spread of the entries around them, per dimension."""

    centres: tuple[np.ndarray, np.ndarray]
    spreads: tuple[np.ndarray, np.ndarray]
    half: int

    @property
    def width(self) -> int:
        return len(self.centres[1])

    def cells(self, rows: np.ndarray) -> np.ndarray:
        first, second = (nearest(part, c) for part, c in zip(self.halves(rows), self.centres))
        return first * self.width + second

    def halves(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return rows[:, :self.half], rows[:, self.half:]


def nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres ** 2).sum(axis=1) - 2 * rows @ centres.T).argmin(axis=1) if centres.shape[1] else np.zeros(len(rows), np.int64)


def fit_half(rows: np.ndarray, count: int, rounds: int = 20) -> tuple[np.ndarray, np.ndarray]:
    """Lloyd's iteration from evenly drawn rows; centres and the root mean square distance per dimension around each."""
    start = np.unique(rows, axis=0)
    rng = np.random.default_rng(7)
    centres = start[np.sort(rng.permutation(len(start))[:count])]
    for _ in range(rounds):
        at = nearest(rows, centres)
        size = np.bincount(at, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, at, rows)
        moved = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], centres)
        if np.array_equal(moved, centres):
            break
        centres = moved
    at = nearest(rows, centres)
    square = ((rows - centres[at]) ** 2).sum(axis=1) / max(1, rows.shape[1])
    pooled = np.sqrt(square.mean())
    each = np.sqrt(np.bincount(at, square, len(centres)) / np.maximum(1, np.bincount(at, minlength=len(centres))))
    return centres, np.maximum(each, pooled)  # a thinly sampled centre says little about its own spread


def fit(sample: np.ndarray, count: int) -> Codebook:
    half = (sample.shape[1] + 1) // 2
    (c1, s1), (c2, s2) = fit_half(sample[:, :half], count), fit_half(sample[:, half:], count)
    return Codebook((c1, c2), (s1, s2), half)


def best_pairs(first: np.ndarray, second: np.ndarray) -> Iterator[tuple[int, int]]:
    """Pairs of positions by falling sum of their two numbers, by a heap over the two sorted lists."""
    by1, by2 = np.argsort(-first, kind="stable").tolist(), np.argsort(-second, kind="stable").tolist()
    up, down = first[by1].tolist(), second[by2].tolist()
    # pair (i, j) enters once: from (i, j - 1), or for j = 0 from (i - 1, 0)
    heap = [(-(up[0] + down[0]), 0, 0)]
    while heap:
        _, i, j = heapq.heappop(heap)
        yield by1[i], by2[j]
        if j + 1 < len(down):
            heapq.heappush(heap, (-(up[i] + down[j + 1]), i, j + 1))
        if j == 0 and i + 1 < len(up):
            heapq.heappush(heap, (-(up[i + 1] + down[0]), i + 1, 0))


def lay_out(sizes: list[tuple[int, int]], group_rows: int) -> dict[int, tuple[int, int]]:
    """Cell -> (first group, number of groups it is split over); neighbouring small cells share a group."""
    plan, group, filled = {}, -1, group_rows
    for cell, size in sizes:
        parts = -(-size // group_rows)
        if parts > 1:
            plan[cell] = (group + 1, parts)
            group, filled = group + parts, group_rows
            continue
        if filled + size > group_rows:
            group, filled = group + 1, 0
        plan[cell] = (group, 1)
        filled += size
    return plan


def _products(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products added in the same order for every row."""
    return np.ascontiguousarray(rows * query).sum(axis=1)


def _best_of_group(entries: pa.Table, queries: pa.Table, dims: int, keep: int) -> pa.Table:
    """The ``keep`` best entries of one group for each of its queries, among the cells the query visits."""
    rows = matrix(entries["__vec"].combine_chunks(), dims) if entries.num_rows else np.zeros((0, dims))
    cells, low, node = (entries[c].to_numpy() for c in ("__cell", "__low", "__node"))
    asked = matrix(queries["__vec"].combine_chunks(), dims) if queries.num_rows else np.zeros((0, dims))
    local, code = np.unique(cells, return_inverse=True)
    out: tuple[list, list, list, list] = ([], [], [], [])
    step = max(1, (1 << 21) // max(1, len(rows)))
    visits = queries["__cells"].to_pylist()
    names = queries["__query"].to_pylist()
    for start in range(0, len(asked) if len(rows) else 0, step):
        part = asked[start:start + step]
        about = part @ rows.T  # to choose by; what is returned is added up again below
        for k, query in enumerate(part):
            open_ = np.isin(local, visits[start + k])[code]
            here = np.flatnonzero(open_)
            if len(here) > keep:
                score = about[k, here]
                edge = np.partition(score, len(here) - keep)[len(here) - keep]
                slack = 1e-9 * max(1e-300, float(np.linalg.norm(query)) * float(np.abs(rows[here]).max()) * dims)
                here = here[score >= edge - slack]
            exact = _products(rows[here], query)
            order = np.lexsort((low[here], -exact))[:keep]
            out[0].extend([names[start + k]] * len(order))
            out[1].extend(node[here][order].tolist())
            out[2].extend(low[here][order].tolist())
            out[3].extend(exact[order].tolist())
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64())
    return pa.table([pa.array(x, t) for x, t in zip(out, kinds)], names=["__query", "__node", "__low", "__score"])


def _rerank(index: DataFrame, visits: DataFrame, dims: int, keep: int, group_queries: int) -> DataFrame:
    """The best ``keep`` entries per query among the cells it visits, with exact products."""
    # many queries of one group are cut into blocks; the group's entries go to each block
    blocks = visits.groupBy("__group").agg(F.ceil(F.count(F.lit(1)) / group_queries).cast("int").alias("__blocks"))
    asked = (visits.join(blocks, "__group")
             .withColumn("__block", F.pmod(F.xxhash64("__query"), F.col("__blocks")).cast("int")).drop("__blocks"))
    entries = (index.join(blocks, "__group")
               .withColumn("__block", F.explode(F.sequence(F.lit(0), F.col("__blocks") - 1))).drop("__blocks"))
    found = (entries.groupBy("__group", "__block").cogroup(asked.groupBy("__group", "__block"))
             .applyInArrow(lambda e, q: _best_of_group(e, q, dims, keep), "__query long, __node long, __low long, __score double"))
    order = Window.partitionBy("__query").orderBy(F.desc("__score"), "__low", "__node")
    return found.withColumn("__r", F.row_number().over(order)).where(F.col("__r") <= keep)


def nearest_neighbours(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 20, is_query: Column | None = None,
                       centroids: int = 64, first: int = 2000, spread: float = 3.0, missed: float = 0.05, sample_rows: int = SAMPLE_ROWS,
                       group_rows: int = 8192, group_queries: int = 4096) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: the k nearest found of every query row (all rows unless given)."""
    spark = df.sparkSession
    asks = F.coalesce(is_query, F.lit(False)) if is_query is not None else F.lit(True)
    vec = finite_vector(F.col(vec_col))
    rows, dims = comparable(df.select(F.col(id_col).cast("long").alias("__id"), vec.alias("__vec"), asks.alias("__asks")), "__vec")
    schema = "query_id long, rank int, vec_id long, score double"
    if not dims:
        return spark.createDataFrame([], schema)
    rows = (rows.where(F.col("__id").isNotNull() & F.exists("__vec", lambda x: x != 0))
            .withColumns({"__h1": F.xxhash64("__vec"), "__h2": F.xxhash64(F.lit("second"), F.col("__vec"))}))
    keep = k + 1  # the query itself may be among them

    # one entry per different vector, with its smallest ids
    smallest = Window.partitionBy("__h1", "__h2").orderBy("__id")
    distinct = rows.groupBy("__h1", "__h2", "__id").agg(F.first("__vec").alias("__vec"))
    nodes = cut(distinct.withColumn("__r", F.row_number().over(smallest)).where(F.col("__r") <= keep)
                .groupBy("__h1", "__h2").agg(F.first("__vec").alias("__vec"), F.sort_array(F.collect_list("__id")).alias("__ids"))
                .withColumn("__node", F.monotonically_increasing_id()), "nodes")
    sample = nodes.select("__h1", "__vec").orderBy("__h1").limit(sample_rows).toArrow()
    if not sample.num_rows:
        return spark.createDataFrame([], schema)
    book = fit(matrix(sample["__vec"].combine_chunks(), dims), centroids)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                cells = book.cells(matrix(b.column("__vec"), dims)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cells)], [*b.schema.names, "__cell"])

    placed = cut(nodes.select("__node", F.get("__ids", F.lit(0)).alias("__low"), "__vec")
                 .mapInArrow(encode, "__node long, __low long, __vec array<double>, __cell int"), "placed")
    # at most centroids ** 2 rows
    sizes = sorted(tuple(r) for r in placed.groupBy("__cell").count().collect())
    plan = lay_out(sizes, group_rows)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = [plan[c] for c in b.column("__cell").to_pylist()]
            group = [g + n % parts for (g, parts), n in zip(at, b.column("__node").to_pylist())]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(group, pa.int32())], [*b.schema.names, "__group"])

    index = placed.mapInArrow(deal, "__node long, __low long, __vec array<double>, __cell int, __group int")
    asking = rows.where("__asks").select("__id", "__h1", "__h2").distinct()
    # walking costs far more than its few bytes: spread over all tasks, not merged by size
    queries = cut(nodes.join(asking.select("__h1", "__h2").distinct(), ["__h1", "__h2"]).select("__node", "__vec")
                  .repartition(partitions(spark), "__node"), "queries")

    cells, counts = (np.array(x, dtype=np.int64) for x in zip(*sizes))
    at1, at2 = cells // book.width, cells % book.width
    known, places = {c: at for at, (c, _) in enumerate(sizes)}, [plan[c] for c, _ in sizes]

    def walk(bounded: bool):
        def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if not b.num_rows:
                    continue
                halves = book.halves(matrix(b.column("__vec"), dims))
                promise = [q @ c.T for q, c in zip(halves, book.centres)]
                spreads = [np.linalg.norm(q, axis=1)[:, None] * s[None, :] for q, s in zip(halves, book.spreads)]
                least = b.column("__least").to_pylist() if bounded else [None] * b.num_rows
                names, groups, visited, where = [], [], [], []
                for r, name in enumerate(b.column("__node").to_pylist()):
                    by_group: dict[int, list[int]] = {}
                    # the first walk is over after so many entries, the second after so many expected better ones
                    enough = float(first)
                    worth = counts
                    first_half, second_half = promise[0][r], promise[1][r]
                    if bounded:
                        enough = float(counts.sum())
                        if least[r] is not None:
                            around = np.hypot(spreads[0][r][at1], spreads[1][r][at2])
                            gap = least[r] - (first_half[at1] + second_half[at2])
                            better = counts * np.interp(gap / np.maximum(around, 1e-300), _GRID, _BEYOND)
                            worth, enough = better, float(better.sum()) - missed * k
                        # the deviations of the halves are independent: a share of sqrt(1/2) each adds up to the whole
                        first_half = first_half + spread * math.sqrt(0.5) * spreads[0][r]
                        second_half = second_half + spread * math.sqrt(0.5) * spreads[1][r]
                    gathered, chosen, worth = 0.0, [], worth.tolist()
                    for i, j in best_pairs(first_half, second_half):
                        if gathered >= enough:
                            break
                        at = known.get(i * book.width + j)
                        if at is not None:
                            chosen.append(at)
                            gathered += worth[at]
                    for at in chosen:
                        cell, (start, parts) = sizes[at][0], places[at]
                        for g in range(start, start + parts):
                            by_group.setdefault(g, []).append(cell)
                    names.extend([name] * len(by_group))
                    groups.extend(by_group)
                    visited.extend(by_group.values())
                    where.extend([r] * len(by_group))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.int64()), pa.array(groups, pa.int32()), pa.array(visited, pa.list_(pa.int32())),
                     b.column("__vec").take(pa.array(where, pa.int64()))], ["__query", "__group", "__cells", "__vec"])
        return visit

    visit_schema = "__query long, __group int, __cells array<int>, __vec array<double>"
    near = cut(_rerank(index, queries.mapInArrow(walk(False), visit_schema), dims, keep, group_queries), "near")
    least = near.where(F.col("__r") == keep).select(F.col("__query").alias("__node"), F.col("__score").alias("__least"))
    bounds = queries.join(least, "__node", "left").repartition(partitions(spark), "__node")
    visits = cut(bounds.mapInArrow(walk(True), visit_schema), "visits")
    best = (_rerank(index, visits, dims, keep, group_queries).unionByName(near)
            .groupBy("__query", "__node").agg(F.first("__score").alias("__score")))

    # from entries to ids: the best k + 1 ids per asking vector, then each query's own id goes
    ids = best.join(nodes.select("__node", "__ids"), "__node").select(
        "__query", F.col("__score"), F.explode("__ids").alias("__other"))
    order = Window.partitionBy("__query").orderBy(F.desc("__score"), "__other")
    lists = (ids.withColumn("__r", F.row_number().over(order)).where(F.col("__r") <= keep)
             .groupBy("__query").agg(F.sort_array(F.collect_list(F.struct("__r", "__other", "__score"))).alias("__list")))
    # written, so that a vector asked for by a third of all rows is split or broadcast in the next join
    lists = cut(nodes.select("__node", "__h1", "__h2").join(lists, F.col("__node") == F.col("__query")).select("__h1", "__h2", "__list"), "lists")
    others = F.filter("__list", lambda x: x["__other"] != F.col("__id"))
    return (asking.join(lists, ["__h1", "__h2"])
            .select(F.col("__id").alias("query_id"), F.posexplode(F.slice(others, 1, k)).alias("__pos", "__hit"))
            .select("query_id", (F.col("__pos") + 1).alias("rank"), F.col("__hit")["__other"].alias("vec_id"), F.col("__hit")["__score"].alias("score")))
