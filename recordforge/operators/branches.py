"""Several tables that are rows of one frame: read in one pass instead of once per table.

A union of filtered projections over one source reads that source once per branch.  Where no row
belongs to two branches, the union is the same as giving every row the columns of its own
branch: one ``CASE`` over the branch conditions, evaluated for the branch taken only.
"""

from __future__ import annotations

from collections.abc import Callable, Hashable, Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: how a rule gets at a column: ``F.col`` over a table of its own, or a lookup of an expression
Accessor = Callable[[str], Column]


@dataclass(frozen=True)
class SharedTables:
    """Tables by name over the same ``rows``: which rows are theirs, and their columns as expressions.

    The conditions of two tables never hold for the same row.
    """

    rows: DataFrame
    where: Mapping[Hashable, Column]
    columns: Mapping[Hashable, Mapping[str, Column]]

    def __iter__(self) -> Iterable[Hashable]:
        return iter(self.columns)

    def __contains__(self, name: Hashable) -> bool:
        return name in self.columns

    def accessor(self, name: Hashable) -> Accessor:
        columns = self.columns[name]

        def column(wanted: str) -> Column:
            if wanted not in columns:
                raise ValueError(f"table {name} has no column {wanted}")
            return columns[wanted]

        return column

    def table(self, name: Hashable) -> DataFrame:
        """One table as a frame of its own."""
        return self.rows.filter(self.where[name]).select(*[c.alias(n) for n, c in self.columns[name].items()])

    def tables(self) -> dict[Hashable, DataFrame]:
        return {name: self.table(name) for name in self.columns}


def one_pass(rows: DataFrame, branches: Sequence[tuple[Column, Sequence[Column]]]) -> DataFrame:
    """UNION ALL of disjoint branches (condition, columns) in one pass over ``rows``.

    The columns of all branches have the same names and types.  A row no condition holds for gives
    nothing.  The rows come out of a generator, so later filters are not pushed below it, where
    they would evaluate the branches' expressions a second time.
    """
    picked = None
    for condition, columns in branches:
        made = F.array(F.struct(*columns))
        picked = F.when(condition, made) if picked is None else picked.when(condition, made)
    return rows.select(F.inline(picked))
