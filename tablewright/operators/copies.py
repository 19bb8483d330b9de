"""Copies of a table that differ from it in some rows, told by these rows alone."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.constants import ROW_ID
from tablewright.tables import col


@dataclass(frozen=True)
class Copies:
    """``before`` holds the rows that a copy changes as they stand in ``table``, ``after`` the same rows as they stand in the
    copy, both with the copy's name in the column ``by``; they may hold the
    facts of their rows as well. All other rows of a copy are those of the table, whose row ids
    are unique."""

    table: DataFrame
    by: str
    names: tuple[str, ...]
    before: DataFrame
    after: DataFrame

    def of_each(self, rows: DataFrame) -> DataFrame:
        """Rows of the table, once for each copy."""
        return rows.withColumn(self.by, F.explode(F.array(*[F.lit(n) for n in self.names])))

    def unchanged(self, rows: DataFrame) -> DataFrame:
        """Those of the rows (with row id and copy) that the copy does not change."""
        return rows.join(self.before.select(col(self.by), ROW_ID), [self.by, ROW_ID], "left_anti").select(*[col(c) for c in rows.columns])

    def stacked(self) -> DataFrame:
        """All rows of all copies."""
        return self.unchanged(self.of_each(self.table)).unionByName(self.after.select(*[col(c) for c in self.table.columns], col(self.by)))
