"""Exact duplicates and key conflicts without gathering a group in one task.

Rows are first grouped by a 64-bit hash, which shuffles eight bytes per row after map-side combining. The repeated
hashes are written and laid out as a bitmap, which every later scan holds its rows against: a row whose hash is not
repeated is compared with no other and never shuffled. The few that the bitmap lets through by chance form groups of
one, so neither it nor a hash collision can make a false duplicate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.constants import ROW_ID
from tablewright.operators.bitmaps import bitmap_of
from tablewright.tables import col, data_columns, materialize

_HASH = "_row_hash"
#: So many repeated hashes are a list in the plan; more are a bitmap.
FEW = 2_000


def _columns_to_group(df: DataFrame, columns: Sequence[str] | None) -> list[str]:
    return list(columns) if columns is not None else data_columns(df)


def hash_of(columns: Sequence[str]) -> Column:
    return F.xxhash64(*[col(c) for c in columns]) if columns else F.lit(0).cast("long")


def repeated(hashed: DataFrame, column: str) -> DataFrame:
    """Hashes that more than one row has, as a written table of one column ``_row_hash``."""
    return materialize(hashed.groupBy(F.col(column).alias(_HASH)).agg(F.count("*").alias("n")).where("n > 1").select(_HASH), "hashes")


def repeated_hashes(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Hashes of the given columns (all data columns by default) that more than one row has."""
    return repeated(df.select(hash_of(_columns_to_group(df, columns)).alias(_HASH)), _HASH)


def suspected(df: DataFrame, columns: Sequence[str], hashes: DataFrame | None = None) -> Column:
    """True for all rows that equal another one in these columns, and for hardly any other."""
    return among(hash_of(columns), repeated_hashes(df, columns) if hashes is None else hashes)


def among(hashed: Column, hashes: DataFrame) -> Column:
    """True for all hashes of a written table of them, and for hardly any other."""
    few = [r[_HASH] for r in hashes.limit(FEW + 1).collect()]
    if len(few) <= FEW:
        return hashed.isin(few) if few else F.lit(False)
    return bitmap_of(hashes, _HASH).may_hold(hashed)


def duplicate_groups(df: DataFrame, columns: Sequence[str] | None = None,
                     hashes: DataFrame | None = None) -> DataFrame:
    """One row per group of equal rows: the columns, ``n`` and the first row id.

    NULLs are equal to each other here. ``hashes`` may pass the repeated hashes if known.
    """
    names = _columns_to_group(df, columns)
    first = [F.min(ROW_ID).alias("first_row")] if ROW_ID in df.columns else []
    rows = df.where(suspected(df, names, hashes))
    return rows.groupBy(*[col(c) for c in names]).agg(F.count("*").alias("n"), *first).where("n > 1")


def key_groups(df: DataFrame, keys: Sequence[str], hashes: DataFrame | None = None) -> DataFrame:
    """One row per business key that several rows share."""
    return duplicate_groups(df, keys, hashes)


def drop_duplicates(df: DataFrame, columns: Sequence[str] | None = None,
                    hashes: DataFrame | None = None) -> DataFrame:
    """Keep the first of equal rows (lowest row id). Only rows that may equal another one are shuffled, once.

    ``columns`` names the columns that make rows equal (all data columns by default).
    """
    names = _columns_to_group(df, columns)
    suspect = suspected(df, names, hashes)

    def firsts(rows):
        others = [c for c in df.columns if c not in names and c != ROW_ID]
        order = F.col(ROW_ID) if ROW_ID in df.columns else F.lit(0)
        kept = rows.groupBy(*[col(c) for c in names]).agg(
            F.min(F.struct(order.alias("_first"), *[col(c) for c in others])).alias("_kept"))
        row_id = [F.col("_kept._first").alias(ROW_ID)] if ROW_ID in df.columns else []
        return kept.select(*[col(c) for c in names], *row_id,
                           *[F.col("_kept")[c].alias(c) for c in others]).select(*[col(c) for c in df.columns])

    return df.where(~suspect).unionByName(firsts(df.where(suspect)))
