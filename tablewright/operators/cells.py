"""A table as cells: one row per (row, column), the common input of profile and checks.

Narrow cells keep the plan size independent of the number of columns, and grouping them by
column combines on the map side to one row per column and task.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.constants import DISGUISED_NULLS, ROW_ID
from tablewright.functions.numeric import framed_number, parse_number_loose
from tablewright.functions.temporal import layout, parse_timestamp
from tablewright.functions.text import as_text
from tablewright.tables import col, column_groups, is_numeric_type, materialize

CELL_TYPES = {"column": "string", "value": "string", "text": "string", "token": "string", "number": "double",
              "layout": "string", "is_typed": "boolean"}


def _unpivot(df: DataFrame, columns: Sequence[str], cast: str, value: str) -> DataFrame:
    keep = [ROW_ID] if ROW_ID in df.columns else []
    cast_df = df.select(*keep, *[col(c).cast(cast).alias(c) for c in columns])
    return cast_df.unpivot(keep, [col(c) for c in columns], "column", value)


def text_cells(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(_row_id?, column, value) of every scalar column, the value as text."""
    text, numeric, _ = column_groups(df)
    wanted = [c for c in df.columns if c in text + numeric and (columns is None or c in columns)]
    return _unpivot(df, wanted, "string", "value")


def numbers(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """The given columns as doubles; typed numbers are cast, text is parsed loosely, NaN is NULL."""
    types = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for c in columns:
        number = (F.nanvl(col(c).cast("double"), F.lit(None).cast("double")) if is_numeric_type(types[c])
                  else parse_number_loose(col(c)))
        out.append(number.alias(c))
    return df.select(*[col(k) for k in keep], *out)


def typed_cells(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(_row_id?, column, value, text, token, number, layout, is_typed) of every scalar column.

    Text and numeric columns are unpivoted apart: each branch scans only its own columns, and
    typed numbers are never parsed from text (their text, token and layout are NULL).
    """
    text, numeric = _scalar_columns(df, columns)
    keep = [ROW_ID] if ROW_ID in df.columns else []
    parts = []
    if text:
        parts.append(_typed_text(_unpivot(df, text, "string", "value"), keep))
    if numeric:
        cells = numbers(df, numeric, keep).unpivot(keep, [col(c) for c in numeric], "column", "number")
        parts.append(_typed_numbers(cells, keep))
    if not parts:
        return df.select(*keep, *[F.lit(None).cast(t).alias(n) for n, t in CELL_TYPES.items()]).where("false")
    return reduce(DataFrame.unionByName, parts)


def _scalar_columns(df: DataFrame, columns: Sequence[str] | None) -> tuple[list[str], list[str]]:
    text, numeric, _ = column_groups(df)
    return [c for c in text if columns is None or c in columns], [c for c in numeric if columns is None or c in columns]


def _typed_text(cells: DataFrame, keep: Sequence[str]) -> DataFrame:
    cells = cells.withColumn("text", as_text("value"))
    return cells.select(
        *keep, "column", "value", "text", F.lower("text").alias("token"),
        parse_number_loose("text", stripped=True).alias("number"),
        layout("text", stripped=True).alias("layout"),
        F.lit(False).alias("is_typed"))


def _typed_numbers(cells: DataFrame, keep: Sequence[str]) -> DataFrame:
    nothing = F.lit(None).cast("string")
    return cells.select(
        *keep, "column", F.col("number").cast("string").alias("value"), nothing.alias("text"),
        nothing.alias("token"), "number", nothing.alias("layout"), F.lit(True).alias("is_typed"))


# ---------------------------------------------------------------- distinct cells with their counts

VALUE_TYPES = {"column": "string", "value": "string", "n": "bigint", "seen": "bigint", "is_typed": "boolean", "text": "string",
               "layout": "string", "token": "string", "number": "double", "stamp": "timestamp_ntz"}
#: Rows up to which every column of a value table is grouped.
GROUPED_ROWS = 100_000
#: The sketch of distinct cells counts, of the hashes of all cells, those that this number divides.
SLICES = 32


def value_table(df: DataFrame, columns: Sequence[str] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """The distinct cells of a table with their counts: both parts that ``value_parts`` writes."""
    return reduce(DataFrame.unionByName, value_parts(df, columns, by).values())


def value_parts(df: DataFrame, columns: Sequence[str] | None = None, by: Sequence[str] = (),
                known: Mapping[bool, DataFrame] | None = None, same: Collection[str] = ()) -> dict[bool, DataFrame]:
    """(by..., column, value, n, seen, is_typed, text, layout, token, number, stamp) of every scalar column: each distinct
    cell, the rows that hold it, the first of them (0 without row ids), and what it reads as. Written once.

    Two scans (a sketch first) and one map-side-combined aggregate. What a profile or an audit asks of single columns (counts, types,
    layouts, distinct values, quartiles, samples) is read from here, so each distinct cell is parsed once. Columns that
    hardly repeat a cell, as a sketch tells, are not shuffled for that: each of their cells is a row with ``n`` of one,
    so readers add up ``n`` and take a value to stand in several rows. The result tells grouped columns (True) from these.

    ``known`` may pass the parts of a table with the same rows, whose columns ``same`` hold the same cells: those columns are
    taken from there, and only the others are scanned.
    """
    if known is not None:
        kept = {k: part.where(F.col("column").isin(*same)) for k, part in known.items()} if same else {}
        left = [c for c in sum(_scalar_columns(df, columns), []) if c not in same]
        made = value_parts(df, left, by) if left or not kept else {}
        return {k: reduce(DataFrame.unionByName, [p[k] for p in (kept, made) if k in p]) for k in (True, False) if k in kept or k in made}
    text, numeric = _scalar_columns(df, columns)
    wanted = [c for c in df.columns if c in text + numeric and c not in by]
    keep = [*by, *([ROW_ID] if ROW_ID in df.columns else [])]
    if not wanted:
        return {True: df.select(*[col(c) for c in by], *[F.lit(None).cast(t).alias(n) for n, t in VALUE_TYPES.items()]).where("false")}
    plain = df.select(*[col(c) for c in keep], *[
        (F.nanvl(col(c).cast("double"), F.lit(None).cast("double")) if c in numeric else col(c)).cast("string").alias(c) for c in wanted])
    alone = _hardly_repeated(plain, wanted, by)
    parts = {}
    if len(alone) < len(wanted):
        seen = F.min(ROW_ID) if ROW_ID in df.columns else F.lit(0)
        parts[True] = (_long(plain, keep, [c for c in wanted if c not in alone])
                       .groupBy(*by, "column", "value").agg(F.count("*").alias("n"), seen.cast("long").alias("seen")))
    if alone:
        seen = F.col(ROW_ID) if ROW_ID in df.columns else F.lit(0)
        parts[False] = _long(plain, keep, alone).select(
            *[col(c) for c in by], "column", "value", F.lit(1).cast("long").alias("n"), seen.cast("long").alias("seen"))
    # Written apart, so that readers of columns with few values pass over few rows.
    return {k: _spelled(materialize(_read(part, numeric), "values"), numeric, by) for k, part in parts.items()}


def _long(plain: DataFrame, keep: Sequence[str], columns: Sequence[str]) -> DataFrame:
    return plain.select(*[col(c) for c in [*keep, *columns]]).unpivot([col(c) for c in keep], [col(c) for c in columns], "column", "value")


def _hardly_repeated(plain: DataFrame, columns: Sequence[str], by: Sequence[str]) -> list[str]:
    """Columns of a large table whose distinct cells are over a quarter of its rows, by a sketch: grouping them would
    shuffle nearly every cell and save little. It decides how a value table is laid out, never what it holds."""
    hashed = plain.select(F.lit(0).cast("long").alias("rows"), *[
        F.xxhash64(*[col(b) for b in by], col(c)).alias(f"c{i}") for i, c in enumerate(columns)])
    kept = hashed.unpivot([], hashed.columns, "place", "hash").where((F.col("hash") % SLICES) == 0)  # "rows" keeps every row
    found = {r["place"]: r for r in kept.groupBy("place", "hash").agg(F.count("*").alias("n"))
             .groupBy("place").agg(F.count("*").alias("hashes"), F.sum("n").alias("rows")).collect()}
    rows = found["rows"]["rows"] if found else 0
    return [c for i, c in enumerate(columns) if rows > GROUPED_ROWS and f"c{i}" in found and found[f"c{i}"]["hashes"] * SLICES > rows / 4]


def _is_typed(numeric: Sequence[str]) -> Column:
    return F.col("column").isin(*numeric) if numeric else F.lit(False)


def _read(counted: DataFrame, numeric: Sequence[str]) -> DataFrame:
    """Counted cells with their number and date, which are costly to read."""
    typed = (counted.withColumn("is_typed", _is_typed(numeric)).withColumn("text", F.when(~F.col("is_typed"), as_text("value")))
             .withColumns({"layout": layout("text", stripped=True), "framed": framed_number("text")}))
    number = F.when(F.col("is_typed"), F.col("value").try_cast("double")).otherwise(
        parse_number_loose("text", stripped=True, framed=F.col("framed")))
    return typed.withColumns({"number": number, "stamp": parse_timestamp("text", F.col("layout"))}).drop("is_typed", "text", "layout", "framed")


def _spelled(values: DataFrame, numeric: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Written values with what is cheaper to work out than to write."""
    typed = (values.withColumn("is_typed", _is_typed(numeric)).withColumn("text", F.when(~F.col("is_typed"), as_text("value")))
             .withColumn("layout", layout("text", stripped=True)).withColumn("token", F.lower("text")))
    return typed.select(*[col(c) for c in by], *VALUE_TYPES)


def typed_values(values: DataFrame, df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The rows of a value table of ``df`` for some columns: typed cells with the rows that each stands for."""
    wanted = sum(_scalar_columns(df, columns), [])
    return values.where(F.col("column").isin(*wanted)) if wanted else values.where("false")


def with_stamp(cells: DataFrame) -> DataFrame:
    """Cells with their parsed date, which a value table has already."""
    return cells if "stamp" in cells.columns else cells.withColumn("stamp", parse_timestamp("text", F.col("layout")))


def counted_cells(df: DataFrame, values: DataFrame | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """Typed cells with ``n``, the rows that each stands for: those of a value table, else every cell as one."""
    return typed_cells(df, columns).withColumn("n", F.lit(1)) if values is None else typed_values(values, df, columns)


def rows_where(condition: Column) -> Column:
    """Rows of counted cells that meet a condition."""
    return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0).cast("long"))


def is_null() -> Column:
    """Real NULL of a typed cell."""
    return F.col("text").isNull() & (~F.col("is_typed") | F.col("number").isNull())


def is_filled() -> Column:
    """Neither NULL nor empty; disguised nulls count as filled."""
    return F.when(F.col("is_typed"), F.col("number").isNotNull()).otherwise(
        F.coalesce(F.col("text") != "", F.lit(False)))


def is_disguised_cell(tokens: Sequence[str] = DISGUISED_NULLS) -> Column:
    return F.coalesce(F.col("token").isin(*tokens), F.lit(False))


def is_present_cell(tokens: Sequence[str] = DISGUISED_NULLS) -> Column:
    return is_filled() & ~is_disguised_cell(tokens)


def cell_text() -> Column:
    """Stripped text of a cell, whatever its type."""
    return F.coalesce(F.col("text"), F.col("value"))


def with_temporal(df: DataFrame, columns: Sequence[str], stamp: bool = True) -> DataFrame:
    """Add ``_text:c``, ``_shape:c`` and ``_stamp:c`` of each column, step by step, so that each
    is computed once and later expressions stay small."""
    out = df.withColumns({f"_text:{c}": as_text(col(c)) for c in columns})
    out = out.withColumns({f"_shape:{c}": layout(col(f"_text:{c}"), stripped=True) for c in columns})
    if stamp:
        out = out.withColumns({f"_stamp:{c}": parse_timestamp(col(f"_text:{c}"), col(f"_shape:{c}")) for c in columns})
    return out


def temporal(column: str) -> tuple[Column, Column, Column]:
    """(text, shape, stamp) columns that ``with_temporal`` added."""
    return col(f"_text:{column}"), col(f"_shape:{column}"), col(f"_stamp:{column}")
