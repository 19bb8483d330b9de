"""Corrections. A fix is a column expression plus the statistics it needs."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.constants import DISGUISED_NULLS, ROW_ID
from tablewright.functions.numeric import has_currency, parse_number_currency, parse_number_loose
from tablewright.functions.temporal import parse_timestamp, render_iso
from tablewright.functions.text import as_text, is_present, plain_double, title_case, values_equivalent
from tablewright.operators.cells import temporal, with_temporal
from tablewright.operators.duplicates import drop_duplicates
from tablewright.operators.quantiles import exact_quantiles
from tablewright.operators.rules import Rules
from tablewright.tables import col, is_numeric_type


@dataclass(frozen=True)
class Cell:
    """A column in the middle of being fixed."""

    value: Column
    is_number: bool

    @property
    def number(self) -> Column:
        if self.is_number:
            return F.nanvl(self.value.cast("double"), F.lit(None).cast("double"))
        return parse_number_loose(self.value)


@dataclass(frozen=True)
class Fixed:
    """Result of one fix on one column: the new cell, which rows it touched, and what to log."""

    cell: Cell
    touched: Column | None = None
    applied: bool = True
    value: str | None = None
    lower: float | None = None
    upper: float | None = None
    reason: str | None = None


@dataclass(frozen=True)
class Context:
    """What a fix may look at: statistics of its column, the rules, the column name."""

    column: str
    rules: Rules
    stats: Mapping[str, object]
    stamp: Column | None = None
    text: Column | None = None
    number: Column | None = None


def _changed(before: Cell, after: Column) -> Column:
    return ~values_equivalent(before.value.cast("string"), after.cast("string"))


def strip_currency(cell: Cell, ctx: Context) -> Fixed:
    if cell.is_number:
        return Fixed(Cell(cell.number, True), F.lit(False))
    return Fixed(Cell(parse_number_currency(cell.value), True), has_currency(cell.value))


def cast_numeric(cell: Cell, ctx: Context) -> Fixed:
    if ctx.number is None:
        return Fixed(Cell(cell.number, True), _changed(cell, cell.number))
    return Fixed(Cell(ctx.number, True), ~_says_number(ctx.text, ctx.number))


def _says_number(text: Column, number: Column, tolerance: float = 1e-9) -> Column:
    """As ``values_equivalent`` of a stripped text and the number's own text, which is not spelled out to be read again."""
    finite = ~number.isin(math.inf, -math.inf)
    return (text.isNull() & number.isNull()) | F.coalesce(F.abs(plain_double(text, stripped=True) - F.when(finite, number)) < tolerance, F.lit(False))


def impute_median(cell: Cell, ctx: Context) -> Fixed:
    median = ctx.stats.get("median")
    if median is None:
        return Fixed(cell, applied=False, reason="no numbers")
    number = cell.number
    return Fixed(Cell(F.coalesce(number, F.lit(median)), True), number.isNull(), value=str(median))


def impute_mode(cell: Cell, ctx: Context) -> Fixed:
    mode = ctx.stats.get("mode")
    if mode is None:
        return Fixed(cell, applied=False, reason="no value to fill in")
    known = cell.number.isNotNull() if cell.is_number else is_present(cell.value)
    return Fixed(Cell(F.when(known, cell.value).otherwise(F.lit(mode)), cell.is_number), ~known, value=str(mode))


def clip_iqr(cell: Cell, ctx: Context) -> Fixed:
    q1, q3 = ctx.stats.get("q1"), ctx.stats.get("q3")
    if q1 is None:
        return Fixed(cell, applied=False, reason="no numbers")
    lower, upper = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    number = cell.number
    clipped = F.when(number < lower, F.lit(lower)).when(number > upper, F.lit(upper)).otherwise(number)
    return Fixed(Cell(clipped, True), ~number.between(lower, upper), lower=lower, upper=upper)


def clip_to_min(cell: Cell, ctx: Context) -> Fixed:
    minimum = ctx.rules.minimum(ctx.column)
    if minimum is None:
        return Fixed(cell, applied=False, reason="no minimum declared")
    number = cell.number
    below = number < minimum
    return Fixed(Cell(F.when(below, F.lit(float(minimum))).otherwise(number), True), below, lower=float(minimum))


def normalize_dates(cell: Cell, ctx: Context) -> Fixed:
    kind = ctx.rules.formats.get(ctx.column, "date")
    if kind not in ("period", "date", "datetime"):
        return Fixed(cell, F.lit(False))
    text = cell.value.cast("string")
    stamp = parse_timestamp(text) if ctx.stamp is None else ctx.stamp
    new = F.coalesce(render_iso(stamp, kind), text)
    return Fixed(Cell(new, False), ~new.eqNullSafe(text))


def normalize_categorical(cell: Cell, ctx: Context) -> Fixed:
    text = cell.value.cast("string")
    new = title_case(F.lower(as_text(text)))
    return Fixed(Cell(new, False), ~new.eqNullSafe(text))


Fix = Callable[[Cell, Context], Fixed]

# Actions on one column, with the statistics each needs.
COLUMN_FIXES: dict[str, Fix] = {
    "strip_currency": strip_currency, "cast_numeric": cast_numeric, "impute_median": impute_median,
    "impute_mode": impute_mode, "clip_iqr": clip_iqr, "clip_to_min": clip_to_min,
    "normalize_dates": normalize_dates, "normalize_categorical": normalize_categorical,
}
NEEDS = {"impute_median": ("median",), "impute_mode": ("mode",), "clip_iqr": ("q1", "q3")}
QUANTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}

# Actions on whole tables. keep_first_by_key is opt-in; no planner proposes it by default.
TABLE_FIXES = ("drop_duplicates", "drop_unexpected_columns", "keep_first_by_key", "ignore")
ACTIONS = (*COLUMN_FIXES, *TABLE_FIXES)


_ISO_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"


def start_cell(df: DataFrame, column: str) -> Cell:
    return Cell(col(column), is_numeric_type(df.schema[column].dataType))


def modes(df: DataFrame, cells: Mapping[str, Cell]) -> dict[str, object]:
    """Most frequent present value of each column, the smallest on ties.

    Values are counted by (column, value) with map-side combining; the winner is a minimum over
    counted values, so no column is gathered anywhere.
    """
    out: dict[str, object] = {c: None for c in cells}
    for numeric in (False, True):
        part = {c: cell for c, cell in cells.items() if cell.is_number == numeric}
        if not part:
            continue
        values = [(cell.number if numeric else F.when(is_present(cell.value), as_text(cell.value))).alias(c)
                  for c, cell in part.items()]
        rows = (df.select(*values).unpivot([], [col(c) for c in part], "column", "value")
                  .where("value is not null")
                  .groupBy("column", "value").agg(F.count("*").alias("n"))
                  .groupBy("column").agg(F.min(F.struct((-F.col("n")).alias("order"), "value")).alias("best"))
                  .select("column", "best.value").collect())
        out.update({r["column"]: r["value"] for r in rows})
    return out


def statistics(df: DataFrame, needed: Mapping[str, tuple[Cell, Sequence[str]]]) -> dict[str, dict[str, object]]:
    """Statistics of several columns in two jobs at most: all quantiles, all modes."""
    out: dict[str, dict[str, object]] = {c: {} for c in needed}
    quantiles = {c: [s for s in names if s in QUANTILES] for c, (_, names) in needed.items()}
    numeric = [c for c, names in quantiles.items() if names]
    if numeric:
        nums = df.select(*[needed[c][0].number.alias(c) for c in numeric])
        probs = sorted({QUANTILES[s] for c in numeric for s in quantiles[c]})
        found = exact_quantiles(nums, numeric, probs)
        for c in numeric:
            out[c].update({s: found[(c, QUANTILES[s])] for s in quantiles[c]})
    modal = {c: cell for c, (cell, names) in needed.items() if "mode" in names}
    for c, mode in (modes(df, modal) if modal else {}).items():
        out[c]["mode"] = mode
    return out


def apply_fix(df: DataFrame, column: str, action: str, rules: Rules, stats: Mapping[str, object],
              touched_as: str | None = None) -> tuple[DataFrame, Fixed]:
    """One correction as one projection, optionally with a flag column for the rows it touched."""
    names, frame, stamp = df.columns, df, None
    if action == "normalize_dates":
        # Text in the layout of a date is written as it stands, be it a date or not, so it need not be read.
        odd = f"_odd:{column}"
        written = col(column).cast("string")
        iso = written.rlike(_ISO_DATE) if rules.formats.get(column, "date") == "date" else F.lit(False)
        frame = with_temporal(df.withColumn(odd, F.when(iso, F.lit(None)).otherwise(written)), [odd])
        stamp = temporal(odd)[2]
    cell, text, number = start_cell(df, column), None, None
    if action == "cast_numeric" and not cell.is_number:
        text, number = col(f"_text:{column}"), col(f"_number:{column}")
        frame = df.withColumn(f"_text:{column}", as_text(cell.value)).withColumn(f"_number:{column}", parse_number_loose(text, stripped=True))
    fixed = COLUMN_FIXES[action](cell, Context(column, rules, stats, stamp, text, number))
    if action in ("normalize_dates", "normalize_categorical") and fixed.cell is not cell:
        new = col(f"_new:{column}")
        frame = frame.withColumn(f"_new:{column}", fixed.cell.value)
        fixed = replace(fixed, cell=Cell(new, False), touched=~new.eqNullSafe(cell.value.cast("string")))
    touched = fixed.touched if fixed.applied and fixed.touched is not None else F.lit(False)
    flag = [touched.alias(touched_as)] if touched_as else []
    return frame.select(*[fixed.cell.value.alias(c) if c == column else col(c) for c in names], *flag), fixed


def fix_column(df: DataFrame, column: str, action: str, rules: Rules = Rules()) -> DataFrame:
    """Apply one action to one column of a table."""
    needed = NEEDS.get(action, ())
    stats = statistics(df, {column: (start_cell(df, column), needed)})[column] if needed else {}
    return apply_fix(df, column, action, rules, stats)[0]


def drop_unexpected_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop the listed columns that exist."""
    return df.select(*[col(c) for c in df.columns if c not in columns or c == ROW_ID])


def keep_first_by_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keep the first row of every business key (opt-in)."""
    return drop_duplicates(df, keys)


__all__ = ["ACTIONS", "COLUMN_FIXES", "DISGUISED_NULLS", "drop_duplicates", "fix_column",
           "drop_unexpected_columns", "keep_first_by_key", "statistics", "modes"]
