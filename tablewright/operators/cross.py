"""Cross-column rules as row predicates; rules name columns, never datasets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.functions.numeric import parse_number_loose
from tablewright.functions.temporal import parse_timestamp, parse_year, parse_year_month
from tablewright.functions.text import is_present, plain_double
from tablewright.operators.cells import temporal, with_temporal
from tablewright.operators.rules import CrossRule
from tablewright.tables import col, is_numeric_type

ISSUE_OF_RULE = {
    "le": ("logical_count_violation", "critical", "`{0}` exceeds `{1}` in some rows."),
    "year_matches": ("year_date_mismatch", "high", "In some rows `{1}` is another year than that of `{0}`."),
    "period_matches": ("month_year_period_mismatch", "high", "In some rows `{0}` is another month than `{1}` and `{2}` say."),
    "product_matches": ("product_mismatch", "high", "`{0}` differs from `{1}` times `{2}` in some rows."),
    "date_order": ("date_order_violation", "high", "`{0}` comes after `{1}` in some rows."),
}


def applicable(df: DataFrame, rules: Sequence[CrossRule]) -> list[CrossRule]:
    """Rules whose columns all exist."""
    return [r for r in rules if set(r.columns) <= set(df.columns)]


#: Places of the columns that a rule reads as dates.
_DATES = {"year_matches": (0,), "date_order": (0, 1)}


def with_dates(df: DataFrame, rules: Sequence[CrossRule]) -> DataFrame:
    """Add the parsed dates that the rules compare, so that each is worked out once a row; ``violation`` reads them there."""
    return with_temporal(df, sorted({r.columns[i] for r in rules for i in _DATES.get(r.kind, ())}))


def violation(df: DataFrame, rule: CrossRule) -> Column:
    """True where a row breaks the rule; rows with an unreadable side never do."""
    types = {f.name: f.dataType for f in df.schema.fields}

    def number(c):
        return col(c).cast("double") if is_numeric_type(types[c]) else parse_number_loose(col(c))

    def shown(c, value):
        return F.when(is_present(col(c)), value)

    def stamp(c):
        return temporal(c)[2] if f"_stamp:{c}" in types else parse_timestamp(col(c))

    c = rule.columns
    if rule.kind == "le":
        bad = number(c[0]) > number(c[1])
    elif rule.kind == "year_matches":
        bad = F.year(stamp(c[0])) != parse_year(col(c[1]))  # no text for a missing value reads as a date or a year
    elif rule.kind == "period_matches":
        part = shown(c[0], parse_year_month(col(c[0])))
        year, month = parse_year(col(c[1])), plain_double(col(c[2]))
        known = part.isNotNull() & year.isNotNull() & month.isNotNull()
        bad = known & ((part["year"] != year) | (part["month"] != month))
    elif rule.kind == "product_matches":
        total, product = number(c[0]), number(c[1]) * number(c[2])
        bad = F.abs(total - product) > F.greatest(F.lit(0.01), F.abs(product) * 0.001)
    elif rule.kind == "date_order":
        bad = stamp(c[0]) > stamp(c[1])
    else:
        raise ValueError(f"unknown cross rule: {rule.kind}")
    return F.coalesce(bad, F.lit(False))
