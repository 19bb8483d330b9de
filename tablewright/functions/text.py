"""Text normalisation, presence tests and display helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tablewright.constants import DISGUISED_NULLS, WHITESPACE

PLAIN_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\z"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def literal(value: object) -> str:
    """SQL text of a constant."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'" if isinstance(value, str) else str(value)


def constant_map(values: dict) -> Column:
    """A constant map as one expression."""
    return F.expr("map(" + ", ".join(f"{literal(k)}, {literal(v)}" for k, v in values.items()) + ")")


def lookup(values: dict, key: Column | str, dtype: str) -> Column:
    """Value of a small constant table, NULL for other keys; folded by the optimizer, no join."""
    values = {k: v for k, v in values.items() if v is not None}
    if not values:
        return F.lit(None).cast(dtype)
    return F.try_element_at(constant_map(values), _col(key)).cast(dtype)


def constant_array(values: Sequence) -> Column:
    """A constant array as one expression."""
    return F.expr("array(" + ", ".join(literal(v) for v in values) + ")")


def as_text(c: Column | str) -> Column:
    """Any scalar as stripped text; NULL stays NULL. Text from one visible ASCII character to another has nothing to strip,
    and telling that is cheaper than looking its ends up in the list of blanks."""
    text = _col(c).cast("string")
    bare = (text >= "!") & (text < "\x7f") & F.substring(text, -1, 1).between("!", "~")
    return F.when(bare, text).otherwise(F.btrim(text, F.lit(WHITESPACE)))


def normalize_text(c: Column | str) -> Column:
    """Stripped text, NULL when nothing is left."""
    return F.nullif(as_text(c), F.lit(""))


def normalize_token(c: Column | str) -> Column:
    """Stripped lower-case text for case-insensitive comparison."""
    return F.lower(normalize_text(c))


def is_disguised(c: Column | str, tokens: Sequence[str] = DISGUISED_NULLS) -> Column:
    """True for text that stands for "no value"; a real NULL is not disguised."""
    return F.coalesce(F.lower(as_text(c)).isin(*tokens), F.lit(False))


def is_present(c: Column | str, tokens: Sequence[str] = DISGUISED_NULLS) -> Column:
    """Neither NULL, nor empty, nor a disguised null."""
    text = as_text(c)
    return F.coalesce((text != "") & ~F.lower(text).isin(*tokens), F.lit(False))


def title_case(c: Column | str) -> Column:
    """First letter of every letter run in upper case, the rest lower ("o'neil" -> "O'Neil"). Text of one run is not taken apart."""
    text = _col(c)
    runs = F.regexp_extract_all(text, F.lit(r"(\p{L}+|\P{L}+)"), F.lit(0))
    return F.when(text.rlike(r"^[A-Za-z]+\z"), F.initcap(text)).otherwise(F.array_join(F.transform(runs, lambda run: F.initcap(run)), ""))


def plain_double(c: Column | str, stripped: bool = False) -> Column:
    """Strict number: NULL unless the whole text is one plain decimal or scientific literal."""
    text = _col(c) if stripped else as_text(c)
    return F.when(text.rlike(PLAIN_NUMBER), text.try_cast("double"))


def values_equivalent(a: Column | str, b: Column | str, tolerance: float = 1e-9) -> Column:
    """Same text, or same number within the tolerance; two NULLs are equal."""
    a, b = _col(a), _col(b)
    close = F.abs(plain_double(a) - plain_double(b)) < tolerance
    return a.cast("string").eqNullSafe(b.cast("string")) | F.coalesce(close, F.lit(False))


def display_number(c: Column | str) -> Column:
    """Numbers with five or more decimals shown with two; anything else as it is."""
    text = _col(c).cast("string")
    short = F.format_string("%.2f", F.round(text.try_cast("double"), 2))
    return F.when(text.rlike(r"^-?\d+\.\d{5,}\z"), short).otherwise(text)
