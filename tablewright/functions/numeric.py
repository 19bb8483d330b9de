"""Numbers out of dirty text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tablewright.functions.text import PLAIN_NUMBER, _col, as_text

# A clean literal: no thousands dots possible, so the clean-up steps would not change it.
_CLEAN = r"^-?\d+(\.(\d{1,2}|\d{4,}))?\z"
# A clean literal among text that the clean-up drops without looking at it: no other digit, point, comma or minus sign.
_FRAMED = r"^[^0-9.,\-]*+(-?\d++(?:\.(?:\d{1,2}|\d{4,}+))?)[^0-9.,\-]*+\z"
# Only text with a digit and no minus sign after it can clean up to a number.
_CANDIDATE = r"^[^0-9]*[0-9][^-]*\z"
_THOUSANDS_DOT = r"(?<=\d)\.(?=\d{3}(\D|\z))"
# What cleaning leaves that is not one number; cleaned text has digits, points and minus signs only.
_NO_NUMBER = r"^(?!-?(\d+\.?\d*|\.\d+)\z).*\z"


def framed_number(text: Column | str) -> Column:
    """The clean literal of stripped text, also among text that is dropped anyway (`ORD-0012`, `5.20 EUR`); empty without one."""
    return F.regexp_extract(_col(text), _FRAMED, 1)


def parse_number_loose(c: Column | str, stripped: bool = False, framed: Column | None = None) -> Column:
    """Best-effort number: drops the euro sign, spaces, thousands dots and any unit text and
    reads a decimal comma as a point. NULL when what is left is not one number.

    Clean literals skip the clean-up, as all do that ``framed``, a column of ``framed_number``, holds if it is given, and text that cannot become a number is NULL at once, so
    the clean-up runs on dirty cells only and no cast ever fails (a failed cast is slow). Text without
    a point needs one replacement, and what is cleaned is read once: as NaN where it is no number.
    """
    text = _col(c) if stripped else as_text(c)
    dotted = F.regexp_replace(text, r"[€\s\u00a0]+", "")
    dotted = F.regexp_replace(dotted, _THOUSANDS_DOT, "")
    dotted = F.regexp_replace(F.replace(dotted, F.lit(","), F.lit(".")), r"[^0-9.\-]+", "")
    plain = F.replace(F.regexp_replace(text, r"[^0-9,\-]+", ""), F.lit(","), F.lit("."))

    def number(cleaned):
        return F.nanvl(F.regexp_replace(cleaned, _NO_NUMBER, "NaN").try_cast("double"), F.lit(None).cast("double"))

    clean = F.when(text.rlike(_CLEAN), text.try_cast("double")) if framed is None else F.when(framed != "", framed.try_cast("double"))
    return clean.when(text.rlike(_CANDIDATE), F.when(text.contains("."), number(dotted)).otherwise(number(plain)))


def parse_number_currency(c: Column | str) -> Column:
    """Strict number after removing currency symbols and reading a comma as the decimal point."""
    text = F.translate(as_text(F.translate(_col(c).cast("string"), "€$£", "")), ",", ".")
    return F.when(text.rlike(PLAIN_NUMBER), text.try_cast("double"))


def has_currency(c: Column | str) -> Column:
    """True when the text holds a currency symbol."""
    return F.coalesce(_col(c).cast("string").rlike("[€$£]"), F.lit(False))
