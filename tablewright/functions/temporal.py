"""Dates, periods and their layouts.

The layout of a cell is its text with every digit written as 9, so that most tests are string
comparisons instead of regular expressions. One layout is tried per value: it is rewritten to
ISO and a single ``try_cast`` parses it. ISO text is always year-month-day, slashed text
day-first. Functions that take a ``shape`` accept a layout
column computed before, and then ``c`` must be stripped text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tablewright.constants import MONTHS
from tablewright.functions.text import _col, as_text, constant_map, is_present

# ---- Fixed values: layouts that carry a label of their own -------------------
MONTH_TEXTS = ("1", "2", "3", "4", "5", "6", "7", "8", "9", "01", "02", "03", "04", "05", "06",
               "07", "08", "09", "10", "11", "12")
PERIODS = ("9999-99", "99/9999", "9999/99")
DATE_ISO, DATE_EU = "9999-99-99", "99/99/9999"
DATETIME_ISO = ("9999-99-99T99:99", "9999-99-99 99:99", "9999-99-99T99:99:99", "9999-99-99 99:99:99")
DATETIME_EU = ("99/99/9999", "99/99/9999 99:99", "99/99/9999 99:99:99")
DATETIME_ISO_FRACTION = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}\.\d+\z"
DATETIME_US = r"^[A-Za-z]{3,9}\.?\s+\d{1,2},?\s+\d{4}( \d{2}:\d{2}(:\d{2})?)?\z"
# ---- End of fixed values ------------------------------------------------------

# Layouts read without a regular expression.
_ISO_DATES = ("9999-99-99", "9999-9-9", "9999-9-99", "9999-99-9")
_SLASHED_DATES = ("99/99/9999", "9/99/9999", "99/9/9999", "9/9/9999")
_DASHED_DATES = ("99-99-9999", "9-99-9999", "99-9-9999", "9-9-9999", "99-99-99", "9-99-99", "99-9-99", "9-9-99")
# Everything else that may be a date has a clock, a zone or a month name.
# Digits of a second beyond the sixth are read over.
_TIME = r"(\d{1,2}:\d{2}(?::\d{2}(?:\.\d{1,6})?)?)\d*"
_RARE = r"^(\d{1,4}[-/]\d{1,2}[-/]\d{1,4}[T ]|\d{1,2}\s+[A-Za-z]{3}|[A-Za-z]{3,9}\.?\s+\d)"
_ISO_TIME = rf"^(\d{{4}})-(\d{{1,2}})-(\d{{1,2}})[T ]{_TIME}(?:Z|[+-]\d{{2}}:?\d{{2}})?\z"
_EU_TIME = rf"^(\d{{1,2}})/(\d{{1,2}})/(\d{{4}}) {_TIME}\z"
_DAY_NAME = rf"^(\d{{1,2}})\s+([A-Za-z]{{3,9}})\.?,?\s+(\d{{4}})(?: {_TIME})?\z"
_NAME_DAY = rf"^([A-Za-z]{{3,9}})\.?\s+(\d{{1,2}}),?\s+(\d{{4}})(?: {_TIME})?\z"


def layout(c: Column | str, stripped: bool = False) -> Column:
    """Text with every digit as 9; NULL unless it starts with a digit."""
    text = _col(c) if stripped else as_text(c)
    return F.when(F.ascii(text).between(48, 57), F.translate(text, "0123456789", "9999999999"))


def _text_and_shape(c: Column | str, shape: Column | None) -> tuple[Column, Column]:
    return (as_text(c), layout(c)) if shape is None else (_col(c), shape)


def is_year(c: Column | str, shape: Column | None = None) -> Column:
    """Four digits of this or the last century."""
    text, shape = _text_and_shape(c, shape)
    return (shape == "9999") & (text.startswith("19") | text.startswith("20"))


def is_month(text: Column) -> Column:
    """Month number with or without a leading zero; takes stripped text."""
    return text.isin(*MONTH_TEXTS)


def is_period(shape: Column) -> Column:
    return shape.isin(*PERIODS)


def is_plain_date(shape: Column) -> Column:
    return shape.isin(DATE_ISO, DATE_EU)


def _named(text: Column, pattern: str, day: int, name: int) -> Column:
    """ISO text of a date with a month name; NULL when it names no month."""
    month = F.try_element_at(constant_map(MONTHS), F.lower(F.regexp_extract(text, pattern, name)))
    date = F.concat(F.regexp_extract(text, pattern, 3), F.lit("-"), month.cast("string"), F.lit("-"),
                    F.regexp_extract(text, pattern, day))
    return F.concat(date, F.lit(" "), F.regexp_extract(text, pattern, 4))


def _parts(text: Column, separator: str) -> list[Column]:
    """Third, second and first field."""
    return [F.split_part(text, F.lit(separator), F.lit(i)) for i in (3, 2, 1)]


def parse_timestamp(c: Column | str, shape: Column | None = None) -> Column:
    """Text to a time-zone-free timestamp, NULL when no known layout fits."""
    text, shape = _text_and_shape(c, shape)
    year, month, day = _parts(text, "-")
    short = F.concat_ws("-", F.concat(F.when(year < "69", "20").otherwise("19"), year), month, day)
    rare = (F.when(text.rlike(_ISO_TIME), F.regexp_replace(text, _ISO_TIME, "$1-$2-$3 $4"))
             .when(text.rlike(_EU_TIME), F.regexp_replace(text, _EU_TIME, "$3-$2-$1 $4"))
             .when(text.rlike(_DAY_NAME), _named(text, _DAY_NAME, day=1, name=2))
             .when(text.rlike(_NAME_DAY), _named(text, _NAME_DAY, day=2, name=1)))
    iso = (F.when(shape.isin(*_ISO_DATES, *DATETIME_ISO), text)
            .when(shape.isin(*_SLASHED_DATES), F.concat_ws("-", *_parts(text, "/")))
            .when(shape == "9999-99", F.concat(text, F.lit("-01")))
            .when(shape == "9999/99", F.concat(F.translate(text, "/", "-"), F.lit("-01")))
            .when(shape == "99/9999", F.concat(F.substring(text, 4, 4), F.lit("-"), F.substring(text, 1, 2),
                                               F.lit("-01")))
            .when(shape.isin(*_DASHED_DATES), F.when(F.length(year) == 4, F.concat_ws("-", year, month, day)).otherwise(short))
            .when((F.octet_length(text) >= 8) & text.rlike(_RARE), F.btrim(rare)))
    return iso.try_cast("timestamp_ntz")


def classify_format(c: Column | str, kind: Column | str, stamp: Column | None = None,
                    shape: Column | None = None) -> Column:
    """Label of the layout a cell uses, given the temporal kind of its column.

    ``kind`` is a kind name or a column of kind names; ``stamp`` may pass an already parsed value.
    """
    kind = F.lit(kind) if isinstance(kind, str) else kind
    text, shape = _text_and_shape(c, shape)
    stamp = parse_timestamp(c, shape) if stamp is None else stamp
    date = (F.when(shape == DATE_ISO, "yyyy-mm-dd").when(shape == DATE_EU, "dd/mm/yyyy")
             .when(stamp.isNotNull(), "other_parseable_date").otherwise("invalid"))
    iso_clock = shape.isin(*DATETIME_ISO) | (shape.startswith(DATE_ISO) & text.rlike(DATETIME_ISO_FRACTION))
    datetime = (F.when(iso_clock, "iso_datetime").when(shape.isin(*DATETIME_EU), "eu_datetime")
                 .when(text.rlike(DATETIME_US), "us_textual_datetime")
                 .when(stamp.isNotNull(), "other_parseable_datetime").otherwise("invalid"))
    period = (F.when(shape == "9999-99", "yyyy-mm").when(shape == "99/9999", "mm/yyyy")
               .when(shape == "9999/99", "yyyy/mm").otherwise("invalid"))
    return (F.when(~is_present(c), "missing")
             .when(kind == "year", F.when(is_year(c, shape), "yyyy").otherwise("invalid"))
             .when(kind == "month", F.when(is_month(text), "m_or_mm").otherwise("invalid"))
             .when(kind == "period", period)
             .when(kind == "date", date)
             .when(kind == "datetime", datetime)
             .otherwise("unknown"))


def parse_year(c: Column | str) -> Column:
    """Four-digit year of this or the last century, else NULL."""
    text = as_text(c)
    return F.when(text.rlike(r"^(19|20)[0-9]{2}\z"), text.try_cast("int"))


def parse_year_month(c: Column | str, shape: Column | None = None) -> Column:
    """Period text in any of the three layouts as ``struct(year, month)``, else NULL."""
    text, shape = _text_and_shape(c, shape)
    year = (F.when(shape.isin("9999-99", "9999/99"), F.substring(text, 1, 4))
             .when(shape == "99/9999", F.substring(text, 4, 4)))
    month = F.when(shape == "99/9999", F.substring(text, 1, 2)).otherwise(F.substring(text, 6, 2))
    return F.when(shape.isin(*PERIODS),
                  F.struct(year.cast("int").alias("year"), month.try_cast("int").alias("month")))


def parse_date_year(c: Column | str) -> Column:
    """Year of a parseable date, else NULL."""
    return F.year(parse_timestamp(c))


def render_iso(stamp: Column, kind: str = "date") -> Column:
    """Canonical text of a timestamp for a kind."""
    if kind == "date":
        return stamp.cast("date").cast("string")
    if kind == "datetime":
        return F.date_format(stamp, "yyyy-MM-dd HH:mm:ss")
    return F.substring(stamp.cast("date").cast("string"), 1, {"year": 4, "period": 7}[kind])


def render_alternative(c: Column | str, kind: str, shape: Column | None = None,
                       stamp: Column | None = None) -> Column:
    """The same moment written in another layout of the same kind; NULL when unreadable."""
    stamp = parse_timestamp(c, shape) if stamp is None else stamp
    text, shape = _text_and_shape(c, shape)
    if kind == "date":
        out = F.when(shape == DATE_EU, render_iso(stamp)).otherwise(F.date_format(stamp, "dd/MM/yyyy"))
    elif kind == "period":
        part = parse_year_month(text, shape)
        year, month = F.lpad(part.year.cast("string"), 4, "0"), F.lpad(part.month.cast("string"), 2, "0")
        out = F.when(shape == "99/9999", F.concat_ws("-", year, month)).when(
            part.isNotNull(), F.concat_ws("/", month, year))
    elif kind == "month":
        month = F.when(text.rlike(r"^\d+(\.\d*)?\z"), text.try_cast("double").cast("int")).cast("string")
        out = F.when(F.length(text) == 1, F.lpad(month, 2, "0")).otherwise(month)
    elif kind == "datetime":
        to_iso = shape.isin(*DATETIME_EU) | text.rlike(DATETIME_US)
        out = F.when(to_iso, render_iso(stamp, "datetime")).otherwise(F.date_format(stamp, "dd/MM/yyyy HH:mm"))
    else:
        out = F.when(is_year(text, shape), text)
    return F.when(is_present(c), out)

