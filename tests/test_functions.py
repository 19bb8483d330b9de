import datetime

import pytest
from pyspark.sql import functions as F

from tablewright.functions import temporal as tp
from tablewright.functions.numeric import parse_number_currency, parse_number_loose
from tablewright.functions.text import display_number, is_disguised, is_present, title_case, values_equivalent


def apply(spark, values, build):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r["x"] for r in df.select("i", build(F.col("v")).alias("x")).orderBy("i").collect()]


def test_loose_numbers(spark):
    cases = {"1.234,56": 1234.56, "12.345.678": 12345678.0, "52.87 EUR": 52.87, "05/03/2024": 5032024.0, "1e5": 15.0,
             "1-2": None, "1,234.5": None, "€ 12,5": 12.5, "-3": -3.0, "--3": None, "abc": None, "": None, "nan": None,
             "12.345": 12345.0, "1.5": 1.5, " 7 ": 7.0, "3 pcs": 3.0, "ORD-0012": -12.0, ".": None, "5-": None,
             "-.5": -0.5, "1.": 1.0, None: None, "1.2.3": None, "x1.234x567": 1234567.0}
    assert dict(zip(cases, apply(spark, cases, parse_number_loose))) == cases


def test_currency_numbers(spark):
    cases = {"€ 12,5": 12.5, "$3": 3.0, "£1e3": 1000.0, "52.87 EUR": None, "1.234,56": None, "1f": None, "NaN": None}
    assert dict(zip(cases, apply(spark, cases, parse_number_currency))) == cases


def test_presence(spark):
    values = ["a", " ", "", None, "N.D.", " Null ", "--", "\tna\n", "0"]
    assert apply(spark, values, is_present) == [True, False, False, False, False, False, True, False, True]
    assert apply(spark, values, is_disguised) == [False, True, True, False, True, True, False, True, False]


def test_title_and_display(spark):
    assert apply(spark, ["o'neil", "abc-def", "a1b", "città è", None], title_case) == [
        "O'Neil", "Abc-Def", "A1B", "Città È", None]
    assert apply(spark, ["182904.47999999954", "1.2345", "-3.000001", "x"], display_number) == [
        "182904.48", "1.2345", "-3.00", "x"]


def test_equivalence(spark):
    df = spark.createDataFrame([("72", "72.0"), ("a", "a"), ("a", "b"), (None, None), ("1", None)], "a string, b string")
    assert [r[0] for r in df.select(values_equivalent("a", "b")).collect()] == [True, True, False, True, False]


@pytest.mark.parametrize("text,expected", [
    ("2024-03-05", (2024, 3, 5)), ("2024-3-5", (2024, 3, 5)), ("05/03/2024", (2024, 3, 5)), ("5/3/2024", (2024, 3, 5)),
    ("05-03-24", (2024, 3, 5)), ("05-03-70", (1970, 3, 5)), ("05-03-2024", (2024, 3, 5)), ("5 Mar 2024", (2024, 3, 5)),
    ("17 GEN 2025", (2025, 1, 17)), ("March 5, 2024", (2024, 3, 5)), ("Sept. 5 2024", (2024, 9, 5)),
    ("2024-03", (2024, 3, 1)), ("03/2024", (2024, 3, 1)), ("2024/03", (2024, 3, 1)), ("2024-02-30", None),
    ("17/17/2024", None), ("5 Foo 2024", None), ("not-a-date", None), ("2024", None), ("", None), ("12345678", None)])
def test_dates(spark, text, expected):
    stamp = apply(spark, [text], tp.parse_timestamp)[0]
    assert stamp == (None if expected is None else datetime.datetime(*expected))


def test_date_times(spark):
    texts = ["2024-03-05T10:20:30Z", "2024-03-05 10:20", "05/03/2024 10:20:30", "Mar 5, 2024 10:20", "2024-03-05T10:20:30.25"]
    assert apply(spark, texts, tp.parse_timestamp) == [
        datetime.datetime(2024, 3, 5, 10, 20, 30), datetime.datetime(2024, 3, 5, 10, 20),
        datetime.datetime(2024, 3, 5, 10, 20, 30), datetime.datetime(2024, 3, 5, 10, 20),
        datetime.datetime(2024, 3, 5, 10, 20, 30, 250000)]


@pytest.mark.parametrize("kind,cases", [
    ("year", {"2024": "yyyy", "1824": "invalid", "24": "invalid", "N.D.": "missing"}),
    ("month", {"1": "m_or_mm", "01": "m_or_mm", "13": "invalid", "0": "invalid"}),
    ("period", {"2024-01": "yyyy-mm", "01/2024": "mm/yyyy", "2024/01": "yyyy/mm", "2024-01-01": "invalid"}),
    ("date", {"2024-01-05": "yyyy-mm-dd", "05/01/2024": "dd/mm/yyyy", "5 Jan 2024": "other_parseable_date",
              "x": "invalid", "": "missing"}),
    ("datetime", {"2024-01-05T10:20": "iso_datetime", "2024-01-05 10:20:30.5": "iso_datetime", "05/01/2024": "eu_datetime",
                  "Jan 5, 2024 10:20": "us_textual_datetime", "2024-01-05": "other_parseable_datetime", "x": "invalid"}),
    ("other", {"x": "unknown"})])
def test_format_labels(spark, kind, cases):
    assert dict(zip(cases, apply(spark, cases, lambda c: tp.classify_format(c, kind)))) == cases


def test_alternative_layouts(spark):
    assert apply(spark, ["2024-03-05", "05/03/2024", "?"], lambda c: tp.render_alternative(c, "date")) == [
        "05/03/2024", "2024-03-05", None]
    assert apply(spark, ["2024-03", "03/2024"], lambda c: tp.render_alternative(c, "period")) == ["03/2024", "2024-03"]
    assert apply(spark, ["3", "03", "12"], lambda c: tp.render_alternative(c, "month")) == ["03", "3", "12"]
    assert apply(spark, ["2024-03-05 10:20:30", "05/03/2024 10:20"], lambda c: tp.render_alternative(c, "datetime")) == [
        "05/03/2024 10:20", "2024-03-05 10:20:00"]
