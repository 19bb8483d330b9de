"""Events, corruption, detection quality, reading and writing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registry.base import query
from registry.dirty import CELLS_SQL, COLUMNS, dirty, dirty_rules, stamp_sql, table, with_dirty
from registry.profile_queries import FACTS_SQL
from tablewright.constants import ROW_ID
from tablewright.operators import corrupt as co
from tablewright.operators import evaluate as ev
from tablewright.operators import events as et
from tablewright.operators.report import cell_diff
from tablewright.operators.rules import ColumnRule, CrossRule, Rules
from tablewright.sources import read_csv, write_fixed
from tablewright.tables import new_path

EVENT = "error_type, issue_type, columns, event_key, row_id"


def _events(events: DataFrame) -> DataFrame:
    return events.select("error_type", "issue_type", "columns", "event_key", "row_id")


def cell_events(family: str, issue: str, columns: str, source: str) -> str:
    return (f"SELECT '{family}' AS error_type, {issue} AS issue_type, {columns} AS columns, CAST(row_id AS VARCHAR) AS event_key, "
            f"row_id FROM {source}")


NUMS_SQL = """
nums AS (SELECT row_id, "column", num, low FROM flags JOIN (VALUES ('order_id', NULL::DOUBLE), ('customer_id', 0.0),
  ('order_year', 0.0), ('total_price', 0.0)) v(c, low) ON c = "column"),
fences AS (SELECT "column", quantile_cont(num, 0.25) AS q1, quantile_cont(num, 0.75) AS q3 FROM nums GROUP BY "column"
  HAVING count(num) >= 8 AND count(DISTINCT num) >= 4)"""
OUTSIDE = ('nums JOIN fences USING ("column") WHERE q1 <> q3 AND num NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)')
LABELLED = """
labelled AS (SELECT row_id, 'order_date' AS "column", CASE WHEN order_date LIKE '%/%' THEN 'dd/mm/yyyy'
  WHEN regexp_full_match(order_date, '\\d{4}-\\d{2}-\\d{2}') THEN 'yyyy-mm-dd' ELSE 'invalid' END AS label FROM dirty)"""

EVENT_SQL = {
    "disguisednull": cell_events(
        "disguisednull", "CASE WHEN \"column\" = 'note' THEN 'missing_optional_values' ELSE 'missing_mandatory_values' END",
        '"column"', "flags WHERE gone"),
    "iqr_outlier": cell_events("iqr_outlier", "'iqr_outliers'", '"column"', OUTSIDE),
    "wrong_but_parseable": cell_events("wrong_but_parseable", "'value_below_minimum'", '"column"', "nums WHERE num < low"),
    "mixed_date_format": cell_events(
        "mixed_date_format", "CASE WHEN label = 'invalid' THEN 'invalid_format_values' ELSE 'mixed_format_family' END",
        '"column"', "labelled WHERE label <> 'yyyy-mm-dd'"),
    "semantic_duplicate": """SELECT 'semantic_duplicate' AS error_type, 'duplicate_business_keys' AS issue_type, 'order_id' AS columns,
      '{"order_id":"' || order_id || '"}' AS event_key, row_id FROM dirty
      QUALIFY count(*) OVER (PARTITION BY order_id) > 1""",
    "crossfield_inconsistency": cell_events(
        "crossfield_inconsistency", "'year_date_mismatch'", "'order_date,order_year'",
        f"dirty WHERE year({stamp_sql('order_date')}) <> CAST(order_year AS INTEGER)"),
}


def with_flags(body: str, *extra: str) -> str:
    return with_dirty(body, CELLS_SQL, FACTS_SQL, NUMS_SQL, LABELLED, *extra)


def _register(family):
    @query(f"events_{family}", with_flags(EVENT_SQL[family]))
    def run(spark, sf):
        return _events(et.DETECTORS[family](dirty(spark, sf), "dirty", dirty_rules()))


for _family in EVENT_SQL:
    _register(_family)


@query("events_summary", with_flags(
    "SELECT 'dirty' AS dataset, error_type, issue_type, columns, count(DISTINCT event_key) AS events, count(*) AS members FROM ("
    + " UNION ALL ".join(f"({s})" for s in EVENT_SQL.values()) + ") GROUP BY ALL"))
def events_summary(spark, sf):
    return et.event_summary(et.detect_events(dirty(spark, sf), "dirty", dirty_rules()))


@query("events_hot_key", """
SELECT event_type AS event_key, count(*) AS members, min(event_id) AS first_row, max(event_id) AS last_row FROM events
GROUP BY event_type HAVING count(*) > 1""")
def events_hot_key(spark, sf):
    """Five keys own all rows: groups stay spread over tasks and are never gathered."""
    e = table(spark, sf, "events").select(F.col("event_id").alias(ROW_ID), "event_type")
    rules = Rules((ColumnRule("event_type", key_rank=1),))
    found = et.key_conflict_events(e, "events", rules)
    return found.groupBy(F.get_json_object("event_key", "$.event_type").alias("event_key")).agg(
        F.count("*").alias("members"), F.min("row_id").alias("first_row"), F.max("row_id").alias("last_row"))


# ---------------------------------------------------------------- corruption of clean orders

def clean(spark, sf) -> DataFrame:
    """Orders as clean text."""
    o = table(spark, sf, "orders")
    return o.select(
        F.col("o_orderkey").alias(ROW_ID), F.concat(F.lit("ORD-"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0")).alias("order_id"),
        F.col("o_orderstatus").alias("status"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"),
        F.year("o_orderdate").cast("string").alias("order_year"),
        F.col("o_totalprice").cast("decimal(15,2)").cast("string").alias("total_price"))


def clean_rules() -> Rules:
    return Rules((ColumnRule("order_id", 0, "string", None, True, key_rank=1), ColumnRule("status", 1, "string", None, True),
                  ColumnRule("order_date", 2, "date", "date", True), ColumnRule("order_year", 3, "numeric", None, True, 0.0),
                  ColumnRule("total_price", 4, "numeric", None, True, 0.0)),
                 (CrossRule("year_matches", ("order_date", "order_year")),))


CLEAN_SQL = """
clean AS (SELECT o_orderkey AS row_id, 'ORD-' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') AS order_id, o_orderstatus AS status,
  strftime(o_orderdate, '%Y-%m-%d') AS order_date, CAST(year(o_orderdate) AS VARCHAR) AS order_year,
  CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS VARCHAR) AS total_price FROM orders)"""
TEXT_COLUMNS = ("order_id", "status", "order_date", "order_year", "total_price")
RATE, SEED = 0.05, 7


def mix_sql(seed: int) -> str:
    p, m = co.PRIME, co.MULTIPLIER
    once = f"((row_id % {p}) * {m} + {(seed * co.STREAM + 1) % p}) % {p}"
    return f"((({once}) * {m} + 12345) % {p})"


def hit_sql(slot: int, slots: int) -> str:
    width = int(RATE * co.PRIME) // slots
    return f"{mix_sql(SEED)} >= {slot * width} AND {mix_sql(SEED)} < {(slot + 1) * width}"


def _union(parts) -> str:
    return "WITH " + CLEAN_SQL.strip() + " " + " UNION ALL ".join(parts)


CORRUPTED_SQL = {
    "disguisednull": _union(
        f"SELECT row_id, '{c}' AS \"column\", {c} AS raw, 'N.D.' AS fixed FROM clean WHERE {hit_sql(i, 5)}"
        for i, c in enumerate(TEXT_COLUMNS)),
    "iqr_outlier": _union(
        f"SELECT row_id, '{c}' AS \"column\", {c} AS raw, CAST(CAST((SELECT max(abs(CAST({c} AS DECIMAL(18,2)))) FROM clean) * 100 "
        f"+ 1000000 AS DECIMAL(18,2)) AS VARCHAR) AS fixed FROM clean WHERE {hit_sql(i, 2)}"
        for i, c in enumerate(("order_year", "total_price"))),
    "wrong_but_parseable": _union(
        f"SELECT row_id, '{c}' AS \"column\", {c} AS raw, CAST(-greatest(1.00, abs(CAST({c} AS DECIMAL(18,2)))) AS VARCHAR) AS fixed "
        f"FROM clean WHERE {hit_sql(i, 2)}" for i, c in enumerate(("order_year", "total_price"))),
    "mixed_date_format": _union([
        "SELECT row_id, 'order_date' AS \"column\", order_date AS raw, strftime(strptime(order_date, '%Y-%m-%d'), '%d/%m/%Y') AS fixed "
        f"FROM clean WHERE {hit_sql(0, 1)}"]),
    "crossfield_inconsistency": _union([
        "SELECT row_id, 'order_year' AS \"column\", order_year AS raw, CAST(CAST(order_date[1:4] AS INTEGER) + 1 AS VARCHAR) AS fixed "
        f"FROM clean WHERE {hit_sql(0, 1)}"]),
    "semantic_duplicate": "WITH " + CLEAN_SQL.strip() + f""",
      mixed AS (SELECT *, {mix_sql(SEED)} % greatest(1, CAST(floor((SELECT count(*) FROM clean) * {RATE}) AS BIGINT)) AS bucket,
        {mix_sql(SEED + 1)} AS ord FROM clean),
      pairs AS (SELECT bucket, arg_min(row_id, ord) AS src, arg_min(order_id, ord) AS key, arg_max(row_id, ord) AS dst
        FROM mixed GROUP BY bucket)
      SELECT row_id, 'order_id' AS "column", order_id AS raw, key AS fixed FROM clean JOIN pairs ON row_id = dst WHERE src <> dst
      UNION ALL SELECT row_id, 'status', status, status || '_alt' FROM clean JOIN pairs ON row_id = dst WHERE src <> dst""",
}


def _register_corruption(family):
    @query(f"corrupt_{family}", CORRUPTED_SQL[family])
    def run(spark, sf):
        df = clean(spark, sf)
        bad, _ = co.corrupt(df, "orders", clean_rules(), family, RATE, SEED)
        return cell_diff(df, bad).withColumnRenamed(ROW_ID, "row_id")


for _family in CORRUPTED_SQL:
    _register_corruption(_family)


def lines(spark, sf) -> DataFrame:
    """Orders with cross-column facts of every kind."""
    day, quantity = F.date_format("o_orderdate", "yyyy-MM-dd"), F.col("o_custkey") % 50 + 1
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias(ROW_ID), quantity.cast("string").alias("quantity"), F.lit("7").alias("price"),
        (quantity * 7).cast("string").alias("total"), day.alias("ordered"), day.alias("shipped"),
        F.date_format("o_orderdate", "yyyy-MM").alias("period"), F.year("o_orderdate").cast("string").alias("year"),
        F.month("o_orderdate").cast("string").alias("month"), F.lit("1").alias("least"), F.lit("100").alias("most"))


LINE_RULES = Rules(cross=(CrossRule("le", ("least", "most")), CrossRule("product_matches", ("total", "quantity", "price")),
                          CrossRule("date_order", ("ordered", "shipped")), CrossRule("period_matches", ("period", "year", "month"))))
LINES_SQL = """
lines AS (SELECT o_orderkey AS row_id, o_custkey % 50 + 1 AS q, o_orderdate AS d FROM orders)"""


@query("corrupt_every_cross_rule", "WITH " + LINES_SQL.strip() + f"""
SELECT row_id, 'least' AS "column", '1' AS raw, '210.00' AS fixed FROM lines WHERE {hit_sql(0, 4)}
UNION ALL SELECT row_id, 'total', CAST(q * 7 AS VARCHAR), CAST(CAST(q * 7 * 1.5 + 1 AS DECIMAL(18,2)) AS VARCHAR) FROM lines WHERE {hit_sql(1, 4)}
UNION ALL SELECT row_id, 'ordered', strftime(d, '%Y-%m-%d'), strftime(d + INTERVAL 30 DAY, '%Y-%m-%d') FROM lines WHERE {hit_sql(2, 4)}
UNION ALL SELECT row_id, 'month', CAST(month(d) AS VARCHAR), CASE WHEN month(d) <> 1 THEN '1' ELSE '2' END FROM lines WHERE {hit_sql(3, 4)}""")
def corrupt_every_cross_rule(spark, sf):
    """Count, product, date order and period rules each take a quarter of the chosen rows."""
    df = lines(spark, sf)
    bad, _ = co.corrupt(df, "lines", LINE_RULES, "crossfield_inconsistency", RATE, SEED)
    return cell_diff(df, bad).withColumnRenamed(ROW_ID, "row_id")


@query("evaluate_every_cross_rule", "WITH " + LINES_SQL.strip() + f"""
, hit AS (SELECT count(*) AS n FROM lines WHERE {hit_sql(0, 4)} OR {hit_sql(1, 4)} OR {hit_sql(2, 4)} OR {hit_sql(3, 4)})
SELECT family, n AS tp, 0::BIGINT AS fp, 0::BIGINT AS fn FROM hit, (VALUES ('crossfield_inconsistency'), ('overall')) v(family)""")
def evaluate_every_cross_rule(spark, sf):
    """The detector finds what was broken, and nothing else."""
    found = ev.evaluate(lines(spark, sf), "lines", LINE_RULES, ["crossfield_inconsistency"], RATE, SEED)[0]
    return found.select("family", "tp", "fp", "fn")


@query("corrupt_truth", "WITH " + CLEAN_SQL.strip() + " SELECT error_type, columns, count(*) AS members FROM (" + " UNION ALL ".join(
    f"SELECT 'disguisednull' AS error_type, '{c}' AS columns FROM clean WHERE {hit_sql(i, 5)}" for i, c in enumerate(TEXT_COLUMNS))
    + ") GROUP BY ALL")
def corrupt_truth(spark, sf):
    _, truth = co.corrupt(clean(spark, sf), "orders", clean_rules(), "disguisednull", RATE, SEED)
    return truth.groupBy("error_type", "columns").agg(F.count("*").alias("members"))


# ---------------------------------------------------------------- detection quality

def perfect(family: str, found: str) -> str:
    """Metrics when every corrupted cell, and nothing else, is found."""
    return (f"SELECT family, n AS tp, 0::BIGINT AS fp, 0::BIGINT AS fn, 1.0::DOUBLE AS \"precision\", 1.0::DOUBLE AS recall, "
            f"1.0::DOUBLE AS f1 FROM (SELECT count(*) AS n FROM ({found})), (VALUES ('{family}'), ('overall')) v(family)")


@query("evaluate_disguisednull", perfect("disguisednull", CORRUPTED_SQL["disguisednull"]))
def evaluate_disguisednull(spark, sf):
    return ev.evaluate(clean(spark, sf), "orders", clean_rules(), ["disguisednull"], RATE, SEED, ["disguisednull"])[0]


@query("evaluate_mixed_date_format", perfect("mixed_date_format", CORRUPTED_SQL["mixed_date_format"]))
def evaluate_mixed_date_format(spark, sf):
    return ev.evaluate(clean(spark, sf), "orders", clean_rules(), ["mixed_date_format"], RATE, SEED, ["mixed_date_format"])[0]


@query("evaluate_semantic_duplicate", perfect(
    "semantic_duplicate", CORRUPTED_SQL["semantic_duplicate"].split("UNION ALL SELECT row_id, 'status'")[0]))
def evaluate_semantic_duplicate(spark, sf):
    return ev.evaluate(clean(spark, sf), "orders", clean_rules(), ["semantic_duplicate"], RATE, SEED, ["semantic_duplicate"])[0]


@query("evaluate_no_op", "SELECT family, 0::BIGINT AS tp, 0::BIGINT AS fp, n AS fn, 0.0::DOUBLE AS \"precision\", 0.0::DOUBLE AS recall, "
       "0.0::DOUBLE AS f1 FROM (SELECT count(*) AS n FROM (" + CORRUPTED_SQL["wrong_but_parseable"]
       + ")), (VALUES ('wrong_but_parseable'), ('overall')) v(family)")
def evaluate_no_op(spark, sf):
    """The floor: a detector that finds nothing."""
    return ev.evaluate(clean(spark, sf), "orders", clean_rules(), ["wrong_but_parseable"], RATE, SEED, detect=ev.no_op_events)[0]


@query("naive_events", with_dirty(f"""
SELECT error_type, columns, count(*) AS events FROM (
  SELECT 'disguisednull' AS error_type, "column" AS columns FROM cells WHERE value IS NULL
  UNION ALL SELECT 'wrong_but_parseable', "column" FROM cells WHERE "column" IN ('order_id', 'customer_id', 'order_year', 'total_price')
    AND value IS NOT NULL AND try_cast(value AS DOUBLE) IS NULL) GROUP BY ALL""", CELLS_SQL))
def naive_events(spark, sf):
    """The naive baseline: real NULLs and strict number casts only."""
    found = ev.naive_events(dirty(spark, sf), "dirty", dirty_rules())
    return found.groupBy("error_type", "columns").agg(F.count("*").alias("events"))


@query("clean_sample", "WITH " + CLEAN_SQL.strip() + f" SELECT row_id, order_id FROM clean ORDER BY {mix_sql(42)}, row_id LIMIT 500")
def clean_sample(spark, sf):
    return ev.clean_sample(clean(spark, sf), 500, 42).select(F.col(ROW_ID).alias("row_id"), "order_id")


# ---------------------------------------------------------------- reading and writing

@query("csv_round_trip", with_dirty("SELECT " + ", ".join(
    f"CASE WHEN {c} IN ('', 'N/A', 'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null') THEN NULL ELSE {c} END AS {c}" for c in COLUMNS)
    + " FROM dirty"))
def csv_round_trip(spark, sf):
    """Written as CSV by the executors, read back as text."""
    path = new_path(spark, "csv")
    write_fixed(dirty(spark, sf), path, "csv")
    return read_csv(spark, path).data


@query("documents_csv_round_trip", """
SELECT doc_id::VARCHAR AS doc_id, md5(text) AS text_md5, lang FROM documents""")
def documents_csv_round_trip(spark, sf):
    """Whole texts with quotes and line breaks survive the trip through CSV."""
    path = new_path(spark, "csv")
    write_fixed(table(spark, sf, "documents").select("doc_id", "text", "lang"), path, "csv")
    return read_csv(spark, path, multi_line=True).data.select("doc_id", F.md5("text").alias("text_md5"), "lang")

