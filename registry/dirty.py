"""The ``dirty`` table: every order as text, with dirt at fixed places, and its SQL twin."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright import ColumnRule, CrossRule, Rules
from tablewright.constants import ROW_ID
from tablewright.tables import materialize

COLUMNS = ("order_id", "customer_id", "status", "priority", "order_date", "order_period", "order_year",
           "total_price", "note")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Where an application has written the dirty table of each data folder.
_WRITTEN: dict[tuple[str, str], DataFrame] = {}


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with missing tokens, case variants, mixed dates, broken numbers, copies and key conflicts.

    Written once for an application and data folder, as nearly all queries scan it, most of them often.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _WRITTEN:
        _WRITTEN[key] = materialize(_dirty(spark, sf_dir), "dirty")
    return _WRITTEN[key]


def _dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, key = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    copies = {0: F.lit(True), 1: key % 200 == 1, 2: key % 300 == 2}  # every order, and some of them once more
    o = reduce(DataFrame.unionByName, [orders.where(some).withColumn("copy", F.lit(i)) for i, some in copies.items()])
    # Dealt to two tasks a core before they are spelled out: an order is half as wide as its texts.
    o = o.repartition(2 * spark.sparkContext.defaultParallelism, "o_orderkey")
    k, date = F.col("o_orderkey"), F.to_date("o_orderdate").cast("string")
    price = F.col("o_totalprice").cast("decimal(15,2)").cast("string")
    return o.select(
        (k * 10 + F.col("copy")).alias(ROW_ID),
        F.concat(F.lit("ORD-"), F.lpad(k.cast("string"), 9, "0")).alias("order_id"),
        F.when(k % 50 == 7, "?").otherwise(F.col("o_custkey").cast("string")).alias("customer_id"),
        F.when(F.col("copy") == 2, "Z").when(k % 97 == 3, "N.D.").when(k % 11 == 2, F.lower("o_orderstatus"))
         .otherwise(F.col("o_orderstatus")).alias("status"),
        F.when(k % 53 == 5, "-").when(k % 5000 == 17, "X-RARE").otherwise(F.col("o_orderpriority")).alias("priority"),
        F.when(k % 1009 == 8, "not-a-date").when(k % 17 == 4, F.date_format("o_orderdate", "dd/MM/yyyy"))
         .otherwise(date).alias("order_date"),
        F.substring(date, 1, 7).alias("order_period"),
        (F.year("o_orderdate") + F.when(k % 61 == 5, 1).otherwise(0)).cast("string").alias("order_year"),
        F.when(k % 31 == 6, F.concat(price, F.lit(" EUR"))).when(k % 41 == 9, F.concat(F.lit("€ "), price))
         .when(k % 101 == 12, F.concat(F.lit("-"), price)).when(k % 211 == 13, "abc")
         .when(k % 499 == 14, (F.col("o_totalprice").cast("decimal(15,2)") * 100).cast("decimal(17,2)").cast("string"))
         .otherwise(price).alias("total_price"),
        F.when(k % 100 == 0, "checked").alias("note"))


DIRTY_SQL = """
base AS (
  SELECT o_orderkey AS k,
    'ORD-' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') AS order_id,
    CASE WHEN o_orderkey % 50 = 7 THEN '?' ELSE CAST(o_custkey AS VARCHAR) END AS customer_id,
    CASE WHEN o_orderkey % 97 = 3 THEN 'N.D.' WHEN o_orderkey % 11 = 2 THEN lower(o_orderstatus)
         ELSE o_orderstatus END AS status,
    CASE WHEN o_orderkey % 53 = 5 THEN '-' WHEN o_orderkey % 5000 = 17 THEN 'X-RARE'
         ELSE o_orderpriority END AS priority,
    CASE WHEN o_orderkey % 1009 = 8 THEN 'not-a-date'
         WHEN o_orderkey % 17 = 4 THEN strftime(o_orderdate, '%d/%m/%Y')
         ELSE strftime(o_orderdate, '%Y-%m-%d') END AS order_date,
    strftime(o_orderdate, '%Y-%m') AS order_period,
    CAST(year(o_orderdate) + CASE WHEN o_orderkey % 61 = 5 THEN 1 ELSE 0 END AS VARCHAR) AS order_year,
    CASE WHEN o_orderkey % 31 = 6 THEN CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS VARCHAR) || ' EUR'
         WHEN o_orderkey % 41 = 9 THEN '€ ' || CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS VARCHAR)
         WHEN o_orderkey % 101 = 12 THEN '-' || CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS VARCHAR)
         WHEN o_orderkey % 211 = 13 THEN 'abc'
         WHEN o_orderkey % 499 = 14 THEN
           CAST(CAST(CAST(o_totalprice AS DECIMAL(15,2)) * 100 AS DECIMAL(17,2)) AS VARCHAR)
         ELSE CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS VARCHAR) END AS total_price,
    CASE WHEN o_orderkey % 100 = 0 THEN 'checked' END AS note
  FROM orders),
dirty AS (
  SELECT k * 10 AS row_id, order_id, customer_id, status, priority, order_date, order_period, order_year,
         total_price, note FROM base
  UNION ALL
  SELECT k * 10 + 1, order_id, customer_id, status, priority, order_date, order_period, order_year,
         total_price, note FROM base WHERE k % 200 = 1
  UNION ALL
  SELECT k * 10 + 2, order_id, customer_id, 'Z', priority, order_date, order_period, order_year,
         total_price, note FROM base WHERE k % 300 = 2)
"""

# Long form: one row per cell, text stripped.
CELLS_SQL = """
cells AS (
  SELECT row_id, col AS "column", val AS value, trim(val, ' ' || chr(9) || chr(10) || chr(13)) AS text
  FROM dirty UNPIVOT INCLUDE NULLS (val FOR col IN (
    order_id, customer_id, status, priority, order_date, order_period, order_year, total_price, note)))
"""

TOKENS_SQL = ("('n.d.','nd','n/a','null','none','?','-','//','unknown','na','missing','',' ')")
POSITION_SQL = "list_position(['" + "','".join(COLUMNS) + "'], \"column\") - 1"


def disguised_sql(text: str) -> str:
    return f"coalesce(lower(trim({text})) IN {TOKENS_SQL}, false)"


def present_sql(text: str) -> str:
    return f"coalesce(trim({text}) <> '' AND lower(trim({text})) NOT IN {TOKENS_SQL}, false)"


def number_sql(text: str) -> str:
    """Loose number parse. The test data has no thousands dots, which this form leaves out."""
    kept = f"regexp_replace(replace(trim({text}), ',', '.'), '[^0-9.\\-]', '', 'g')"
    return f"try_cast(CASE WHEN regexp_matches({text}, '[0-9]') THEN {kept} END AS DOUBLE)"


def stamp_sql(text: str) -> str:
    """Date parse of the layouts the dirty table uses."""
    t = f"trim({text})"
    return (f"CASE WHEN regexp_full_match({t}, '\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}') THEN try_strptime({t}, '%Y-%m-%d') "
            f"WHEN regexp_full_match({t}, '\\d{{1,2}}/\\d{{1,2}}/\\d{{4}}') THEN try_strptime({t}, '%d/%m/%Y') "
            f"WHEN regexp_full_match({t}, '\\d{{4}}-\\d{{2}}') THEN try_strptime({t} || '-01', '%Y-%m-%d') "
            f"WHEN regexp_full_match({t}, '\\d{{1,2}}-\\d{{1,2}}-\\d{{4}}') THEN try_strptime({t}, '%d-%m-%Y') END")


def with_dirty(body: str, *extra: str) -> str:
    return "WITH " + ", ".join((DIRTY_SQL.strip(), *[e.strip() for e in extra])) + "\n" + body


def dirty_rules() -> Rules:
    """Rules of the dirty table as a user would write them; the same ones discovery finds,
    with the order id as the one business key."""
    text = ("numeric", "numeric", "string", "string", "date", "date", "numeric", "numeric", "string")
    kinds = {"order_date": "date", "order_period": "period"}
    minimum = {"customer_id": 0.0, "order_year": 0.0, "total_price": 0.0}
    rules = [ColumnRule(c, i, t, kinds.get(c), c != "note", minimum.get(c),
                        ("€",) if c == "total_price" else (), 1 if c == "order_id" else None)
             for i, (c, t) in enumerate(zip(COLUMNS, text))]
    return Rules(tuple(rules), (CrossRule("year_matches", ("order_date", "order_year")),))
