"""Corrections, each on the whole dirty table, and runs of plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.base import query

from registry.dirty import COLUMNS, dirty, dirty_rules, number_sql, present_sql, stamp_sql, table, with_dirty
from registry.profile_queries import TITLE_SQL
from tablewright.constants import ROW_ID
from tablewright.operators import fixes as fx
from tablewright.operators import report
from tablewright.operators.checks import AuditOptions
from tablewright.operators.duplicates import drop_duplicates, repeated_hashes
from tablewright.plans.apply import Step, apply_steps, log_frame
from tablewright.plans.run import run_quality

NUM = number_sql("total_price")
QUARTILES = f"""
q AS (SELECT quantile_cont(num, 0.25) AS q1, median(num) AS med, quantile_cont(num, 0.75) AS q3
      FROM (SELECT {NUM} AS num FROM dirty))"""


def fixed(column: str, action: str):
    """Query that applies one action to one column of the dirty table."""
    def run(spark, sf):
        out = fx.fix_column(dirty(spark, sf), column, action, dirty_rules())
        value = F.col(column)
        if dict(out.dtypes)[column] == "double":
            value = F.round(value, 6)
        return out.select(F.col(ROW_ID).alias("row_id"), value.alias(column))
    return run


FIXES = {
    "fix_strip_currency": ("total_price", "strip_currency", with_dirty(
        "SELECT row_id, try_cast(trim(replace(total_price, '€', '')) AS DOUBLE) AS total_price FROM dirty")),
    "fix_cast_numeric": ("total_price", "cast_numeric", with_dirty(
        f"SELECT row_id, {NUM} AS total_price FROM dirty")),
    "fix_impute_median": ("total_price", "impute_median", with_dirty(
        f"SELECT row_id, round(coalesce({NUM}, med), 6) AS total_price FROM dirty CROSS JOIN q", QUARTILES)),
    "fix_impute_mode": ("status", "impute_mode", with_dirty(
        f"""SELECT row_id, CASE WHEN {present_sql('status')} THEN status ELSE m END AS status FROM dirty CROSS JOIN (
        SELECT trim(status) AS m FROM dirty WHERE {present_sql('status')} GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)""")),
    "fix_impute_mode_ids": ("customer_id", "impute_mode", with_dirty(
        f"""SELECT row_id, CASE WHEN {present_sql('customer_id')} THEN customer_id ELSE m END AS customer_id FROM dirty CROSS JOIN (
        SELECT trim(customer_id) AS m FROM dirty WHERE {present_sql('customer_id')} GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)""")),
    "fix_clip_iqr": ("total_price", "clip_iqr", with_dirty(
        f"""SELECT row_id, round(CASE WHEN {NUM} < q1 - 1.5 * (q3 - q1) THEN q1 - 1.5 * (q3 - q1)
        WHEN {NUM} > q3 + 1.5 * (q3 - q1) THEN q3 + 1.5 * (q3 - q1) ELSE {NUM} END, 6) AS total_price
        FROM dirty CROSS JOIN q""", QUARTILES)),
    "fix_clip_to_min": ("total_price", "clip_to_min", with_dirty(
        f"SELECT row_id, CASE WHEN {NUM} < 0 THEN 0.0 ELSE {NUM} END::DOUBLE AS total_price FROM dirty")),
    "fix_normalize_dates": ("order_date", "normalize_dates", with_dirty(
        f"SELECT row_id, coalesce(strftime({stamp_sql('order_date')}, '%Y-%m-%d'), order_date) AS order_date FROM dirty")),
    "fix_normalize_categorical": ("priority", "normalize_categorical", with_dirty(
        f"SELECT row_id, {TITLE_SQL.format('trim(priority)')} AS priority FROM dirty")),
}
for _name, (_column, _action, _sql) in FIXES.items():
    query(_name, _sql)(fixed(_column, _action))


@query("fix_normalize_periods", with_dirty("SELECT row_id, order_period FROM dirty"))
def fix_normalize_periods(spark, sf):
    """Periods written in three layouts come out in one."""
    period, third = F.col("order_period"), (F.col(ROW_ID) / 10).cast("long") % 3
    mixed = (F.when(third == 0, F.concat(F.substring(period, 6, 2), F.lit("/"), F.substring(period, 1, 4)))
             .when(third == 1, F.replace(period, F.lit("-"), F.lit("/"))).otherwise(period))
    d = dirty(spark, sf).withColumn("order_period", mixed)
    return fx.fix_column(d, "order_period", "normalize_dates", dirty_rules()).select(F.col(ROW_ID).alias("row_id"), "order_period")


@query("fix_clip_iqr_events", """
SELECT event_id, round(CASE WHEN value > hi THEN hi WHEN value < lo THEN lo ELSE value END, 6) AS value FROM events, (
  SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM (
    SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events))""")
def fix_clip_iqr_events(spark, sf):
    events = table(spark, sf, "events").select("event_id", "value")
    return fx.fix_column(events, "value", "clip_iqr").select("event_id", F.round("value", 6).alias("value"))


@query("fix_impute_median_labels", """
SELECT doc_id, coalesce(quality, m)::DOUBLE AS quality FROM documents LEFT JOIN labels USING (doc_id)
CROSS JOIN (SELECT median(quality) AS m FROM documents JOIN labels USING (doc_id))""")
def fix_impute_median_labels(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id").join(
        table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")
    return fx.fix_column(docs, "quality", "impute_median")


@query("fix_impute_mode_labels", """
SELECT doc_id, coalesce(quality, m) AS quality FROM documents LEFT JOIN labels USING (doc_id) CROSS JOIN (
  SELECT quality AS m FROM labels JOIN documents USING (doc_id) GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)""")
def fix_impute_mode_labels(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id").join(
        table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")
    return fx.fix_column(docs, "quality", "impute_mode").select("doc_id", F.col("quality").cast("int").alias("quality"))


DEDUP_SQL = with_dirty("SELECT min(row_id) AS row_id, order_id, status FROM dirty GROUP BY " + ", ".join(COLUMNS))


@query("fix_drop_duplicates", DEDUP_SQL)
def fix_drop_duplicates(spark, sf):
    return drop_duplicates(dirty(spark, sf)).select(F.col(ROW_ID).alias("row_id"), "order_id", "status")


@query("fix_drop_duplicates_unbroadcast", DEDUP_SQL)
def fix_drop_duplicates_unbroadcast(spark, sf):
    """The same with the hashes joined by shuffle and sort."""
    d = dirty(spark, sf)
    return drop_duplicates(d, hashes=repeated_hashes(d).hint("merge")).select(F.col(ROW_ID).alias("row_id"), "order_id", "status")


@query("fix_keep_first_by_key", with_dirty(
    "SELECT row_id, order_id, status, total_price FROM dirty QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY row_id) = 1"))
def fix_keep_first_by_key(spark, sf):
    return fx.keep_first_by_key(dirty(spark, sf), ["order_id"]).select(
        F.col(ROW_ID).alias("row_id"), "order_id", "status", "total_price")


@query("fix_drop_columns", with_dirty("SELECT row_id, " + ", ".join(COLUMNS[:-2]) + " FROM dirty"))
def fix_drop_columns(spark, sf):
    return fx.drop_unexpected_columns(dirty(spark, sf), ["total_price", "note", "absent"]).withColumnRenamed(ROW_ID, "row_id")


STEPS = [
    Step("impute_mode", "missing_mandatory_values", ("status",), "Completeness"),
    Step("ignore", "sparse_column", ("note",), "Completeness"),
    Step("normalize_dates", "mixed_format_family", ("order_date",), "Consistency"),
    Step("normalize_categorical", "categorical_variant_inconsistency", ("status",), "Consistency"),
    Step("drop_duplicates", "exact_duplicate_rows", COLUMNS, "Consistency"),
    Step("cast_numeric", "non_numeric_values_in_numeric_field", ("total_price",), "Anomaly"),
    Step("clip_to_min", "value_below_minimum", ("total_price",), "Anomaly"),
    Step("clip_iqr", "iqr_outliers", ("total_price",), "Anomaly"),
    Step("clip_iqr", "iqr_outliers", ("ghost",), "Anomaly"),
]
CHAIN = f"""
step1 AS (SELECT row_id, order_id, customer_id, CASE WHEN {present_sql('status')} THEN status ELSE m END AS status, priority,
  order_date, order_period, order_year, total_price, note FROM dirty CROSS JOIN (
  SELECT trim(status) AS m FROM dirty WHERE {present_sql('status')} GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)),
step2 AS (SELECT * REPLACE (coalesce(strftime({stamp_sql('order_date')}, '%Y-%m-%d'), order_date) AS order_date,
  upper(status) AS status) FROM step1),
step3 AS (SELECT min(row_id) AS row_id, {', '.join(COLUMNS)} FROM step2 GROUP BY ALL),
step4 AS (SELECT row_id, order_id, status, order_date, total_price AS raw, {NUM} AS num FROM step3),
step5 AS (SELECT *, CASE WHEN num < 0 THEN 0 ELSE num END AS low FROM step4),
f AS (SELECT quantile_cont(low, 0.25) AS q1, quantile_cont(low, 0.75) AS q3 FROM step5)"""


@query("plan_applied", with_dirty("""
SELECT row_id, order_id, status, order_date, round(CASE WHEN low > q3 + 1.5 * (q3 - q1) THEN q3 + 1.5 * (q3 - q1)
  WHEN low < q1 - 1.5 * (q3 - q1) THEN q1 - 1.5 * (q3 - q1) ELSE low END, 6) AS total_price FROM step5 CROSS JOIN f""", CHAIN))
def plan_applied(spark, sf):
    """A whole plan compiled into stages and run in order."""
    out, _ = apply_steps(dirty(spark, sf), "dirty", STEPS, dirty_rules())
    return out.select(F.col(ROW_ID).alias("row_id"), "order_id", "status", "order_date",
                      F.round("total_price", 6).alias("total_price"))


PLAN_LOG_SQL = f"""
SELECT 1::BIGINT AS seq, 'impute_mode' AS action, 'status' AS "column", count(*) AS rows_affected, true AS applied FROM dirty WHERE NOT {present_sql('status')}
UNION ALL SELECT 2, 'ignore', 'note', 0, false
UNION ALL SELECT 3, 'normalize_dates', 'order_date', count(*), true FROM dirty WHERE strftime({stamp_sql('order_date')}, '%Y-%m-%d') <> order_date
UNION ALL SELECT 4, 'normalize_categorical', 'status', count(*), true FROM step1 WHERE upper(status) <> status
UNION ALL SELECT 5, 'drop_duplicates', 'order_id', (SELECT count(*) FROM step2) - (SELECT count(*) FROM step3), true
UNION ALL SELECT 6, 'cast_numeric', 'total_price', count(*), true FROM step4 WHERE try_cast(raw AS DOUBLE) IS DISTINCT FROM num OR num IS NULL AND raw IS NOT NULL
UNION ALL SELECT 7, 'clip_to_min', 'total_price', count(*), true FROM step5 WHERE num < 0
UNION ALL SELECT 8, 'clip_iqr', 'total_price', count(*), true FROM step5 CROSS JOIN f
  WHERE low NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)
UNION ALL SELECT 9, 'clip_iqr', 'ghost', 0, false"""


@query("plan_log", with_dirty(PLAN_LOG_SQL, CHAIN))
def plan_log(spark, sf):
    d = dirty(spark, sf)
    _, entries = apply_steps(d, "dirty", STEPS, dirty_rules())
    return log_frame(d, entries).select("seq", "action", "column", "rows_affected", "applied")


@query("plan_log_summary", with_dirty(f"""
SELECT 'dirty' AS dataset, agent, action, count(*) AS entries, count(*) FILTER (applied) AS applied, sum(n)::BIGINT AS rows_affected FROM (
  SELECT 'Completeness' AS agent, 'impute_mode' AS action, count(*) AS n, true AS applied FROM dirty WHERE NOT {present_sql('status')}
  UNION ALL SELECT 'Completeness', 'ignore', 0, false
  UNION ALL SELECT 'Consistency', 'normalize_dates', count(*), true FROM dirty WHERE strftime({stamp_sql('order_date')}, '%Y-%m-%d') <> order_date
  UNION ALL SELECT 'Consistency', 'normalize_categorical', count(*), true FROM step1 WHERE upper(status) <> status
  UNION ALL SELECT 'Consistency', 'drop_duplicates', (SELECT count(*) FROM step2) - (SELECT count(*) FROM step3), true
  UNION ALL SELECT 'Anomaly', 'cast_numeric', count(*), true FROM step4 WHERE try_cast(raw AS DOUBLE) IS DISTINCT FROM num OR num IS NULL AND raw IS NOT NULL
  UNION ALL SELECT 'Anomaly', 'clip_to_min', count(*), true FROM step5 WHERE num < 0
  UNION ALL SELECT 'Anomaly', 'clip_iqr', count(*), true FROM step5 CROSS JOIN f
    WHERE low NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)
  UNION ALL SELECT 'Anomaly', 'clip_iqr', 0, false) GROUP BY ALL""", CHAIN))
def plan_log_summary(spark, sf):
    d = dirty(spark, sf)
    _, entries = apply_steps(d, "dirty", STEPS, dirty_rules())
    return report.log_summary(log_frame(d, entries))


@query("cell_diff", with_dirty("""
SELECT row_id, 'status' AS "column", d.status AS raw, s.status AS fixed FROM step3 s JOIN dirty d USING (row_id) WHERE d.status <> s.status
UNION ALL SELECT row_id, 'order_date', d.order_date, s.order_date FROM step3 s JOIN dirty d USING (row_id)
WHERE d.order_date <> s.order_date""", CHAIN))
def cell_diff(spark, sf):
    """Every cell the text corrections changed, found by row identity."""
    d = dirty(spark, sf)
    out, _ = apply_steps(d, "dirty", STEPS[:5], dirty_rules())
    return report.cell_diff(d, out).withColumnRenamed(ROW_ID, "row_id")


@query("diff_preview", with_dirty("""
SELECT s.row_id, s.order_id, s.status || CASE WHEN d.status <> s.status THEN '*' ELSE '' END AS status,
  s.order_date || CASE WHEN d.order_date <> s.order_date THEN '*' ELSE '' END AS order_date, coalesce(s.note, '') AS note
FROM step3 s JOIN dirty d USING (row_id) ORDER BY row_id LIMIT 8""", CHAIN))
def diff_preview(spark, sf):
    d = dirty(spark, sf)
    out, _ = apply_steps(d, "dirty", STEPS[:5], dirty_rules())
    return report.diff_preview(d, out).select(F.col(ROW_ID).alias("row_id"), "order_id", "status", "order_date", "note")


@query("full_run")
def full_run(spark, sf):
    """Discover, audit, plan, correct twice, audit, score; without sample texts in the evidence."""
    return run_quality(dirty(spark, sf), "dirty", pin=True, options=AuditOptions(samples=False)).scores


@query("full_run_given_rules")
def full_run_given_rules(spark, sf):
    """The flagship: the same run with rules written by the user."""
    options = AuditOptions(samples=False)
    return run_quality(dirty(spark, sf), "dirty", dirty_rules(), pin=True, options=options).scores


@query("full_run_summary")
def full_run_summary(spark, sf):
    """The run with given rules, as one sentence."""
    run = run_quality(dirty(spark, sf), "dirty", dirty_rules(), pin=True)
    return report.summary_sentence(run.scores, run.issues, run.log)


@query("full_run_lineitem")
def full_run_lineitem(spark, sf):
    """A typed numeric table through the whole run."""
    lines = table(spark, sf, "lineitem").withColumn(
        ROW_ID, F.col("l_orderkey") * 8 + F.col("l_linenumber"))
    return run_quality(lines, "lineitem").scores



