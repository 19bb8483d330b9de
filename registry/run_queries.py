"""The whole run with given rules, two passes of corrections included, spelled out in SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registry.base import query
from registry.check_queries import with_audit
from registry.dirty import COLUMNS, TOKENS_SQL, dirty, dirty_rules, number_sql, present_sql, stamp_sql, with_dirty
from registry.plan_queries import CATALOGUE_SQL, SCORES_SQL
from tablewright.constants import ROW_ID
from tablewright.operators import report
from tablewright.operators import score as sc
from tablewright.operators.checks import AuditOptions
from tablewright.plans.run import run_many, run_quality
from tablewright.sources.writers import write_result
from tablewright.tables import new_path


def _mode(column: str) -> str:
    return (f"(SELECT trim({column}) FROM dirty WHERE {present_sql(column)} GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)")


def _imputed(column: str) -> str:
    return f"CASE WHEN {present_sql(column)} THEN {column} ELSE {_mode(column)} END"


RUN_SQL = f"""
imputed AS (SELECT row_id, order_id, {_imputed('customer_id')} AS customer_id, {_imputed('status')} AS status,
  {_imputed('priority')} AS priority, order_date, order_period, order_year, total_price, note FROM dirty),
written AS (SELECT * REPLACE (coalesce(strftime({stamp_sql('order_date')}, '%Y-%m-%d'), order_date) AS order_date, upper(status) AS status)
  FROM imputed),
single AS (SELECT min(row_id) AS row_id, {', '.join(COLUMNS)} FROM written GROUP BY {', '.join(COLUMNS)}),
read AS (SELECT *, {number_sql('total_price')} AS num FROM single),
floored AS (SELECT *, CASE WHEN num < 0 THEN 0.0 ELSE num END AS low FROM read),
fence AS (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM (
  SELECT quantile_cont(low, 0.25) AS q1, quantile_cont(low, 0.75) AS q3 FROM floored)),
pass1 AS (SELECT row_id, {', '.join(COLUMNS[:7])}, CASE WHEN low > hi THEN hi WHEN low < lo THEN lo ELSE low END AS total_price, note
  FROM floored CROSS JOIN fence),
pass2 AS (SELECT * REPLACE (coalesce(total_price, (SELECT total_price FROM pass1 WHERE total_price IS NOT NULL
  GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS total_price) FROM pass1)"""

FINAL_SQL = f"""
total AS (SELECT count(*)::DOUBLE AS rows FROM pass2),
gone AS (SELECT count(*) FILTER (note IS NULL OR lower(trim(note)) IN {TOKENS_SQL}) AS missing FROM pass2),
texts AS (SELECT "column", trim(v) AS v FROM pass2 UNPIVOT (v FOR "column" IN ({', '.join(COLUMNS[:7])}, note))),
counts AS (SELECT "column", v, count(*) AS n FROM texts WHERE lower(v) NOT IN {TOKENS_SQL} GROUP BY ALL),
sizes AS (SELECT "column", sum(n) AS rows, count(*) AS k FROM counts GROUP BY "column" HAVING sum(n) >= 200 AND count(*) BETWEEN 2 AND 200),
issues AS (
  SELECT 'missing_optional_values' AS issue_type, CASE WHEN missing / rows >= 0.2 THEN 'medium' ELSE 'low' END AS severity, 'note' AS columns,
    missing AS row_count, NULL::DOUBLE AS completeness, round(missing / rows, 4) AS missing_ratio FROM gone CROSS JOIN total WHERE missing > 0
  UNION ALL SELECT 'sparse_column', CASE WHEN 1 - missing / rows < 0.6 THEN 'high' ELSE 'medium' END, 'note', missing,
    round(1 - missing / rows, 4), NULL FROM gone CROSS JOIN total WHERE 1 - missing / rows < 0.85
  UNION ALL SELECT 'invalid_format_values', CASE WHEN 1 - n / rows < 0.8 THEN 'high' ELSE 'medium' END, 'order_date', n, NULL, NULL
    FROM (SELECT count(*) AS n FROM pass2 WHERE {stamp_sql('order_date')} IS NULL) CROSS JOIN total WHERE n > 0
  UNION ALL SELECT 'categorical_rare_value', 'low', "column", CAST(sum(n) AS BIGINT), NULL, NULL FROM counts JOIN sizes USING ("column")
    WHERE n / rows::DOUBLE < 0.001 GROUP BY "column"
  UNION ALL SELECT 'duplicate_business_keys', 'high', 'order_id', CAST(sum(n) AS BIGINT), NULL, NULL
    FROM (SELECT count(*) AS n FROM pass2 GROUP BY order_id HAVING count(*) > 1) HAVING count(*) > 0
  UNION ALL SELECT 'year_date_mismatch', 'high', 'order_date,order_year', n, NULL, NULL
    FROM (SELECT count(*) AS n FROM pass2 WHERE year({stamp_sql('order_date')}) <> CAST(order_year AS INTEGER)) WHERE n > 0)"""


def run(spark, sf):
    return run_quality(dirty(spark, sf), "dirty", dirty_rules(), options=AuditOptions(samples=False))


@query("run_fixed_table", with_dirty(
    "SELECT row_id, customer_id, status, priority, order_date, round(total_price, 6) AS total_price FROM pass2", RUN_SQL))
def run_fixed_table(spark, sf):
    """What both passes leave of the table."""
    return run(spark, sf).fixed.select(F.col(ROW_ID).alias("row_id"), "customer_id", "status", "priority", "order_date",
                                       F.round("total_price", 6).alias("total_price"))


@query("run_second_pass_log", with_dirty("""
SELECT 'impute_mode' AS action, 'total_price' AS "column", 'missing_mandatory_values' AS issue_type,
  count(*) FILTER (total_price IS NULL) AS rows_affected, true AS applied FROM pass1
UNION ALL SELECT 'normalize_dates', 'order_date', 'invalid_format_values', 0, true
UNION ALL SELECT 'drop_duplicates', 'order_id', 'duplicate_business_keys', 0, true""", RUN_SQL))
def run_second_pass_log(spark, sf):
    """Corrections of what the first re-audit still found."""
    log = run(spark, sf).log.where(F.col("pass") == 2)
    return log.select("action", "column", "issue_type", "rows_affected", "applied")


@query("run_final_issues", with_dirty("SELECT * FROM issues", RUN_SQL, FINAL_SQL))
def run_final_issues(spark, sf):
    """Issues of the corrected table."""
    return run(spark, sf).post_issues.select("issue_type", "severity", F.array_join("columns", ",").alias("columns"), "row_count",
                                             "completeness", "missing_ratio")


_POST = CATALOGUE_SQL.split("routed AS")[0].rstrip().rstrip(",")


POST_SCORE_SQL = with_dirty("""
SELECT 'dirty' AS dataset, round(100 * sum(w * sub_score), 1)::DOUBLE AS post_reliability_score,
  (SELECT count(*) FROM issues) AS issues_post FROM scored""", RUN_SQL, FINAL_SQL, _POST, SCORES_SQL)


@query("run_scores", POST_SCORE_SQL)
def run_scores(spark, sf):
    """The score after both passes, from the issues really left."""
    return run(spark, sf).scores.select("dataset", "post_reliability_score",
                                        F.col("issues_post").cast("long").alias("issues_post"))


LEFT_SQL = FINAL_SQL.replace("issues AS (", "left_over AS (").replace("sizes AS", "final_sizes AS").replace("JOIN sizes", "JOIN final_sizes") \
    .replace("counts AS", "final_counts AS").replace("FROM counts", "FROM final_counts")
WEIGHT = "CASE severity WHEN 'critical' THEN 4.0 WHEN 'high' THEN 2.0 WHEN 'medium' THEN 1.0 WHEN 'low' THEN 0.5 END"


@query("run_remediation", with_audit(f"""
SELECT 'dirty' AS dataset, n_pre, n_post, round(100.0 * (n_pre - n_post) / n_pre, 1)::DOUBLE AS remediation_score,
  round(100.0 * (w_pre - w_post) / w_pre, 1)::DOUBLE AS remediation_score_weighted
FROM (SELECT count(*) AS n_pre, sum({WEIGHT}) AS w_pre FROM issues), (SELECT count(*) AS n_post, sum({WEIGHT}) AS w_post FROM left_over)""",
    RUN_SQL, LEFT_SQL))
def run_remediation(spark, sf):
    """Share of issues that the run did away with, by its own last audit."""
    done = run(spark, sf)
    return sc.remediation_rate(done.issues, done.post_issues)


@query("run_severity_deltas", with_audit("""
SELECT 'dirty' AS dataset, s AS severity, pre, post, post - pre AS delta FROM (SELECT s,
  (SELECT count(*) FROM issues WHERE severity = s) AS pre, (SELECT count(*) FROM left_over WHERE severity = s) AS post
  FROM (SELECT unnest(['critical', 'high', 'medium', 'low']) AS s))""", RUN_SQL, LEFT_SQL))
def run_severity_deltas(spark, sf):
    done = run(spark, sf)
    return sc.severity_deltas(done.issues, done.post_issues)


@query("run_summary", with_audit("""
SELECT 'dirty' AS dataset, count(*) FILTER (severity = 'critical') AS critical, count(*) FILTER (severity = 'high') AS high,
  count(*) FILTER (severity = 'medium') AS medium, count(*) FILTER (severity = 'low') AS low, (SELECT count(*) FROM left_over) AS "left"
FROM issues""", RUN_SQL, LEFT_SQL))
def run_summary(spark, sf):
    """The numbers that the summary sentence gives, read out of it again."""
    done = run(spark, sf)
    text = report.summary_sentence(done.scores, done.issues, done.log)

    def number(pattern):
        return F.regexp_extract("summary", pattern, 1).cast("long")

    return text.select("dataset", *[number(rf"(\d+) {s}").alias(s) for s in ("critical", "high", "medium", "low")],
                       number(r"issues left: (\d+)").alias("left"))


def _without_conflicts(sql: str) -> str:
    """The same over the dirty table without its key conflicts."""
    return sql.replace("FROM base WHERE k % 300 = 2)", "FROM base WHERE false)").replace("SELECT 'dirty' AS dataset", "SELECT 'unique' AS dataset")


@query("scores_of_two_tables", f"SELECT * FROM ({POST_SCORE_SQL}) UNION ALL SELECT * FROM ({_without_conflicts(POST_SCORE_SQL)})")
def scores_of_two_tables(spark, sf):
    """Two tables, each corrected and audited again, side by side in one score table."""
    d = dirty(spark, sf)
    _, scores = run_many({"dirty": d, "unique": d.where(F.col(ROW_ID) % 10 != 2)}, rules=dirty_rules(), options=AuditOptions(samples=False))
    return scores.select("dataset", "post_reliability_score", F.col("issues_post").cast("long").alias("issues_post"))


@query("bundle_written", with_audit("""
SELECT 'fixed' AS part, count(*) AS rows FROM pass2 UNION ALL SELECT 'issues', count(*) FROM issues
UNION ALL SELECT 'post_issues', count(*) FROM left_over UNION ALL SELECT 'scores', 1 UNION ALL SELECT 'summary', 1
UNION ALL SELECT 'fixed text', count(*) FROM pass2 WHERE status = 'F'""", RUN_SQL, LEFT_SQL))
def bundle_written(spark, sf):
    """All tables of a run in one directory, read back."""
    path = new_path(spark, "bundle")
    write_result(run(spark, sf), path)
    fixed = spark.read.option("header", True).csv(f"{path}/fixed")
    parts = {"fixed": fixed, "fixed text": fixed.where("status = 'F'"),
             **{n: spark.read.json(f"{path}/{n}") for n in ("issues", "post_issues", "scores", "summary")}}
    counted = [t.agg(F.count("*").alias("rows")).select(F.lit(n).alias("part"), "rows") for n, t in parts.items()]
    return reduce(DataFrame.unionByName, counted)
