"""Plans and scores over the issues of the dirty table."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from registry.base import query
from registry.check_queries import dirty_issues, with_audit
from tablewright.operators import report
from tablewright.operators import score as sc
from tablewright.plans import planner as pl


# Routes, dimensions and weights written out, so that a wrong entry in the package shows.
CATALOGUE_SQL = """
kinds AS (SELECT *, CASE agent WHEN 'Schema' THEN 'drop_unexpected_columns cast_numeric normalize_dates ignore'
    WHEN 'Completeness' THEN 'impute_median impute_mode ignore'
    WHEN 'Consistency' THEN 'normalize_dates drop_duplicates normalize_categorical ignore'
    ELSE 'clip_iqr clip_to_min cast_numeric strip_currency ignore' END AS allowed FROM (VALUES
  ('missing_required_columns', 'Schema', NULL), ('duplicate_column_names', 'Schema', 'drop_unexpected_columns'),
  ('semantic_type_mismatch', 'Schema', 'cast_numeric'), ('naming_convention_violation', 'Schema', NULL),
  ('missing_mandatory_values', 'Completeness', 'impute_mode'), ('missing_optional_values', 'Completeness', NULL),
  ('sparse_column', 'Completeness', NULL), ('invalid_format_values', 'Consistency', 'normalize_dates'),
  ('mixed_format_family', 'Consistency', 'normalize_dates'),
  ('categorical_variant_inconsistency', 'Consistency', 'normalize_categorical'), ('categorical_rare_value', 'Anomaly', 'ignore'),
  ('non_numeric_values_in_numeric_field', 'Anomaly', 'cast_numeric'), ('forbidden_token_in_numeric_field', 'Anomaly', 'strip_currency'),
  ('value_below_minimum', 'Anomaly', 'clip_to_min'), ('iqr_outliers', 'Anomaly', 'clip_iqr'),
  ('exact_duplicate_rows', 'Consistency', 'drop_duplicates'), ('duplicate_business_keys', 'Consistency', 'drop_duplicates'),
  ('year_date_mismatch', 'Consistency', NULL)) v(issue_type, agent, fallback)),
dims AS (SELECT * FROM (VALUES
  ('semantic_type_mismatch', 'validity'), ('naming_convention_violation', 'validity'), ('missing_mandatory_values', 'completeness'),
  ('missing_optional_values', 'completeness'), ('sparse_column', 'completeness'), ('invalid_format_values', 'consistency'),
  ('mixed_format_family', 'consistency'), ('categorical_variant_inconsistency', 'consistency'), ('categorical_rare_value', 'accuracy'),
  ('non_numeric_values_in_numeric_field', 'accuracy'), ('forbidden_token_in_numeric_field', 'accuracy'),
  ('value_below_minimum', 'accuracy'), ('iqr_outliers', 'accuracy'), ('exact_duplicate_rows', 'consistency'),
  ('exact_duplicate_rows', 'uniqueness'), ('duplicate_business_keys', 'consistency'), ('duplicate_business_keys', 'uniqueness'),
  ('year_date_mismatch', 'consistency')) v(issue_type, dimension)),
routed AS (SELECT issues.*, agent, fallback, allowed,
    list_position(['Schema', 'Completeness', 'Consistency', 'Anomaly'], agent) AS agent_no
  FROM issues JOIN kinds USING (issue_type))"""
EXEMPT = ("(issue_type = 'naming_convention_violation' OR (issue_type = 'sparse_column' AND completeness < 0.05) "
          "OR (issue_type LIKE 'missing_%_values' AND missing_ratio > 0.95))")
PENALTY = "CASE severity WHEN 'critical' THEN 0.40 WHEN 'high' THEN 0.20 WHEN 'medium' THEN 0.08 WHEN 'low' THEN 0.02 ELSE 0.05 END"
SCORES_SQL = f"""
penalties AS (SELECT dimension, count(*) AS n, greatest(0, round(1 - sum(CASE WHEN {EXEMPT} THEN 0 ELSE {PENALTY} END), 3)) AS s
  FROM issues JOIN dims USING (issue_type) GROUP BY dimension),
scored AS (SELECT d AS dimension, w, coalesce(n, 0) AS issues, coalesce(s, 1.0)::DOUBLE AS sub_score
  FROM (VALUES ('completeness', 0.30), ('consistency', 0.25), ('validity', 0.20), ('uniqueness', 0.15), ('accuracy', 0.10)) v(d, w)
  LEFT JOIN penalties ON d = dimension)"""


def with_plan(body: str, *extra: str) -> str:
    return with_audit(body, CATALOGUE_SQL, *extra)


@query("plan_routes", with_plan("SELECT issue_index, issue_type, agent, fallback AS default_action FROM routed"))
def plan_routes(spark, sf):
    return pl.route(dirty_issues(spark, sf)).select("issue_index", "issue_type", "agent", "default_action")


@query("plan_default", with_plan("""
SELECT 'dirty' AS dataset, issue_index, CAST(row_number() OVER (ORDER BY agent_no, issue_index) AS INTEGER) AS step, agent,
  coalesce(fallback, 'ignore') AS action, 'default for ' || issue_type AS rationale, false AS overridden FROM routed"""))
def plan_default(spark, sf):
    return pl.default_plan(dirty_issues(spark, sf))


def _proposal(issues):
    """Proposals of a cautious planner: mostly ``ignore``, with and without a reason; the anomaly
    planner misses one issue."""
    routed = pl.route(issues)
    action = (F.when(F.col("issue_index") % 3 == 0, F.coalesce("default_action", F.lit("ignore")))
               .when(F.col("issue_index") % 3 == 1, "ignore").otherwise("rewrite_everything"))
    why = F.when(F.col("issue_index") % 4 == 1, "Identifier column, not meaningful").otherwise("better to be careful")
    last = F.max("issue_index").over(Window.partitionBy("agent"))
    return routed.select("dataset", "agent", "issue_index", action.alias("action"), why.alias("rationale"),
                         last.alias("last")).where("agent <> 'Anomaly' OR issue_index < last").drop("last")


VALIDATED_SQL = """
proposed AS (SELECT *, CASE issue_index % 3 WHEN 0 THEN coalesce(fallback, 'ignore') WHEN 1 THEN 'ignore' ELSE 'rewrite_everything' END AS asked,
  CASE WHEN issue_index % 4 = 1 THEN 'Identifier column, not meaningful' ELSE 'better to be careful' END AS why FROM routed),
checked AS (SELECT *, CASE WHEN list_contains(string_split(allowed, ' '), asked) THEN asked ELSE 'ignore' END AS action0 FROM proposed),
judged AS (SELECT *, action0 = 'ignore' AND fallback IS NOT NULL AND list_contains(string_split(allowed, ' '), fallback)
  AND NOT (""" + EXEMPT.replace("completeness <", "coalesce(completeness, 1) <").replace("missing_ratio >", "coalesce(missing_ratio, 0) >") + """)
  AND NOT (""" + "contains(lower(why), 'identifier') OR contains(lower(why), 'not meaningful')" + """) AS override FROM checked)"""


@query("plan_validated", with_plan("""
SELECT issue_index, agent,
  CASE WHEN agent = 'Anomaly' THEN coalesce(fallback, 'ignore') WHEN override THEN fallback ELSE action0 END AS action,
  agent <> 'Anomaly' AND override AS overridden,
  CASE WHEN agent = 'Anomaly' THEN 'default for ' || issue_type
    WHEN override THEN fallback || ' instead of ignore, which the planner explained by: ' || why ELSE why END AS rationale FROM judged""", VALIDATED_SQL))
def plan_validated(spark, sf):
    issues = dirty_issues(spark, sf)
    plan = pl.validated_plan(issues, _proposal(issues))
    return plan.select("issue_index", "agent", "action", "overridden", "rationale")


@query("plan_from_text", with_plan("""
SELECT 'dirty' AS dataset, agent, issue_index, coalesce(fallback, 'ignore') AS action, 'because ' || issue_type AS rationale FROM routed"""))
def plan_from_text(spark, sf):
    """Proposals as text with prose and code fences around a JSON array, read back."""
    routed = pl.route(dirty_issues(spark, sf))
    entry = F.struct(F.col("issue_index").alias("i"), F.coalesce("default_action", F.lit("ignore")).alias("action"),
                     F.concat(F.lit("because "), F.col("issue_type")).alias("why"))
    text = routed.groupBy("dataset", "agent").agg(F.collect_list(entry).alias("entries")).select(
        "dataset", "agent", F.concat(F.lit("Here is the plan:\n```json\n"), F.to_json("entries"), F.lit("\n```\nDone.")).alias("text"))
    return pl.parse_plan_text(text)


@query("sub_scores", with_plan("SELECT 'dirty' AS dataset, dimension, issues, sub_score FROM scored", SCORES_SQL))
def sub_scores(spark, sf):
    return sc.sub_scores(dirty_issues(spark, sf))


@query("reliability", with_plan("""
SELECT 'dirty' AS dataset, r AS reliability_score, CASE WHEN r >= 70 THEN 'high' WHEN r >= 40 THEN 'medium' ELSE 'low' END AS verdict
FROM (SELECT round(100 * sum(w * sub_score), 1)::DOUBLE AS r FROM scored)""", SCORES_SQL))
def reliability(spark, sf):
    scored = sc.reliability(sc.sub_scores(dirty_issues(spark, sf)))
    return scored.select("dataset", "reliability_score", sc.verdict(F.col("reliability_score")).alias("verdict"))


def _untreated(issues):
    """Issues no default action answers: what a plan without second thoughts leaves behind."""
    return pl.route(issues).where("coalesce(default_action, 'ignore') = 'ignore'").select(*issues.columns)


@query("remediation_rate", with_plan("""
SELECT 'dirty' AS dataset, n_pre, n_post, round(100.0 * (n_pre - n_post) / n_pre, 1)::DOUBLE AS remediation_score,
  round(100.0 * (w_pre - w_post) / w_pre, 1)::DOUBLE AS remediation_score_weighted FROM (
  SELECT count(*) AS n_pre, count(*) FILTER (coalesce(fallback, 'ignore') = 'ignore') AS n_post, sum(w) AS w_pre,
    sum(w) FILTER (coalesce(fallback, 'ignore') = 'ignore') AS w_post FROM (SELECT *, CASE severity WHEN 'critical' THEN 4.0
      WHEN 'high' THEN 2.0 WHEN 'medium' THEN 1.0 WHEN 'low' THEN 0.5 END AS w FROM routed))"""))
def remediation_rate(spark, sf):
    issues = dirty_issues(spark, sf)
    return sc.remediation_rate(issues, _untreated(issues))


@query("severity_deltas", with_plan("""
SELECT 'dirty' AS dataset, s AS severity, count(issue_index) AS pre, count(*) FILTER (kept) AS post,
  count(*) FILTER (kept) - count(issue_index) AS delta
FROM (SELECT unnest(['critical', 'high', 'medium', 'low']) AS s) LEFT JOIN (
  SELECT *, coalesce(fallback, 'ignore') = 'ignore' AS kept FROM routed) ON severity = s GROUP BY s"""))
def severity_deltas(spark, sf):
    issues = dirty_issues(spark, sf)
    return sc.severity_deltas(issues, _untreated(issues))


@query("score_table")
def score_table(spark, sf):
    """Scores of two tables side by side: the dirty orders and their untreated issues."""
    issues = dirty_issues(spark, sf)
    both = issues.unionByName(_untreated(issues).withColumn("dataset", F.lit("untreated")))
    return sc.score_table(both, _untreated(both), both.select("dataset").distinct())


@query("top_issues", with_plan("""
SELECT issue_type, severity, columns, row_count FROM issues ORDER BY list_position(['critical', 'high', 'medium', 'low'], severity),
  row_count DESC, issue_index LIMIT 5"""))
def top_issues(spark, sf):
    top = report.top_issues(dirty_issues(spark, sf), 5)
    return top.select("issue_type", "severity", F.array_join("columns", ",").alias("columns"), "row_count")


@query("worst_issues", with_plan("""
SELECT issue_type, severity, columns, row_count FROM issues ORDER BY list_position(['critical', 'high', 'medium', 'low'], severity),
  row_count DESC, issue_index LIMIT 25"""))
def worst_issues(spark, sf):
    """The report's list in its usual length."""
    top = report.top_issues(dirty_issues(spark, sf))
    return top.select("issue_type", "severity", F.array_join("columns", ",").alias("columns"), "row_count")


@query("issue_list", with_plan("""
SELECT 'dirty' AS dataset, issue_index + 1 AS id, tool, issue_type, severity, columns, row_count FROM issues"""))
def issue_list(spark, sf):
    return report.issue_list(dirty_issues(spark, sf)).drop("message")


def _resolutions_sql() -> str:
    from registry.fix_queries import CHAIN, PLAN_LOG_SQL, STEPS

    why = ", ".join(f"({n}, '{s.agent}')" for n, s in enumerate(STEPS, 1))
    return with_plan("""
SELECT 'dirty' AS dataset, i.first_column, issue_index, issue_type, l.seq, v.agent, l.action, l.rows_affected, l.applied,
  CASE WHEN l.seq IS NOT NULL THEN '' END AS rationale
FROM (SELECT *, split_part(columns, ',', 1) AS first_column FROM issues) i LEFT JOIN log l ON l."column" = i.first_column
LEFT JOIN (VALUES """ + why + ") v(seq, agent) ON v.seq = l.seq", CHAIN, f"log AS ({PLAN_LOG_SQL})")


@query("issue_resolutions", _resolutions_sql())
def issue_resolutions(spark, sf):
    """Issues with the corrections made on their first column."""
    from registry.dirty import dirty, dirty_rules
    from registry.fix_queries import STEPS
    from tablewright.plans.apply import apply_steps, log_frame

    d = dirty(spark, sf)
    _, entries = apply_steps(d, "dirty", STEPS, dirty_rules())
    return report.resolutions(dirty_issues(spark, sf), log_frame(d, entries))
