"""Detection quality with all families and all detectors, counted by SQL from the events themselves."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from registry.base import query
from registry.dirty import TOKENS_SQL, number_sql, stamp_sql
from registry.event_queries import CLEAN_SQL, CORRUPTED_SQL, RATE, SEED, TEXT_COLUMNS, clean, clean_rules, mix_sql
from tablewright.operators import evaluate as ev

FAMILIES = ("disguisednull", "iqr_outlier", "mixed_date_format", "wrong_but_parseable", "semantic_duplicate", "crossfield_inconsistency")
NUMBERS = ("order_year", "total_price")


def _cells(rel: str, columns) -> str:
    return f"(SELECT row_id, c, v FROM {rel} UNPIVOT (v FOR c IN ({', '.join(columns)})))"


def events_sql(rel: str) -> str:
    """(f, columns, rows) of all six detectors on a table shaped like the clean orders."""
    label = ("CASE WHEN regexp_full_match(order_date, '\\d{4}-\\d{2}-\\d{2}') THEN 'yyyy-mm-dd' "
             "WHEN regexp_full_match(order_date, '\\d{2}/\\d{2}/\\d{4}') THEN 'dd/mm/yyyy' END")
    nums = f"SELECT row_id, c, {number_sql('v')} AS num FROM {_cells(rel, NUMBERS)}"
    return f"""
SELECT 'disguisednull' AS f, c AS columns, CAST(row_id AS VARCHAR) AS rows FROM {_cells(rel, TEXT_COLUMNS)} WHERE lower(trim(v)) IN {TOKENS_SQL}
UNION ALL SELECT 'iqr_outlier', c, CAST(row_id AS VARCHAR) FROM ({nums}) JOIN (
  SELECT c, quantile_cont(num, 0.25) AS q1, quantile_cont(num, 0.75) AS q3 FROM ({nums}) GROUP BY c
  HAVING count(num) >= 8 AND count(DISTINCT num) >= 4) USING (c)
  WHERE q1 <> q3 AND num NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)
UNION ALL SELECT 'wrong_but_parseable', c, CAST(row_id AS VARCHAR) FROM ({nums}) WHERE num < 0
UNION ALL SELECT 'mixed_date_format', 'order_date', CAST(row_id AS VARCHAR) FROM (SELECT row_id, order_date, {label} AS label FROM {rel})
  WHERE lower(trim(order_date)) NOT IN {TOKENS_SQL} AND (label IS NULL OR label <> (
    SELECT label FROM (SELECT {label} AS label FROM {rel}) WHERE label IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1))
UNION ALL SELECT 'semantic_duplicate', 'order_id', string_agg(CAST(row_id AS VARCHAR), ',' ORDER BY row_id) FROM {rel}
  GROUP BY order_id HAVING count(*) > 1
UNION ALL SELECT 'crossfield_inconsistency', 'order_date,order_year', CAST(row_id AS VARCHAR) FROM {rel}
  WHERE regexp_full_match(order_year, '(19|20)\\d{{2}}') AND year({stamp_sql('order_date')}) <> try_cast(order_year AS INTEGER)"""


def naive_sql(rel: str) -> str:
    """Only real NULLs and strict casts."""
    return (f"SELECT 'wrong_but_parseable' AS f, c AS columns, CAST(row_id AS VARCHAR) AS rows FROM {_cells(rel, NUMBERS)} "
            "WHERE try_cast(v AS DOUBLE) IS NULL")


def changes_sql(family: str, seed: int, rate: float) -> str:
    """Changed cells of one trial: the family's own SQL under another seed and rate."""
    sql = CORRUPTED_SQL[family].split(CLEAN_SQL.strip(), 1)[1].lstrip(" ,")
    sql = sql.replace(mix_sql(SEED + 1), "@next@").replace(mix_sql(SEED), mix_sql(seed)).replace("@next@", mix_sql(seed + 1))
    for slots in (1, 2, 5):
        for slot in range(slots):
            old, new = int(RATE * 2_147_483_647) // slots, int(rate * 2_147_483_647) // slots
            for sign, k in ((">=", slot), ("<", slot + 1)):  # marked, so that no new bound is taken for an old one
                sql = re.sub(rf"{sign} {k * old}\b", f"{sign} @{k * new}", sql)
    sql = sql.replace("@", "").replace(f"* {RATE})", f"* {rate})")
    return ("WITH " if family == "semantic_duplicate" else "") + sql


def outcomes_sql(rate: float, seed: int, detect, runs: int = 1) -> str:
    """CTEs up to ``counted``: (family, tp, fp, fn) summed over the runs, each with seeds of its own."""
    parts = [CLEAN_SQL.strip(), f"known AS ({detect('clean')})"]
    trials = []
    for i in range(runs * len(FAMILIES)):
        family = FAMILIES[i % len(FAMILIES)]
        new = ", ".join(f"coalesce(max(h.fixed) FILTER (h.\"column\" = '{c}'), any_value(c.{c})) AS {c}" for c in TEXT_COLUMNS)
        parts.append(f"change{i} AS ({changes_sql(family, seed + i, rate)})")
        parts.append(f"bad{i} AS (SELECT c.row_id, {new} FROM clean c LEFT JOIN change{i} h ON c.row_id = h.row_id GROUP BY c.row_id)")
        if family == "semantic_duplicate":
            truth = (f"SELECT 'semantic_duplicate' AS f, 'order_id' AS columns, least(s.row_id, h.row_id) || ',' || greatest(s.row_id, h.row_id) AS rows "
                     f"FROM change{i} h JOIN clean s ON s.order_id = h.fixed WHERE h.\"column\" = 'order_id'")
        else:
            columns = "'order_date,order_year'" if family == "crossfield_inconsistency" else '"column"'
            truth = f"SELECT '{family}' AS f, {columns} AS columns, CAST(row_id AS VARCHAR) AS rows FROM change{i}"
        parts.append(f"truth{i} AS (SELECT DISTINCT * FROM ({truth}))")
        parts.append(f"found{i} AS (SELECT DISTINCT * FROM ({detect(f'bad{i}')}) EXCEPT SELECT * FROM known)")
        trials.append(f"SELECT '{family}' AS family, (SELECT count(*) FROM (FROM found{i} INTERSECT FROM truth{i})) AS tp, "
                      f"(SELECT count(*) FROM (FROM found{i} EXCEPT FROM truth{i})) AS fp, (SELECT count(*) FROM (FROM truth{i} EXCEPT FROM found{i})) AS fn")
    parts.append("trials AS (" + " UNION ALL ".join(trials) + ")")
    if runs > 1:
        parts.append("""counted AS (SELECT coalesce(family, 'overall') AS family, sum(tp)::BIGINT AS tp, sum(fp)::BIGINT AS fp, sum(fn)::BIGINT AS fn,
          count(*)::INTEGER AS runs FROM trials GROUP BY ROLLUP (family))""")
        return "WITH " + ", ".join(parts)
    parts.append("""counted AS (SELECT * FROM trials UNION ALL SELECT 'overall', sum(tp)::BIGINT, sum(fp)::BIGINT, sum(fn)::BIGINT FROM trials)""")
    return "WITH " + ", ".join(parts)


METRICS = """ SELECT family, tp, fp, fn, round(p, 4) AS "precision", round(r, 4) AS recall,
  CASE WHEN p + r > 0 THEN round(2 * p * r / (p + r), 4) ELSE 0.0 END AS f1 FROM (
  SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp)::DOUBLE ELSE 0.0 END AS p,
    CASE WHEN tp + fn > 0 THEN tp / (tp + fn)::DOUBLE ELSE 0.0 END AS r FROM counted)"""


@query("evaluate_all", outcomes_sql(0.01, 42, events_sql) + METRICS)
def evaluate_all(spark, sf):
    """All six families, all six detectors: new findings of any kind count against a family."""
    return ev.evaluate(clean(spark, sf), "orders", clean_rules(), rate=0.01, seed=42)[0]


@query("evaluate_again", outcomes_sql(0.03, 1042, events_sql) + METRICS)
def evaluate_again(spark, sf):
    """The same with other rows, three times as many."""
    return ev.evaluate(clean(spark, sf), "orders", clean_rules(), rate=0.03, seed=1042)[0]


@query("evaluate_trials", outcomes_sql(0.01, 7, events_sql, 5) + METRICS.replace("SELECT family,", "SELECT family, runs,", 1))
def evaluate_trials(spark, sf):
    """Five trials of every family, each with rows of its own, in one pass over the stacked tables."""
    return ev.evaluate(clean(spark, sf), "orders", clean_rules(), rate=0.01, seed=7, trials=5)[0]


@query("evaluate_naive", outcomes_sql(0.01, 42, naive_sql) + METRICS)
def evaluate_naive(spark, sf):
    """The naive detector through the same trials."""
    return ev.evaluate(clean(spark, sf), "orders", clean_rules(), rate=0.01, seed=42, detect=ev.naive_events)[0]


@query("evaluate_issue_hits", "SELECT family, CASE family WHEN 'overall' THEN 6 ELSE 1 END AS runs, CASE family WHEN 'overall' THEN 6 ELSE 1 END "
       "AS issue_hits, 1.0::DOUBLE AS issue_hit_rate FROM (SELECT unnest(['" + "','".join((*FAMILIES, "overall")) + "']) AS family)")
def evaluate_issue_hits(spark, sf):
    """Whether the audit of each corrupted table raises an issue of the family's kind."""
    found = ev.evaluate(clean(spark, sf), "orders", clean_rules(), rate=0.03, seed=1042, with_audit=True)[0]
    return found.select("family", "runs", "issue_hits", F.col("issue_hit_rate").cast("double").alias("issue_hit_rate"))
