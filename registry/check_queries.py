"""The ten checks, cross-column rules, quartiles and duplicates."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registry.base import query
from registry.dirty import CELLS_SQL, COLUMNS, dirty, dirty_rules, stamp_sql, table, with_dirty
from registry.profile_queries import FACTS_SQL, LABEL_SQL
from tablewright.constants import ROW_ID
from tablewright.operators import checks as ck
from tablewright.operators import cross
from tablewright.operators.duplicates import duplicate_groups, key_groups, repeated_hashes
from tablewright.operators.issues import issues_summary, severity_breakdown
from tablewright.operators.rules import ColumnRule, CrossRule, Rules
from tablewright.tables import local_rows, small_frame


def facts_of(d: DataFrame) -> DataFrame:
    return local_rows(ck.audit_facts(d, dirty_rules()))


def shown(issues: DataFrame, *extra: str) -> DataFrame:
    """Issue columns that SQL can repeat."""
    return issues.select("tool", "issue_type", "severity", F.array_join("columns", ",").alias("columns"),
                         "row_count", *extra)


# The whole issue list of the dirty table in SQL, for this module and the plan and score queries.
AUDIT_SQL = f"""
n AS (SELECT count(*) AS rows FROM dirty),
required_cols AS (SELECT unnest(['order_id','customer_id','status','priority','order_date','order_period',
  'order_year','total_price']) AS c),
gaps AS (SELECT *, (real_nulls + disguised_nulls) AS missing, (real_nulls + disguised_nulls) / total::DOUBLE AS ratio,
  "column" IN (SELECT c FROM required_cols) AS required FROM profiled),
labels_of AS (SELECT "column", {LABEL_SQL.format(t='text', k='kind', s='stamp')} AS label, kind
  FROM flags JOIN (VALUES ('order_date','date'),('order_period','period')) v(c, kind) ON c = "column"),
formats AS (SELECT "column", count(*) FILTER (label = 'invalid') AS bad, count(*) FILTER (label <> 'missing') AS filled_n,
  count(DISTINCT label) FILTER (label NOT IN ('invalid', 'missing')) AS kinds FROM labels_of GROUP BY "column"),
vals AS (SELECT "column", text, count(*) AS n, here FROM flags WHERE text <> '' GROUP BY "column", text, here),
few AS (SELECT "column" FROM vals GROUP BY "column" HAVING count(*) <= 40),
variants AS (SELECT "column", sum(k) AS n FROM (SELECT "column", lower(text) AS t, count(*) AS k FROM vals
  WHERE "column" IN (SELECT "column" FROM few) GROUP BY ALL HAVING count(*) > 1) GROUP BY "column"),
sizes AS (SELECT "column", sum(n) AS rows, count(*) AS k FROM vals WHERE here GROUP BY "column"
  HAVING sum(n) >= 200 AND count(*) BETWEEN 2 AND 200),
rare AS (SELECT "column", sum(n) AS n FROM vals JOIN sizes USING ("column") WHERE here AND n / rows::DOUBLE < 0.001
  GROUP BY "column"),
minimums AS (SELECT * FROM (VALUES ('order_id', NULL::DOUBLE), ('customer_id', 0.0), ('order_year', 0.0),
  ('total_price', 0.0)) v(c, low)),
nums AS (SELECT * FROM flags JOIN minimums ON c = "column"),
fences AS (SELECT "column", count(num) AS numbers, quantile_cont(num, 0.25) AS q1, quantile_cont(num, 0.75) AS q3
  FROM nums GROUP BY "column" HAVING count(num) >= 8 AND count(DISTINCT num) >= 4),
outside AS (SELECT "column", count(*) AS n FROM nums JOIN fences USING ("column")
  WHERE num NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AND q3 <> q1 GROUP BY "column"),
copies AS (SELECT count(*) AS n, order_id, customer_id, status, priority, order_date, order_period, order_year,
  total_price, note FROM dirty GROUP BY ALL HAVING count(*) > 1),
keys AS (SELECT order_id, count(*) AS n FROM dirty GROUP BY order_id HAVING count(*) > 1),
wrong_year AS (SELECT count(*) AS n FROM dirty WHERE year({stamp_sql('order_date')}) <> CAST(order_year AS INTEGER)),
found AS (
  SELECT 1 AS t, 'check_nulls' AS tool, CASE WHEN required THEN 'missing_mandatory_values' ELSE 'missing_optional_values' END AS issue_type,
    CASE WHEN required THEN CASE WHEN ratio >= 0.2 THEN 'critical' ELSE 'high' END
         ELSE CASE WHEN ratio >= 0.2 THEN 'medium' ELSE 'low' END END AS severity,
    "column" AS columns, missing AS row_count, NULL::DOUBLE AS completeness, round(ratio, 4) AS missing_ratio, 5 AS o
    FROM gaps WHERE missing > 0
  UNION ALL SELECT 2, 'check_sparse_columns', 'sparse_column', CASE WHEN 1 - ratio < 0.6 THEN 'high' ELSE 'medium' END,
    "column", missing, round(1 - ratio, 4), NULL, 7 FROM gaps WHERE 1 - ratio < 0.85
  UNION ALL SELECT 3, 'check_formats', 'invalid_format_values',
    CASE WHEN 1 - bad / filled_n::DOUBLE < 0.8 THEN 'high' ELSE 'medium' END, "column", bad, NULL, NULL, 8 FROM formats WHERE bad > 0
  UNION ALL SELECT 3, 'check_formats', 'mixed_format_family', 'medium', "column", filled_n, NULL, NULL, 9 FROM formats WHERE kinds > 1
  UNION ALL SELECT 4, 'check_categorical_case_variants', 'categorical_variant_inconsistency', 'low', "column", n, NULL, NULL, 10 FROM variants
  UNION ALL SELECT 5, 'check_categorical_rare_values', 'categorical_rare_value', 'low', "column", n, NULL, NULL, 11 FROM rare
  UNION ALL SELECT 6, 'check_numeric_validity', 'non_numeric_values_in_numeric_field', 'high', "column",
    count(*) FILTER (here AND num IS NULL), NULL, NULL, 12 FROM nums GROUP BY "column" HAVING count(*) FILTER (here AND num IS NULL) > 0
  UNION ALL SELECT 6, 'check_numeric_validity', 'forbidden_token_in_numeric_field', 'medium', 'total_price',
    count(*), NULL, NULL, 13 FROM dirty WHERE contains(total_price, '€') HAVING count(*) > 0
  UNION ALL SELECT 6, 'check_numeric_validity', 'value_below_minimum', 'high', "column", count(*), NULL, NULL, 14
    FROM nums WHERE num < low GROUP BY "column"
  UNION ALL SELECT 7, 'check_outliers_iqr', 'iqr_outliers', CASE WHEN n / rows::DOUBLE < 0.05 THEN 'medium' ELSE 'high' END,
    "column", n, NULL, NULL, 15 FROM outside CROSS JOIN (SELECT rows FROM n)
  UNION ALL SELECT 8, 'check_duplicates', 'exact_duplicate_rows', 'medium', '{','.join(COLUMNS)}', sum(n)::BIGINT, NULL, NULL, 16
    FROM copies HAVING count(*) > 0
  UNION ALL SELECT 8, 'check_duplicates', 'duplicate_business_keys', 'high', 'order_id', sum(n)::BIGINT, NULL, NULL, 17
    FROM keys HAVING count(*) > 0
  UNION ALL SELECT 9, 'check_cross_column', 'year_date_mismatch', 'high', 'order_date,order_year', n, NULL, NULL, 18
    FROM wrong_year WHERE n > 0),
issues AS (SELECT row_number() OVER (ORDER BY t, CASE WHEN t IN (8, 9) THEN 0 ELSE
    list_position(['{"','".join(COLUMNS)}'], columns) END, o) - 1 AS issue_index, * FROM found)
"""


def with_audit(body: str, *extra: str) -> str:
    return with_dirty(body, CELLS_SQL, FACTS_SQL, AUDIT_SQL, *extra)


def dirty_issues(spark, sf, samples: bool = False) -> DataFrame:
    return ck.audit(dirty(spark, sf), "dirty", dirty_rules(), ck.AuditOptions(samples=samples))


def some_issues(tool: str, *extra: str) -> str:
    return with_audit("SELECT tool, issue_type, severity, columns, row_count"
                      + "".join(f", {e}" for e in extra) + f" FROM issues WHERE tool = '{tool}'")


@query("null_issues", some_issues("check_nulls", "missing_ratio"))
def null_issues(spark, sf):
    d = dirty(spark, sf)
    return shown(ck.check_nulls(d, "dirty", facts_of(d)), "missing_ratio")


@query("sparse_issues", some_issues("check_sparse_columns", "completeness"))
def sparse_issues(spark, sf):
    d = dirty(spark, sf)
    return shown(ck.check_sparse_columns(d, "dirty", facts_of(d)), "completeness")


@query("format_issues", some_issues("check_formats"))
def format_issues(spark, sf):
    d = dirty(spark, sf)
    return shown(ck.check_formats(d, "dirty", facts_of(d)))


@query("case_variant_issues", with_dirty("""
SELECT 'categorical_variant_inconsistency' AS issue_type, 'status' AS columns, CAST(sum(k) AS BIGINT) AS row_count,
  string_agg(t || ':' || vs, ';' ORDER BY t) AS groups FROM (
  SELECT lower(status) AS t, count(DISTINCT status) AS k, string_agg(DISTINCT status, '|' ORDER BY status) AS vs
  FROM dirty GROUP BY 1 HAVING count(DISTINCT status) > 1)"""))
def case_variant_issues(spark, sf):
    d = dirty(spark, sf)
    found = ck.check_categorical_case_variants(d, "dirty", local_rows(ck.category_values(d, 200)))
    groups = F.from_json(F.get_json_object("evidence", "$.variant_groups"), "map<string,array<string>>")
    listed = F.array_join(F.transform(F.array_sort(F.map_keys(groups)), lambda k: F.concat(
        k, F.lit(":"), F.array_join(F.try_element_at(groups, k), "|"))), ";")
    return found.select("issue_type", F.array_join("columns", ",").alias("columns"), "row_count",
                        listed.alias("groups"))


@query("rare_value_issues", some_issues("check_categorical_rare_values"))
def rare_value_issues(spark, sf):
    d = dirty(spark, sf)
    return shown(ck.check_categorical_rare_values(d, "dirty", local_rows(ck.category_values(d, 200))))


@query("numeric_issues", some_issues("check_numeric_validity"))
def numeric_issues(spark, sf):
    d = dirty(spark, sf)
    return shown(ck.check_numeric_validity(d, "dirty", facts_of(d)))


@query("numeric_samples", with_dirty("""
SELECT problem, string_agg(total_price, '|' ORDER BY seen, total_price) AS samples FROM (
  SELECT problem, total_price, min(row_id) AS seen, row_number() OVER (PARTITION BY problem ORDER BY min(row_id), total_price) AS r
  FROM (SELECT row_id, total_price, 'non_numeric' AS problem FROM dirty WHERE total_price = 'abc'
    UNION ALL SELECT row_id, total_price, '€' FROM dirty WHERE contains(total_price, '€')
    UNION ALL SELECT row_id, total_price, 'below_minimum' FROM dirty WHERE total_price LIKE '-%')
  GROUP BY problem, total_price) WHERE r <= 10 GROUP BY problem"""))
def numeric_samples(spark, sf):
    d = dirty(spark, sf)
    found = ck.numeric_samples(d, facts_of(d).where("column = 'total_price'").collect(),
                               ck.iqr_fences(d, []))
    rows = [(problem, "|".join(texts["total_price"])) for problem, texts in found.items()]
    return small_frame(spark, rows, "problem string, samples string")


FENCE_SQL = """SELECT '{t}.{c}' AS "column", count({c}) AS numbers, round(quantile_cont({c}, 0.25), 6) AS q1,
  round(quantile_cont({c}, 0.75), 6) AS q3, round(quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25), 6) AS iqr,
  round(quantile_cont({c}, 0.25) - 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)), 6) AS lower_bound,
  round(quantile_cont({c}, 0.75) + 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)), 6) AS upper_bound FROM {t}"""


@query("iqr_fences", " UNION ALL ".join(FENCE_SQL.format(t=t, c=c) for t, c in (
    ("events", "value"), ("lineitem", "l_extendedprice"), ("lineitem", "l_tax"), ("customer", "c_acctbal"))))
def iqr_fences(spark, sf):
    parts = []
    for name, columns in (("events", ["value"]), ("lineitem", ["l_extendedprice", "l_tax"]), ("customer", ["c_acctbal"])):
        fences = ck.iqr_fences(table(spark, sf, name), columns)
        parts.append(fences.withColumn("column", F.concat(F.lit(f"{name}."), "column")))
    rounded = [F.round(c, 6).alias(c) for c in ("q1", "q3", "iqr", "lower_bound", "upper_bound")]
    return reduce(DataFrame.unionByName, parts).select("column", "numbers", *rounded)


@query("bracketed_quantiles", """
SELECT p, round(quantile_cont(l_extendedprice, 0.01), 4) AS low, round(median(l_extendedprice), 4) AS mid,
  round(quantile_cont(l_extendedprice, 0.999), 4) AS high FROM lineitem, (SELECT 'l_extendedprice' AS p) GROUP BY p""")
def bracketed_quantiles(spark, sf):
    """The route of columns too large to sort: sketch a bracket, prove it, sort what is inside."""
    from tablewright.operators.quantiles import exact_quantiles

    nums = table(spark, sf, "lineitem").select("l_extendedprice")
    found = exact_quantiles(nums, ["l_extendedprice"], [0.01, 0.5, 0.999], block_rows=1000)
    row = ("l_extendedprice", *(found[("l_extendedprice", p)] for p in (0.01, 0.5, 0.999)))
    return small_frame(spark, [row], "p string, low double, mid double, high double").select(
        "p", *[F.round(c, 4).alias(c) for c in ("low", "mid", "high")])


@query("iqr_outlier_counts", """
SELECT 'value' AS "column", count(*) FILTER (value < lo OR value > hi) AS outliers, count(*) AS total FROM events, (
  SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM (
    SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events))""")
def iqr_outlier_counts(spark, sf):
    e = table(spark, sf, "events")
    return ck.outlier_counts(e, ck.iqr_fences(e, ["value"])).select("column", "outliers", "total")


@query("iqr_outlier_issues", some_issues("check_outliers_iqr"))
def iqr_outlier_issues(spark, sf):
    d = dirty(spark, sf)
    fences = ck.iqr_fences(d, [r.column for r in dirty_rules().numeric])
    return shown(ck.check_outliers_iqr(d, "dirty", ck.outlier_counts(d, fences)))


@query("exact_duplicates", with_dirty("""
SELECT order_id, min(row_id) AS first_row, count(*) AS n FROM dirty GROUP BY order_id, customer_id, status, priority,
  order_date, order_period, order_year, total_price, note HAVING count(*) > 1"""))
def exact_duplicates(spark, sf):
    return duplicate_groups(dirty(spark, sf)).select("order_id", "first_row", "n")


@query("exact_duplicates_unbroadcast", with_dirty("""
SELECT order_id, min(row_id) AS first_row, count(*) AS n FROM dirty GROUP BY order_id, customer_id, status, priority,
  order_date, order_period, order_year, total_price, note HAVING count(*) > 1"""))
def exact_duplicates_unbroadcast(spark, sf):
    """The way taken when too many hashes repeat to broadcast them."""
    return duplicate_groups(dirty(spark, sf), hashes=repeated_hashes(dirty(spark, sf)).hint("merge")).select("order_id", "first_row", "n")


@query("duplicate_texts", """
SELECT md5(text) AS text_md5, count(*) AS n FROM documents GROUP BY text HAVING count(*) > 1""")
def duplicate_texts(spark, sf):
    """Exact copies among whole documents: only rows with a repeated hash are compared."""
    return duplicate_groups(table(spark, sf, "documents"), ["text"]).select(F.md5("text").alias("text_md5"), "n")


@query("key_duplicates", with_dirty("""
SELECT order_id, min(row_id) AS first_row, count(*) AS n FROM dirty GROUP BY order_id HAVING count(*) > 1"""))
def key_duplicates(spark, sf):
    return key_groups(dirty(spark, sf), ["order_id"])


@query("duplicate_issues", some_issues("check_duplicates"))
def duplicate_issues(spark, sf):
    return shown(ck.check_duplicates(dirty(spark, sf), "dirty", ["order_id"]))


def _priced_lines(spark, sf):
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", (1 - F.col("l_discount")).alias("factor"),
        F.when(F.col("l_orderkey") % 125 == 0, net * 3).otherwise(net).alias("net"), "l_tax", "l_discount", "l_shipdate")


CROSS = {
    "cross_year": (dirty, CrossRule("year_matches", ("order_date", "order_year")), with_dirty(
        f"SELECT count(*) AS violations FROM dirty WHERE year({stamp_sql('order_date')}) <> CAST(order_year AS INTEGER)")),
    "cross_period": (
        lambda spark, sf: dirty(spark, sf).withColumn("month", F.substring("order_period", 6, 2)),
        CrossRule("period_matches", ("order_period", "order_year", "month")), with_dirty(
            "SELECT count(*) AS violations FROM dirty WHERE CAST(order_period[1:4] AS INTEGER) <> CAST(order_year AS INTEGER)")),
    "cross_le": (_priced_lines, CrossRule("le", ("l_discount", "l_tax")),
                 "SELECT count(*) AS violations FROM lineitem WHERE l_discount > l_tax"),
    "cross_product": (_priced_lines, CrossRule("product_matches", ("net", "l_extendedprice", "factor")),
                      "SELECT count(*) AS violations FROM lineitem WHERE l_orderkey % 125 = 0 "
                      "AND 2 * l_extendedprice * (1 - l_discount) > 0.01"),
    "cross_date_order": (
        lambda spark, sf: table(spark, sf, "lineitem").join(
            table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).select("o_orderdate", "l_shipdate"),
        CrossRule("date_order", ("o_orderdate", "l_shipdate")),
        "SELECT count(*) AS violations FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderdate > l_shipdate"),
}


def _register_cross(name, source, rule, sql):
    @query(name, sql)
    def run(spark, sf):
        df = source(spark, sf)
        return df.agg(F.count_if(cross.violation(df, rule)).alias("violations"))


for _name, (_source, _rule, _sql) in CROSS.items():
    _register_cross(_name, _source, _rule, _sql)


@query("cross_issues", some_issues("check_cross_column"))
def cross_issues(spark, sf):
    return shown(ck.check_cross_column(dirty(spark, sf), "dirty", dirty_rules().cross))


@query("schema_issues", with_dirty("""
SELECT 'check_schema' AS tool, * FROM (
  SELECT 'missing_required_columns' AS issue_type, 'critical' AS severity, 'ghost' AS columns, count(*) AS row_count FROM dirty
  UNION ALL SELECT 'duplicate_column_names', 'high', 'status', count(*) FROM dirty
  UNION ALL SELECT 'semantic_type_mismatch', 'high', 'order_date', count(order_date) FROM dirty
  UNION ALL SELECT 'semantic_type_mismatch', 'high', 'priority', count(priority) FROM dirty
  UNION ALL SELECT 'naming_convention_violation', 'low', 'Order Note', count(*) FROM dirty
  UNION ALL SELECT 'naming_convention_violation', 'low', '2price', count(*) FROM dirty)"""))
def schema_issues(spark, sf):
    """The dirty table against other expectations: a lost column, two changed types, bad names."""
    d = dirty(spark, sf).withColumnsRenamed({"note": "Order Note", "total_price": "2price"})
    changed = {"order_date": "string", "priority": "numeric"}
    rules = tuple(replace(r, semantic_type=changed.get(r.column, r.semantic_type), temporal_kind=None)
                  for r in dirty_rules().columns if r.column not in ("note", "total_price"))
    rules = Rules((*rules, ColumnRule("ghost", 10, "string", required=True)))
    header = [c for c in d.columns if c != ROW_ID] + ["status"]
    facts = local_rows(ck.audit_facts(d, rules))
    return shown(ck.check_schema(d, "dirty", rules, facts, header=header))


@query("strict_names", with_dirty("""
SELECT c AS "column", v AS violations, n AS rows FROM (SELECT count(*) AS n FROM dirty),
  (VALUES ('Order Note', 'mixed_case special_char_or_space'), ('2price', 'starts_with_digit'),
          ('order-date', 'special_char_or_space')) t(c, v)"""))
def strict_names(spark, sf):
    d = dirty(spark, sf).withColumnsRenamed({"note": "Order Note", "total_price": "2price", "order_date": "order-date"})
    found = ck.name_violations(d, strict=True)
    return found.select("column", F.array_join("violations", " ").alias("violations")).withColumn("rows", F.lit(d.count()))


@query("audit_issues", with_audit(
    "SELECT issue_index, tool, issue_type, severity, columns, row_count, completeness, missing_ratio FROM issues"))
def audit_issues(spark, sf):
    return shown(dirty_issues(spark, sf), "issue_index", "completeness", "missing_ratio")


@query("audit_evidence")
def audit_evidence(spark, sf):
    """All issues with messages, evidence and samples."""
    return dirty_issues(spark, sf, samples=True).withColumn("columns", F.array_join("columns", ","))


EVIDENCE = ("real_nulls", "disguised_nulls", "q1", "q3", "lower_bound", "upper_bound", "min_allowed")


@query("evidence_numbers", with_audit("""
SELECT issue_type, columns, key, round(value, 6)::DOUBLE AS value FROM (
  SELECT issue_type, columns, 'real_nulls' AS key, real_nulls::DOUBLE AS value FROM issues JOIN gaps ON columns = "column" WHERE tool IN ('check_nulls', 'check_sparse_columns')
  UNION ALL SELECT issue_type, columns, 'disguised_nulls', disguised_nulls FROM issues JOIN gaps ON columns = "column"
    WHERE tool IN ('check_nulls', 'check_sparse_columns')
  UNION ALL SELECT issue_type, columns, k, CASE k WHEN 'q1' THEN q1 WHEN 'q3' THEN q3 WHEN 'lower_bound' THEN q1 - 1.5 * (q3 - q1) ELSE q3 + 1.5 * (q3 - q1) END
    FROM issues JOIN fences ON columns = "column", (SELECT unnest(['q1', 'q3', 'lower_bound', 'upper_bound']) AS k) WHERE tool = 'check_outliers_iqr'
  UNION ALL SELECT issue_type, columns, 'min_allowed', low FROM issues JOIN minimums ON columns = c WHERE issue_type = 'value_below_minimum'
  UNION ALL SELECT issue_type, columns, 'sample_rows', least(5, (SELECT count(*) FROM copies)) FROM issues WHERE issue_type = 'exact_duplicate_rows'
  UNION ALL SELECT issue_type, columns, 'sample_rows', least(5, (SELECT count(*) FROM keys)) FROM issues WHERE issue_type = 'duplicate_business_keys'
  UNION ALL SELECT issue_type, columns, 'sample_rows', least(10, row_count) FROM issues WHERE tool = 'check_cross_column')"""))
def evidence_numbers(spark, sf):
    """The numbers in the evidence of every issue, read out of its text, and how many rows it shows."""
    issues = dirty_issues(spark, sf, samples=True)
    found = [F.struct(F.lit(k).alias("key"), F.get_json_object("evidence", f"$.{k}").cast("double").alias("value")) for k in EVIDENCE]
    shown_rows = F.size(F.from_json(F.get_json_object("evidence", "$.sample_rows"), "array<string>"))
    found.append(F.struct(F.lit("sample_rows").alias("key"), F.when(shown_rows >= 0, shown_rows).cast("double").alias("value")))
    rows = issues.select("issue_type", F.array_join("columns", ",").alias("columns"), F.inline(F.array(*found)))
    return rows.where("value is not null").withColumn("value", F.round("value", 6))


@query("evidence_samples", with_audit("""
SELECT issue_type, columns, string_agg(text, '|' ORDER BY r) AS samples FROM issues JOIN (
  SELECT "column", text, row_number() OVER (PARTITION BY "column" ORDER BY min(row_id), text) AS r FROM flags WHERE text <> '' GROUP BY "column", text)
  ON columns = "column" WHERE tool = 'check_nulls' AND r <= 5 GROUP BY issue_type, columns"""))
def evidence_samples(spark, sf):
    """The first values that the evidence of columns with missing ones shows."""
    issues = dirty_issues(spark, sf, samples=True).where("tool = 'check_nulls'")
    listed = F.from_json(F.get_json_object("evidence", "$.samples"), "array<string>")
    return issues.select("issue_type", F.array_join("columns", ",").alias("columns"), F.array_join(listed, "|").alias("samples"))


@query("audit_discovered_columns", with_audit(
    "SELECT tool, issue_type, severity, columns, row_count FROM issues WHERE tool NOT IN ('check_duplicates', 'check_cross_column')"))
def audit_discovered_columns(spark, sf):
    """The checks of single columns find with discovered rules what they find with those that a user wrote."""
    from tablewright import audit, discover_rules

    d = dirty(spark, sf)
    found = audit(d, "dirty", discover_rules(d, "dirty"), ck.AuditOptions(samples=False))
    return shown(found.where(~F.col("tool").isin("check_duplicates", "check_cross_column")))


@query("audit_discovered")
def audit_discovered(spark, sf):
    """Rules found in the data, then the audit with them."""
    from tablewright import audit, discover_rules

    d = dirty(spark, sf)
    return shown(audit(d, "dirty", discover_rules(d, "dirty")))


TOOLS = ("check_schema", "check_nulls", "check_sparse_columns", "check_formats", "check_categorical_case_variants",
         "check_categorical_rare_values", "check_numeric_validity", "check_outliers_iqr", "check_duplicates",
         "check_cross_column")


@query("issues_by_tool", with_audit("""
SELECT 'dirty' AS dataset, t.tool, count(i.tool) AS issue_count, count(*) FILTER (severity = 'critical') AS critical,
  count(*) FILTER (severity = 'high') AS high, count(*) FILTER (severity = 'medium') AS medium,
  count(*) FILTER (severity = 'low') AS low
FROM (SELECT unnest([""" + ",".join(f"'{t}'" for t in TOOLS) + """]) AS tool) t LEFT JOIN issues i USING (tool) GROUP BY t.tool"""))
def issues_by_tool(spark, sf):
    return issues_summary(dirty_issues(spark, sf))


@query("severity_counts", with_audit("""
SELECT 'dirty' AS dataset, count(*) FILTER (severity = 'critical') AS critical, count(*) FILTER (severity = 'high') AS high,
  count(*) FILTER (severity = 'medium') AS medium, count(*) FILTER (severity = 'low') AS low FROM issues"""))
def severity_counts(spark, sf):
    return severity_breakdown(dirty_issues(spark, sf))



