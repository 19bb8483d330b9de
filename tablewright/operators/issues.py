"""The issue table: one schema for the findings of every check."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablewright.constants import CATALOGUE, SEVERITIES, SUGGESTED_FIX

ISSUE_SCHEMA = (
    "dataset string, tool string, issue_type string, severity string, columns array<string>, "
    "row_count bigint, message string, completeness double, missing_ratio double, "
    "evidence string, suggested_fix string")
ISSUE_COLUMNS = [part.split()[0] for part in ISSUE_SCHEMA.split(", ")]
CHECKS = ("check_schema", "check_nulls", "check_sparse_columns", "check_formats",
          "check_categorical_case_variants", "check_categorical_rare_values",
          "check_numeric_validity", "check_outliers_iqr", "check_duplicates", "check_cross_column")
from tablewright.functions.text import constant_array, constant_map
from tablewright.tables import small_frame


def issues_from(
    found: DataFrame,
    dataset: str,
    issue_type: str | Column,
    severity: str | Column,
    row_count: Column,
    message: Column,
    evidence: Column,
    columns: Column | None = None,
    completeness: Column | None = None,
    missing_ratio: Column | None = None,
    tool: str | None = None,
) -> DataFrame:
    """Shape findings (one row each, with a ``column``) into issue rows."""
    if isinstance(issue_type, str):
        tool, advice = CATALOGUE[issue_type][0], F.lit(SUGGESTED_FIX[issue_type])
        issue_type = F.lit(issue_type)
    else:
        advice = constant_map(SUGGESTED_FIX)[issue_type]
    severity = F.lit(severity) if isinstance(severity, str) else severity
    nothing = F.lit(None).cast("double")
    order = ["position"] if "position" in found.columns else []
    return found.select(
        F.lit(dataset).alias("dataset"), F.lit(tool).alias("tool"), issue_type.alias("issue_type"),
        severity.alias("severity"),
        (F.array("column") if columns is None else columns).alias("columns"),
        row_count.cast("long").alias("row_count"), message.alias("message"),
        (nothing if completeness is None else completeness).alias("completeness"),
        (nothing if missing_ratio is None else missing_ratio).alias("missing_ratio"),
        F.to_json(evidence).alias("evidence"),
        advice.alias("suggested_fix"),
        *[F.col(c).alias("_order") for c in order] or [F.lit(0).alias("_order")])


def empty_issues(spark: SparkSession) -> DataFrame:
    return small_frame(spark, [], ISSUE_SCHEMA + ", _order int")


def union_issues(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def numbered(issues: DataFrame) -> DataFrame:
    """Issues with ``issue_index``: per dataset by check order, then column order, then type."""
    tools, types = constant_array(CHECKS), constant_array(list(CATALOGUE))
    order = Window.partitionBy("dataset").orderBy(
        F.array_position(tools, F.col("tool")), "_order", F.array_position(types, F.col("issue_type")),
        "columns", "message")
    return issues.select((F.row_number().over(order) - 1).cast("long").alias("issue_index"), *ISSUE_COLUMNS)


def issues_summary(issues: DataFrame, tools: tuple[str, ...] = CHECKS) -> DataFrame:
    """Issue count and per-severity counts of every (dataset, tool), zero rows included."""
    spark = issues.sparkSession
    all_tools = small_frame(spark, [(t,) for t in tools], "tool string")
    counts = issues.groupBy("dataset", "tool").agg(
        F.count("*").alias("issue_count"),
        *[F.count_if(F.col("severity") == s).alias(s) for s in SEVERITIES])
    grid = issues.select("dataset").distinct().withColumn(
        "tool", F.explode(constant_array(tools)))
    joined = grid.join(counts, ["dataset", "tool"], "left").join(F.broadcast(all_tools), "tool")
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("issue_count", *SEVERITIES)]
    return joined.select("dataset", "tool", *zero)


def severity_breakdown(issues: DataFrame) -> DataFrame:
    """Counts of all four severities per dataset, zeros included."""
    return issues.groupBy("dataset").agg(
        *[F.count_if(F.col("severity") == s).alias(s) for s in SEVERITIES])
