"""Scores over issue tables of one or many datasets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.constants import (
    DEAD_COMPLETENESS, OTHER_PENALTY, RESOLUTION_WEIGHT, SEVERITIES, SEVERITY_PENALTY, WEIGHTS)
from tablewright.functions.text import constant_array
from tablewright.plans.planner import catalogue
from tablewright.tables import small_frame


def _by_severity(values: dict[str, float], other: float) -> Column:
    expr = F.lit(other)
    for severity, value in values.items():
        expr = F.when(F.col("severity") == severity, F.lit(value)).otherwise(expr)
    return expr


def is_exempt() -> Column:
    """Issues that cost nothing: naming, and gaps of columns that are dead anyway."""
    kind = F.col("issue_type")
    return ((kind == "naming_convention_violation")
            | ((kind == "sparse_column") & (F.coalesce("completeness", F.lit(1.0)) < DEAD_COMPLETENESS))
            | (kind.isin("missing_optional_values", "missing_mandatory_values")
               & (F.coalesce("missing_ratio", F.lit(0.0)) > 1.0 - DEAD_COMPLETENESS)))


def dimension_penalties(issues: DataFrame, legacy_uniqueness: bool = False) -> DataFrame:
    """(dataset, dimension, issues, sub_score) of the dimensions that have issues.

    ``legacy_uniqueness`` scores uniqueness with every consistency issue, as published
    pre-correction numbers do.
    """
    dims = catalogue(issues.sparkSession).select("issue_type", F.explode("dimensions").alias("dimension"))
    if legacy_uniqueness:
        dims = dims.where("dimension <> 'uniqueness'").unionByName(
            dims.where("dimension = 'consistency'").withColumn("dimension", F.lit("uniqueness")))
    penalty = F.when(is_exempt(), F.lit(0.0)).otherwise(_by_severity(SEVERITY_PENALTY, OTHER_PENALTY))
    return (issues.join(F.broadcast(dims), "issue_type").groupBy("dataset", "dimension")
            .agg(F.count("*").alias("issues"),
                 F.greatest(F.lit(0.0), F.round(1 - F.sum(penalty), 3)).alias("sub_score")))


def sub_scores(issues: DataFrame, datasets: DataFrame | None = None, legacy_uniqueness: bool = False) -> DataFrame:
    """Sub-score of all five dimensions per dataset, 1.0 where nothing was found.

    ``datasets`` (a ``dataset`` column) adds datasets without any issue.
    """
    names = (datasets if datasets is not None else issues).select("dataset").distinct()
    grid = names.withColumn("dimension", F.explode(constant_array(list(WEIGHTS))))
    found = dimension_penalties(issues, legacy_uniqueness)
    return grid.join(found, ["dataset", "dimension"], "left").select(
        "dataset", "dimension", F.coalesce("issues", F.lit(0).cast("long")).alias("issues"),
        F.coalesce("sub_score", F.lit(1.0)).alias("sub_score"))


def reliability(scores: DataFrame) -> DataFrame:
    """Weighted 0-100 score per dataset from its sub-scores."""
    weight = F.lit(0.0)
    for dimension, w in WEIGHTS.items():
        weight = F.when(F.col("dimension") == dimension, F.lit(w)).otherwise(weight)
    return scores.groupBy("dataset").agg(
        F.round(100 * F.sum(weight * F.col("sub_score")), 1).alias("reliability_score"),
        *[F.round(100 * F.max(F.when(F.col("dimension") == d, F.col("sub_score"))), 1).alias(d) for d in WEIGHTS])


def verdict(score: Column) -> Column:
    return F.when(score >= 70, "high").when(score >= 40, "medium").otherwise("low")


def remediation_rate(before: DataFrame, after: DataFrame) -> DataFrame:
    """Share of issues, plain and severity-weighted, that the corrections closed."""
    weight = F.sum(_by_severity(RESOLUTION_WEIGHT, 1.0))

    def totals(issues, n, w):
        return issues.groupBy("dataset").agg(F.count("*").alias(n), weight.alias(w))

    joined = totals(before, "n_pre", "w_pre").join(totals(after, "n_post", "w_post"), "dataset", "left")
    n_post, w_post = F.coalesce("n_post", F.lit(0)), F.coalesce("w_post", F.lit(0.0))
    plain = 100 * F.greatest(F.lit(0), F.col("n_pre") - n_post) / F.col("n_pre")
    weighted = 100 * F.greatest(F.lit(0.0), F.col("w_pre") - w_post) / F.col("w_pre")
    return joined.select(
        "dataset", "n_pre", n_post.cast("long").alias("n_post"), F.round(plain, 1).alias("remediation_score"),
        F.round(F.coalesce(weighted, F.lit(100.0)), 1).alias("remediation_score_weighted"))


def score_table(before: DataFrame, after: DataFrame, datasets: DataFrame, legacy_uniqueness: bool = False) -> DataFrame:
    """One row per dataset: scores before and after, rates, verdict."""
    pre = reliability(sub_scores(before, datasets, legacy_uniqueness))
    post = reliability(sub_scores(after, datasets))
    post = post.select("dataset", *[F.col(c).alias(f"post_{c}") for c in post.columns if c != "dataset"])
    joined = pre.join(post, "dataset").join(remediation_rate(before, after), "dataset", "left")
    full = F.lit(100.0)
    return joined.select(
        *pre.columns, *[c for c in post.columns if c != "dataset"],
        F.round(F.col("post_reliability_score") - F.col("reliability_score"), 1).alias("delta"),
        F.coalesce("n_pre", F.lit(0).cast("long")).alias("issues_pre"),
        F.coalesce("n_post", F.lit(0).cast("long")).alias("issues_post"),
        F.coalesce("remediation_score", full).alias("remediation_score"),
        F.coalesce("remediation_score_weighted", full).alias("remediation_score_weighted"),
        verdict(F.col("post_reliability_score")).alias("verdict"))


def severity_deltas(before: DataFrame, after: DataFrame) -> DataFrame:
    """Issue counts per dataset and severity before and after, all four severities."""
    def counts(issues, name):
        return issues.groupBy("dataset", "severity").agg(F.count("*").alias(name))

    names = before.select("dataset").union(after.select("dataset")).distinct()
    grid = names.withColumn("severity", F.explode(constant_array(SEVERITIES)))
    joined = counts(before, "pre").join(counts(after, "post"), ["dataset", "severity"], "full_outer")
    zero = F.lit(0).cast("long")
    pre, post = F.coalesce("pre", zero), F.coalesce("post", zero)
    return grid.join(joined, ["dataset", "severity"], "left").select(
        "dataset", "severity", pre.alias("pre"), post.alias("post"), (post - pre).alias("delta"))


def datasets_frame(spark: SparkSession, *names: str) -> DataFrame:
    return small_frame(spark, [(n,) for n in names], "dataset string")
