"""Writers. Every result is written by the executors into a directory."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.constants import ROW_ID
from tablewright.operators import report
from tablewright.plans.run import QualityResult
from tablewright.tables import col


def write_fixed(df: DataFrame, path: str, fmt: str = "csv", mode: str = "errorifexists") -> None:
    """Write a corrected table as CSV or parquet, without the row identity."""
    data = df.drop(ROW_ID)
    writer = data.write.mode(mode)
    if fmt == "csv":
        writer.option("header", True).option("escape", '"').csv(path)
    else:
        writer.format(fmt).save(path)


def write_log(log: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write a correction log as JSON lines."""
    log.write.mode(mode).json(path)


def write_evaluation(metrics: DataFrame, trials: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Summary as JSON, trials and family metrics as CSV."""
    metrics.where(F.col("family") == "overall").write.mode(mode).json(f"{path}/summary")
    trials.write.mode(mode).option("header", True).csv(f"{path}/trials")
    metrics.where(F.col("family") != "overall").write.mode(mode).option("header", True).csv(f"{path}/families")


def write_result(result: QualityResult, path: str, fmt: str = "csv", mode: str = "errorifexists") -> None:
    """All tables of a run in one directory."""
    write_fixed(result.fixed, f"{path}/fixed", fmt, mode)
    write_log(result.log, f"{path}/correction_log", mode)
    for name, table in {
        "issues": result.issues, "post_issues": result.post_issues, "plan": result.plan, "scores": result.scores,
        "summary": report.summary_sentence(result.scores, result.issues, result.log),
    }.items():
        table.select(*[col(c) for c in table.columns]).write.mode(mode).json(f"{path}/{name}")
