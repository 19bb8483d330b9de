"""The whole job: discover, audit, plan, correct twice, audit again, score."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from functools import partial, reduce

from pyspark.sql import DataFrame

from tablewright.operators.checks import AuditOptions, AuditTables, audit
from tablewright.operators.rules import Rules, discover_rules
from tablewright.operators.score import datasets_frame, score_table
from tablewright.plans.apply import Changes, apply_steps, log_frame, plan_steps, residual_steps
from tablewright.plans.planner import default_plan, validated_plan
from tablewright.tables import local_rows, materialize, together, with_row_id

STAGES = ("ingest", "discover", "audit", "plan", "remediation", "re_audit", "second_pass", "final_audit", "score")

Proposer = Callable[[DataFrame], DataFrame]


@dataclass
class QualityResult:
    """Tables of one run. Later stages replace earlier values, nothing is appended twice."""

    dataset: str
    raw: DataFrame
    rules: Rules | None = None
    issues: DataFrame | None = None
    plan: DataFrame | None = None
    fixed: DataFrame | None = None
    log: DataFrame | None = None
    post_issues: DataFrame | None = None
    scores: DataFrame | None = None
    log_rows: list[tuple] = field(default_factory=list, repr=False)


def iter_quality(
    df: DataFrame,
    dataset: str,
    rules: Rules | None = None,
    plan: DataFrame | Proposer | None = None,
    key: str | None = None,
    header: Sequence[str] | None = None,
    options: AuditOptions = AuditOptions(),
    legacy_uniqueness: bool = False,
    pin: bool = False,
) -> Iterator[tuple[str, QualityResult]]:
    """Run stage by stage, yielding ``(stage, result so far)`` after each.

    ``plan`` may be a table of proposed actions, or a function from the issue table to one; it
    is checked before use. Without it the default plan applies. ``pin`` writes the input once
    first; worth it when it is itself the result of a costly query, since a run scans it often.
    """
    raw = with_row_id(df, key)
    run = QualityResult(dataset, materialize(raw, "raw") if pin else raw)
    yield "ingest", run
    run.rules = rules or discover_rules(run.raw, dataset, date_first=options.date_first)
    yield "discover", run
    run.issues = audit(run.raw, dataset, run.rules, options, header)
    yield "audit", run
    proposal = plan(run.issues) if callable(plan) else plan
    made = default_plan(run.issues) if proposal is None else validated_plan(run.issues, proposal)
    run.plan = local_rows(made)
    yield "plan", run

    steps = plan_steps(run.plan, run.issues)
    fixed, run.log_rows = apply_steps(run.raw, dataset, steps, run.rules)
    run.fixed, run.log = fixed, log_frame(df, run.log_rows)
    yield "remediation", run
    kept = None if header is None else [h for h in header if h in run.fixed.columns]
    kept = None if kept is None else list(dict.fromkeys(kept))
    tables, changes = AuditTables(), Changes()
    run.post_issues = audit(run.fixed, dataset, run.rules, options, kept, tables)
    yield "re_audit", run

    steps = residual_steps(run.post_issues)
    if steps:
        run.fixed, more = apply_steps(run.fixed, dataset, steps, run.rules, 2, len(run.log_rows) + 1, log_skipped=False,
                                      written=run.fixed is not run.raw, changes=changes)
        run.log_rows = run.log_rows + more
        run.log = log_frame(df, run.log_rows)
    yield "second_pass", run
    if steps:
        tables.hold_for(run.fixed, changes.columns, changes.rows, changes.hashes)
        run.post_issues = audit(run.fixed, dataset, run.rules, options, kept, tables)
    yield "final_audit", run
    names = datasets_frame(df.sparkSession, dataset)
    run.scores = local_rows(score_table(run.issues, run.post_issues, names, legacy_uniqueness))
    yield "score", run


def run_quality(df: DataFrame, dataset: str, rules: Rules | None = None, **options) -> QualityResult:
    """Run all stages and return the result tables."""
    result = None
    for _, result in iter_quality(df, dataset, rules, **options):
        pass
    return result


def run_many(datasets: Mapping[str, DataFrame], **options) -> tuple[dict[str, QualityResult], DataFrame]:
    """Run several tables, side by side; returns the results and one score table for all."""
    runs = [partial(run_quality, df, name, **options) for name, df in datasets.items()]
    results = dict(zip(datasets, together(next(iter(datasets.values())).sparkSession, *runs)))
    return results, reduce(DataFrame.unionByName, [r.scores for r in results.values()])
