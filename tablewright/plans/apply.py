"""Turn a plan into column expressions and run it.

Actions are gathered into stages. All statistics a stage needs come from one or two aggregate
jobs. All its corrections are one ``select``, whose rows are written together with a flag for each
correction that touched them; the counts for the log are read from the flags alone. So a stage is
worked out once, however many stages follow. A stage that only compares numbers of a written table is
counted, not written again: reading it costs as little as reading the table. A second pass is counted
first, as it mostly finds nothing left: what touches no row is left out. A stage ends where an action needs
statistics of a column that the stage has already changed through statistics, and where rows or columns are dropped.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.constants import CATALOGUE, ROW_ID
from tablewright.operators.duplicates import drop_duplicates, repeated_hashes
from tablewright.operators.fixes import (
    ACTIONS, COLUMN_FIXES, NEEDS, Fixed, apply_fix, drop_unexpected_columns, start_cell,
    statistics)
from tablewright.operators.rules import Rules
from tablewright.tables import col, materialize, small_frame

LOG_SCHEMA = (
    "dataset string, seq bigint, pass int, agent string, action string, column string, "
    "columns array<string>, issue_type string, rows_affected bigint, applied boolean, value string, "
    "lower double, upper double, reason string, rationale string")
_LOG_FIELDS = [part.split()[0] for part in LOG_SCHEMA.split(", ")]


@dataclass(frozen=True)
class Step:
    """One plan entry with the issue it answers."""

    action: str
    issue_type: str
    columns: tuple[str, ...]
    agent: str = ""
    rationale: str = ""

    @property
    def column(self) -> str | None:
        return next((c for c in self.columns if c), None)


def plan_steps(plan: DataFrame, issues: DataFrame) -> list[Step]:
    """Plan rows in order, with their issues. One row per issue: bounded by columns, not by rows."""
    rows = (plan.join(issues.select("dataset", "issue_index", "issue_type", "columns"), ["dataset", "issue_index"])
                .orderBy("step").collect())
    return [Step(r["action"], r["issue_type"], tuple(r["columns"] or ()), r["agent"], r["rationale"]) for r in rows]


def residual_steps(issues: DataFrame) -> list[Step]:
    """Second pass: the default action of every remaining issue that has one."""
    steps = []
    for r in issues.orderBy("issue_index").collect():
        action = CATALOGUE[r["issue_type"]][2]
        if action and action != "ignore":
            steps.append(Step(action, r["issue_type"], tuple(r["columns"] or ()), "SecondPass",
                              f"still {r['issue_type']} after the first pass"))
    return steps


@dataclass
class Changes:
    """What corrections did to a table: the columns whose cells may differ, whether rows went, and the repeated hashes
    of its last rows if they are known."""

    columns: set[str] = field(default_factory=set)
    rows: bool = False
    hashes: DataFrame | None = None


#: Actions whose flag is raised for every cell that they change, as long as the column keeps its type.
_FLAG_TELLS_ALL = ("impute_median", "impute_mode", "normalize_dates", "normalize_categorical")


@dataclass
class _Stage:
    """Corrections waiting to be applied in one select."""

    frame: DataFrame
    rules: Rules
    written: bool = False
    count_first: bool = False
    changes: Changes = field(default_factory=Changes)
    waiting: list[tuple[Step, dict]] = field(default_factory=list)

    def must_end_before(self, step: Step) -> bool:
        return step.action in NEEDS and any(
            s.column == step.column and s.action in NEEDS for s, _ in self.waiting)

    def add(self, step: Step, entry: dict) -> None:
        self.waiting.append((step, entry))

    def _apply(self, frame: DataFrame, number: int, stats: dict) -> tuple[DataFrame, Fixed]:
        """One correction as one projection: what later ones read are columns, not nested
        expressions, so a chain of corrections on a column grows linearly."""
        step = self.waiting[number][0]
        return apply_fix(frame, step.column, step.action, self.rules, stats, f"_touched_{number}")

    def finish(self) -> DataFrame:
        """Apply what waits. If that fails, its corrections are tried one by one; one that fails alone is
        logged with the reason, and the run goes on without it."""
        try:
            return self._finish()
        except (PySparkException, Py4JJavaError) as error:
            if len(self.waiting) == 1:
                self.waiting[0][1].update(applied=False, rows_affected=0, reason=_reason(error))
                return self.frame
        frame = self.frame
        for waiting in self.waiting:
            frame = _Stage(frame, self.rules, self.written, self.count_first, self.changes, [waiting]).finish()
        return frame

    def _finish(self) -> DataFrame:
        if not self.waiting:
            return self.frame
        # Statistics are taken on each column as the stat-free actions before left it.
        before, needed = self.frame, {}
        for i, (step, _) in enumerate(self.waiting):
            if step.action in NEEDS:
                needed[step.column] = NEEDS[step.action]
            elif step.column not in needed:
                before, _ = self._apply(before, i, {})
        stats = {}
        if needed:
            stats = statistics(before, {c: (start_cell(before, c), names) for c, names in needed.items()})

        frame, numbers_only = self._applied(range(len(self.waiting)), stats)
        flags = [f"_touched_{i}" for i in range(len(self.waiting))]
        counted = self.count_first or (numbers_only and self.written)
        if not counted:
            frame = materialize(frame, "stage")
        counts = frame.agg(*[F.count_if(f).alias(f) for f in flags]).first()
        for (_, entry), flag in zip(self.waiting, flags):
            entry["rows_affected"] = counts[flag]
        if counted:
            types = dict(self.frame.dtypes)
            idle = [i for i, (step, _) in enumerate(self.waiting) if not counts[flags[i]] and step.action in _FLAG_TELLS_ALL
                    and dict(frame.dtypes)[step.column] == types[step.column]]
            left = [i for i in range(len(self.waiting)) if i not in idle]
            frame, numbers_only = self._applied(left, stats) if idle else (frame, numbers_only)
            if left and not (numbers_only and self.written):
                frame = materialize(frame, "stage")
                self.written = True
            self.changes.columns.update(self.waiting[i][0].column for i in left)
        else:
            self.written = True
            self.changes.columns.update(step.column for step, _ in self.waiting)
        if self.changes.columns:
            self.changes.hashes = None
        return frame.select(*[col(c) for c in self.frame.columns])

    def _applied(self, numbers: Iterable[int], stats: dict) -> tuple[DataFrame, bool]:
        """The table with some of the corrections and their flags, and whether all of them are of columns of numbers."""
        frame, numbers_only = self.frame, True
        for i in numbers:
            step, entry = self.waiting[i]
            numbers_only = numbers_only and start_cell(frame, step.column).is_number
            frame, fixed = self._apply(frame, i, stats.get(step.column, {}))
            entry.update(applied=fixed.applied, value=fixed.value, lower=fixed.lower, upper=fixed.upper,
                         reason=fixed.reason)
        return frame, numbers_only


def _reason(error: Exception) -> str:
    return "failed: " + str(error).strip().splitlines()[0][:200]


def _renamed_copies(df: DataFrame, names: Iterable[str]) -> list[str]:
    """Columns the CSV reader renamed because their header repeated an earlier one."""
    return [c for c in df.columns if any(re.fullmatch(re.escape(n) + r"\.\d+", c) for n in names)]


def apply_steps(df: DataFrame, dataset: str, steps: list[Step], rules: Rules, pass_number: int = 1,
                first_seq: int = 1, log_skipped: bool = True, written: bool = False,
                changes: Changes | None = None) -> tuple[DataFrame, list[tuple]]:
    """Run the steps in order; returns the corrected table and log rows.

    The table is written wherever a step has changed more than numbers of a written one; ``written`` says that the
    given table is one. ``changes``, if given, is told what the steps did.
    """
    entries: list[dict] = []
    changes = Changes() if changes is None else changes
    frame, stage, deduplicated = df, _Stage(df, rules, written, pass_number > 1, changes), None

    def fresh(step: Step, **values) -> dict:
        entry = dict.fromkeys(_LOG_FIELDS)
        entry.update(dataset=dataset, agent=step.agent, action=step.action, column=step.column,
                     columns=list(step.columns), issue_type=step.issue_type, rows_affected=0, applied=True,
                     rationale=step.rationale)
        entry["pass"] = pass_number
        entry.update(values)
        return entry

    def close(now: DataFrame) -> _Stage:
        return _Stage(now, rules, stage.written, pass_number > 1, changes)

    for step in steps:
        if step.action in COLUMN_FIXES and (step.column is None or step.column not in frame.columns):
            reason = ("the issue names no column" if step.column is None
                      else f"no column `{step.column}`")
            if log_skipped:
                entries.append(fresh(step, applied=False, reason=reason))
            continue
        entry = fresh(step)
        if step.action in COLUMN_FIXES:
            if stage.must_end_before(step):
                frame = stage.finish()
                stage = close(frame)
            stage.add(step, entry)
        elif step.action in ("drop_duplicates", "keep_first_by_key"):
            frame = stage.finish()
            keys = None if step.action == "drop_duplicates" else list(step.columns)
            absent = [c for c in keys or () if c not in frame.columns]
            if absent or keys == []:
                entry.update(applied=False, reason=f"no column `{absent[0]}`" if absent else "the issue names no column")
            elif keys is not None or frame is not deduplicated:
                try:
                    hashes = repeated_hashes(frame, keys)
                    if hashes.isEmpty():
                        changes.hashes = hashes if keys is None else changes.hashes
                    else:
                        # Written, so that later statistics don't drop the copies again.
                        kept = materialize(drop_duplicates(frame, keys, hashes=hashes), "deduplicated")
                        entry["rows_affected"] = frame.count() - kept.count()
                        frame, stage.written = kept, True
                        changes.rows, changes.hashes = True, None
                except (PySparkException, Py4JJavaError) as error:
                    entry.update(applied=False, reason=_reason(error))
            deduplicated = frame if keys is None else deduplicated
            stage = close(frame)
        elif step.action == "drop_unexpected_columns":
            frame = stage.finish()
            doomed = (_renamed_copies(frame, step.columns) if step.issue_type == "duplicate_column_names"
                      else [c for c in step.columns if c in frame.columns])
            frame = drop_unexpected_columns(frame, doomed)
            changes.hashes = None if doomed else changes.hashes
            entry.update(columns=doomed, rows_affected=0)
            stage = close(frame)
        else:
            entry.update(applied=False, reason="nothing to do by plan" if step.action == "ignore"
                         else f"unknown action {step.action}")
        entries.append(entry)
    frame = stage.finish()
    for i, entry in enumerate(entries):
        entry["seq"] = first_seq + i
    return frame, [tuple(e[f] for f in _LOG_FIELDS) for e in entries]


def log_frame(df: DataFrame, entries: list[tuple]) -> DataFrame:
    return small_frame(df.sparkSession, entries, LOG_SCHEMA)


__all__ = ["ACTIONS", "LOG_SCHEMA", "ROW_ID", "Step", "apply_steps", "log_frame", "plan_steps", "residual_steps"]
