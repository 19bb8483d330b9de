"""tablewright: find, fix and score data-quality problems of large tables on Spark."""

from tablewright.constants import WEIGHTS
from tablewright.operators.checks import AuditOptions, audit
from tablewright.operators.evaluate import evaluate
from tablewright.operators.events import detect_events
from tablewright.operators.fixes import ACTIONS, fix_column
from tablewright.operators.issues import CHECKS, issues_summary
from tablewright.operators.profile import profile
from tablewright.operators.rules import ColumnRule, CrossRule, Rules, discover_rules
from tablewright.plans.run import QualityResult, iter_quality, run_many, run_quality

__all__ = [
    "ACTIONS", "AuditOptions", "CHECKS", "ColumnRule", "CrossRule", "QualityResult", "Rules", "WEIGHTS", "audit",
    "detect_events", "discover_rules", "evaluate", "fix_column", "issues_summary", "iter_quality", "profile",
    "run_many", "run_quality",
]
