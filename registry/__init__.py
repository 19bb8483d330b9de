"""Registered queries over the test tables, each next to its equivalent SQL."""

from __future__ import annotations


def load():
    """(queries, oracle SQL) of all query modules."""
    from registry import (  # noqa: F401
        base, check_queries, event_queries, fix_queries, plan_queries, profile_queries, quality_queries, run_queries, source_queries)

    return base.QUERIES, base.ORACLE
