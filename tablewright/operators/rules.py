"""Validation rules: found in the data or written by the user, always passed as a value."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablewright.constants import FORBIDDEN_SYMBOLS
from tablewright.operators.profile import profile

RULE_SCHEMA = ("column string, position int, semantic_type string, temporal_kind string, "
               "required boolean, min_value double, forbid_tokens array<string>, key_rank int")
KEY_COLUMNS = 3
from tablewright.tables import small_frame


@dataclass(frozen=True)
class ColumnRule:
    """What one column should look like."""

    column: str
    position: int = 0
    semantic_type: str = "unknown"
    temporal_kind: str | None = None
    required: bool = False
    min_value: float | None = None
    forbid_tokens: tuple[str, ...] = ()
    key_rank: int | None = None


@dataclass(frozen=True)
class CrossRule:
    """A rule over several columns of a row: ``le``, ``year_matches``, ``period_matches``,
    ``product_matches`` or ``date_order``, with its columns in that rule's order."""

    kind: str
    columns: tuple[str, ...]


@dataclass(frozen=True)
class Rules:
    """All rules of one dataset."""

    columns: tuple[ColumnRule, ...] = ()
    cross: tuple[CrossRule, ...] = field(default=())

    @property
    def numeric(self) -> list[ColumnRule]:
        return [r for r in self.columns if r.semantic_type == "numeric"]

    @property
    def formats(self) -> dict[str, str]:
        return {r.column: r.temporal_kind for r in self.columns
                if r.semantic_type == "date" and r.temporal_kind}

    @property
    def keys(self) -> list[str]:
        ranked = [r for r in self.columns if r.key_rank is not None]
        return [r.column for r in sorted(ranked, key=lambda r: r.key_rank)]

    def minimum(self, column: str) -> float | None:
        return next((r.min_value for r in self.columns
                     if r.column == column and r.semantic_type == "numeric"), None)

    def with_cross(self, *cross: CrossRule) -> Rules:
        return replace(self, cross=tuple(cross))

    def to_df(self, spark: SparkSession) -> DataFrame:
        rows = [(r.column, r.position, r.semantic_type, r.temporal_kind, r.required, r.min_value,
                 list(r.forbid_tokens), r.key_rank) for r in self.columns]
        return small_frame(spark, rows, RULE_SCHEMA)


def rules_from_profile(profiles: DataFrame) -> DataFrame:
    """One rule row per column of every profiled dataset."""
    is_key = ((F.col("present_count") > 0) & (F.col("unique_ratio") >= 0.98)
              & (F.col("completeness") >= 0.95))
    by_position = Window.partitionBy("dataset").orderBy("position")
    key_rank = F.when(is_key, F.count_if(is_key).over(by_position))
    numeric = F.col("semantic_type") == "numeric"
    symbols = F.array(*[F.lit(s) for s in FORBIDDEN_SYMBOLS])
    return profiles.withColumn("rank", key_rank).select(
        "dataset", "column", "position", "semantic_type", "temporal_kind",
        ((F.col("completeness") >= 0.80) & (F.col("nunique_present") > 1)).alias("required"),
        F.when(numeric, F.col("min_value")).alias("min_value"),
        F.when(numeric, F.array_intersect(symbols, "forbid_tokens"))
         .otherwise(F.array().cast("array<string>")).alias("forbid_tokens"),
        F.when(F.col("rank") <= KEY_COLUMNS, F.col("rank").cast("int")).alias("key_rank"))


def discover_rules(df: DataFrame, dataset: str, cross: Sequence[CrossRule] = (),
                   sample_fraction: float | None = None, seed: int = 42, **options) -> Rules:
    """Rules found in the data. All rows are profiled; ``sample_fraction`` is an opt-in."""
    source = df.sample(sample_fraction, seed) if sample_fraction else df
    rows = rules_from_profile(profile(source, dataset, **options)).orderBy("position").collect()
    if not rows or df.isEmpty():
        raise ValueError(f"cannot discover rules of an empty table: {dataset}")
    return Rules(tuple(rule_from_row(r) for r in rows), tuple(cross))


def rule_from_row(r) -> ColumnRule:
    return ColumnRule(r["column"], r["position"], r["semantic_type"], r["temporal_kind"], r["required"],
                      r["min_value"], tuple(r["forbid_tokens"]), r["key_rank"])


def fallback_key(profiles: DataFrame) -> DataFrame:
    """The most unique well-filled column of each dataset, for tables without a discovered key."""
    enough = F.greatest(F.lit(8).cast("long"), F.floor(F.col("total") * 0.80))
    ratio = F.try_divide(F.col("nunique_present"), F.col("present_count"))
    best = Window.partitionBy("dataset").orderBy(F.desc("ratio"), F.desc("column"))
    return (profiles.where(F.col("present_count") >= enough).withColumn("ratio", ratio)
            .where(F.col("ratio") >= 0.98)
            .withColumn("rank", F.row_number().over(best)).where("rank = 1")
            .select("dataset", "column", F.round("ratio", 6).alias("unique_ratio")))


def with_fallback_key(rules: Rules, profiles: DataFrame) -> Rules:
    """Rules with the fallback key filled in when no key was found."""
    if rules.keys:
        return rules
    best = fallback_key(profiles).first()
    if best is None:
        return rules
    return replace(rules, columns=tuple(
        replace(r, key_rank=1) if r.column == best["column"] else r for r in rules.columns))


def schema_fingerprint(rules: DataFrame) -> DataFrame:
    """md5 of names, types and rules of each dataset; equal rules give equal fingerprints."""
    entry = F.to_json(F.struct("position", "column", "semantic_type", "temporal_kind", "min_value",
                               "forbid_tokens"))
    return rules.groupBy("dataset").agg(
        F.md5(F.array_join(F.sort_array(F.collect_list(entry)), ",")).alias("fingerprint"))
