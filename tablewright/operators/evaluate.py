"""Detection quality: corrupt, detect, compare with the truth."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.constants import ROW_ID
from tablewright.functions.text import plain_double
from tablewright.operators.checks import AuditOptions, audit
from tablewright.operators.corrupt import EXPECTED_ISSUES, INJECTORS, TRIAL, corrupt_trials, mix
from tablewright.operators.duplicates import _HASH, among, hash_of
from tablewright.operators.events import FAMILIES, _events, detect_events, empty_events, table_facts
from tablewright.operators.profile import profile
from tablewright.operators.rules import CrossRule, Rules, discover_rules, with_fallback_key
from tablewright.tables import col, column_groups, data_columns, is_numeric_type, materialize, rows_of_groups, small_frame, together

_IDENTITY = ["dataset", "error_type", "columns", "members", "first_row", "last_row", "digest"]
_OWNER = ["dataset", "error_type", "columns", "event_key"]


def _digest() -> Column:
    row_hash = F.xxhash64("row_id")
    # Halves are summed, as whole hashes would overflow.
    return F.concat_ws(":", F.bit_xor(row_hash), F.sum(F.shiftright(row_hash, 32)), F.sum(row_hash.bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))))


def event_sets(events: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per event (with the columns ``by``): dataset, family, columns, its set of rows, and ``same``.

    Two events have the same set of rows exactly if all of ``_IDENTITY`` and ``same`` are equal. Up to two rows the size
    and the ends say that, and only the rows of larger events are gone through again. Larger events whose size, ends and
    digest agree are compared by their members: those that share all rows with the first of them have its name, the others
    are compared among themselves.
    """
    owner = [*by, *_OWNER]
    rows = materialize(events.select(*owner, "row_id"), "members")
    counted = materialize(rows.groupBy(*owner).agg(
        F.count("*").alias("n"), F.min("row_id").alias("first_row"), F.max("row_id").alias("last_row")), "ends")
    one, two = F.col("first_row").eqNullSafe(F.col("last_row")), F.col("n") == 2
    small = counted.where(one | two).withColumn("members", F.when(one, 1).otherwise(2).cast("long"))
    parts = [small.select(*owner, "members", "first_row", "last_row", F.lit("").alias("digest"), F.lit("").alias("same"))]
    large = counted.where(~(one | two)).select(*owner)
    if large.isEmpty():
        return parts[0]
    hashes = materialize(large.select(hash_of(owner).alias(_HASH)).distinct(), "hashes")
    found = rows_of_groups(rows.where(among(hash_of(owner), hashes)), materialize(large, "large"), owner)
    members = materialize(found.groupBy(*owner, "row_id").agg(F.lit(1).alias("one")).drop("one"), "members")
    sizes = members.groupBy(*owner).agg(
        F.count("*").alias("members"), F.min("row_id").alias("first_row"), F.max("row_id").alias("last_row"), _digest().alias("digest"))
    sizes = materialize(sizes, "sizes")
    parts.append(sizes.where("members <= 2").withColumn("digest", F.lit("")).withColumn("same", F.lit("")))
    left = materialize(sizes.where("members > 2").withColumn("event", _name(owner)), "sets")
    while not left.isEmpty():
        firsts = left.groupBy(*_IDENTITY).agg(F.min("event").alias("same"))
        asked = left.join(firsts, _IDENTITY)
        named = members.withColumn("event", _name(owner)).select("event", "row_id")
        mine = named.join(asked.where("event != same").select("event", "same"), "event")
        theirs = named.join(firsts.select(F.col("same").alias("event")), "event").withColumnRenamed("event", "same")
        shared = mine.join(theirs, ["same", "row_id"]).groupBy("event").agg(F.count("*").alias("shared"))
        judged = materialize(asked.join(shared, "event", "left").withColumn(
            "equal", (F.col("event") == F.col("same")) | (F.coalesce("shared", F.lit(0)) == F.col("members"))), "judged")
        parts.append(judged.where("equal").select(*parts[0].columns))
        left = judged.where("not equal").select(*left.columns)
    return reduce(DataFrame.unionByName, parts)


def _name(owner: Sequence[str]) -> Column:
    return F.to_json(F.struct(*[col(c) for c in owner]))


def event_signatures(events: DataFrame) -> DataFrame:
    """One row per distinct event: dataset, family, columns and what tells its set of rows."""
    return event_sets(events).select(*_IDENTITY, "same").distinct().drop("same")


def match_events(truth: DataFrame, baseline: DataFrame, detected: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Event identity columns plus ``outcome``: tp, fp or fn. Events of the clean table are no findings.

    ``by`` names columns of truth and detected events that tell stacked tables apart; they lead the result.
    """
    side, identity = "_side", [*_IDENTITY, "same"]

    def of(events, name):
        stacked = events if set(by) <= set(events.columns) else events.withColumns({b: F.lit("") for b in by})
        return stacked.select(F.lit(name).alias(side), *[col(b) for b in by], *_OWNER, "row_id")

    sets = event_sets(of(truth, "truth").unionByName(of(baseline, "baseline")).unionByName(of(detected, "found")), (side, *by))
    sides = sets.where(col(side) != "baseline").groupBy(*by, *identity).agg(
        F.bool_or(col(side) == "found").alias("found"), F.bool_or(col(side) == "truth").alias("real"))
    old = materialize(sets.where(col(side) == "baseline").select(*identity).distinct().withColumn("old", F.lit(True)), "old")
    judged = sides.join(old, identity, "left").withColumn("found", F.col("found") & F.col("old").isNull()).where("found or real")
    outcome = F.when(F.col("found") & F.col("real"), "tp").when(F.col("found"), "fp").otherwise("fn")
    return judged.select(*by, *_IDENTITY, outcome.alias("outcome"))


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def with_metrics(counts: DataFrame) -> DataFrame:
    """Precision, recall and F1 (0 on empty denominators, 4 decimals) from tp, fp, fn columns."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    precision, recall = _ratio(tp, tp + fp), _ratio(tp, tp + fn)
    return (counts.withColumn("precision", F.round(precision, 4)).withColumn("recall", F.round(recall, 4))
                  .withColumn("f1", F.round(_ratio(2 * precision * recall, precision + recall), 4)))


def detection_metrics(outcomes: DataFrame) -> DataFrame:
    """Metrics per injected ``family`` and, as family ``overall``, for all together."""
    def n(name):
        return F.count_if(F.col("outcome") == name).alias(name)

    counts = outcomes.rollup("family").agg(n("tp"), n("fp"), n("fn"))
    return with_metrics(counts.withColumn("family", F.coalesce("family", F.lit("overall"))))


def clean_sample(df: DataFrame, n: int = 500, seed: int = 42) -> DataFrame:
    """``n`` rows drawn by the seeded row mix; the same rows on every run."""
    return df.orderBy(mix(seed), ROW_ID).limit(n)


def bootstrap_rules(df: DataFrame, dataset: str, cross: Sequence[CrossRule] = (), **options) -> Rules:
    """Discovered rules, with the fallback key when no key was found."""
    rules = discover_rules(df, dataset, cross, **options)
    return rules if rules.keys else with_fallback_key(rules, profile(df, dataset, **options))


def evaluate(
    df: DataFrame,
    dataset: str,
    rules: Rules,
    families: Sequence[str] = tuple(INJECTORS),
    rate: float = 0.01,
    seed: int = 42,
    detectors: Sequence[str] = FAMILIES,
    with_audit: bool = False,
    detect=detect_events,
    trials: int = 1,
) -> tuple[DataFrame, DataFrame]:
    """(metrics per family and overall, trial outcomes).

    Every family corrupts the whole table ``trials`` times at ``rate``, each time other rows. One pass of the detectors
    judges all corrupted tables, each by its own values; outcomes are summed over the trials, whose
    number is in ``runs`` if there are several. ``detect_events`` gets the copies by the rows that they change; other detectors and audits
    get all their rows, stacked in one table. ``with_audit`` also reports how often the audit of a corrupted table
    raised an issue of the expected type.
    """
    apart = detect is detect_events and not with_audit
    known = {}
    if apart:  # the table is read some seven times
        facts = table_facts(df, rules, sorted({*detectors, *families}), wide=True)
        df, known = facts.rows.select(*[col(c) for c in df.columns]), {"facts": facts}
    baseline, (bad, truth) = together(
        df.sparkSession, lambda: detect(df, dataset, rules, detectors, **known),
        lambda: corrupt_trials(df, dataset, rules, families, rate, seed, trials, apart, **known))
    bad = bad if apart else materialize(bad, "corrupted")
    matched = match_events(truth, baseline, detect(bad, dataset, rules, detectors, by=(TRIAL,), **known), (TRIAL,))
    family, number = F.substring_index(TRIAL, ":", 1), F.substring_index(TRIAL, ":", -1).cast("int")
    outcomes = materialize(matched.select(*_IDENTITY, "outcome", family.alias("family"), number.alias("trial")), "trials")
    metrics = detection_metrics(outcomes)
    if with_audit:
        hits = []
        for name in families:
            found = 0
            for k in range(trials):
                issues = audit(bad.where(F.col(TRIAL) == f"{name}:{k}").drop(TRIAL), dataset, rules, AuditOptions(samples=False))
                found += int(not issues.where(F.col("issue_type").isin(*EXPECTED_ISSUES[name])).isEmpty())
            hits.append((name, trials, found))
        hit = small_frame(df.sparkSession, hits, "family string, runs int, issue_hits int")
        overall = hit.agg(F.lit("overall").alias("family"), F.sum("runs").cast("int").alias("runs"),
                          F.sum("issue_hits").cast("int").alias("issue_hits"))
        both = hit.unionByName(overall).withColumn("issue_hit_rate", F.round(F.col("issue_hits") / F.col("runs"), 4))
        metrics = metrics.join(F.broadcast(both), "family", "left")
    elif trials > 1:
        counted = outcomes.select("family", "trial").distinct().rollup("family").agg(F.count("*").cast("int").alias("runs"))
        metrics = metrics.join(counted.withColumn("family", F.coalesce("family", F.lit("overall"))), "family", "left")
    return metrics, outcomes


# ---------------------------------------------------------------- baselines

def no_op_events(df: DataFrame, dataset: str, rules: Rules, families: Sequence[str] = (), by: Sequence[str] = ()) -> DataFrame:
    """Detector that finds nothing."""
    return empty_events(df, by)


def naive_events(df: DataFrame, dataset: str, rules: Rules, families: Sequence[str] = (), by: Sequence[str] = ()) -> DataFrame:
    """Detector that knows only real NULLs and strict number casts."""
    text, numeric, _ = column_groups(df)
    keep = [c for c in data_columns(df) if c in text + numeric and c not in by]
    rule_columns = [r.column for r in rules.numeric if r.column in text]
    problems = F.array_compact(F.array(
        *[F.when(col(c).isNull(), F.struct(F.lit("disguisednull").alias("family"), F.lit(c).alias("column")))
          for c in keep],
        *[F.when(col(c).isNotNull() & plain_double(col(c)).isNull(),
                 F.struct(F.lit("wrong_but_parseable").alias("family"), F.lit(c).alias("column")))
          for c in rule_columns if not is_numeric_type(df.schema[c].dataType)]))
    rows = df.select(*[col(b) for b in by], ROW_ID, F.explode(problems).alias("e"))
    return _events(rows, dataset, F.col("e.family"), "naive", F.col("e.column"), by=by)
