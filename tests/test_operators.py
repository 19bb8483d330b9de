import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright import AuditOptions, ColumnRule, CrossRule, Rules, audit, discover_rules, iter_quality, run_quality
from tablewright.constants import ROW_ID
from tablewright.functions.numeric import parse_number_loose
from tablewright.operators import checks as ck
from tablewright.operators.cells import numbers
from tablewright.operators import duplicates as duplicates_module
from tablewright.operators import evaluate as evaluate_module
from tablewright.operators.bitmaps import bitmap_of
from tablewright.operators.cells import typed_cells, typed_values, value_table
from tablewright.operators.corrupt import TRIAL, corrupt, corrupt_trials
from tablewright.operators.duplicates import drop_duplicates, duplicate_groups
from tablewright.operators.evaluate import evaluate, event_signatures, match_events
from tablewright.operators.events import detect_events, key_conflict_events
from tablewright.operators.fixes import fix_column, modes, start_cell
from tablewright.operators import quantiles as quantiles_module
from tablewright.operators import events as events_module
from tablewright.operators.quantiles import exact_quantiles
from tablewright.operators.rules import with_fallback_key
from tablewright.operators.score import datasets_frame, reliability, sub_scores
from tablewright.plans import planner as pl
from tablewright.plans.apply import Step, apply_steps
from tablewright.plans.run import STAGES
from tablewright.sources import read_csv, write_fixed, write_result
from tablewright.operators.profile import profile
from tablewright.functions.temporal import classify_format, parse_timestamp
from tablewright.functions.text import as_text
from tablewright.tables import local_rows, materialize, new_path, rows_of_groups, small_frame, with_row_id

# One anomaly per row, as in the fixture of the orders table.
SHOWCASE = [
    (0, "ORD-2025-000001", "N.D.", "2025-02-17", "2025-02-18", "2", "10.00", "20.00", "PayPal"),
    (1, "ORD-2025-000002", "Lamp", "17/02/2025", "2025-02-18", "1", "25.50", "25.50", "PayPal"),
    (2, "ORD-2025-000003", "Lamp", "2025-03-01", "2025-03-02", "1", "9999.99", "9999.99", "PayPal"),
    (3, "ORD-2025-000004", "Book", "2025-03-03", "2025-03-04", "1", "52.87 EUR", "52.87", "PayPal"),
    (4, "ORD-2025-000005", "Book", "2025-03-05", "2025-03-06", "3", "5.00", "15.00", "?"),
    (5, "ORD-2025-000006", "Book", "2025-03-05", "2025-03-02", "3", "5.00", "15.00", "PayPal"),
    (6, "ORD-2025-000007", "Pen", "2025-03-05", "2025-03-06", "2", "1.50", "3.00", "Bitcoin"),
    (7, "ORD-2025-000001", "N.D.", "2025-02-17", "2025-02-18", "2", "10.00", "20.00", "PayPal"),
]
ORDER_SCHEMA = (f"{ROW_ID} bigint, order_id string, product string, order_date string, ship_date string, quantity string, "
                "unit_price string, total_price string, payment string")
ORDER_RULES = Rules((
    ColumnRule("order_id", 0, "string", None, True, key_rank=1), ColumnRule("product", 1, "string", None, True),
    ColumnRule("order_date", 2, "date", "date", True), ColumnRule("ship_date", 3, "date", "date", True),
    ColumnRule("quantity", 4, "numeric", None, True, 0.0), ColumnRule("unit_price", 5, "numeric", None, True, 0.0),
    ColumnRule("total_price", 6, "numeric", None, True, 0.0), ColumnRule("payment", 7, "string", None, True)),
    (CrossRule("date_order", ("order_date", "ship_date")),
     CrossRule("product_matches", ("total_price", "quantity", "unit_price"))))


@pytest.fixture(scope="module")
def orders(spark):
    return small_frame(spark, SHOWCASE, ORDER_SCHEMA)


def issues_of(df):
    return {(r["issue_type"], r["columns"][0]): r for r in df.collect()}


def test_showcase_audit(orders):
    found = issues_of(audit(orders, "orders", ORDER_RULES))
    assert found[("missing_mandatory_values", "product")]["row_count"] == 2
    assert found[("missing_mandatory_values", "product")]["severity"] == "critical"
    assert found[("missing_mandatory_values", "payment")]["severity"] == "high"
    assert found[("mixed_format_family", "order_date")]["row_count"] == 8
    assert found[("exact_duplicate_rows", "order_id")]["row_count"] == 2
    assert found[("duplicate_business_keys", "order_id")]["row_count"] == 2
    assert found[("date_order_violation", "order_date")]["row_count"] == 1
    assert found[("iqr_outliers", "unit_price")]["row_count"] == 1
    assert ("product_mismatch", "total_price") not in found
    assert found[("sparse_column", "product")]["completeness"] == 0.75


def test_run_stages_and_invariants(orders):
    stages, last = [], None
    for stage, last in iter_quality(orders, "orders", ORDER_RULES):
        stages.append(stage)
    assert tuple(stages) == STAGES
    row = last.scores.first()
    assert 0 <= row["reliability_score"] <= row["post_reliability_score"] <= 100
    assert last.fixed.count() == 7
    again, log = apply_steps(last.fixed, "orders", [Step("normalize_dates", "mixed_format_family", ("order_date",)),
                                                    Step("drop_duplicates", "exact_duplicate_rows", ("order_id",)),
                                                    Step("clip_to_min", "value_below_minimum", ("unit_price",))], ORDER_RULES)
    assert [e[8] for e in log] == [0, 0, 0]
    assert again.count() == 7


@pytest.mark.parametrize("missing,rows,required,severity", [
    (2, 10, True, "critical"), (1, 10, True, "high"), (2, 10, False, "medium"), (1, 10, False, "low")])
def test_null_severity(spark, missing, rows, required, severity):
    df = small_frame(spark, [("?" if i < missing else "x",) for i in range(rows)], "a string")
    rules = Rules((ColumnRule("a", 0, "string", None, required),))
    assert ck.check_nulls(df, "t", local_rows(ck.audit_facts(df, rules))).first()["severity"] == severity


@pytest.mark.parametrize("missing,severity", [(14, None), (15, None), (16, "medium"), (40, "medium"), (41, "high")])
def test_sparse_severity(spark, missing, severity):
    df = small_frame(spark, [(None if i < missing else "x",) for i in range(100)], "a string")
    found = ck.check_sparse_columns(df, "t", local_rows(ck.audit_facts(df, Rules()))).first()
    assert (found and found["severity"]) == severity


@pytest.mark.parametrize("values,expected", [
    ([1, 2, 3, 4, 5, 6, 100], False), ([1, 1, 1, 1, 2, 2, 2, 3, 3], False), ([5] * 20 + [1, 2, 3, 4], False),
    ([1, 2, 3, 4, 5, 6, 7, 100], True)])
def test_outlier_guards(spark, values, expected):
    df = small_frame(spark, [(str(v),) for v in values], "a string")
    fences = ck.iqr_fences(df, ["a"])
    assert bool(fences.count() and ck.outlier_counts(df, fences).first()["outliers"]) is expected


@pytest.mark.parametrize("n,rare", [(199, False), (2000, True)])
def test_rare_value_guard(spark, n, rare):
    df = small_frame(spark, [("a" if i else "odd",) for i in range(n)], "a string")
    values = ck.category_values(df, 200)
    assert (ck.check_categorical_rare_values(df, "t", values).count() == 1) is rare


def test_case_variants_count_variants_not_rows(spark):
    df = small_frame(spark, [(v,) for v in ["Roma"] * 5 + ["ROMA", "roma", "Milano"]], "a string")
    issue = ck.check_categorical_case_variants(df, "t", ck.category_values(df, 200)).first()
    assert issue["row_count"] == 3


@pytest.mark.parametrize("block_rows", [10, 1000, 10**6])
def test_exact_quantiles_with_a_hot_value(spark, block_rows):
    """A third of all rows share one value; brackets are narrowed and still exact."""
    rng = np.random.default_rng(5)
    values = [7.0] * 4000 + [float(x) for x in rng.lognormal(2, 2, 8000)]
    df = small_frame(spark, [(v,) for v in values], "a double").repartition(4)
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]
    found = exact_quantiles(df, ["a"], probs, block_rows=block_rows, accuracy=100)
    for p in probs:
        assert found[("a", p)] == pytest.approx(np.quantile(values, p), rel=1e-12)


@pytest.mark.parametrize("rounds", [0, 1])
def test_quantiles_whose_brackets_do_not_settle(spark, monkeypatch, rounds):
    """Sorted by ranges with counted offsets: no window or sort sees a column as a whole."""
    monkeypatch.setattr(quantiles_module, "MAX_ROUNDS", rounds)
    rng = np.random.default_rng(8)
    values = [float(x) for x in np.concatenate([rng.normal(0, 1e-9, 3000), rng.lognormal(0, 30, 3000), np.full(3000, 5.0)])]
    df = small_frame(spark, [(v, -v if v < 1 else None) for v in values], "a double, b double").repartition(4)
    probs, distinct = [0.0, 0.1, 0.5, 0.66, 1.0], {}
    found = exact_quantiles(df, ["a", "b"], probs, block_rows=50, accuracy=4, distinct=distinct)
    for p in probs:
        assert found[("a", p)] == pytest.approx(np.quantile(values, p), rel=1e-12)
        assert found[("b", p)] == pytest.approx(np.quantile([-v for v in values if v < 1], p), rel=1e-12)
    if not rounds:
        assert distinct == {"a": len(set(values)), "b": len({v for v in values if v < 1})}


def test_ranges_spread_an_unreduced_column(spark, monkeypatch):
    """What is sorted is dealt out by ranges: a task's window gets a part of the column only."""
    seen = []

    def spy(df, label="table"):
        out = materialize(df, label)
        seen.append((label, out))
        return out

    monkeypatch.setattr(quantiles_module, "materialize", spy)
    monkeypatch.setattr(quantiles_module, "MAX_ROUNDS", 0)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        values = spark.range(20_000).select(F.lit("a").alias("column"), (F.col("id") * 3 % 20_011).cast("double").alias("number"), F.lit(2).cast("long").alias("n"))
        found = quantiles_module.counted_quantiles(values, ["a"], [0.5], {"a": 40_000}, block_rows=100)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert found[("a", 0.5)] == statistics.median([i * 3 % 20_011 for i in range(20_000)] * 2)
    sizes = [r["count"] for r in dict(seen)["ranges"].groupBy("part").count().collect()]
    assert len(sizes) == 4 and max(sizes) < 8_000


def test_bitmap_holds_all_and_lets_few_others_through(spark):
    hashes = materialize(spark.range(3000).select(F.xxhash64("id").alias("h")), "hashes")
    bits = bitmap_of(hashes, "h")
    row = spark.range(100_000).where(bits.may_hold(F.xxhash64("id"))).agg(F.count("*").alias("n"), F.count_if(F.col("id") < 3000).alias("own")).first()
    assert row["own"] == 3000 and row["n"] < 3000 + 97_000 * 0.1
    assert bitmap_of(hashes.limit(0), "h") is None


def _executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("few", [2_000, 0])
def test_only_suspects_of_duplicates_are_shuffled_once(spark, monkeypatch, few):
    monkeypatch.setattr(duplicates_module, "FEW", few)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = materialize(spark.range(5000).select(F.col("id").alias(ROW_ID), F.concat(F.lit("v"), F.col("id") % 4990).alias("a"), F.lit("x").alias("b")), "t")
        kept = drop_duplicates(df)
        plan = _executed(kept).split("== Initial Plan ==")[0]
        assert kept.count() == 4990
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Join" not in plan and len([line for line in plan.splitlines() if "Exchange hashpartitioning" in line]) == 1


def test_value_table_counts_every_cell_once(spark):
    rows = [(i, "hot" if i % 3 else f" v{i} ", None if i % 5 == 0 else float(i % 7), i % 2) for i in range(300)]
    df = small_frame(spark, rows, f"{ROW_ID} bigint, a string, x double, k int")
    cells = typed_cells(df).drop(ROW_ID)
    assert sorted(map(str, cells.collect())) == sorted(
        str(r) for r in typed_values(value_table(df), df).withColumn("i", F.explode(F.sequence(F.lit(1), F.col("n")))).select(*cells.columns).collect())
    seen = {(r["column"], r["value"]): r["seen"] for r in value_table(df).collect()}
    assert seen[("a", "hot")] == 1 and seen[("x", None)] == 0 and seen[("k", "1.0")] == 1


def test_sorted_text_column_is_not_taken_for_a_category(spark):
    """The first thousands of rows hold one value, the column as a whole thousands."""
    df = spark.range(20_000).select(F.col("id").alias(ROW_ID), F.when(F.col("id") < 15_000, "same").otherwise(F.concat(F.lit("v"), "id")).alias("a"),
                                    F.concat(F.lit("c"), F.col("id") % 200).alias("b"))
    assert ck.low_cardinality_columns(df, 200) == ["b"]
    for values in (None, value_table(df)):
        assert {r["column"] for r in ck.category_values(df, 200, values=values).select("column").distinct().collect()} == {"b"}


def scans_of(spark, path, job):
    """How many scans of files under ``path`` were run by ``job``."""
    store = spark._jsparkSession.sharedState().statusStore()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    before = store.executionsCount()
    job()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    found = 0
    for i in range(int(before), int(store.executionsCount())):
        execution = store.executionsList(i, 1).head()
        nodes = store.planGraph(execution.executionId()).allNodes()
        found += sum(nodes.apply(k).name().startswith("Scan parquet") and path in nodes.apply(k).desc() for k in range(nodes.size()))
    return found


def test_an_audit_scans_the_table_at_most_five_times(spark, clean):
    path = "/tmp/" + new_path(spark, "t").rsplit("-", 1)[1][:8]
    clean.unionByName(clean.limit(20)).write.parquet(path)
    df = spark.read.parquet(path)
    assert 2 <= scans_of(spark, path, lambda: audit(df, "t", CLEAN_RULES)) <= 5
    assert 2 <= scans_of(spark, path, lambda: detect_events(df, "t", CLEAN_RULES).collect()) <= 3


def test_duplicates_hot_group_both_ways(spark):
    rows = [(i, "hot", None) if i % 3 == 0 else (i, f"v{i // 2}", "x") for i in range(600)]
    df = small_frame(spark, rows, f"{ROW_ID} bigint, a string, b string").repartition(4)
    seen, firsts = {}, []
    for i, a, b in rows:
        seen[(a, b)] = seen.get((a, b), 0) + 1
        if seen[(a, b)] == 1:
            firsts.append(i)
    want = {k: n for k, n in seen.items() if n > 1}
    for threshold in ("-1", "10m"):  # shuffled, and broadcast
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        groups = duplicate_groups(df).collect()
        assert {(r["a"], r["b"]): r["n"] for r in groups} == want
        assert sorted(r[ROW_ID] for r in drop_duplicates(df).collect()) == firsts


def test_hot_key_members_salted_and_broadcast(spark, monkeypatch):
    rows = [(i, "hot" if i % 3 == 0 else (None if i % 3 == 1 else f"k{i}")) for i in range(300)]
    df = small_frame(spark, rows, f"{ROW_ID} bigint, k string")
    rules = Rules((ColumnRule("k", key_rank=1),))
    want = sorted(i for i, k in rows if k in ("hot", None))
    assert sorted(r["row_id"] for r in key_conflict_events(df, "t", rules).collect()) == want
    groups = df.groupBy("k").agg(F.count("*").alias("n"))
    assert rows_of_groups(df, groups, ["k"]).count() == 300


def test_mode_ties_go_to_the_smallest(spark):
    df = small_frame(spark, [("b",), ("a",), ("a",), ("b",), ("?",), ("?",), ("?",)], "a string")
    assert modes(df, {"a": start_cell(df, "a")}) == {"a": "a"}
    fixed = fix_column(df, "a", "impute_mode")
    assert [r["a"] for r in fixed.where("a = 'a'").collect()] == ["a"] * 5


def test_median_and_clip(spark):
    values = [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 1000.0]
    df = small_frame(spark, [(str(v),) for v in values] + [("n/a",)], "a string")
    assert fix_column(df, "a", "impute_median").collect()[-1]["a"] == statistics.median(values)
    q1, q3 = np.quantile(values, [0.25, 0.75])
    assert max(r["a"] for r in fix_column(df, "a", "clip_iqr").collect() if r["a"] is not None) == q3 + 1.5 * (q3 - q1)
    assert numbers(df, ["a"]).where("a is null").count() == 1


def test_fixes_without_data_are_logged_as_not_applied(spark):
    df = small_frame(spark, [(1, "x"), (2, "?")], f"{ROW_ID} bigint, a string")
    steps = [Step(a, "t", ("a",)) for a in ("impute_median", "clip_iqr", "clip_to_min")] + [
        Step("clip_iqr", "t", ("gone",)), Step("clip_iqr", "t", ()), Step("ignore", "t", ("a",))]
    out, log = apply_steps(df, "t", steps, Rules())
    assert [(e[9], e[13]) for e in log] == [
        (False, "no numbers"), (False, "no numbers"), (False, "no minimum declared"),
        (False, "no column `gone`"), (False, "the issue names no column"),
        (False, "nothing to do by plan")]
    assert out.collect() == df.collect()


def _issues(spark, *rows):
    schema = ("issue_index bigint, dataset string, issue_type string, severity string, columns array<string>, row_count bigint, "
              "completeness double, missing_ratio double")
    return small_frame(spark, [(i, "t", t, s, ["a"], 1, c, m) for i, (t, s, c, m) in enumerate(rows)], schema)


def test_scores_exempt_dead_columns_and_names(spark):
    issues = _issues(spark, ("missing_optional_values", "medium", None, 0.96), ("sparse_column", "high", 0.04, None),
                     ("naming_convention_violation", "low", None, None), ("iqr_outliers", "medium", None, None),
                     ("duplicate_business_keys", "high", None, None))
    scores = {r["dimension"]: r["sub_score"] for r in sub_scores(issues).collect()}
    assert scores == {"completeness": 1.0, "consistency": 0.8, "validity": 1.0, "uniqueness": 0.8, "accuracy": 0.92}
    assert reliability(sub_scores(issues)).first()["reliability_score"] == 91.2
    assert reliability(sub_scores(issues.limit(0), datasets_frame(spark, "t"))).first()["reliability_score"] == 100.0


def test_plan_validation(spark):
    issues = _issues(spark, ("iqr_outliers", "medium", None, None), ("value_below_minimum", "high", None, None),
                     ("categorical_rare_value", "low", None, None), ("invalid_format_values", "high", None, None))
    text = "Sure:\n```json\n" + ('[{"i": 0, "action": "ignore", "why": "careful"}, {"i": 1, "action": "ignore", "why": "ID column"},'
                                 '{"i": 2, "action": "explode", "why": "x"}]') + "\n```"
    bad = '[{"i": 3, "action": "ignore", "why": "naming"}, {"i": 3, "action": "ignore", "why": "naming"}]'
    proposal = pl.parse_plan_text(small_frame(spark, [("t", "Anomaly", text), ("t", "Consistency", bad)],
                                              "dataset string, agent string, text string"))
    plan = {r["issue_index"]: r for r in pl.validated_plan(issues, proposal).collect()}
    assert (plan[0]["action"], plan[0]["overridden"]) == ("clip_iqr", True)
    assert (plan[1]["action"], plan[1]["overridden"]) == ("ignore", False)
    assert plan[2]["action"] == "ignore"
    assert plan[3]["action"] == "normalize_dates" and plan[3]["rationale"].startswith("default for")
    assert [r["agent"] for r in pl.default_plan(issues).orderBy("step").collect()] == ["Consistency"] + ["Anomaly"] * 3


def test_discovery(spark):
    rows = [(i, f"k{i}x", str(i), "2024-01-%02d" % (i % 28 + 1), "2024-%02d" % (i % 12 + 1), None) for i in range(60)]
    df = small_frame(spark, rows, f"{ROW_ID} bigint, code string, n string, d string, p string, empty string")
    rules = {r.column: r for r in discover_rules(df, "t").columns}
    assert (rules["d"].semantic_type, rules["d"].temporal_kind, rules["p"].temporal_kind) == ("date", "date", "period")
    assert rules["n"].min_value == 0.0 and rules["empty"].semantic_type == "unknown" and not rules["empty"].required
    assert [c for c, r in rules.items() if r.key_rank] == ["code", "n"]
    with pytest.raises(ValueError):
        discover_rules(df.limit(0), "t")
    from tablewright.operators.profile import profile
    keyless = Rules((ColumnRule("d"), ColumnRule("code")))
    assert with_fallback_key(keyless, profile(df.select(ROW_ID, "d", "code"), "t")).keys == ["code"]


@pytest.fixture(scope="module")
def clean(spark):
    rows = [(i, f"ORD-{i:05d}", "OFP"[i % 3], "2024-%02d-%02d" % (i % 12 + 1, i % 28 + 1), "2024", "%.2f" % (100 + i % 97))
            for i in range(400)]
    return small_frame(spark, rows, f"{ROW_ID} bigint, order_id string, status string, order_date string, order_year string, total string")


CLEAN_RULES = Rules((ColumnRule("order_id", 0, "string", None, True, key_rank=1), ColumnRule("status", 1, "string", None, True),
                     ColumnRule("order_date", 2, "date", "date", True), ColumnRule("order_year", 3, "numeric", None, True, 0.0),
                     ColumnRule("total", 4, "numeric", None, True, 0.0)), (CrossRule("year_matches", ("order_date", "order_year")),))


def test_detection_quality(clean):
    """Recall is 1 for the rule-based families; every truth event has one or two rows."""
    families = ["disguisednull", "wrong_but_parseable", "mixed_date_format", "semantic_duplicate", "crossfield_inconsistency"]
    metrics, _ = evaluate(clean, "t", CLEAN_RULES, families, rate=0.05, seed=3)
    got = {r["family"]: r for r in metrics.collect()}
    assert set(got) == {*families, "overall"}
    for family in families:
        assert got[family]["tp"] > 0 and got[family]["recall"] == 1.0, family


def test_trials_are_summed_and_counted(clean):
    families = ["disguisednull", "semantic_duplicate"]
    one, _ = evaluate(clean, "t", CLEAN_RULES, families, rate=0.05, seed=3)
    many, trials = evaluate(clean, "t", CLEAN_RULES, families, rate=0.05, seed=3, trials=3)
    alone = [evaluate(clean, "t", CLEAN_RULES, [f], rate=0.05, seed=3 + i + 2 * k)[0].where("family != 'overall'").first()
             for i, f in enumerate(families) for k in range(3)]
    got = {r["family"]: r for r in many.collect()}
    for f in families:
        assert got[f]["runs"] == 3 and got[f]["recall"] == 1.0
        assert [got[f][x] for x in ("tp", "fp", "fn")] == [sum(a[x] for a in alone if a["family"] == f) for x in ("tp", "fp", "fn")]
    assert got["overall"]["runs"] == 6 and trials.select("trial").distinct().count() == 3
    assert "runs" not in one.columns


def _members(spark, events):
    rows = [("t", "semantic_duplicate", "duplicate_business_keys", "k", key, i) for key, ids in events.items() for i in ids]
    return spark.createDataFrame(rows, "dataset string, error_type string, issue_type string, columns string, event_key string, row_id bigint")


@pytest.mark.parametrize("collide", [False, True])
def test_events_of_many_rows_match_by_their_members(spark, monkeypatch, collide):
    """Sets with equal size and ends, some equal, some not, with a digest that tells nothing."""
    if collide:
        monkeypatch.setattr(evaluate_module, "_digest", lambda: F.lit("same"))
    truth = _members(spark, {"a": [1, 2, 5, 9], "b": [1, 3, 5, 9], "c": [1, 4, 6, 9], "pair": [20, 21], "long": range(100, 400)})
    found = _members(spark, {"x": [1, 3, 5, 9], "y": [1, 4, 5, 9], "z": [9, 6, 4, 1, 1], "pair2": [20, 21], "old": [1, 7, 8, 9],
                             "long2": [*range(100, 398), 398, 399], "twin": [1, 3, 5, 9]})
    base = _members(spark, {"o": [1, 8, 7, 9], "p": [1, 2, 7, 9]})
    got = match_events(truth, base, found).groupBy("outcome", "members").count().collect()
    assert {(r["outcome"], r["members"]): r["count"] for r in got} == {
        ("tp", 4): 2, ("fn", 4): 1, ("fp", 4): 1, ("tp", 2): 1, ("tp", 300): 1}


def test_stacked_tables_are_judged_each_by_itself(spark, clean):
    """Detection over stacked copies gives what detection of each copy gives."""
    families = ["iqr_outlier", "mixed_date_format", "semantic_duplicate"]
    bad, _ = corrupt_trials(clean, "t", CLEAN_RULES, families, 0.05, 5, 2)
    bad = materialize(bad, "bad")
    together = detect_events(bad, "t", CLEAN_RULES, by=(TRIAL,))
    for trial in ("iqr_outlier:1", "mixed_date_format:0", "semantic_duplicate:1"):
        alone = detect_events(bad.where(F.col(TRIAL) == trial).drop(TRIAL), "t", CLEAN_RULES)
        mine = together.where(F.col(TRIAL) == trial).drop(TRIAL)
        assert sorted(mine.collect()) == sorted(alone.collect()) and alone.count() > 5


def test_corruption_is_repeatable(clean):
    one, truth = corrupt(clean, "t", CLEAN_RULES, "semantic_duplicate", 0.05, 9)
    two, _ = corrupt(clean.repartition(3), "t", CLEAN_RULES, "semantic_duplicate", 0.05, 9)
    assert sorted(one.collect()) == sorted(two.collect())
    assert {r["members"] for r in event_signatures(truth).collect()} == {2}


def test_csv_keeps_text_and_repeated_headers(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('id,price,price,note\n1,"52.87 EUR",NA,"line one\nline ""two"""\n2,"1.234,56",x,\n')
    table = read_csv(spark, str(path), multi_line=True)
    assert table.header == ("id", "price", "price", "note")
    assert [tuple(r) for r in table.data.orderBy("id").collect()] == [
        ("1", "52.87 EUR", None, 'line one\nline "two"'), ("2", "1.234,56", "x", None)]
    run = run_quality(table.data, "t", Rules((ColumnRule("price", 1, "string"),)), header=table.header, key="id")
    assert run.fixed.columns == [*"id price note".split(), ROW_ID] and "duplicate_column_names" not in {
        r["issue_type"] for r in run.post_issues.collect()}
    target = new_path(spark, "bundle")
    write_result(run, target)
    assert spark.read.json(f"{target}/correction_log").count() == run.log.count()
    write_fixed(run.fixed, f"{target}/again", "parquet")
    assert spark.read.parquet(f"{target}/again").columns == ["id", "price", "note"]
    (tmp_path / "empty.csv").write_text("a,b\n")
    with pytest.raises(ValueError):
        read_csv(spark, str(tmp_path / "empty.csv"))


def test_audit_options_leave_out_samples(orders):
    plain = audit(orders, "orders", ORDER_RULES, AuditOptions(samples=False))
    full = audit(orders, "orders", ORDER_RULES)
    key = ["issue_index", "issue_type", "row_count"]
    assert plain.select(*key).collect() == full.select(*key).collect()


def folder(tmp_path, **files):
    for name, text in files.items():
        (tmp_path / f"{name}.csv").write_text(text)
    return str(tmp_path)


def test_csv_rows_that_do_not_fit(spark, tmp_path):
    path = folder(tmp_path, a='a,b\n1,2\n3,4,5\n6\n"x,7\n"q ""z""",8\n')
    with pytest.raises(ValueError, match="2 rows"):
        read_csv(spark, path)
    table = read_csv(spark, path, keep_bad=True)
    assert sorted(map(tuple, table.data.collect()), key=str) == [("1", "2"), ("6", None), ('q "z"', "8")]
    assert sorted(r["record"] for r in table.bad.collect()) == ['"x,7', "3,4,5"]


@pytest.mark.parametrize("split", [100, 1 << 20])
def test_csv_with_breaks_in_cells_is_split(spark, tmp_path, split):
    """Quoted breaks, doubled quotes and empty lines, with splits of a few lines, are read as in one task."""
    import csv
    import random

    rng = random.Random(split)
    parts = ["x", "long text", 'a ""', "line\nbreak", "\n\n", "\r\n", '","', "", "é", '"']
    rows = [[str(i), "".join(rng.choices(parts, k=rng.randint(0, 5))), "".join(rng.choices(parts, k=2))] for i in range(80)]
    rows += [["hot", "\n" * 200, ""]]
    for n in range(2):
        with open(tmp_path / f"{n}.csv", "w", newline="") as f:
            writer = csv.writer(f, lineterminator="\r\n" if n else "\n")
            writer.writerows([["id", "a", "b"], *[[f"{n}-{r[0]}", *r[1:]] for r in rows]])
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = read_csv(spark, str(tmp_path), nulls=(), multi_line=True).data
        found = {r["id"]: (r["a"] or "", r["b"] or "") for r in got.collect()}
        assert got.count() == len(found)
        whole = {r["id"]: (r["a"] or "", r["b"] or "") for r in read_csv(spark, str(tmp_path), nulls=(), multi_line="file").data.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert found == {f"{n}-{r[0]}": (r[1], r[2]) for n in range(2) for r in rows}
    plain = lambda cells: tuple(c.replace("\r\n", "\n") for c in cells)  # noqa: E731  in one task Spark itself changes these
    assert {k: plain(v) for k, v in found.items()} == {k: plain(v) for k, v in whole.items()}


def test_csv_files_meet_by_name(spark, tmp_path):
    table = read_csv(spark, folder(tmp_path, a="a,b\n1,2\n", b="b,a\n3,4\n"))
    assert sorted(tuple(r) for r in table.data.select("a", "b").collect()) == [("1", "2"), ("4", "3")]


@pytest.mark.parametrize("files, error", [({"a": "a,b\n1,2\n", "b": "b,c\n3,4\n"}, "different columns"), ({"a": "a,b\n"}, "no rows"),
                                          ({"a": ""}, "empty"), ({"a": '"a\nb",c\n1,2\n'}, "line break")])
def test_csv_that_cannot_be_read(spark, tmp_path, files, error):
    with pytest.raises(ValueError, match=error):
        read_csv(spark, folder(tmp_path, **files))


def test_tables_without_scalar_columns_or_issues(spark):
    nested = spark.createDataFrame([(1, [1, 2]), (2, None)], f"{ROW_ID} bigint, xs array<int>")
    assert profile(nested, "t").count() == 1 and audit(nested, "t", Rules()).count() == 0


def test_row_keys(spark):
    frame = spark.createDataFrame([("ORD-1", 1), ("ORD-2", 1)], "k string, n int")
    kept = with_row_id(frame, "k")
    assert kept.columns == ["k", "n", ROW_ID] and kept.select(ROW_ID).distinct().count() == 2
    for rows in ([("a", 1), ("a", 2)], [("a", 1), (None, 2)]):
        with pytest.raises(ValueError, match="row key"):
            with_row_id(spark.createDataFrame(rows, "k string, n int"), "k")


def test_long_fractions_are_dates(spark):
    frame = spark.createDataFrame([("2024-01-02T03:04:05." + "1" * 25,), ("2024-01-02",), ("　 ",)], "d string")
    row = frame.select(classify_format("d", "datetime").alias("label"), parse_timestamp("d").alias("stamp"), as_text("d").alias("text")).collect()
    assert row[0]["label"] == "iso_datetime" and str(row[0]["stamp"]) == "2024-01-02 03:04:05.111111" and row[2]["text"] == ""


def test_a_failing_step_is_logged_and_the_run_goes_on(spark):
    frame = small_frame(spark, [(0, "a", "1"), (1, "a", "x"), (2, "b", "2")], f"{ROW_ID} bigint, k string, v string")
    steps = [Step("keep_first_by_key", "duplicate_business_keys", ("gone",)), Step("keep_first_by_key", "duplicate_business_keys", ("k",)),
             Step("cast_numeric", "semantic_type_mismatch", ("v",))]
    fixed, log = apply_steps(frame, "t", steps, Rules())
    assert [(r[9], r[13]) for r in log][:2] == [(False, "no column `gone`"), (True, None)] and fixed.count() == 2


def test_counted_quantiles_sort_only_the_piece_that_holds_the_rank(spark, monkeypatch):
    """Wide brackets are cut and counted first; one value with most rows, and numbers in several rows, are no matter."""
    sorted_values = []

    def spy(values, spans, brackets, block_rows, distinct, read=quantiles_module._read_ranks):
        sorted_values.append(values.count())
        return read(values, spans, brackets, block_rows, distinct)

    monkeypatch.setattr(quantiles_module, "_read_ranks", spy)
    rng = np.random.default_rng(3)
    rows = [("a", float(v), int(n)) for v, n in zip(rng.lognormal(0, 20, 9000), rng.integers(1, 9, 9000))]
    rows += [("b", float(i % 3), 1) for i in range(4000)] + [("c", float(i), 30_000 if i == 2000 else 1) for i in range(4000)] * 2
    counts = {c: sum(n for k, _, n in rows if k == c) for c in "abc"}
    df, distinct, probs = small_frame(spark, rows, "column string, number double, n bigint"), {}, [0.0, 0.25, 0.75, 1.0]
    found = quantiles_module.counted_quantiles(df, list("abc"), probs, counts, block_rows=200, distinct=distinct)
    for c in "abc":
        flat = np.repeat([v for k, v, _ in rows if k == c], [n for k, _, n in rows if k == c])
        assert [found[(c, p)] for p in probs] == pytest.approx(list(np.quantile(flat, probs)), rel=1e-12)
    assert distinct["a"] >= 4 and distinct["b"] == 3 and distinct["c"] >= 4
    assert sorted_values[0] < 3000


def test_loose_numbers_without_a_point_are_cleaned_at_once(spark):
    texts = ["ORD-0012", "€ 1 200", "1.234.567,89 EUR", "7 - 3", "--5", "a.b5", "12,5", "1,2,3", "x", "1.2.3 km", "-", None]
    found = [r[0] for r in small_frame(spark, [(t,) for t in texts], "t string").select(parse_number_loose("t")).collect()]
    assert found == [-12.0, 1200.0, 1234567.89, None, None, 0.5, 12.5, None, None, None, None, None]


def test_events_of_keys_group_and_join_only_suspects(spark, monkeypatch):
    """Rows with a key of their own are neither grouped nor joined; events need no table of all distinct keys."""
    written = {}

    def spy(df, label="table"):
        out = materialize(df, label)
        written[label] = out.count()
        return out

    monkeypatch.setattr(events_module, "materialize", spy)
    rows = [(i, f"K{i if i % 100 else 0}", str(i % 50) if i != 77 else "99999") for i in range(1000)]
    df = materialize(small_frame(spark, rows, f"{ROW_ID} bigint, k string, v string"), "t")
    rules = Rules((ColumnRule("k", 0, "string", None, True, key_rank=1), ColumnRule("v", 1, "numeric", None, True, 0.0)))
    found = {(r["error_type"], r["columns"], r["row_id"]) for r in events_module.detect_events(df, "t", rules).collect()}
    assert found == {("semantic_duplicate", "k", i) for i in range(0, 1000, 100)} | {("iqr_outlier", "v", 77)}
    assert written["keys"] == 1 and written["suspects"] < 50
