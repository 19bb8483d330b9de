"""Layouts that only large tables get give what small ones give."""

from bisect import bisect_left

import pytest
from pyspark.sql import functions as F

from tablewright import ColumnRule, CrossRule, Rules
from tablewright.constants import ROW_ID, WHITESPACE
from tablewright.functions.text import as_text, title_case, values_equivalent
from tablewright.operators import cells, checks, cross, quantiles
from tablewright.operators.checks import AuditOptions, audit, row_facts
from tablewright.operators.fixes import apply_fix
from tablewright.plans import apply
from tablewright.plans.apply import Step, apply_steps
from tablewright.plans.run import run_many, run_quality
from tablewright.tables import materialize, small_frame

RULES = Rules((ColumnRule("id", 0, "string", None, True, None, (), 1), ColumnRule("price", 1, "numeric", None, True, 0.0, (), None),
               ColumnRule("day", 2, "date", "date", True, None, (), None), ColumnRule("year", 3, "numeric", None, False, None, (), None),
               ColumnRule("kind", 4, "string", None, False, None, (), None)), (CrossRule("year_matches", ("day", "year")),))


@pytest.fixture(scope="module")
def orders(spark):
    rows = [(i, f"K{i - (i % 90 == 1):05d}", "abc" if i % 50 == 3 else f" {i * 37 % 1000}.{i % 7}5 " if i % 40 else str(10**6 + i),
             f"{1 + i % 28:02d}/03/2020" if i % 5 else "2020-03-04", "2021" if i % 70 == 9 else "2020", "a" if i % 3 else "A ")
            for i in range(600)]
    return small_frame(spark, rows, f"{ROW_ID} bigint, id string, price string, day string, year string, kind string")


def test_columns_that_hardly_repeat_are_not_grouped(orders, monkeypatch):
    small = audit(orders, "t", RULES).collect()
    profile = cells.value_parts(orders)
    assert set(profile) == {True}
    monkeypatch.setattr(cells, "GROUPED_ROWS", 500)
    parts = cells.value_parts(orders)
    assert {r["column"] for r in parts[False].select("column").distinct().collect()} == {"id", "price"}
    assert {r["column"] for r in parts[True].select("column").distinct().collect()} == {"day", "year", "kind"}
    plain = cells.typed_cells(orders).drop(ROW_ID)
    spread = cells.value_table(orders).withColumn("i", F.explode(F.sequence(F.lit(1), F.col("n")))).select(*plain.columns)
    assert sorted(map(str, spread.collect())) == sorted(map(str, plain.collect()))
    assert audit(orders, "t", RULES).collect() == small and len(small) > 5
    assert audit(orders, "t", RULES, AuditOptions(rare_max_unique=10**6)).count() >= len(small)


def test_pieces_are_found_by_halving(spark):
    cuts = [float(i) for i in range(0, 300, 3)]
    numbers = [-1.0, 0.0, 0.5, 3.0, 150.0, 150.5, 297.0, 1e300, float("inf")]
    df = small_frame(spark, [(x, quantiles._padded(cuts)) for x in numbers], "number double, cuts array<double>")
    found = {r["number"]: r["piece"] for r in quantiles._with_piece(df).collect()}
    assert found == {x: bisect_left(cuts, x) for x in numbers}


def test_dates_of_rules_are_read_once(spark):
    rows = [("2020-01-02", "2020-01-03", "2020"), ("03/01/2020", " 2020-01-02 ", "2021"), ("?", "2020-01-01", "2020"), (None, None, None),
            ("not a date", "2020-01-01", "1999"), ("2021-05-05", "N/A", "1999")]
    df = small_frame(spark, rows, "a string, b string, y string")
    rules = [CrossRule("date_order", ("a", "b")), CrossRule("year_matches", ("a", "y"))]
    dated = cross.with_dates(df, rules)
    for i, rule in enumerate(rules):
        assert dated.select(cross.violation(dated, rule)).collect() == df.select(cross.violation(df, rule)).collect()
    plan = row_facts.__globals__["cross_rules"].with_dates(df, rules).columns
    assert {"_stamp:a", "_stamp:b"} <= set(plan)
    broken = sorted((b["rule"], b["row"]) for r in row_facts(df, ["y"], rules).collect() for b in r["broken"] or [])
    assert [b[0] for b in broken] == [0, 1, 1]


def test_stripped_text(spark):
    texts = ["", " ", "a", " a", "a ", " x y\t", "é", " é ", "~", "!", "\x7f", "a\x7f", "\x1c1\x1f", "0 1", "!　", "　!", "a\n"]
    df = small_frame(spark, [(t,) for t in [*texts, None]], "t string")
    assert [r[0] for r in df.select(as_text("t")).collect()] == [*[t.strip(WHITESPACE) for t in texts], None]


def test_tables_side_by_side_score_as_alone(orders):
    both = run_many({"one": orders, "two": orders.where("year = '2020'")}, rules=RULES)[1]
    alone = [run_many({"one": orders}, rules=RULES)[1], run_many({"two": orders.where("year = '2020'")}, rules=RULES)[1]]
    assert sorted(both.collect()) == sorted(alone[0].collect() + alone[1].collect())


def test_last_audit_reads_again_only_what_the_second_pass_changed(orders, monkeypatch):
    """Ids and prices are read as numbers again by the second pass; the other columns and the rule keep what the re-audit wrote."""
    monkeypatch.setattr(cells, "GROUPED_ROWS", 500)
    scanned, held, first = [], [], checks.value_parts
    monkeypatch.setattr(checks, "value_parts", lambda df, **known: scanned.append(sorted(known["same"])) or first(df, **known))
    hold = checks.AuditTables.hold_for
    monkeypatch.setattr(checks.AuditTables, "hold_for", lambda *args: hold(*args) or held.append(args[0].hashes.keys()))
    done = run_quality(orders, "t", RULES)
    assert scanned == [[], [], ["day", "kind", "year"]] and "key_hash" in held[0]
    fresh = audit(done.fixed, "t", RULES)
    assert done.post_issues.collect() == fresh.collect() and fresh.count() > 2


def test_dropped_rows_hold_nothing(orders):
    tables = checks.AuditTables()
    audit(orders, "t", RULES, tables=tables)
    fewer = orders.where("year = '2020'")
    tables.hold_for(fewer, (), True, None)
    assert audit(fewer, "t", RULES, tables=tables).collect() == audit(fewer, "t", RULES).collect()


def test_stages_of_numbers_and_idle_second_passes_are_not_written(spark, monkeypatch):
    rows = [(i, float(i % 50) if i else 1e6, "a" if i else "?", "2020-01-02") for i in range(200)]
    df = small_frame(spark, rows, f"{ROW_ID} bigint, n double, t string, d string")
    wrote = []
    monkeypatch.setattr(apply, "materialize", lambda frame, label: wrote.append(label) or materialize(frame, label))
    clip, fill, dates = Step("clip_iqr", "t", ("n",)), Step("impute_mode", "t", ("t",)), Step("normalize_dates", "t", ("d",))
    changes = apply.Changes()
    out, log = apply_steps(df, "t", [clip, dates], Rules(), 2, written=True, changes=changes)
    assert wrote == [] and [e[8] for e in log] == [1, 0] and changes.columns == {"n"} and not changes.rows
    assert out.agg(F.max("n")).first()[0] < 1e6 and sorted(out.drop("n").collect()) == sorted(df.drop("n").collect())
    out, log = apply_steps(df, "t", [fill, Step("drop_duplicates", "t", ())], Rules(), 2, written=True, changes=changes)
    assert wrote == ["stage", "deduplicated"] and log[0][8] == 1 and log[1][8] == 200 - out.count() > 0 and changes.rows


def test_numbers_read_from_text_are_compared_without_spelling_them(spark):
    texts = [None, "", "1", " 1.50 ", "1,5", "€ 5", "1e5", "abc", "1.234", "0.1000000001", "1" * 400, "Infinity", "NaN", "-7", "12 EUR"]
    df = small_frame(spark, list(enumerate(texts)), f"{ROW_ID} bigint, t string")
    fixed = apply_fix(df, "t", "cast_numeric", Rules(), {}, "touched")[0].join(df.withColumnRenamed("t", "old"), ROW_ID)
    same = values_equivalent(F.col("old"), F.col("t").cast("string"))
    assert fixed.where(F.col("touched") == same).count() == 0 and fixed.where("touched").count() > 4
    one_run = df.select(title_case(F.lit("ABC")).alias("a"), title_case(F.lit("o'NEIL é")).alias("b")).first()
    assert tuple(one_run) == ("Abc", "O'Neil É")


def test_pieces_of_equal_width_give_the_same_quantiles_whatever_the_ends(spark, monkeypatch):
    numbers = [float(i * i % 701) for i in range(400)] + [1e9] * 3 + [-5.5, 1e-300]
    rows = [("a", x, 1 + i % 3) for i, x in enumerate(numbers)] + [("b", float(i), 1) for i in range(300)]
    values = small_frame(spark, rows, "column string, number double, n bigint")
    counts = {c: sum(n for k, _, n in rows if k == c) for c in "ab"}
    plain = quantiles.counted_quantiles(values, ["a", "b"], [0.25, 0.75], counts)
    sketched, found = [], F.percentile_approx
    monkeypatch.setattr(F, "percentile_approx", lambda *args: sketched.append(args) or found(*args))
    for ends in ({"a": (-5.5, 1e9), "b": (0.0, 299.0)}, {"a": (3.0, 4.0), "b": (0.0, 1.0)}):
        assert quantiles.counted_quantiles(values, ["a", "b"], [0.25, 0.75], counts, 50, ends=ends) == plain
    sketched.clear()
    assert quantiles.counted_quantiles(values, ["b"], [0.25, 0.75], counts, 50, ends={"b": (0.0, 299.0)}) == {
        k: v for k, v in plain.items() if k[0] == "b"} and not sketched
    for ends in ({}, {"b": (None, None)}, {"b": (0.0, float("inf"))}, {"b": (7.0, 7.0)}, {"b": (-1.7e308, 1.7e308)}):
        assert quantiles._even_step(ends.get("b")) is None


def test_columns_without_bad_cells_are_not_read_again(orders, monkeypatch):
    """All numbers of the years lie inside their fences, so neither outliers nor samples are looked for among them."""
    looked, first = [], checks.numeric_samples
    monkeypatch.setattr(checks, "numeric_samples", lambda df, facts, *args, **known: looked.append(
        {r["column"] for r in facts}) or first(df, facts, *args, **known))
    rows = [(i, f"{i}", "1" if i != 5 else "1000", "x" if i == 7 else "2") for i in range(40)]
    df = small_frame(orders.sparkSession, rows, f"{ROW_ID} bigint, plain string, far string, text string")
    rules = Rules(tuple(ColumnRule(c, i, "numeric", None, False, None, (), None) for i, c in enumerate(("plain", "far", "text"))))
    values = cells.value_table(df)
    facts = {r["column"]: r for r in checks.audit_facts(df, rules, values=values).collect()}
    assert (facts["plain"]["least"], facts["plain"]["largest"]) == (0.0, 39.0)
    fences = checks.iqr_fences(df, ["plain"], values=values)
    read, typed = [], checks.typed_values
    monkeypatch.setattr(checks, "typed_values", lambda v, d, columns=None: read.append(columns) or typed(v, d, columns))
    known = checks.outlier_counts(df, fences, values, facts).collect()
    assert read == [] and known == checks.outlier_counts(df, fences, values).collect() and known[0]["outliers"] == 0
    assert audit(df, "t", rules).count() > 0 and looked == [{"text"}]


def test_copies_are_looked_for_among_rows_of_shared_keys(spark, monkeypatch):
    rows = [(i, f"K{i - (i % 10 == 1)}", "a" if i % 20 < 10 else str(i)) for i in range(300)]
    df = small_frame(spark, rows, f"{ROW_ID} bigint, id string, text string")
    facts, hashed, known = row_facts(df, ["id"], []), {}, {}
    first = checks.repeated
    monkeypatch.setattr(checks, "repeated", lambda held, name: hashed.update({name: held.count()}) or first(held, name))
    issues = checks.check_duplicates(df, "t", ["id"], True, facts, known).collect()
    assert hashed == {"key_hash": 300, "row_hash": 60} and set(known) == {"key_hash", "row_hash"}
    assert issues == checks.check_duplicates(df, "t", ["id"]).collect() and [r["row_count"] for r in issues] == [30, 60]


def test_framed_numbers_read_as_cleaned_ones(spark):
    texts = ["ORD-0012", "52.87 EUR", "€ 12", "- 5", "x-5", "5-", "1.234 EUR", "x1.2345y", "1,5 EUR", "a1b2", "EUR", "", "-.5", "1.", None]
    df = small_frame(spark, [(t,) for t in texts], "value string").select(F.lit("c").alias("column"), "value")
    found = cells._read(df, []).select("value", "number").collect()
    assert {r["value"]: r["number"] for r in found} == {r["value"]: r["n"] for r in df.select("value", cells.parse_number_loose("value").alias("n")).collect()}


def test_broken_rows_alone_keep_their_id_and_cells(spark):
    df = small_frame(spark, [(5, "2020-01-02", "2020"), (6, "2020-01-02", "2021"), (7, None, "2021")], f"{ROW_ID} bigint, day string, `the.year` string")
    facts = row_facts(df, (), [CrossRule("year_matches", ("day", "the.year"))])
    kept = facts.where("broken is not null").collect()
    assert [(r[ROW_ID], [tuple(b) for b in r["broken"]]) for r in kept] == [(6, [(0, '{"day":"2020-01-02","the.year":"2021"}')])]
    assert facts.where(f"{ROW_ID} is null").count() == 2
