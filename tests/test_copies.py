"""Copies told by their changed rows give what all their rows, stacked in one table, give."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright import ColumnRule, CrossRule, Rules
from tablewright.constants import ROW_ID
from tablewright.operators import corrupt as corrupt_module
from tablewright.operators import evaluate as evaluate_module
from tablewright.operators import events as events_module
from tablewright.operators import quantiles
from tablewright.operators.corrupt import PRIME, TRIAL, corrupt_trials, duplicate_pairs, mix, unmix
from tablewright.operators.evaluate import evaluate
from tablewright.operators.events import detect_events
from tablewright.tables import materialize, small_frame

RULES = Rules((ColumnRule("k", 0, "string", None, True, key_rank=1), ColumnRule("kind", 1, "string", None, False),
               ColumnRule("day", 2, "date", "date", True), ColumnRule("year", 3, "numeric", None, True, 0.0),
               ColumnRule("price", 4, "numeric", None, True, 0.0), ColumnRule("size", 5, "numeric", None, True)),
              (CrossRule("year_matches", ("day", "year")),))
FAMILIES = list(corrupt_module.INJECTORS)


@pytest.fixture(scope="module")
def odd(spark):
    """Shared keys, a missing one, disguised nulls, outliers, two date layouts with as good as equal shares, broken rules; ids far apart."""
    rows = []
    for i in range(300):
        day = "%02d/%02d/2024" % (i % 28 + 1, i % 12 + 1) if i % 2 else "2024-%02d-%02d" % (i % 12 + 1, i % 28 + 1)
        rows.append((i if i < 200 else (i % 3 + 1 << 33) + i, None if i == 7 else f"K{i - i % 40 if i % 40 < 3 else i}", "N.D." if i % 60 == 5 else "ab"[i % 2],
                     "soon" if i == 11 else day, "2023" if i % 50 == 9 else "2024", "-5" if i == 21 else "90000" if i == 31 else str(100 + i % 90), float(i % 9)))
    return materialize(small_frame(spark, rows, f"{ROW_ID} bigint, k string, kind string, day string, year string, price string, size double"), "odd")


def _rows(df):
    return sorted(map(str, df.collect()))


def test_copies_by_their_changes_equal_stacked_ones(odd):
    copies, truth = corrupt_trials(odd, "t", RULES, FAMILIES, 0.1, 3, 2, apart=True)
    bad, whole_truth = corrupt_trials(odd, "t", RULES, FAMILIES, 0.1, 3, 2)
    bad = materialize(bad, "bad")
    assert copies.after.count() == copies.before.count() < 12 * 300 / 5
    assert _rows(copies.stacked()) == _rows(bad.select(*copies.stacked().columns))
    assert _rows(truth) == _rows(whole_truth) and truth.count() > 200
    found = detect_events(copies, "t", RULES, by=(TRIAL,))
    assert _rows(found) == _rows(detect_events(bad, "t", RULES, by=(TRIAL,)).select(*found.columns))
    assert {r[0] for r in found.select("error_type").distinct().collect()} == set(FAMILIES)


def test_no_copy_is_written_whole(odd, monkeypatch):
    written = []

    def spy(df, label="table", folders=()):
        out = materialize(df, label, folders)
        written.append((out.count(), label))
        return out

    for module in (corrupt_module, events_module, evaluate_module):
        monkeypatch.setattr(module, "materialize", spy)
    families = ["disguisednull", "wrong_but_parseable"]
    metrics, _ = evaluate(odd, "t", RULES, families, rate=0.02, seed=3, trials=10)
    rows = [(n, label) for n, label in written if label in ("table", "facts", "picked", "corrupted")]
    assert len(rows) >= 3 and max(rows)[0] <= 300, rows
    got = {r["family"]: r for r in metrics.collect()}
    assert got["overall"]["runs"] == 20 and all(got[f]["recall"] == 1.0 for f in families)


def test_an_evaluation_by_changes_counts_what_one_of_stacked_copies_counts(odd):
    """A detector of another name gets all rows of all copies."""
    def stacked(df, dataset, rules, families, by=()):
        return detect_events(df, dataset, rules, families, by)

    mine, trials = evaluate(odd, "t", RULES, rate=0.1, seed=3, trials=2)
    theirs, others = evaluate(odd, "t", RULES, rate=0.1, seed=3, trials=2, detect=stacked)
    assert _rows(mine) == _rows(theirs) and _rows(trials.drop("digest")) == _rows(others.drop("digest"))
    assert {r["outcome"] for r in trials.select("outcome").distinct().collect()} == {"tp", "fp", "fn"}


def test_pairs_are_the_ends_of_their_buckets(odd):
    rows = {r[ROW_ID]: r for r in odd.where("k is not null").select(ROW_ID, "k", mix(5).alias("a"), mix(6).alias("b"), unmix(6, mix(6)).alias("u")).collect()}
    assert all(r["u"] == i % PRIME for i, r in rows.items())
    buckets = {}
    for i, r in rows.items():
        buckets.setdefault(r["a"] % 30, []).append((r["b"], i))
    want = {(min(b)[1], max(b)[1], rows[min(b)[1]]["k"]) for b in buckets.values() if min(b) != max(b)}
    assert {tuple(r) for r in duplicate_pairs(odd, ["k"], 0.1, 5).collect()} == want and len(want) > 20


@pytest.mark.parametrize("ends", [(-50.0, 1e9), (None, None)])
def test_quartiles_of_copies(spark, ends):
    """Copies that lose and gain numbers, narrowed in rounds; a number that a copy loses altogether does not count."""
    random = np.random.default_rng(3)
    table = {"a": [*random.integers(0, 700, 900).astype(float), *[5.5] * 400, 1e9, -50.0], "b": [1.0] * 30 + [2.0] * 9 + [3.0] * 2 + [4.0]}
    gone = {"x": {"a": table["a"][:60], "b": []}, "y": {"a": [5.5] * 390, "b": [4.0]}, "z": {"a": [], "b": []}}
    new = {"x": {"a": [1e6] * 40, "b": [7.0] * 30}, "y": {"a": [-3.0, 12.25], "b": [2.0]}, "z": {"a": [], "b": []}}
    values = materialize(small_frame(spark, [(c, x, 1) for c, xs in table.items() for x in xs], "column string, number double, n int"), "v")
    changes = [(k, c, x, n) for side, n in ((gone, -1), (new, 1)) for k, of in side.items() for c, xs in of.items() for x in xs]
    changes = materialize(small_frame(spark, changes, "copy string, column string, number double, n int"), "c")
    kept = {}
    for k in gone:
        for c, xs in table.items():
            left = [*xs, *new[k][c]]
            for x in gone[k][c]:
                left.remove(x)
            kept[k, c] = left
    distinct = {}
    found = quantiles.copied_quantiles(values, changes, list(kept), [0.25, 0.75], {k: len(v) for k, v in kept.items()},
                                       {"a": ends, "b": (1.0, 4.0)}, distinct, block_rows=20)
    assert found == {(k, p): pytest.approx(np.quantile(v, p)) for k, v in kept.items() for p in (0.25, 0.75)}
    assert {k: min(n, 4) for k, n in distinct.items()} == {k: min(len(set(v)), 4) for k, v in kept.items()}
