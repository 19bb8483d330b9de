"""Seeded corruption of a clean table: one error family at a time, with the truth.

Rows are chosen at a rate by a multiplicative hash of the row id, so the choice needs no
shuffle, is the same on every retry, and grows with the table. The seed may be a column: copies of a
table that are stacked, told apart by the columns ``by``, are then corrupted each in its own way at once.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.constants import ROW_ID
from tablewright.functions.temporal import (
    classify_format, parse_date_year, parse_timestamp, parse_year_month, render_alternative)
from tablewright.functions.numeric import parse_number_loose
from tablewright.functions.text import as_text, is_present
from tablewright.operators.cells import numbers, temporal, with_temporal
from tablewright.operators.copies import Copies
from tablewright.operators.cross import applicable, ISSUE_OF_RULE
from tablewright.operators.duplicates import _HASH, among
from tablewright.operators.events import Facts, dominant_labels, empty_events, labelled_cells, numbers_of, row_facts, table_facts, usual_layouts
from tablewright.operators.rules import CrossRule, Rules
from tablewright.tables import col, column_groups, is_numeric_type, materialize

PRIME = 2_147_483_647
MULTIPLIER = 1_103_515_245
STREAM = 69_069


Seed = int | Column


#: Undoes a multiplication by MULTIPLIER.
INVERSE = pow(MULTIPLIER, -1, PRIME)


def _shift(seed: Seed) -> Column | int:
    return (seed * STREAM + 1) % PRIME if isinstance(seed, int) else F.pmod(seed.cast("long") * STREAM + 1, F.lit(PRIME))


def mix(seed: Seed, row_id: Column | str = ROW_ID) -> Column:
    """Evenly spread number in [0, PRIME) from a row id and a seed."""
    row_id = F.col(row_id) if isinstance(row_id, str) else row_id
    start = F.pmod(row_id.cast("long"), F.lit(PRIME))
    once = F.pmod(start * MULTIPLIER + _shift(seed), F.lit(PRIME))
    return F.pmod(once * MULTIPLIER + 12_345, F.lit(PRIME))


def unmix(seed: Seed, mixed: Column) -> Column:
    """What row ids with this mix are modulo PRIME."""
    once = F.pmod((mixed - 12_345) * INVERSE, F.lit(PRIME))
    return F.pmod((once - _shift(seed)) * INVERSE, F.lit(PRIME))


def chosen(rate: float, seed: Seed, slot: int = 0, slots: int = 1) -> Column:
    """True for the given share of rows; disjoint ``slots`` share that share out."""
    width = int(rate * PRIME) // slots
    return (mix(seed) >= slot * width) & (mix(seed) < (slot + 1) * width)


def _truth(rows: DataFrame, dataset: str, family: str, columns: str | Column, event: Column | None = None,
           row_id: Column | None = None, by: Sequence[str] = ()) -> DataFrame:
    row_id = F.col(ROW_ID) if row_id is None else row_id
    event = row_id.cast("string") if event is None else event
    columns = F.lit(columns) if isinstance(columns, str) else columns
    return rows.select(*[col(b) for b in by], F.lit(dataset).alias("dataset"), F.lit(family).alias("error_type"),
                       columns.alias("columns"), event.alias("event_key"), row_id.cast("long").alias("row_id"))


def _replace(df: DataFrame, new: dict[str, Column]) -> DataFrame:
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[new[c].cast(types[c]).alias(c) if c in new else col(c) for c in df.columns])


def _spread(columns: Sequence[str], rate: float, seed: Seed, allowed: dict[str, Column]) -> dict[str, Column]:
    """Which rows to corrupt in which column: every chosen row is corrupted in one column."""
    return {c: chosen(rate, seed, i, len(columns)) & F.coalesce(allowed[c], F.lit(False))
            for i, c in enumerate(columns)}


def _one_table(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """One of the stacked copies."""
    return reduce(lambda d, b: d.where(col(b) == 0), by, df)


def _apply(df: DataFrame, dataset: str, family: str, hits: dict[str, Column], new: dict[str, Column], by: Sequence[str] = ()):
    """Corrupt the hit cells; the truth comes from the same conditions on the clean table."""
    bad = _replace(df, {c: F.when(hits[c], new[c]).otherwise(col(c).cast("string") if not is_numeric_type(
        df.schema[c].dataType) else col(c)) for c in hits})
    changed = F.array_compact(F.array(*[F.when(hits[c], F.lit(c)) for c in hits]))
    truth = _truth(df.select(*[col(b) for b in by], ROW_ID, F.explode(changed).alias("columns")), dataset, family, F.col("columns"), by=by)
    return bad, truth


def inject_disguised_null(df: DataFrame, dataset: str, rules: Rules, rate: float, seed: Seed, by: Sequence[str] = (),
                          whole: Facts | None = None):
    """``N.D.`` into present text cells."""
    text = [c for c in column_groups(df)[0] if c not in by]
    hits = _spread(text, rate, seed, {c: is_present(col(c)) for c in text})
    return _apply(df, dataset, "disguisednull", hits, {c: F.lit("N.D.") for c in text}, by)


def inject_outlier(df: DataFrame, dataset: str, rules: Rules, rate: float, seed: Seed, by: Sequence[str] = (),
                   whole: Facts | None = None):
    """A number a hundred times the largest of its column, plus a million."""
    columns = [r.column for r in rules.numeric if r.column in df.columns]
    nums = numbers(_one_table(df, by), columns) if whole is None else numbers_of(whole.rows, columns)
    facts = nums.agg(*[F.max(F.abs(col(c))).alias(c) for c in columns],
                     *[F.count(col(c)).alias(f"n:{c}") for c in columns]).first() if columns else None
    columns = [c for c in columns if facts[f"n:{c}"] >= 8]
    number = _number_of(df)
    hits = _spread(columns, rate, seed, {c: number(c).isNotNull() for c in columns})
    new = {c: F.lit(facts[c] * 100 + 1_000_000) for c in columns}
    return _apply(df, dataset, "iqr_outlier", hits, {c: _as_cell(df, c, new[c]) for c in columns}, by)


def inject_below_minimum(df: DataFrame, dataset: str, rules: Rules, rate: float, seed: Seed, by: Sequence[str] = (),
                         whole: Facts | None = None):
    """A readable but impossible number: the negative of the cell, at most -1."""
    columns = [r.column for r in rules.numeric if r.min_value is not None and r.column in df.columns]
    number = _number_of(df)
    hits = _spread(columns, rate, seed, {c: number(c).isNotNull() for c in columns})
    new = {c: -F.greatest(F.lit(1.0), F.abs(number(c))) for c in columns}
    return _apply(df, dataset, "wrong_but_parseable", hits, {c: _as_cell(df, c, new[c]) for c in columns}, by)


def inject_date_layout(df: DataFrame, dataset: str, rules: Rules, rate: float, seed: Seed, by: Sequence[str] = (),
                       whole: Facts | None = None):
    """Another layout of the same date into cells of the dominant layout."""
    formats = {c: k for c, k in rules.formats.items() if c in df.columns and k in ("date", "period", "datetime")}
    if not formats:
        return df, empty_events(df, by).drop("issue_type")
    dominant = ({r["column"]: r["dominant"] for r in dominant_labels(labelled_cells(_one_table(df, by), formats)).collect()} if whole is None
                else {c: usual for (c,), (usual, _) in usual_layouts(whole.rows, [c for c in formats if f"_label:{c}" in whole.rows.columns]).items()})
    columns = [c for c in formats if c in dominant]
    frame, new, ok = with_temporal(df, columns), {}, {}
    for c in columns:
        text, shape, stamp = temporal(c)
        frame = frame.withColumn(f"_new:{c}", render_alternative(text, formats[c], shape, stamp))
        new[c] = col(f"_new:{c}")
        ok[c] = (classify_format(text, formats[c], stamp, shape) == dominant[c]) & (new[c] != text)
    hits = _spread(columns, rate, seed, ok)
    frame = frame.withColumns({f"_hit:{c}": hits[c] for c in columns})
    bad, truth = _apply(frame, dataset, "mixed_date_format", {c: col(f"_hit:{c}") for c in columns}, new, by)
    return bad.select(*[col(c) for c in df.columns]), truth


def _number_of(df: DataFrame):
    types = {f.name: f.dataType for f in df.schema.fields}
    return lambda c: col(c).cast("double") if is_numeric_type(types[c]) else parse_number_loose(col(c))


def _as_cell(df: DataFrame, column: str, number: Column) -> Column:
    """A number as it would stand in the column: plain decimals in text, never an exponent."""
    if is_numeric_type(df.schema[column].dataType):
        return number
    return F.format_string("%.2f", number)


def duplicate_pairs(df: DataFrame, keys: Sequence[str], rate: float, seed: Seed, by: Sequence[str] = ()) -> DataFrame:
    """(by..., src, dst, key...) pairs of different rows: in every hash bucket the row with the lowest
    mixed id gives its key to the row with the highest. Only mixed ids are aggregated; which rows have the two of a bucket
    is worked out from these."""
    whole = _one_table(df, by)
    buckets = max(1, int(whole.count() * rate))
    bucket = F.pmod(mix(seed), F.lit(buckets)).alias("bucket")
    ends = materialize(df.where(_all_present(keys)).select(*[col(b) for b in by], bucket, mix(seed + 1).alias("order"))
                       .groupBy(*[col(b) for b in by], "bucket").agg(F.min("order").alias("least"), F.max("order").alias("most")), "ends")
    side = F.explode(F.array(F.struct(F.lit(True).alias("gives"), F.col("least").alias("order")),
                             F.struct(F.lit(False).alias("gives"), F.col("most").alias("order"))))
    wanted = ends.select(*[col(b) for b in by], "bucket", side.alias("side"))
    wanted = wanted.select(*[col(b).alias(f"by:{b}") for b in by], "bucket", "side.gives", unmix(seed + 1, F.col("side.order")).alias("rest"))
    rows = whole.where(_all_present(keys)).select(ROW_ID, F.struct(*[col(k) for k in keys]).alias("key"),
                                                  F.pmod(F.col(ROW_ID).cast("long"), F.lit(PRIME)).alias("rest"))
    rests = materialize(wanted.select(F.xxhash64("rest").alias(_HASH)).distinct(), "hashes")
    pairs = wanted.join(rows.where(among(F.xxhash64("rest"), rests)), "rest").groupBy(*[col(f"by:{b}") for b in by], "bucket").agg(
        F.min(F.when(F.col("gives"), F.struct(ROW_ID, "key"))).alias("src"), F.max(F.when(~F.col("gives"), F.col(ROW_ID))).alias("dst"))
    return (pairs.where(F.col(f"src.{ROW_ID}") != F.col("dst"))
                 .select(*[col(f"by:{b}") for b in by], F.col(f"src.{ROW_ID}").alias("src"), "dst",
                         *[F.col("src.key")[k].alias(f"key:{k}") for k in keys]))


def _all_present(keys: Sequence[str]) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & is_present(col(k))
    return out


def inject_key_conflict(df: DataFrame, dataset: str, rules: Rules, rate: float, seed: Seed, by: Sequence[str] = (),
                        pairs: DataFrame | None = None):
    """Another row's business key, with the first filled payload cell changed; ``pairs`` may pass the rows, if known."""
    keys = [k for k in rules.keys if k in df.columns]
    if not keys:
        return df, empty_events(df, by).drop("issue_type")
    pairs = materialize(duplicate_pairs(df, keys, rate, seed, by), "pairs") if pairs is None else pairs
    same = reduce(lambda on, b: on & (df[b] == pairs[f"by:{b}"]), by, df[ROW_ID] == pairs["dst"])
    joined = df.join(pairs, same, "left")
    hit, new, changed = F.col("dst").isNotNull(), {}, F.lit(False)
    for k in keys:
        new[k] = F.when(hit, F.col(f"`key:{k}`")).otherwise(col(k))
    for c in df.columns:
        if c in keys or c in by or c == ROW_ID or c not in sum(column_groups(df)[:2], []):
            continue
        filled = is_present(col(c))
        altered = (col(c) + 1) if is_numeric_type(df.schema[c].dataType) else F.concat(as_text(col(c)), F.lit("_alt"))
        new[c] = F.when(hit & filled & ~changed, altered).otherwise(col(c))
        changed = changed | filled
    types = {f.name: f.dataType for f in df.schema.fields}
    bad = joined.select(*[new[c].cast(types[c]).alias(c) if c in new else col(c) for c in df.columns])
    members = pairs.select(*[col(f"by:{b}").alias(b) for b in by], F.explode(F.array("src", "dst")).alias("row"),
                           F.to_json(F.struct(*[F.col(f"`key:{k}`").alias(k) for k in keys]),
                                     {"ignoreNullFields": "false"}).alias("key"))
    truth = _truth(members, dataset, "semantic_duplicate", ",".join(sorted(keys)), F.col("key"), F.col("row"), by)
    return bad, truth


def _broken(df: DataFrame, rule: CrossRule) -> tuple[Column, dict[str, Column]]:
    """(where the rule can be broken, the new cells that break it)."""
    number, c = _number_of(df), rule.columns
    if rule.kind == "le":
        above = F.abs(number(c[1])) * 2 + 10
        return number(c[1]).isNotNull(), {c[0]: _as_cell(df, c[0], above)}
    if rule.kind == "year_matches":
        year = parse_date_year(col(c[0]))
        return year.isNotNull() & is_present(col(c[0])), {c[1]: (year + 1).cast("string")}
    if rule.kind == "period_matches":
        part = parse_year_month(col(c[0]))
        return part.isNotNull() & is_present(col(c[0])), {
            c[1]: part["year"].cast("string"), c[2]: F.when(part["month"] != 1, F.lit(1)).otherwise(F.lit(2)).cast("string")}
    if rule.kind == "product_matches":
        product = number(c[1]) * number(c[2])
        return product.isNotNull(), {c[0]: _as_cell(df, c[0], product + F.abs(product) * 0.5 + 1)}
    first, second = parse_timestamp(col(c[0])), parse_timestamp(col(c[1]))
    late = second + F.expr("INTERVAL 30 DAYS")
    if dict(df.dtypes)[c[0]] == "string":
        late = F.date_format(late, "yyyy-MM-dd")
    return first.isNotNull() & second.isNotNull(), {c[0]: late}


def inject_cross_error(df: DataFrame, dataset: str, rules: Rules, rate: float, seed: Seed, by: Sequence[str] = (),
                       whole: Facts | None = None):
    """Break cross-column rules; all applicable ones share the chosen rows out by slots."""
    usable = applicable(df, rules.cross)
    if not usable:
        return df, empty_events(df, by).drop("issue_type")
    new, hits = {}, []
    for slot, rule in enumerate(usable):
        ok, cells = _broken(df, rule)
        hits.append(chosen(rate, seed, slot, len(usable)) & F.coalesce(ok, F.lit(False)))
        for c, value in cells.items():
            new[c] = F.when(hits[-1], value.cast(df.schema[c].dataType)).otherwise(new.get(c, col(c)))
    broken = F.array_compact(F.array(*[F.when(h, F.lit(",".join(sorted(r.columns)))) for h, r in zip(hits, usable, strict=True)]))
    truth = _truth(df.select(*[col(b) for b in by], ROW_ID, F.explode(broken).alias("columns")), dataset, "crossfield_inconsistency",
                   F.col("columns"), by=by)
    return _replace(df, new), truth


INJECTORS = {
    "disguisednull": inject_disguised_null,
    "iqr_outlier": inject_outlier,
    "mixed_date_format": inject_date_layout,
    "wrong_but_parseable": inject_below_minimum,
    "semantic_duplicate": inject_key_conflict,
    "crossfield_inconsistency": inject_cross_error,
}
EXPECTED_ISSUES = {
    "disguisednull": ("missing_mandatory_values", "missing_optional_values", "sparse_column"),
    "iqr_outlier": ("iqr_outliers",),
    "mixed_date_format": ("mixed_format_family", "invalid_format_values"),
    "wrong_but_parseable": ("value_below_minimum",),
    "semantic_duplicate": ("duplicate_business_keys",),
    "crossfield_inconsistency": tuple(v[0] for v in ISSUE_OF_RULE.values()),
}


def corrupt(df: DataFrame, dataset: str, rules: Rules, family: str, rate: float = 0.01, seed: int = 42):
    """(corrupted table, truth events) for one error family."""
    return INJECTORS[family](df, dataset, rules, rate, seed)


TRIAL, COPY, FAMILY = "_trial", "_copy", "_family"


def corrupt_trials(df: DataFrame, dataset: str, rules: Rules, families: Sequence[str], rate: float = 0.01, seed: int = 42,
                   trials: int = 1, apart: bool = False, facts: Facts | None = None) -> tuple[DataFrame | Copies, DataFrame]:
    """(corrupted copies stacked in one table, truth events), both with the trial in ``_trial`` as ``family:number``.

    Every family corrupts ``trials`` copies of the table, each with a seed of its own, in one pass over the table. ``apart``
    gives the copies by the rows that they change; ``facts`` may then pass the table's, if known for these families.
    """
    if apart:
        return _corrupt_apart(df, dataset, rules, families, rate, seed, trials, table_facts(df, rules, families) if facts is None else facts)
    bad, truth = [], []
    copies = _numbered(df, trials)
    for i, family in enumerate(families):
        found, real = INJECTORS[family](copies, dataset, rules, rate, F.lit(seed + i) + F.col(TRIAL) * len(families), (TRIAL,))
        bad.append(_named(found, family))
        truth.append(_named(real, family))
    return reduce(DataFrame.unionByName, bad), reduce(DataFrame.unionByName, truth)


def _numbered(df: DataFrame, trials: int) -> DataFrame:
    return df.withColumn(TRIAL, F.explode(F.sequence(F.lit(0), F.lit(trials - 1))))


def _named(rows: DataFrame, family: str) -> DataFrame:
    return rows.withColumn(TRIAL, F.concat(F.lit(f"{family}:"), F.col(TRIAL).cast("string")))


def _corrupt_apart(df: DataFrame, dataset: str, rules: Rules, families: Sequence[str], rate: float, seed: int, trials: int,
                   facts: Facts) -> tuple[Copies, DataFrame]:
    """Each row of each copy is asked whether it is chosen; those that are, are written and corrupted."""
    every = len(families)
    names = [f"{families[n % every]}:{n // every}" for n in range(every * trials)]
    by_rate = [n for n in range(len(names)) if families[n % every] != "semantic_duplicate"]
    picked, pairs = [], {}
    held = facts.rows is not None and set(df.columns) <= set(facts.rows.columns)
    wide = facts.rows if held else df
    if by_rate:
        copies = wide.withColumn(COPY, F.explode(F.array(*[F.lit(n) for n in by_rate])))
        picked.append(copies.where(mix(F.lit(seed) + F.col(COPY)) < int(rate * PRIME)))
    keys = [k for k in rules.keys if k in df.columns]
    for i, family in enumerate(families):
        if family == "semantic_duplicate" and keys:
            numbered = _numbered(df.select(ROW_ID, *[col(k) for k in keys]), trials)
            pairs[i] = materialize(duplicate_pairs(numbered, keys, rate, F.lit(seed + i) + F.col(TRIAL) * every, (TRIAL,)), "pairs")
            taken = pairs[i].select((F.col(f"`by:{TRIAL}`") * every + i).alias(COPY), "dst")
            ids = materialize(taken.select(F.xxhash64("dst").alias(_HASH)).distinct(), "hashes")
            rows = wide.where(among(F.xxhash64(F.col(ROW_ID).cast("long")), ids))
            picked.append(rows.join(taken, F.col(ROW_ID) == F.col("dst")).drop("dst"))
    if not picked:
        picked = [wide.withColumn(COPY, F.lit(0)).where("false")]
    rows = materialize(reduce(DataFrame.unionByName, picked).withColumn(FAMILY, F.col(COPY) % every), "picked", [FAMILY])
    bad, truth = [], []
    for i, family in enumerate(families):
        mine = rows.where(F.col(FAMILY) == i).select(*[col(c) for c in df.columns], F.floor(F.col(COPY) / every).cast("int").alias(TRIAL))
        known = {"pairs": pairs.get(i)} if family == "semantic_duplicate" else {"whole": facts}
        found, real = INJECTORS[family](mine, dataset, rules, rate, F.lit(seed + i) + F.col(TRIAL) * every, (TRIAL,), **known)
        bad.append(_named(found, family))
        truth.append(_named(real, family))
    before = rows.withColumn(TRIAL, F.element_at(F.array(*[F.lit(n) for n in names]), F.col(COPY) + 1)).drop(COPY, FAMILY)
    after = reduce(DataFrame.unionByName, bad)
    if held:
        after = row_facts(after, facts.ask, (TRIAL,), facts.ask.keys, keep=after.columns)
    after = materialize(after, "corrupted")
    return Copies(df, TRIAL, tuple(names), before, after), reduce(DataFrame.unionByName, truth)
