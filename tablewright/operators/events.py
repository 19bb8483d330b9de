"""Events: every single detected error, in long form.

One row per affected row: ``(dataset, error_type, issue_type, columns, event_key, row_id)``. An
event about one cell has one member; a key conflict has one member per row that shares the key.
The long form keeps a key that owns a third of the table distributed, which an array of its row
ids would not.

One scan reads every row's cells and writes what the families ask of it: disguised nulls, numbers, labels of dates, broken
rules, the hash of its key. What a cell is held against (fences, usual layouts) and the events of all families that look at
one row are read from there. Copies of a table are judged by the table's facts and those of the rows that they change.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.constants import DISGUISED_NULLS, ROW_ID
from tablewright.functions.numeric import parse_number_loose
from tablewright.functions.temporal import classify_format, layout, parse_timestamp
from tablewright.functions.text import as_text
from tablewright.operators import cross as cross_rules
from tablewright.operators.cells import temporal, text_cells, with_temporal
from tablewright.operators.copies import Copies
from tablewright.operators.cross import ISSUE_OF_RULE
from tablewright.operators.duplicates import _HASH, among, hash_of, repeated, suspected
from tablewright.operators.quantiles import copied_quantiles, counted_quantiles
from tablewright.operators.rules import CrossRule, Rules
from tablewright.tables import col, column_groups, is_numeric_type, materialize, quoted, rows_of_groups, small_frame, together

EVENT_COLUMNS = ("dataset", "error_type", "issue_type", "columns", "event_key", "row_id")
FAMILIES = ("disguisednull", "iqr_outlier", "mixed_date_format", "wrong_but_parseable", "semantic_duplicate",
            "crossfield_inconsistency")
KEY_HASH = "_key_hash"
NO_LAYOUT = ("missing", "invalid", "unknown")


def _events(rows: DataFrame, dataset: str, family: str | Column, issue_type: str | Column, columns: Column,
            key: Column | None = None, by: Sequence[str] = ()) -> DataFrame:
    issue = F.lit(issue_type) if isinstance(issue_type, str) else issue_type
    family = F.lit(family) if isinstance(family, str) else family
    key = F.col(ROW_ID).cast("string") if key is None else key
    return rows.select(
        *[col(b) for b in by], F.lit(dataset).alias("dataset"), family.alias("error_type"), issue.alias("issue_type"),
        columns.alias("columns"), key.alias("event_key"), F.col(ROW_ID).cast("long").alias("row_id"))


def empty_events(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    schema = T.StructType([*[df.schema[b] for b in by], *T.StructType.fromDDL(
        "dataset string, error_type string, issue_type string, columns string, event_key string, row_id bigint")])
    return small_frame(df.sparkSession, [], schema)


# ---------------------------------------------------------------- what cells are held against

def labelled_cells(df: DataFrame, formats: dict[str, str]) -> DataFrame:
    """(_row_id, column, value, kind, label, n) of the temporal columns."""
    kinds = small_frame(df.sparkSession, list(formats.items()), "column string, kind string")
    cells = with_temporal(text_cells(df, list(formats)).join(F.broadcast(kinds), "column"), ["value"])
    text, shape, stamp = temporal("value")
    return cells.select(ROW_ID, "column", "value", "kind",
                        classify_format(text, F.col("kind"), stamp, shape).alias("label"), F.lit(1).alias("n"))


def dominant_labels(labelled: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by..., column, dominant, labels): most frequent valid layout of each column, first name on ties."""
    group = [*by, "column"]
    counts = labelled.where(~F.col("label").isin(*NO_LAYOUT)).groupBy(*group, "label").agg(F.sum("n").alias("n"))
    best = F.row_number().over(Window.partitionBy(*group).orderBy(F.desc("n"), "label"))
    labels = F.count("*").over(Window.partitionBy(*group))
    return (counts.withColumn("labels", labels).withColumn("rank", best).where("rank = 1")
                  .select(*group, F.col("label").alias("dominant"), "labels"))


@dataclass(frozen=True)
class Asked:
    """What families ask of the rows of a table."""

    text: tuple[str, ...]
    ranges: tuple[str, ...]
    lows: Mapping[str, float]
    formats: Mapping[str, str]
    cross: tuple[CrossRule, ...]
    keys: tuple[str, ...]
    required: frozenset[str]

    @property
    def of_rows(self) -> bool:
        return bool(self.text or self.ranges or self.lows or self.formats or self.cross)


def asked(df: DataFrame, rules: Rules, families: Sequence[str], by: Sequence[str] = ()) -> Asked:
    ranges = [r.column for r in rules.numeric if r.column in df.columns] if "iqr_outlier" in families else []
    lows = ({r.column: r.min_value for r in rules.numeric if r.min_value is not None and r.column in df.columns}
            if "wrong_but_parseable" in families else {})
    typed = {c for c in (*ranges, *lows) if is_numeric_type(df.schema[c].dataType)}
    return Asked(
        tuple(c for c in column_groups(df)[0] if c not in by) if "disguisednull" in families else (), tuple(ranges), lows,
        {c: k for c, k in rules.formats.items() if c in df.columns and c not in typed} if "mixed_date_format" in families else {},
        tuple(cross_rules.applicable(df, rules.cross)) if "crossfield_inconsistency" in families else (),
        tuple(k for k in rules.keys if k in df.columns) if "semantic_duplicate" in families else (),
        frozenset(r.column for r in rules.columns if r.required))


@dataclass(frozen=True)
class Facts:
    """Written facts of the rows of a table, with its own columns if ``wide``, and the hashes of its keys that several rows have."""

    rows: DataFrame | None
    hashes: DataFrame | None
    ask: Asked | None = None


def row_facts(df: DataFrame, ask: Asked, by: Sequence[str] = (), hashed: Sequence[str] = (), tokens: Sequence[str] = DISGUISED_NULLS,
              keep: Sequence[str] = ()) -> DataFrame:
    """(``keep`` or by..., row id, ``_gone:c``, ``_number:c``, ``_label:c``, ``_broken:i``, hash of the columns ``hashed``) of every row: each cell
    is parsed once."""
    typed = {c for c in (*ask.ranges, *ask.lows) if is_numeric_type(df.schema[c].dataType)}
    spelled = {*ask.text, *ask.ranges, *ask.lows, *ask.formats} - typed
    rows = df.withColumns({f"_text:{c}": as_text(col(c)) for c in df.columns if c in spelled}) if spelled else df
    read = {f"_shape:{c}": layout(col(f"_text:{c}"), stripped=True) for c in ask.formats}
    for c in dict.fromkeys((*ask.ranges, *ask.lows)):
        read[f"_number:{c}"] = (F.nanvl(col(c).cast("double"), F.lit(None).cast("double")) if c in typed
                                else parse_number_loose(col(f"_text:{c}"), stripped=True))
    rows = rows.withColumns(read) if read else rows
    if ask.formats:
        rows = rows.withColumns({f"_stamp:{c}": parse_timestamp(col(f"_text:{c}"), col(f"_shape:{c}")) for c in ask.formats})
    late = {f"_gone:{c}": F.coalesce(F.lower(col(f"_text:{c}")).isin(*tokens), F.lit(False)) for c in ask.text}
    late |= {f"_label:{c}": classify_format(temporal(c)[0], kind, temporal(c)[2], temporal(c)[1]) for c, kind in ask.formats.items()}
    late |= {f"_broken:{i}": cross_rules.violation(rows, r) for i, r in enumerate(ask.cross)}
    kept = [*(keep or (*by, ROW_ID)), *[n for n in read if n.startswith("_number:")]]
    return rows.select(*[col(c) for c in kept], *[v.alias(n) for n, v in late.items()], *([hash_of(hashed).alias(KEY_HASH)] if hashed else []))


def table_facts(df: DataFrame, rules: Rules, families: Sequence[str] = FAMILIES, by: Sequence[str] = (),
                tokens: Sequence[str] = DISGUISED_NULLS, wide: bool = False) -> Facts:
    """The facts of a table, or of tables stacked in it, read once and written; ``wide`` with the columns of the table."""
    ask = asked(df, rules, families, by)
    if not (ask.of_rows or ask.keys or wide):
        return Facts(None, None)
    rows = materialize(row_facts(df, ask, by, [*by, *ask.keys] if ask.keys else [], tokens, df.columns if wide else [*by, ROW_ID]), "facts")
    return Facts(rows, repeated(rows, KEY_HASH) if ask.keys else None, ask)


def numbers_of(facts: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    return facts.select(*[col(k) for k in keep], *[col(f"_number:{c}").alias(c) for c in columns])


def _cells_of(facts: DataFrame, columns: Sequence[str], prefix: str, value: str, keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., column, value) of columns of the facts."""
    named = facts.select(*[col(k) for k in keep], *[col(f"{prefix}:{c}").alias(c) for c in columns])
    return named.unpivot([col(k) for k in keep], [col(c) for c in columns], "column", value)


def usual_layouts(facts: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> dict[tuple, tuple[str, int]]:
    """{(by..., column): (dominant layout, number of valid ones)}"""
    labelled = _cells_of(facts, columns, "_label", "label", by).withColumn("n", F.lit(1))
    return {(*[r[b] for b in by], r["column"]): (r["dominant"], r["labels"]) for r in dominant_labels(labelled, by).collect()}


#: What the numbers of a column are counted and bounded by.
_ENDS = (("n", F.count), ("lo", F.min), ("hi", F.max))


def grouped_fences(nums: DataFrame, columns: Sequence[str], by: Sequence[str] = (), whisker: float = 1.5) -> dict[tuple, tuple[float, float]]:
    """{(by..., column): (lower, upper fence)} of columns with 8 numbers, 4 distinct ones and a spread.

    ``nums`` holds numbers; the quartiles come from counts over them, without a shuffle of the column.
    """
    # One row for each stacked table.
    tables = nums.groupBy(*[col(b) for b in by]).agg(*[f(col(c)).alias(f"{n}:{c}") for c in columns for n, f in _ENDS]).collect()
    sizes = {(*[r[b] for b in by], c): r[f"n:{c}"] for r in tables for c in columns}
    named = {"\x1f".join(map(str, k)): k for k, n in sizes.items() if n >= 8}
    ends = {"\x1f".join([*[str(r[b]) for b in by], c]): (r[f"lo:{c}"], r[f"hi:{c}"]) for r in tables for c in columns}
    if not named:
        return {}
    cells = nums.unpivot([col(b) for b in by], [col(c) for c in columns], "column", "number").where("number is not null")
    numbered = cells.select(F.concat_ws("\x1f", *[col(b).cast("string") for b in by], "column").alias("column"), "number", F.lit(1).alias("n"))
    distinct: dict[str, int] = {}
    found = counted_quantiles(numbered, list(named), [0.25, 0.75], {n: sizes[k] for n, k in named.items()}, distinct=distinct, ends=ends)
    fences = {}
    for name, key in named.items():
        q1, q3 = found[(name, 0.25)], found[(name, 0.75)]
        if q1 != q3 and distinct[name] >= 4:
            fences[key] = (q1 - whisker * (q3 - q1), q3 + whisker * (q3 - q1))
    return fences


# ---------------------------------------------------------------- one pass over the rows

LIMITS = {"low": "double", "high": "double", "usual": "string", "labels": "bigint"}


def with_limits(df: DataFrame, by: Sequence[str], columns: Sequence[str], fences: dict[tuple, tuple], dominant: dict[tuple, tuple]) -> DataFrame:
    """The rows with ``_low:c``, ``_high:c``, ``_usual:c`` and ``_labels:c`` of each column: what its stacked table says."""
    empty = (None, None)
    tables = sorted({k[:-1] for k in fences.keys() | dominant.keys()} | (set() if by else {()}))
    rows = [(*t, *[v for c in columns for v in (*fences.get((*t, c), empty), *dominant.get((*t, c), empty))]) for t in tables]
    names = [(f"_{n}:{c}", dtype) for c in columns for n, dtype in LIMITS.items()]
    if not by:
        return df.withColumns({n: F.lit(v).cast(dtype) for (n, dtype), v in zip(names, rows[0], strict=True)})
    schema = T.StructType([*[df.schema[b] for b in by], *T.StructType.fromDDL(", ".join(f"{quoted(n)} {t}" for n, t in names))])
    return df.join(F.broadcast(small_frame(df.sparkSession, rows, schema)), list(by), "left")


def judgements(ask: Asked) -> list[tuple[Column, str, str, Column]]:
    """(condition, family, column, issue) of each event that a row of facts with its limits may have."""
    found = [(col(f"_gone:{c}"), "disguisednull", c,
              F.lit("missing_mandatory_values" if c in ask.required else "missing_optional_values")) for c in ask.text]
    found += [(~col(f"_number:{c}").between(col(f"_low:{c}"), col(f"_high:{c}")), "iqr_outlier", c, F.lit("iqr_outliers")) for c in ask.ranges]
    found += [(col(f"_number:{c}") < low, "wrong_but_parseable", c, F.lit("value_below_minimum")) for c, low in ask.lows.items()]
    for c in ask.formats:
        label = col(f"_label:{c}")
        mixed = (label != col(f"_usual:{c}")) & (col(f"_labels:{c}") > 1) & ~label.isin(*NO_LAYOUT)
        issue = F.when(label == "invalid", "invalid_format_values").when(mixed, "mixed_format_family")
        found.append((issue.isNotNull(), "mixed_date_format", c, issue))
    return found + [(col(f"_broken:{i}"), "crossfield_inconsistency", ",".join(sorted(r.columns)), F.lit(ISSUE_OF_RULE[r.kind][0]))
                    for i, r in enumerate(ask.cross)]


def local_events(facts: DataFrame, dataset: str, ask: Asked, by: Sequence[str], fences: dict[tuple, tuple],
                 dominant: dict[tuple, tuple]) -> DataFrame:
    """Events of the families that look at one row; only rows with an event are spelled out."""
    held = list(dict.fromkeys((*ask.ranges, *ask.formats)))
    rows = with_limits(facts, by, held, fences, dominant) if held else facts
    found = judgements(ask)
    events = [F.when(condition, F.struct(F.lit(family).alias("family"), F.lit(column).alias("column"), issue.alias("issue")))
              for condition, family, column, issue in found]
    rows = rows.where(reduce(Column.__or__, [F.coalesce(condition, F.lit(False)) for condition, *_ in found]))
    rows = rows.select(*[col(b) for b in by], ROW_ID, F.explode(F.array_compact(F.array(*events))).alias("event"))
    return _events(rows, dataset, F.col("event.family"), F.col("event.issue"), F.col("event.column"), by=by)


def key_of(keys: Sequence[str]) -> Column:
    """Text that identifies a business key, NULL parts included."""
    return F.to_json(F.struct(*[col(k) for k in keys]), {"ignoreNullFields": "false"})


def key_conflict_events(df: DataFrame, dataset: str, rules: Rules, by: Sequence[str] = (), hashes: DataFrame | None = None) -> DataFrame:
    """Rows that share a business key; one event per key, one member per row. Rows whose key's hash is repeated are
    written, and only these are grouped and joined; ``hashes`` may pass the repeated ones."""
    keys = [k for k in rules.keys if k in df.columns]
    if not keys:
        return empty_events(df, by)
    whole = [*by, *keys]
    rows = df.select(ROW_ID, *[col(k) for k in whole])
    return _conflicts(rows.where(suspected(rows, whole, hashes)), dataset, keys, by)


def _conflicts(rows: DataFrame, dataset: str, keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Events of the keys that several of these rows share."""
    whole = [*by, *keys]
    suspects = materialize(rows, "suspects")
    shared = suspects.groupBy(*[col(k) for k in whole]).agg(F.count("*").alias("n")).where("n > 1").drop("n")
    members = rows_of_groups(suspects, materialize(shared, "keys"), whole)
    return _events(members, dataset, "semantic_duplicate", "duplicate_business_keys",
                   F.lit(",".join(sorted(keys))), key_of(keys), by)


def detect_events(df: DataFrame | Copies, dataset: str, rules: Rules, families: Sequence[str] = FAMILIES, by: Sequence[str] = (),
                  whisker: float = 1.5, tokens: Sequence[str] = DISGUISED_NULLS, facts: Facts | None = None) -> DataFrame:
    """All events of the chosen families.

    The table is read twice: for the facts of its rows, which ``facts`` may pass if known, and for the members of key
    conflicts. ``by`` names columns that tell tables apart which are stacked in ``df``: each is judged by its own values, and
    the columns lead its events. Copies of a table are judged as if they were stacked; ``facts`` are then the table's.
    """
    if isinstance(df, Copies):
        return _events_of_copies(df, dataset, rules, families, whisker, tokens, facts)
    ask = asked(df, rules, families, by)
    facts = table_facts(df, rules, families, by, tokens) if facts is None else facts
    fences, dominant, conflicts = together(
        df.sparkSession,
        lambda: grouped_fences(numbers_of(facts.rows, ask.ranges, by), ask.ranges, by, whisker) if ask.ranges else {},
        lambda: usual_layouts(facts.rows, list(ask.formats), by) if ask.formats else {},
        lambda: [key_conflict_events(df, dataset, rules, by, facts.hashes)] if ask.keys else [])
    parts = [local_events(facts.rows, dataset, ask, by, fences, dominant)] if ask.of_rows else []
    return reduce(DataFrame.unionByName, parts + conflicts) if parts + conflicts else empty_events(df, by)


# ---------------------------------------------------------------- copies of a table

def _events_of_copies(copies: Copies, dataset: str, rules: Rules, families: Sequence[str], whisker: float, tokens: Sequence[str],
                      facts: Facts | None) -> DataFrame:
    """Every row of every copy is judged by its copy's own values: those that the copy leaves alone by the table's facts.

    What a copy's cells are held against is counted: as in the table, less its changed rows as they were, and with them as
    they are.
    """
    df, by = copies.table, (copies.by,)
    ask = asked(df, rules, families)
    if not (ask.of_rows or ask.keys):
        return empty_events(copies.after, by)
    facts = table_facts(df, rules, families, (), tokens) if facts is None else facts
    before, after = (_facts_of(rows, ask, by, tokens) for rows in (copies.before, copies.after))
    changes = before.withColumn("n", F.lit(-1)).unionByName(after.withColumn("n", F.lit(1)))
    fences, dominant, parts = together(
        df.sparkSession,
        lambda: _copied_fences(copies, facts.rows, changes, ask.ranges, whisker) if ask.ranges else {},
        lambda: _copied_layouts(copies, facts.rows, changes, list(ask.formats)) if ask.formats else {},
        lambda: [_copied_conflicts(copies, dataset, ask.keys, facts.hashes, changes)] if ask.keys else [])
    if ask.of_rows:
        parts.append(local_events(after, dataset, ask, by, fences, dominant))
        near = copies.of_each(facts.rows.where(_near_limits(ask, fences, dominant)))
        parts.append(copies.unchanged(local_events(near, dataset, ask, by, fences, dominant).withColumnRenamed("row_id", ROW_ID))
                     .withColumnRenamed(ROW_ID, "row_id"))
    return reduce(DataFrame.unionByName, parts)


def _facts_of(rows: DataFrame, ask: Asked, by: Sequence[str], tokens: Sequence[str]) -> DataFrame:
    """The facts of changed rows, which they may hold already."""
    facts = row_facts(rows, ask, by, ask.keys, tokens)
    held = set(facts.columns) <= set(rows.columns)
    return rows.select(*[col(c) for c in facts.columns]) if held else materialize(facts, "facts")


def _near_limits(ask: Asked, fences: dict[tuple, tuple], dominant: dict[tuple, tuple]) -> Column:
    """True for all rows of a table that have an event in some copy: outside the tightest fences, or not in all usual layouts."""
    found = [condition for condition, family, *_ in judgements(ask) if family not in ("iqr_outlier", "mixed_date_format")]
    for c in ask.ranges:
        of = [f for (_, column), f in fences.items() if column == c]
        if of:
            found.append(~col(f"_number:{c}").between(max(f[0] for f in of), min(f[1] for f in of)))
    for c in ask.formats:
        found.append(col(f"_label:{c}") == "invalid")
        for usual in sorted({u for (_, column), (u, labels) in dominant.items() if column == c and labels > 1}):
            found.append((col(f"_label:{c}") != usual) & ~col(f"_label:{c}").isin(*NO_LAYOUT))
    return reduce(Column.__or__, [F.coalesce(condition, F.lit(False)) for condition in found], F.lit(False))


def _copied_fences(copies: Copies, facts: DataFrame, changes: DataFrame, columns: Sequence[str], whisker: float) -> dict[tuple, tuple[float, float]]:
    """``grouped_fences`` of the copies."""
    nums, moved = numbers_of(facts, columns), numbers_of(changes, columns, [copies.by, "n"])
    whole = nums.agg(*[f(col(c)).alias(f"{n}:{c}") for c in columns for n, f in _ENDS]).first()
    more = {r[copies.by]: r for r in moved.groupBy(copies.by).agg(*[
        F.coalesce(F.sum(F.when(col(c).isNotNull(), F.col("n"))), F.lit(0)).alias(f"n:{c}") for c in columns]).collect()}
    sizes = {(name, c): whole[f"n:{c}"] + (more[name][f"n:{c}"] if name in more else 0) for name in copies.names for c in columns}
    fences = {}
    step = max(1, 100 // len(copies.names))  # the driver gets the rows of each piece, column and copy
    for start in range(0, len(columns), step):
        some = columns[start:start + step]
        keys = [k for k, n in sizes.items() if k[1] in some and n >= 8]
        if not keys:
            continue
        values = _cells_of(facts, some, "_number", "number").where("number is not null").withColumn("n", F.lit(1))
        other = _cells_of(changes, some, "_number", "number", [copies.by, "n"]).where("number is not null").withColumnRenamed(copies.by, "copy")
        distinct: dict[tuple[str, str], int] = {}
        found = copied_quantiles(values, other, keys, [0.25, 0.75], sizes, {c: (whole[f"lo:{c}"], whole[f"hi:{c}"]) for c in some}, distinct)
        for k in keys:
            q1, q3 = found[(k, 0.25)], found[(k, 0.75)]
            if q1 != q3 and distinct[k] >= 4:
                fences[k] = (q1 - whisker * (q3 - q1), q3 + whisker * (q3 - q1))
    return fences


def _copied_layouts(copies: Copies, facts: DataFrame, changes: DataFrame, columns: Sequence[str]) -> dict[tuple, tuple[str, int]]:
    """``usual_layouts`` of the copies."""
    table = _cells_of(facts, columns, "_label", "label").groupBy("column", "label").agg(F.count("*").alias("n")).collect()
    counts = {(name, r["column"], r["label"]): r["n"] for name in copies.names for r in table}
    for r in (_cells_of(changes, columns, "_label", "label", [copies.by, "n"]).groupBy(copies.by, "column", "label")
              .agg(F.sum("n").alias("n")).collect()):
        k = (r[copies.by], r["column"], r["label"])
        counts[k] = counts.get(k, 0) + r["n"]
    ranked: dict[tuple, list] = {}
    for (name, column, label), n in counts.items():
        if n > 0 and label not in NO_LAYOUT:
            ranked.setdefault((name, column), []).append((-n, label))
    return {k: (min(found)[1], len(found)) for k, found in ranked.items()}


def _copied_conflicts(copies: Copies, dataset: str, keys: Sequence[str], hashes: DataFrame, changes: DataFrame) -> DataFrame:
    """``key_conflict_events`` of the copies. A key that rows of a copy share is one that rows of the table share, or one that a
    changed row has and its row in the table has not: of the table's rows, just those with such hashes are suspects."""
    by = copies.by
    own = changes.groupBy(by, KEY_HASH).agg(F.sum("n").alias("n")).where("n > 0").select(by, F.col(KEY_HASH).alias(_HASH))
    own = materialize(own, "own_hashes")
    rows = copies.table.select(ROW_ID, *[col(k) for k in keys], hash_of(keys).alias(KEY_HASH))
    shared, given = among(F.col(KEY_HASH), hashes), among(F.col(KEY_HASH), materialize(own.select(_HASH).distinct(), "hashes"))
    in_all = copies.of_each(rows.where(shared).drop(KEY_HASH))
    in_some = rows.where(~shared & given).join(own, F.col(KEY_HASH) == F.col(_HASH)).drop(KEY_HASH, _HASH)
    suspects = copies.unchanged(in_all.unionByName(in_some)).unionByName(copies.after.select(by, ROW_ID, *[col(k) for k in keys]))
    return _conflicts(suspects, dataset, keys, (by,))


#: A detector for each family alone.
DETECTORS = {family: (lambda df, name, rules, family=family: detect_events(df, name, rules, [family])) for family in FAMILIES}


def event_summary(events: DataFrame) -> DataFrame:
    """Events and affected rows per family and issue type.

    Members are first combined per event, so a conflict with very many rows stays one counted row.
    """
    per_event = events.groupBy("dataset", "error_type", "issue_type", "columns", "event_key").agg(
        F.count("*").alias("members"))
    return per_event.groupBy("dataset", "error_type", "issue_type", "columns").agg(
        F.count("*").alias("events"), F.sum("members").alias("members"))
