"""Column profiles and dataset descriptions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.constants import DISGUISED_NULLS, FORBIDDEN_SYMBOLS, ROW_ID, TOKEN_PATTERNS
from tablewright.functions import temporal as tp
from tablewright.operators.cells import (
    cell_text, counted_cells, is_disguised_cell, is_filled, is_null, is_present_cell, numbers, rows_where, typed_cells,
    typed_values, value_table, with_stamp)
from tablewright.operators.quantiles import exact_quantiles
from tablewright.functions.text import lookup
from tablewright.tables import col, column_groups, data_columns, is_numeric_type, small_frame

SEMANTIC_SHARE = 0.90
KIND_SHARE = 0.85
TIME_SHARE = 0.20
HEAD_ROWS = 1_000
#: Keys of a range whose rows share a fingerprint.
RANGE_ROWS = 1 << 20


def _count(condition: Column) -> Column:
    return F.count_if(condition)


def _share(part: str, whole: str) -> Column:
    return F.coalesce(F.try_divide(F.col(part), F.col(whole)), F.lit(0.0))


def column_counts(df: DataFrame, tokens: Sequence[str] = DISGUISED_NULLS, values: DataFrame | None = None) -> DataFrame:
    """One row of counts per scalar column, from one scan (or the table's distinct ``values``) and one narrow shuffle."""
    shape, text, number = F.col("layout"), F.col("text"), F.col("number")
    cells = (with_stamp(counted_cells(df, values))
             .withColumn("filled", is_filled()).withColumn("present", is_present_cell(tokens)))
    filled, present = F.col("filled"), F.col("present")
    return cells.groupBy("column").agg(
        F.sum("n").alias("total"),
        rows_where(is_null()).alias("real_nulls"),
        rows_where(is_disguised_cell(tokens)).alias("disguised_nulls"),
        rows_where(filled).alias("filled"),
        rows_where(filled & number.isNotNull()).alias("numeric_cells"),
        rows_where(filled & F.col("stamp").isNotNull()).alias("date_cells"),
        rows_where(filled & (text.contains(":") | text.contains("T"))).alias("time_cells"),
        rows_where(filled & tp.is_year(text, shape)).alias("year_cells"),
        rows_where(filled & tp.is_month(text)).alias("month_cells"),
        rows_where(filled & tp.is_period(shape)).alias("period_cells"),
        rows_where(filled & tp.is_plain_date(shape)).alias("plain_date_cells"),
        rows_where(present).alias("present_count"),
        rows_where(present & number.isNotNull()).alias("present_numeric"),
        rows_where(present & (number >= 0)).alias("present_nonnegative"),
        *[rows_where(text.contains(t) if t in FORBIDDEN_SYMBOLS else text.rlike(TOKEN_PATTERNS[t])).alias(f"token_{i}")
          for i, t in enumerate(TOKEN_PATTERNS)])


def semantic_type(date_first: bool = False) -> Column:
    """Type of a column from its counts. Numbers are tried before dates unless told otherwise."""
    filled = F.col("filled")
    numeric = F.try_divide(F.col("numeric_cells"), filled) >= SEMANTIC_SHARE
    date = F.try_divide(F.col("date_cells"), filled) >= SEMANTIC_SHARE
    first, second = (("date", date), ("numeric", numeric)) if date_first else (("numeric", numeric), ("date", date))
    return (F.when(filled == 0, "unknown").when(first[1], first[0]).when(second[1], second[0])
             .otherwise("string"))


def temporal_kind() -> Column:
    """Kind of a temporal column from its counts; NULL when none fits."""
    filled = F.col("filled")
    dated = F.try_divide(F.col("date_cells"), filled) >= KIND_SHARE
    timed = F.try_divide(F.col("time_cells"), filled) >= TIME_SHARE
    shares = {k: F.coalesce(F.try_divide(F.col(f"{c}_cells"), filled), F.lit(0.0)) for k, c in
              (("year", "year"), ("month", "month"), ("period", "period"), ("date", "plain_date"))}
    best = F.greatest(*shares.values())
    kind = F.when(dated & timed, "datetime")
    for name, share in shares.items():
        kind = kind.when((best >= KIND_SHARE) & (share == best), name)
    return kind.when(dated, "date")


def distinct_counts(df: DataFrame, tokens: Sequence[str] = DISGUISED_NULLS, approximate: bool = False,
                    columns: Sequence[str] | None = None, values: DataFrame | None = None) -> DataFrame:
    """Distinct present values per column.

    Exact by default: values are combined on the map side, then spread by (column, value), so
    neither a frequent value nor a wide column lands in one task.
    """
    cells = counted_cells(df, values, columns).where(is_present_cell(tokens)).select("column", cell_text().alias("text"))
    if approximate:
        return cells.groupBy("column").agg(F.approx_count_distinct("text").alias("nunique_present"))
    return (cells.groupBy("column", "text").agg(F.lit(1).alias("one"))
                 .groupBy("column").agg(F.count("*").alias("nunique_present")))


def first_seen(values: DataFrame, group: Sequence[str], n: int) -> DataFrame:
    """Arrays of the first ``n`` distinct texts per group, in row order when rows have ids (or were ``seen`` first)."""
    place = next((c for c in (ROW_ID, "seen") if c in values.columns), None)
    order = [F.min(place).alias("seen") if place else F.lit(0).alias("seen")]
    firsts = values.groupBy(*group, "text").agg(*order)
    rank = F.row_number().over(Window.partitionBy(*group).orderBy("seen", "text"))
    return (firsts.withColumn("rank", rank).where(F.col("rank") <= n)
                  .groupBy(*group)
                  .agg(F.sort_array(F.collect_list(F.struct("rank", "text"))).alias("ranked"))
                  .select(*group, F.col("ranked.text").alias("samples")))


def column_samples(df: DataFrame, columns: Sequence[str] | None = None, n: int = 5, values: DataFrame | None = None) -> DataFrame:
    """The first ``n`` distinct non-empty texts of each column, as (column, samples).

    They are read from the table's distinct ``values`` if those are given. Without them, a column that shows ``n`` distinct texts in the first rows is settled by them; only the
    others, which repeat few values, are grouped as a whole.
    """
    text, numeric, _ = column_groups(df)
    wanted = [c for c in text + numeric if columns is None or c in columns]
    spark = df.sparkSession
    if not wanted:
        return small_frame(spark, [], "column string, samples array<string>")
    if values is not None:
        cells = typed_values(values, df, wanted).where(is_filled())
        return first_seen(cells.select("seen", "column", cell_text().alias("text")), ["column"], n)
    narrow = df.select(*[col(c) for c in df.columns if c in wanted or c == ROW_ID])

    def samples_of(frame, cols):
        cells = typed_cells(frame, cols).where(is_filled())
        keep = [ROW_ID] if ROW_ID in frame.columns else []
        return first_seen(cells.select(*keep, "column", cell_text().alias("text")), ["column"], n)

    if ROW_ID not in df.columns:
        return samples_of(narrow, wanted)
    head = narrow.orderBy(ROW_ID).limit(HEAD_ROWS)
    settled = samples_of(head, wanted).where(F.size("samples") >= n).collect()
    rest = [c for c in wanted if c not in {r["column"] for r in settled}]
    out = small_frame(spark, settled, "column string, samples array<string>")
    return out.unionByName(samples_of(narrow, rest)) if rest else out


def positions(df: DataFrame) -> DataFrame:
    """(column, position, dtype) of every data column, from the schema."""
    rows = [(f.name, i, f.dataType.simpleString())
            for i, f in enumerate(f for f in df.schema.fields if f.name != ROW_ID)]
    return small_frame(df.sparkSession, rows, "column string, position int, dtype string")


def profile(
    df: DataFrame,
    dataset: str,
    tokens: Sequence[str] = DISGUISED_NULLS,
    approximate: bool = False,
    date_first: bool = False,
    samples: int = 5,
) -> DataFrame:
    """Profile of every column: completeness, type, uniqueness, parse rates, tokens, samples."""
    values = None if approximate else value_table(df)
    counts = column_counts(df, tokens, values)
    _, _, nested = column_groups(df)
    if nested:
        # Nested columns get null counts only.
        whole = [F.count("*").alias("total")] + [
            F.count_if(col(c).isNull()).alias(str(i)) for i, c in enumerate(nested)]
        listed = F.array(*[F.struct(F.lit(c).alias("column"), F.col("total"), F.col(str(i)).alias("real_nulls"))
                           for i, c in enumerate(nested)])
        rows = df.agg(*whole).select(F.inline(listed))
        others = [F.lit(0).cast("long").alias(c) for c in counts.columns if c not in rows.columns]
        counts = counts.unionByName(rows.select("*", *others))
    missing = F.col("real_nulls") + F.col("disguised_nulls")
    found = F.array_compact(F.array(*[
        F.when(F.col(f"token_{i}") > 0, F.lit(name)) for i, name in enumerate(TOKEN_PATTERNS)]))
    mostly_positive = F.try_divide(F.col("present_nonnegative"), F.col("present_numeric")) >= 0.98
    kind = F.col("semantic_type")
    return (
        counts.withColumn("position", lookup({c: i for i, c in enumerate(data_columns(df))}, "column", "int"))
        .join(distinct_counts(df, tokens, approximate, values=values), "column", "left")
        .join(column_samples(df, n=samples, values=values), "column", "left")
        .withColumn("semantic_type", semantic_type(date_first))
        .select(
            F.lit(dataset).alias("dataset"), "column", "position", "semantic_type",
            F.when(kind == "date", temporal_kind()).alias("temporal_kind"),
            "total", "real_nulls", "disguised_nulls", missing.alias("effective_missing"),
            F.round(1 - F.coalesce(F.try_divide(missing, F.col("total")), F.lit(0.0)), 4).alias("completeness"),
            "present_count",
            F.coalesce("nunique_present", F.lit(0).cast("long")).alias("nunique_present"),
            F.round(F.coalesce(F.try_divide("nunique_present", "present_count"), F.lit(0.0)), 4).alias("unique_ratio"),
            F.round(_share("present_numeric", "present_count"), 4).alias("numeric_parse_rate"),
            F.coalesce("samples", F.array().cast("array<string>")).alias("samples"),
            found.alias("forbid_tokens"),
            F.when((kind == "numeric") & mostly_positive, F.lit(0.0)).alias("min_value")))


def completeness_profile(df: DataFrame, dataset: str, tokens: Sequence[str] = DISGUISED_NULLS) -> DataFrame:
    """Null and disguised-null counts with the completeness percentage of every column."""
    cells = typed_cells(df)
    counts = cells.groupBy("column").agg(
        F.count("*").alias("total"), _count(is_null()).alias("null_count"),
        _count(is_disguised_cell(tokens)).alias("disguised_null_count"))
    missing = F.col("null_count") + F.col("disguised_null_count")
    pct = F.round(100 * (1 - F.try_divide(missing, F.col("total"))), 2)
    return counts.select(F.lit(dataset).alias("dataset"), "column", "null_count", "disguised_null_count",
                         pct.alias("completeness_pct"))


def sparse_profile(df: DataFrame, dataset: str, below: float = 85.0) -> DataFrame:
    """Columns under a completeness percentage, emptiest first."""
    return (completeness_profile(df, dataset).where(F.col("completeness_pct") < below)
            .orderBy("completeness_pct", "column"))


def column_context(df: DataFrame, issues: DataFrame, n: int = 5) -> DataFrame:
    """Facts about the columns that issues name: type, distinct values, nulls, samples."""
    named = [r["column"] for r in
             issues.select(F.explode("columns").alias("column")).distinct()
                   .join(F.broadcast(positions(df)), "column", "left_semi").collect()]
    cells = typed_cells(df, named)
    nulls = cells.groupBy("column").agg(_count(is_null()).alias("n_nulls"))
    filled = cells.where(~is_null()).select("column", F.col("value").alias("text"))
    unique = (filled.groupBy("column", "text").agg(F.lit(1).alias("one"))
                    .groupBy("column").agg(F.count("*").alias("n_unique")))
    return (nulls.join(unique, "column", "left").join(F.broadcast(positions(df)), "column")
                 .join(column_samples(df, named, n), "column", "left")
                 .select("column", "dtype", F.coalesce("n_unique", F.lit(0).cast("long")).alias("n_unique"),
                         "n_nulls", F.coalesce("samples", F.array().cast("array<string>")).alias("samples")))


def numeric_exploration(df: DataFrame, column: str, pair: tuple[str, str] | None = None, n: int = 6) -> DataFrame:
    """First look at one numeric column: euro signs, negatives, unreadable cells, extremes.

    ``pair`` names two columns of which the first must not exceed the second.
    """
    from tablewright.functions.text import plain_double

    text = col(column).cast("string")
    number = plain_double(col(column))
    bad = F.lit(False) if pair is None else plain_double(col(pair[0])) > plain_double(col(pair[1]))
    unreadable = text.isNotNull() & number.isNull()
    keep = [ROW_ID] if ROW_ID in df.columns else []
    wrong = df.where(unreadable).select(*keep, F.lit(column).alias("column"), text.alias("text"))
    p99 = exact_quantiles(df.select(number.alias("n")), ["n"], [0.99])[("n", 0.99)]
    facts = df.agg(
        F.count_if(text.contains("€")).alias("with_euro"),
        F.count_if(number < 0).alias("negative"),
        F.count_if(unreadable).alias("unreadable"),
        F.max(number).alias("max_value"),
        F.count_if(bad).alias("pair_violations"))
    return (facts.withColumn("column", F.lit(column)).withColumn("p99", F.lit(p99).cast("double"))
                 .join(first_seen(wrong, ["column"], n), "column", "left")
                 .withColumn("samples", F.coalesce("samples", F.array().cast("array<string>"))))


def preview_type(dtype: T.DataType) -> str:
    """One of numeric, date, string for a declared type."""
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "date"
    return "numeric" if is_numeric_type(dtype) else "string"


def preview_types(df: DataFrame, dataset: str) -> DataFrame:
    """(dataset, column, type) from the schema alone."""
    rows = [(dataset, f.name, preview_type(f.dataType)) for f in df.schema.fields if f.name != ROW_ID]
    return small_frame(df.sparkSession, rows, "dataset string, column string, type string")


def dataset_summary(df: DataFrame, dataset: str) -> DataFrame:
    """Row, column and per-type counts of a table."""
    kinds = [preview_type(f.dataType) for f in df.schema.fields if f.name != ROW_ID]
    return df.agg(F.count("*").alias("rows")).select(
        F.lit(dataset).alias("dataset"), "rows", F.lit(len(kinds)).cast("long").alias("cols"),
        *[F.lit(kinds.count(k)).cast("long").alias(f"{k}_cols") for k in ("numeric", "string", "date")])


def preview_rows(df: DataFrame, n: int = 8) -> DataFrame:
    """The first ``n`` rows as text, NULL as the empty string."""
    text = [F.coalesce(col(c).cast("string"), F.lit("")).alias(c) for c in data_columns(df)]
    if ROW_ID in df.columns:
        return df.orderBy(ROW_ID).limit(n).select(ROW_ID, *text)
    return df.limit(n).select(*text)


def content_fingerprint(df: DataFrame) -> DataFrame:
    """Order-free fingerprint of the rows: count, xor and sum of two row hashes, and a digest."""
    return df.agg(*_multiset_hash(df)).select("rows", _digest(df).alias("fingerprint"))


def _multiset_hash(df: DataFrame) -> list[Column]:
    """Aggregates that don't depend on the order of the rows, but on how often each occurs."""
    columns = [col(c) for c in data_columns(df)]
    return [F.count("*").alias("rows"), F.bit_xor(F.xxhash64(*columns)).alias("xor_hash"),
            F.sum(F.xxhash64(F.lit(1), *columns).cast("decimal(38,0)")).alias("sum_hash")]


def _digest(df: DataFrame) -> Column:
    return F.sha1(F.concat_ws("|", F.lit(",".join(data_columns(df))), "rows", "xor_hash", "sum_hash"))


def range_fingerprints(df: DataFrame, width: int = RANGE_ROWS, key: str = ROW_ID) -> DataFrame:
    """(range, rows, fingerprint) of every range of ``width`` keys; a null key is range null. Rows combine on the map
    side, so a task hands on one row a range."""
    place = F.floor(col(key) / F.lit(width)).cast("long").alias("range")
    return df.groupBy(place).agg(*_multiset_hash(df)).select("range", "rows", _digest(df).alias("fingerprint"))


def differing_ranges(one: DataFrame, other: DataFrame, width: int = RANGE_ROWS, key: str = ROW_ID) -> DataFrame:
    """(range, rows, other_rows) of the key ranges in which two versions of a table hold different rows; 0 rows where a
    version has none. Equal versions, in whatever order, have no such range."""
    left = range_fingerprints(one, width, key).select(F.struct("range").alias("place"), "rows", "fingerprint")
    right = range_fingerprints(other, width, key).select(
        F.struct("range").alias("place"), F.col("rows").alias("other_rows"), F.col("fingerprint").alias("other_fingerprint"))
    both = left.join(right, "place", "full_outer").where(~F.col("fingerprint").eqNullSafe(F.col("other_fingerprint")))
    zero = F.lit(0).cast("long")
    return both.select("place.range", F.coalesce("rows", zero).alias("rows"), F.coalesce("other_rows", zero).alias("other_rows"))
