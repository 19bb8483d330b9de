"""Readers. CSV is read as text, so that dirty cells survive; parquet keeps its types."""

from __future__ import annotations

import csv
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.constants import CSV_NULLS
from tablewright.tables import col, materialize, small_frame

_RECORD, _FILE = "_corrupt_record", "_file"


@dataclass(frozen=True)
class CsvTable:
    """A CSV table, its header as written (repeated names included), and the rows that don't fit it."""

    data: DataFrame
    header: tuple[str, ...]
    bad: DataFrame | None = None


def _unique(names: list[str]) -> list[str]:
    """Repeated names get ``.1``, ``.2``, ... in order."""
    seen: dict[str, int] = {}
    out = []
    for name in names:
        times = seen.get(name, 0)
        seen[name] = times + 1
        out.append(f"{name}.{times}" if times else name)
    return out


def _headers(spark: SparkSession, path: str, options: dict) -> dict[tuple[str, ...], str]:
    """Each header that some file has, with one such file's path: a distributed read of first lines."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"),
                                         F.col("_metadata.file_block_start").alias("start"),
                                         F.monotonically_increasing_id().alias("at")).where("start = 0")
    firsts = lines.groupBy("file").agg(F.min_by("value", "at").alias("line"))
    found = {}
    for r in firsts.groupBy("line").agg(F.min("file").alias("file")).orderBy("file").collect():
        line = r["line"].removeprefix("﻿")
        if line.count(options["quote"]) % 2:
            raise ValueError(f"header with a line break in {r['file']}")
        cells = next(csv.reader([line], delimiter=options.get("sep", ","), quotechar=options["quote"]), [])
        found.setdefault(tuple(cells), r["file"])
    return found


def _bad(names: list[str], options: dict) -> Column:
    """Rows that lose something when read under these names: a cell too many, or a quote that never closes.

    Cells that are missing at the end of a row are null, as usual.
    """
    wider = ", ".join(f"c{i} string" for i in range(len(names) + 1))
    keep = {k: str(v) for k, v in options.items() if k != "multiLine"}
    record = F.col(_RECORD)
    surplus = F.from_csv(record, wider, keep)[f"c{len(names)}"].isNotNull()
    quotes = F.length(record) - F.length(F.replace(record, F.lit(options["quote"]), F.lit("")))
    return F.coalesce(record.isNotNull() & (surplus | (quotes % 2 == 1)), F.lit(False))


def _records(spark: SparkSession, path: str, quote: str) -> DataFrame:
    """(_file, _corrupt_record): the records of CSV files whose quoted cells may hold line breaks, headers left out.

    A line starts a record if the quotes before it in its file are even in number. So each split counts its quotes and,
    for both ways it may begin, the records that start in it; the sums over the splits before it tell which way holds and
    the number of its first record. A file is read in as many tasks as it has splits, and only the lines of records with
    breaks are brought together.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias(_FILE), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"))
    lines = lines.withColumn("odd", (F.length("value") - F.length(F.replace("value", F.lit(quote), F.lit("")))) % 2)
    split = [_FILE, "start"]
    so_far = Window.partitionBy(*split).orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lines = lines.withColumn("before", (F.sum("odd").over(so_far) - F.col("odd")) % 2)
    lines = materialize(lines.withColumns({f"starts{k}": F.sum((F.col("before") == k).cast("long")).over(so_far) for k in (0, 1)}), "lines")
    splits = lines.groupBy(*split).agg(F.sum("odd").alias("quotes"), F.max("starts0").alias("starts0"), F.max("starts1").alias("starts1"))
    earlier = Window.partitionBy(_FILE).orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("open", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2)
    splits = splits.withColumn("first", F.coalesce(F.sum(F.when(F.col("open") == 0, F.col("starts0")).otherwise(F.col("starts1"))).over(earlier), F.lit(0)))
    placed = lines.join(splits.select(*split, "open", "first"), split)
    inside = F.col("before") != F.col("open")
    record = F.col("first") + F.when(F.col("open") == 0, F.col("starts0")).otherwise(F.col("starts1"))
    placed = placed.select(_FILE, record.alias("record"), "start", "at", "value", "odd", inside.alias("inside"))
    whole = ~F.col("inside") & (F.col("odd") == 0)
    listed = F.sort_array(F.collect_list(F.struct("start", "at", "value")))
    broken = placed.where(~whole).groupBy(_FILE, "record").agg(F.array_join(F.transform(listed, lambda x: x["value"]), "\n").alias("value"))
    both = placed.where(whole).select(_FILE, "record", "value").unionByName(broken)
    return both.where("record > 1").select(_FILE, F.regexp_replace("value", "\r$", "").alias(_RECORD)).where(F.col(_RECORD) != "")


def read_csv(spark: SparkSession, path: str, nulls: tuple[str, ...] = CSV_NULLS, multi_line: bool | str = False,
             keep_bad: bool = False, **options) -> CsvTable:
    """Read a CSV with header, all columns as text, usual NULL spellings as NULL.

    Files of one folder may have their columns in any order, they meet by name; other sets of names raise, and
    so do an empty table and rows with more cells than the header or an unclosed quote. ``keep_bad`` hands
    such rows out as ``bad`` (file, record, first_cell) instead. ``multi_line`` says that quoted cells can hold line
    breaks; large files are split over tasks then, too, for which quotes must stand around whole cells and doubled inside
    them. ``"file"`` reads each file in one task instead, and so does an ``escape`` of its own. No row cap. Repeated
    names are renamed instead of merged.
    """
    reader = {"quote": '"', "escape": '"', "multiLine": bool(multi_line), **options}
    by_parity = bool(multi_line) and multi_line != "file" and reader["escape"] == reader["quote"]
    headers = _headers(spark, path, reader)
    if not headers or not any(headers):
        raise ValueError(f"CSV is empty: {path}")
    named = {h: _unique([n if n else f"Unnamed: {i}" for i, n in enumerate(h)]) for h in headers}
    header = next(iter(headers))
    names = named[header]
    if len({frozenset(n) for n in named.values()}) > 1:
        raise ValueError("files have different columns: " + "; ".join(f"{headers[h]}: {', '.join(h)}" for h in headers))
    parts, records = [], materialize(_records(spark, path, reader["quote"]), "records") if by_parity else None
    for own in named.values():
        schema = T.StructType([T.StructField(n, T.StringType()) for n in [*own, _RECORD]])
        if by_parity:
            keep = {k: str(v).lower() if isinstance(v, bool) else str(v) for k, v in reader.items()}
            cells = F.from_csv(_RECORD, ", ".join(f"c{i} string" for i in range(len(own))), keep)
            raw = records.withColumn("_cells", cells).select(
                *[F.col("_cells")[f"c{i}"].alias(n) for i, n in enumerate(own)], _RECORD, _FILE)
        else:
            raw = (spark.read.options(**{**reader, "header": True, "enforceSchema": True, "mode": "PERMISSIVE",
                                         "columnNameOfCorruptRecord": _RECORD, "columnPruning": False})
                   .schema(schema).csv(path)).withColumn(_FILE, F.col("_metadata.file_path"))
        if len(named) > 1:
            raw = raw.join(_files_of(spark, path, own, named, reader), _FILE, "left_semi")
        parts.append(raw.withColumn("_bad", _bad(own, reader)))
    rows = reduce(DataFrame.unionByName, parts)
    counts = rows.agg(F.count(col(names[0])).alias("seen"), F.count("*").alias("rows"), F.count_if("_bad").alias("bad")).first()
    if not counts["rows"]:
        raise ValueError(f"CSV has no rows: {path}")
    if counts["bad"] and not keep_bad:
        example = rows.where("_bad").select(_FILE, _RECORD, col(names[0])).first()
        raise ValueError(f"{counts['bad']} rows don't fit the header, for instance in {example[0]}: {example[1][:200]}")
    if counts["bad"]:
        rows_kept = materialize(rows.where("not _bad").select(*[col(n) for n in names]), "good-rows")
    else:
        rows_kept = reduce(DataFrame.unionByName, [p.select(*[col(n) for n in names]) for p in parts])
    data = rows_kept.select(*[F.when(~col(n).isin(*nulls), col(n)).alias(n) for n in names])
    # Written, as Spark reads no raw CSV for its bad records alone.
    found = rows.where("_bad").select(F.col(_FILE).alias("file"), F.col(_RECORD).alias("record"), col(names[0]).alias("first_cell"))
    bad = materialize(found, "bad-rows") if counts["bad"] else small_frame(spark, [], "file string, record string, first_cell string")
    return CsvTable(data, header, bad)


def _files_of(spark: SparkSession, path: str, own: list[str], named: dict, options: dict) -> DataFrame:
    """The files whose header gives just these names, as a table."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias(_FILE),
                                         F.col("_metadata.file_block_start").alias("start"),
                                         F.monotonically_increasing_id().alias("at")).where("start = 0")
    firsts = lines.groupBy(_FILE).agg(F.min_by("value", "at").alias("line"))
    wanted = [list(h) for h, n in named.items() if n == own]
    cells = ", ".join(f"c{i} string" for i in range(len(own)))
    keep = {k: str(v) for k, v in options.items() if k != "multiLine"}
    parsed = F.from_csv(F.regexp_replace("line", "^﻿", ""), cells, keep)
    same = reduce(lambda a, b: a | b, [reduce(lambda a, b: a & b, [F.coalesce(parsed[f"c{i}"], F.lit("")) == n for i, n in enumerate(h)])
                                       for h in wanted])
    return firsts.where(same).select(_FILE)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """CSV or parquet by extension."""
    if path.rstrip("/").endswith(".csv"):
        return read_csv(spark, path).data
    data = spark.read.parquet(path)
    if data.isEmpty():
        raise ValueError(f"table has no rows: {path}")
    return data


def read_tables(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, DataFrame]:
    """Several named tables."""
    return {name: read_table(spark, path) for name, path in paths.items()}
