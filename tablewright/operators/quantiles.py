"""Exact quantiles of many columns without gathering a column in one task.

A mergeable sketch brackets each wanted rank, one counting pass proves the bracket, and this
repeats until a bracket holds few rows. Only the distinct values inside the last brackets are
then sorted. A value that fills a third of the table collapses to one counted value. Brackets that
do not settle are sorted by ranges: each range counts its rows, and the counts of all ranges tell
the one that holds a rank, so that no task gets more than its range.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.tables import col, materialize, small_frame

BLOCK_ROWS = 100_000
#: Counted values of a bracket that one task may sort, and the pieces that a round cuts a wider bracket into.
BLOCK_VALUES, PIECES = 100_000, 256
#: Pieces of equal width that the first round cuts a column into whose least and largest number are known.
EVEN_PIECES = 1_024
ACCURACY = 10_000
MAX_ROUNDS = 12
#: Counted values of a bracket that are sorted for a copy of a table.
COPY_VALUES = 20_000


def _bracket_rounds(nums, brackets, block_rows, accuracy):
    """Narrow every bracket with more than ``block_rows`` rows by sketch and proof."""
    for _ in range(MAX_ROUNDS):
        wide = [b for b in brackets if b["inside"] > block_rows and b["lo"] != b["hi"]]
        if not wide:
            return
        sketches = []
        for i, b in enumerate(wide):
            margin = b["margin"] / accuracy
            lo_share = (b["lo_rank"] - b["below"]) / b["inside"]
            hi_share = (b["hi_rank"] - b["below"]) / b["inside"]
            shares = [max(0.0, lo_share - margin), min(1.0, hi_share + margin)]
            sketches.append(F.percentile_approx(_inside(b), shares, accuracy).alias(str(i)))
        found = nums.agg(*sketches).first()
        counts = []
        for i, b in enumerate(wide):
            c, (lo, hi) = col(b["column"]), found[str(i)]
            counts += [F.count_if(c < lo).alias(f"{i}lo"), F.count_if(c <= hi).alias(f"{i}hi")]
        proof = nums.agg(*counts).first()
        for i, b in enumerate(wide):
            below, upto = proof[f"{i}lo"], proof[f"{i}hi"]
            if not (below <= b["lo_rank"] and b["hi_rank"] < upto):
                b["margin"] *= 8  # the sketch missed: take more room and try again
            elif upto - below < b["inside"]:
                b["lo"], b["hi"] = found[str(i)]
                b["below"], b["inside"] = below, upto - below
            else:
                b["done"] = True  # a few values hold these rows, so their counted values are few
        brackets = [b for b in brackets if not b.get("done")]


def _inside(b):
    c = col(b["column"])
    ok = c.isNotNull()
    if b["lo"] is not None:
        ok = (c >= b["lo"]) & (c <= b["hi"])
    return F.when(ok, c)


def _brackets(columns, probs, counts) -> tuple[dict, list[dict]]:
    """(results of empty columns, one bracket over the whole column for each other column and probability)"""
    out, brackets = {}, []
    for c in columns:
        for p in probs:
            if not counts[c]:
                out[(c, p)] = None
                continue
            position = (counts[c] - 1) * p
            brackets.append({"id": len(brackets), "column": c, "p": p, "lo": None, "hi": None,
                             "below": 0, "inside": counts[c], "position": position, "margin": 3.0,
                             "lo_rank": math.floor(position), "hi_rank": math.ceil(position)})
    return out, brackets


def exact_quantiles(
    nums: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    counts: Mapping[str, int] | None = None,
    block_rows: int = BLOCK_ROWS,
    accuracy: int = ACCURACY,
    distinct: dict[str, int] | None = None,
) -> dict[tuple[str, float], float | None]:
    """Linear-interpolation quantiles of double columns, as ``{(column, p): value}``.

    ``counts`` may pass the known non-null counts and saves one scan. ``distinct``, if given, gets the number of
    distinct values of those columns of which all values were sorted.
    """
    if not columns:
        return {}
    nums = nums.select(*[col(c) for c in columns])
    if counts is None:
        row = nums.agg(*[F.count(col(c)).alias(str(i)) for i, c in enumerate(columns)]).first()
        counts = {c: row[str(i)] for i, c in enumerate(columns)}
    out, brackets = _brackets(columns, probs, counts)
    if not brackets:
        return out
    _bracket_rounds(nums, brackets, block_rows, accuracy)
    cells = nums.unpivot([], [col(c) for c in columns], "column", "number").where("number is not null")
    spans = _spans(nums, brackets)
    return out | _read_ranks(_inside_spans(cells.withColumn("n", F.lit(1)), spans), spans, brackets, block_rows, distinct)


def counted_quantiles(
    values: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    counts: Mapping[str, int],
    block_rows: int = BLOCK_VALUES,
    distinct: dict[str, int] | None = None,
    ends: Mapping[str, tuple[float | None, float | None]] | None = None,
) -> dict[tuple[str, float], float | None]:
    """As ``exact_quantiles``, of values that are counted already: (column, number, n), a number in one row or in several.

    A bracket with more rows is cut into pieces at quantiles of its values, and the rows of all pieces are counted, which
    tells the piece that holds a rank. Pieces of equal width between the ``ends`` of a column, if known, come first and need
    no pass to find them; whatever the ends, the pieces are in the order of the numbers. So only the values of that piece are sorted, whatever the rows of each value.
    ``distinct`` gets the number of distinct values, of a column that was cut at least four if there are four.
    """
    out, brackets = _brackets(columns, probs, counts)
    if not brackets:
        return out
    _piece_rounds(values, brackets, block_rows, distinct, ends or {})
    spans = _spans(values, brackets)
    return out | _read_ranks(_inside_spans(values, spans), spans, brackets, block_rows, distinct)


def _even_step(ends) -> float | None:
    """Pieces for each unit between two ends; None without a finite width."""
    if ends is None or None in ends or not 0 < ends[1] - ends[0] < math.inf:
        return None
    step = EVEN_PIECES / (ends[1] - ends[0])
    return step if 0 < step < math.inf else None


def _with_even_piece(numbers: DataFrame) -> DataFrame:
    """Add ``piece``, the place of the row's number among pieces of equal width: ``step`` a unit, from ``least`` on."""
    place = F.floor((F.col("number") - F.col("least")) * F.col("step"))
    return numbers.withColumn("piece", F.greatest(F.lit(0), F.least(F.lit(EVEN_PIECES - 1), place)).cast("int"))


def _piece_rounds(values, brackets, block_rows, distinct, ends) -> None:
    """Narrow every bracket with more than ``block_rows`` counted values by counting the rows of its pieces."""
    for turn in range(MAX_ROUNDS):
        wide = [b for b in brackets if b.get("values", b["inside"]) > block_rows and not b.get("done")]
        if not wide:
            return
        spans = {k: i for i, k in enumerate({(b["column"], b["lo"], b["hi"]): None for b in wide})}
        limits = small_frame(values.sparkSession, [(i, *k) for k, i in spans.items()], "id int, column string, lo double, hi double")
        inside = (values.join(F.broadcast(limits), "column").where(F.col("lo").isNull() | F.col("number").between(F.col("lo"), F.col("hi")))
                  .select("id", "number", "n"))
        even = turn == 0 and all(_even_step(ends.get(b["column"])) for b in wide)
        if even:
            steps = [(i, ends[c][0], _even_step(ends[c])) for (c, _, _), i in spans.items()]
            pieces = _with_even_piece(inside.join(F.broadcast(small_frame(values.sparkSession, steps, "id int, least double, step double")), "id"))
        else:
            shares = [i / PIECES for i in range(1, PIECES)]
            cuts = [(r["id"], _padded(sorted(set(r["cuts"])))) for r in inside.groupBy("id").agg(
                F.percentile_approx("number", shares, ACCURACY).alias("cuts")).collect()]
            pieces = _with_piece(inside.join(F.broadcast(small_frame(values.sparkSession, cuts, "id int, cuts array<double>")), "id"))
        counted: dict[int, list] = {}
        for r in pieces.groupBy("id", "piece").agg(
                F.sum("n").alias("rows"), F.count("*").alias("values"), F.min("number").alias("lo"), F.max("number").alias("hi")).collect():
            counted.setdefault(r["id"], []).append(r)
        for b in wide:
            pieces = sorted(counted[spans[(b["column"], b["lo"], b["hi"])]], key=lambda r: r["piece"])
            if distinct is not None and b["lo"] is None and b["column"] not in distinct:
                least = sum(1 + (r["lo"] < r["hi"]) for r in pieces)
                distinct[b["column"]] = least if least >= 4 else values.where(
                    F.col("column") == b["column"]).select("number").distinct().limit(4).count()
            start, held = b["below"], []
            for r in pieces:
                if start <= b["hi_rank"] and b["lo_rank"] < start + r["rows"]:
                    held.append((start, r))
                start += r["rows"]
            rows, kept = sum(r["rows"] for _, r in held), sum(r["values"] for _, r in held)
            b["done"] = not even and kept == sum(r["values"] for r in pieces)  # equal numbers: their one counted value is few
            b.update(lo=held[0][1]["lo"], hi=held[-1][1]["hi"], below=held[0][0], inside=rows, values=kept)


def _padded(cuts: list[float]) -> list[float]:
    return cuts + [math.inf] * (PIECES - 1 - len(cuts))


def _with_piece(numbers: DataFrame) -> DataFrame:
    """Add ``piece``, how many of the row's ``PIECES - 1`` sorted ``cuts`` lie below its number, by halving: a column a step."""
    out, step = numbers.withColumn("piece", F.lit(0)), PIECES // 2
    while step:
        out = out.withColumn("piece", F.col("piece") + F.when(F.get("cuts", F.col("piece") + F.lit(step - 1)) < F.col("number"), step).otherwise(0))
        step //= 2
    return out


def _inside_spans(cells: DataFrame, spans: DataFrame) -> DataFrame:
    """(column, number, n) of the distinct numbers inside the brackets."""
    # A condition for each bracket of a column, which is compiled; a function over the list would be interpreted for each cell.
    of_column: dict[str, list] = {}
    for r in spans.collect():
        of_column.setdefault(r["column"], []).append((r["lo"], r["hi"]))
    most = max(map(len, of_column.values()))
    ends = ", ".join(f"held{i} boolean, lo{i} double, hi{i} double" for i in range(most))
    rows = [(c, *sum([(True, *s) for s in found], ()), *(False, None, None) * (most - len(found))) for c, found in of_column.items()]
    keep = F.broadcast(small_frame(cells.sparkSession, rows, f"column string, {ends}"))
    wanted = reduce(Column.__or__, [F.col(f"held{i}") & (F.col(f"lo{i}").isNull() | F.col("number").between(F.col(f"lo{i}"), F.col(f"hi{i}")))
                                    for i in range(most)])
    return cells.join(keep, "column").where(wanted).groupBy("column", "number").agg(F.sum("n").alias("n"))


def _spans(df: DataFrame, brackets) -> DataFrame:
    return small_frame(
        df.sparkSession, [(b["id"], b["column"], b["lo"], b["hi"], b["below"], b["lo_rank"], b["hi_rank"]) for b in brackets],
        "id int, column string, lo double, hi double, below bigint, lo_rank bigint, hi_rank bigint")


def _read_ranks(values, spans, brackets, block_rows, distinct) -> dict:
    """The values at the brackets' ranks. One row per (column, distinct value, bracket); brackets of a column that was not
    narrowed share its whole value list."""
    ranked = (values.join(F.broadcast(spans), "column")
              .where(F.col("lo").isNull() | F.col("number").between(F.col("lo"), F.col("hi"))))
    found = _ranks_of(ranked, brackets, block_rows)
    out = {}
    for b in brackets:
        lo, hi, n = found[b["id"]]
        out[(b["column"], b["p"])] = lo + (hi - lo) * (b["position"] - b["lo_rank"])
        if distinct is not None and b["lo"] is None:
            distinct.setdefault(b["column"], n)
    return out


def _ranks_of(ranked, brackets, block_rows) -> dict[int, tuple]:
    """{id: (value at the lower rank, at the upper rank, distinct values)} of (id, number, n, below, lo_rank, hi_rank)."""
    if max(b.get("values", b["inside"]) for b in brackets) > block_rows:
        return _ranks_by_ranges(ranked.select("id", "number", "n"), brackets)
    upto = F.sum("n").over(Window.partitionBy("id").orderBy("number")
                           .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = ranked.withColumn("upto", F.col("below") + upto).withColumn("start", F.col("upto") - F.col("n"))
    return {r["id"]: (r["lo"], r["hi"], r["values"]) for r in ranked.groupBy("id").agg(
        _at("lo_rank").alias("lo"), _at("hi_rank").alias("hi"), F.count("*").alias("values")).collect()}


def _at(rank):
    return F.max(F.when((F.col("start") <= F.col(rank)) & (F.col(rank) < F.col("upto")), F.col("number")))


def _ranks_by_ranges(ranked, brackets) -> dict[int, tuple]:
    """{id: (value at the lower rank, at the upper rank, distinct values)} by range partitions of (id, value) and their
    row counts. The driver gets a row for each partition and bracket; a window sees one range at a time."""
    spread = materialize(ranked.repartitionByRange("id", "number").withColumn("part", F.spark_partition_id()), "ranges")
    parts = {}
    for r in spread.groupBy("id", "part").agg(F.sum("n").alias("rows"), F.count("*").alias("values"), F.min("number").alias("least")).collect():
        parts.setdefault(r["id"], []).append((r["least"], r["part"], r["rows"], r["values"]))
    wanted = []
    for b in brackets:
        start = b["below"]
        for _, part, rows, _ in sorted(parts[b["id"]]):
            for name in ("lo_rank", "hi_rank"):
                if start <= b[name] < start + rows:
                    wanted.append((b["id"], part, name, start, b[name]))
            start += rows
    asked = small_frame(ranked.sparkSession, wanted, "id int, part int, name string, before bigint, rank bigint")
    upto = F.sum("n").over(Window.partitionBy("id", "part", "name").orderBy("number").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = (spread.join(F.broadcast(asked), ["id", "part"]).withColumn("upto", F.col("before") + upto)
            .withColumn("start", F.col("upto") - F.col("n")))
    at = {(r["id"], r["name"]): r["value"] for r in rows.groupBy("id", "name").agg(_at("rank").alias("value")).collect()}
    return {i: (at[(i, "lo_rank")], at[(i, "hi_rank")], sum(p[3] for p in found)) for i, found in parts.items()}


# ---------------------------------------------------------------- copies of a table

def copied_quantiles(
    values: DataFrame,
    changes: DataFrame,
    keys: Sequence[tuple[str, str]],
    probs: Sequence[float],
    counts: Mapping[tuple[str, str], int],
    ends: Mapping[str, tuple[float | None, float | None]],
    distinct: dict[tuple[str, str], int],
    block_rows: int = COPY_VALUES,
) -> dict[tuple[tuple[str, str], float], float | None]:
    """As ``counted_quantiles``, of copies of a table: ``values`` are the table's (column, number, n), ``changes`` what a
    copy has more or, with ``n`` below 0, less of (copy, column, number, n). ``keys`` are (copy, column).

    The rows of a piece are those of the table and those that the copy has more, so the table's numbers are passed over
    once a round for all copies, whose brackets share their spans. ``distinct`` gets the number of distinct values, at
    least four if there are four.
    """
    out, brackets = _brackets(keys, probs, counts)
    for b in brackets:
        b["key"] = b["column"]
        b["copy"], b["column"] = b["key"]
    if not brackets:
        return out
    _copied_rounds(values, changes, brackets, block_rows, ends, distinct)
    session = values.sparkSession
    spans = small_frame(session, [(b["id"], b["copy"], b["column"], b["lo"], b["hi"], b["below"], b["lo_rank"], b["hi_rank"]) for b in brackets],
                        "id int, copy string, column string, lo double, hi double, below bigint, lo_rank bigint, hi_rank bigint")
    shared = small_frame(session, sorted({(b["column"], b["lo"], b["hi"]) for b in brackets}, key=str), "column string, lo double, hi double")
    inside = F.col("lo").isNull() | F.col("number").between(F.col("lo"), F.col("hi"))
    own = changes.join(F.broadcast(spans), ["copy", "column"]).where(inside).select("id", "number", "n")
    both = _inside_spans(values, shared).join(F.broadcast(spans), "column").where(inside).select("id", "number", "n").unionByName(own)
    ranked = both.groupBy("id", "number").agg(F.sum("n").alias("n")).where("n > 0").join(F.broadcast(spans), "id")
    found = _ranks_of(ranked, brackets, block_rows)
    for b in brackets:
        lo, hi, n = found[b["id"]]
        out[(b["key"], b["p"])] = lo + (hi - lo) * (b["position"] - b["lo_rank"])
        if b["lo"] is None:
            distinct.setdefault(b["key"], n)
    left = sorted(set(keys) - set(distinct))
    if left:
        distinct |= _copied_distinct(values, changes, left)
    return out


def _copied_rounds(values, changes, brackets, block_rows, ends, distinct) -> None:
    """``_piece_rounds`` for copies: pieces of the table's values, with what each copy has more or less in them."""
    session = values.sparkSession
    for turn in range(MAX_ROUNDS):
        wide = [b for b in brackets if b.get("values", b["inside"]) > block_rows and not b.get("done")]
        if not wide:
            return
        spans = {k: i for i, k in enumerate({(b["column"], b["lo"], b["hi"]): None for b in wide})}
        limits = small_frame(session, [(i, *k) for k, i in spans.items()], "id int, column string, lo double, hi double")

        def inside(df):
            return df.join(F.broadcast(limits), "column").where(F.col("lo").isNull() | F.col("number").between(F.col("lo"), F.col("hi"))).drop("column", "lo", "hi")

        even = turn == 0 and all(_even_step(ends.get(b["column"])) for b in wide)
        if even:
            places = small_frame(session, [(i, ends[c][0], _even_step(ends[c])) for (c, _, _), i in spans.items()], "id int, least double, step double")
            with_piece = _with_even_piece
        else:
            shares = [i / PIECES for i in range(1, PIECES)]
            cuts = {r["id"]: r["cuts"] for r in inside(values).groupBy("id").agg(F.percentile_approx("number", shares, ACCURACY).alias("cuts")).collect()}
            places = small_frame(session, [(i, _padded(sorted(set(cuts.get(i, ()))))) for i in spans.values()], "id int, cuts array<double>")
            with_piece = _with_piece

        def pieces(df, *group):
            return with_piece(inside(df).join(F.broadcast(places), "id")).groupBy("id", "piece", *group).agg(
                F.sum("n").alias("rows"), F.count("*").alias("values"), F.min("number").alias("lo"), F.max("number").alias("hi")).collect()

        ranges: dict[tuple, tuple] = {}
        table: dict[int, dict] = {}
        moved: dict[tuple, dict] = {}
        for r in pieces(values):
            table.setdefault(r["id"], {})[r["piece"]] = (r["rows"], r["values"])
            ranges[r["id"], r["piece"]] = (r["lo"], r["hi"])
        for r in pieces(changes, "copy"):
            moved.setdefault((r["id"], r["copy"]), {})[r["piece"]] = (r["rows"], r["values"])
            lo, hi = ranges.get((r["id"], r["piece"]), (r["lo"], r["hi"]))
            ranges[r["id"], r["piece"]] = (min(lo, r["lo"]), max(hi, r["hi"]))
        for b in wide:
            i = spans[b["column"], b["lo"], b["hi"]]
            own, more = table.get(i, {}), moved.get((i, b["copy"]), {})
            parts = [(p, *(x + y for x, y in zip(own.get(p, (0, 0)), more.get(p, (0, 0)), strict=True))) for p in sorted(own.keys() | more.keys())]
            filled = sum(rows > 0 for _, rows, _ in parts)
            if b["lo"] is None and filled >= 4:
                distinct.setdefault(b["key"], filled)
            start, held = b["below"], []
            for piece, rows, n in parts:
                if rows and start <= b["hi_rank"] and b["lo_rank"] < start + rows:
                    held.append((start, piece, rows, n))
                start += rows
            kept = sum(n for *_, n in held)
            b["done"] = not even and kept == sum(n for *_, n in parts)  # equal numbers: their one counted value is few
            b.update(lo=ranges[i, held[0][1]][0], hi=ranges[i, held[-1][1]][1], below=held[0][0], inside=sum(h[2] for h in held), values=kept)


def _copied_distinct(values, changes, keys) -> dict[tuple[str, str], int]:
    """Distinct numbers of columns of copies: those of the table, without those gone, with those that are new."""
    columns = sorted({c for _, c in keys})
    table = values.where(F.col("column").isin(columns)).groupBy("column", "number").agg(F.sum("n").alias("rows"))
    whole = {r["column"]: r["n"] for r in table.groupBy("column").agg(F.count("*").alias("n")).collect()}
    moved = changes.where(F.col("column").isin(columns)).groupBy("copy", "column", "number").agg(F.sum("n").alias("n")).join(
        table, ["column", "number"], "left")
    known = F.coalesce(F.col("rows"), F.lit(0))
    found = {(r["copy"], r["column"]): r["more"] for r in moved.groupBy("copy", "column").agg(
        (F.count_if((known == 0) & (F.col("n") > 0)) - F.count_if((known > 0) & (known + F.col("n") <= 0))).alias("more")).collect()}
    return {k: whole.get(k[1], 0) + found.get(k, 0) for k in keys}
