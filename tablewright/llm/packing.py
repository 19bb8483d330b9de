"""Best-fit packing of documents into sequences by linear grouping.

Lengths are whole numbers up to the capacity, so how many pieces have each length is all a plan needs, whatever
the corpus' size. Large lengths are cut into groups of equal cardinality and rounded up to their group's
largest; the few sizes left are packed by an optimised mix of configurations (a cutting-stock program solved by
column generation); actual lengths take the rounded ones' places; what is left, small pieces above all, goes by
best fit into the gaps. The plan is a table of runs: pieces of one length, by rank, to consecutive sequences.
"""

from __future__ import annotations

import base64
import zlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from tablewright.llm.common import cut

CAPACITY, END_ID = 1024, 2
#: (groups of large lengths, what a large length exceeds as a part of the capacity): each gives a plan, and the
#: one with the fewest sequences is taken.
SCHEMES = ((64, 3), (128, 3), (192, 3), (192, 4))


@lru_cache(maxsize=2)
def _encoder(path: str | None):
    """The byte-level BPE vocabulary; its ids are those of the tokenizers library for the same vocabulary."""
    import public_tokenizers
    import tiktoken

    with open(path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_ids(text: str, vocabulary: str | None = None) -> np.ndarray:
    """A document's ids with the end id, little-endian unsigned 32 bits."""
    return np.array([*_encoder(vocabulary).encode_ordinary(text), END_ID], "<u4")


def piece_lengths(n: int, capacity: int) -> list[int]:
    """A document longer than the capacity is cut into full pieces, the first one taking what is left over."""
    return [n % capacity or capacity] + [capacity] * ((n - 1) // capacity)


@dataclass(frozen=True)
class Run:
    """``count`` pieces of one length, from ``rank`` on, one to each sequence from ``first`` on, at ``offset``."""

    length: int
    rank: int
    count: int
    first: int
    offset: int


class _Plan:
    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity, self.runs, self.bins = capacity, [], 0
        self.left = {n: [0, c] for n, c in counts.items() if c > 0}  # length -> [next rank, pieces left]
        self.gaps: dict[int, list[tuple[int, int]]] = {}             # free tokens -> [(first sequence, sequences)]
        self.order: list[int] = []                                   # those gaps, ascending

    def open(self, n: int) -> int:
        self.bins += n
        return self.bins - n

    def add_gap(self, gap: int, first: int, n: int) -> None:
        if n and gap:
            if gap not in self.gaps:
                self.gaps[gap] = []
                self.order.insert(bisect_left(self.order, gap), gap)
            self.gaps[gap].append((first, n))

    def take_gap(self, least: int) -> tuple[int, int, int] | None:
        at = bisect_left(self.order, least)
        if at == len(self.order):
            return None
        gap = self.order[at]
        first, n = self.gaps[gap].pop()
        if not self.gaps[gap]:
            del self.gaps[gap], self.order[at]
        return gap, first, n

    def take(self, lengths: list[int], n: int) -> list[tuple[int, int, int]]:
        """Up to n pieces of the given lengths, the first lengths first: (length, rank, count)."""
        got = []
        for length in lengths:
            state = self.left.get(length)
            if n and state and state[1]:
                k = min(n, state[1])
                got.append((length, state[0], k))
                state[0], state[1], n = state[0] + k, state[1] - k, n - k
        return got

    def place_configuration(self, slots: list[list[int]], n: int) -> None:
        """n sequences with a piece from each slot's lengths, actual pieces replacing rounded ones."""
        first, streams = self.open(n), [self.take(lengths, n) for lengths in slots]
        edges = {0, n}
        for stream in streams:
            edges |= set(np.cumsum([k for *_, k in stream]).tolist())
        edges = sorted(edges)
        for a, b in zip(edges, edges[1:], strict=False):
            offset = 0
            for stream in streams:
                at = 0
                for length, rank, k in stream:
                    if at <= a < at + k:
                        self.runs.append(Run(length, rank + a - at, b - a, first + a, offset))
                        offset += length
                    at += k
            self.add_gap(self.capacity - offset, first + a, b - a)

    def best_fit(self) -> None:
        """All pieces left, longest first, each into the tightest gap that takes it, else into a new sequence."""
        for length in sorted(self.left, reverse=True):
            while self.left[length][1]:
                rank, todo = self.left[length]
                hole = self.take_gap(length)
                if hole is None:
                    n = -(-todo // (self.capacity // length))
                    hole = (self.capacity, self.open(n), n)
                gap, first, n = hole
                each = gap // length
                if todo >= each * n:
                    whole, part = n, 0
                else:
                    whole, part = divmod(todo, each)
                for j in range(each if whole else 0):
                    self.runs.append(Run(length, rank + j * whole, whole, first, self.capacity - gap + j * length))
                for j in range(part):
                    self.runs.append(Run(length, rank + each * whole + j, 1, first + whole, self.capacity - gap + j * length))
                self.add_gap(gap - each * length, first, whole)
                if part:
                    self.add_gap(gap - part * length, first + whole, 1)
                self.add_gap(gap, first + whole + bool(part), n - whole - bool(part))
                done = each * whole + part
                self.left[length] = [rank + done, todo - done]


def grouped(counts: dict[int, int], groups: int) -> list[list[int]]:
    """Lengths, longest first, in groups of about equal cardinality; pieces of one length stay together."""
    total, out, seen = sum(counts.values()), [], 0
    for length in sorted(counts, reverse=True):
        if not out or seen * groups >= total * len(out):
            out.append([])
        out[-1].append(length)
        seen += counts[length]
    return out


def configurations(sizes: list[int], need: list[int], capacity: int, rounds: int = 1500) -> list[tuple[list[int], int]]:
    """(pieces of each size, sequences): the cutting-stock optimum by column generation, rounded down."""
    size, need_ = np.array(sizes), np.array(need, float)
    basis = np.diag((capacity // size).astype(float))
    order = np.argsort(size, kind="stable")
    ordered = size[order]
    for _ in range(rounds):
        worth = np.maximum(np.linalg.solve(basis.T, np.ones(len(size))), 0)
        value, column = _knapsack(ordered, worth[order], capacity)
        if value <= 1 + 1e-7:
            break
        new = np.zeros(len(size))
        np.add.at(new, order[column], 1)
        step, amount = np.linalg.solve(basis, new), np.linalg.solve(basis, need_)
        ratio = np.where(step > 1e-9, amount / np.where(step > 1e-9, step, 1), np.inf)
        if not np.isfinite(ratio.min()):
            break
        basis[:, int(ratio.argmin())] = new
    amount = np.floor(np.linalg.solve(basis, need_) + 1e-6).astype(int)
    return [(basis[:, i].round().astype(int).tolist(), int(n)) for i, n in enumerate(amount) if n > 0]


def _knapsack(sizes: np.ndarray, worth: np.ndarray, capacity: int) -> tuple[float, list[int]]:
    """Best worth of any number of pieces of ascending sizes within the capacity, and their indices."""
    best, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    fitting = np.searchsorted(sizes, np.arange(capacity + 1), side="right")
    for c in range(int(sizes[0]), capacity + 1):
        k = fitting[c]
        found = best[c - sizes[:k]] + worth[:k]
        at = int(found.argmax())
        if found[at] > best[c - 1]:
            best[c], choice[c] = found[at], at
        else:
            best[c] = best[c - 1]
    picked, c = [], capacity
    while c > 0:
        if choice[c] < 0:
            c -= 1
        else:
            picked.append(int(choice[c]))
            c -= int(sizes[choice[c]])
    return float(best[capacity]), picked


def plan(counts: dict[int, int], capacity: int = CAPACITY, schemes: tuple = SCHEMES) -> list[Run]:
    """Runs that place ``counts[length]`` pieces of each length; the number of runs doesn't depend on the counts."""
    return min((_grouping(counts, capacity, *scheme) for scheme in schemes), key=lambda made: made.bins).runs


def _grouping(counts: dict[int, int], capacity: int, groups: int, small_part: int) -> _Plan:
    made = _Plan(counts, capacity)
    large = {n: c for n, c in counts.items() if c > 0 and capacity < n * small_part}
    if large:
        members = grouped(large, groups)
        found = configurations([g[0] for g in members], [sum(large[n] for n in g) for g in members], capacity)
        # Fullest configurations first: the longest of each group's pieces go there.
        for column, n in sorted(found, key=lambda x: -sum(k * g[0] for k, g in zip(x[0], members, strict=True))):
            slots = [g for k, g in zip(column, members, strict=True) for _ in range(k)]
            made.place_configuration(slots, n)
    made.best_fit()
    return made


def pack(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None, with_ids: bool = False,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each piece: (id_col, piece, start, length, ids_crc32, [ids], sequence_id, offset).

    ``vocabulary`` is a path of byte-level BPE ranks that every executor can open (default: the installed
    50k one). Pieces of one sequence lie at offsets without gaps. A null or empty text is one piece, its end
    id. Each row is packed for itself, repeated rows and null ids too; an empty table gives an empty table.
    Other columns are ignored. Which of several pieces of equal length goes where is arbitrary.
    """
    rows = docs.select(F.col(f"`{id_col}`"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text_"))
    fields = [rows.schema[0], StructField("piece", IntegerType()), StructField("start", LongType()),
              StructField("length", LongType()), StructField("ids_crc32", LongType())]
    fields += [StructField("ids", ArrayType(IntegerType()))] * with_ids
    spelled = StructType([*fields, StructField("part", IntegerType()), StructField("rank", LongType())])
    pieces = cut(rows.mapInArrow(_cutter(to_arrow_schema(spelled), capacity, vocabulary, with_ids), spelled), "pieces")
    counts = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    # At most ``capacity`` rows, whatever the table's size.
    runs = plan({r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}, capacity)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select(F.col("part").alias("part_"), F.col("length").alias("length_"),
                         F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = (pieces.join(base, (F.col("part") == F.col("part_")) & (F.col("length") == F.col("length_")))
              .withColumn("rank", F.col("rank") + F.col("base")).drop("part", "part_", "length_", "base"))
    out = StructType([*fields, StructField("sequence_id", LongType()), StructField("offset", LongType())])
    return ranked.mapInArrow(_placer(runs, to_arrow_schema(out)), out)


def _cutter(schema: pa.Schema, capacity: int, vocabulary: str | None, with_ids: bool):
    """Spells documents and cuts them; numbers this task's pieces of each length."""
    def spell(found: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, ranks = TaskContext.get().partitionId(), {}
        for batch in found:
            cells: list[list] = [[] for _ in schema]
            for id_, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids, start = token_ids(text, vocabulary), 0
                for piece, length in enumerate(piece_lengths(len(ids), capacity)):
                    own = ids[start:start + length]
                    rank = ranks[length] = ranks.get(length, -1) + 1
                    row = [id_, piece, start, length, zlib.crc32(own.tobytes())] + [own.astype("i4")] * with_ids + [part, rank]
                    for cell, value in zip(cells, row, strict=True):
                        cell.append(value)
                    start += length
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cells, schema.types, strict=True)], schema=schema)

    return spell


def _placer(runs: list[Run], schema: pa.Schema):
    runs = sorted(runs, key=lambda r: (r.length, r.rank))
    table = np.array([(r.length, r.rank, r.first, r.offset) for r in runs], np.int64).reshape(-1, 4)
    stride = int(table[:, 1].max(initial=0)) + max([r.count for r in runs], default=0) + 1
    key = table[:, 0] * stride + table[:, 1]

    def place(found: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("rank").to_numpy(zero_copy_only=False)
            at = np.searchsorted(key, length * stride + rank, side="right") - 1
            kept = [batch.column(n) for n in schema.names[:-2]]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(table[at, 2] + rank - table[at, 1]), pa.array(table[at, 3])], schema=schema)

    return place
