"""SimHash near-dedup by meet-in-the-middle ball hashing.

Two fingerprints that differ in 3 bits meet in points one flip from one and two flips from the other. Each
distinct fingerprint emits itself, its 64 single flips and those double flips that such a meeting can need:
the 64 bits fall into two halves, of 3 differing bits two share a half, so it is enough that fingerprints
with an even number of ones flip pairs in the lower half and the others pairs in the upper half. Variants are
shuffled by their leading bits: a fingerprint travels once to each prefix its variants have, and there the
variants are spelled out, sorted and met. Whoever meets at a point that is at most one flip from one of them
is linked to that one (1 + 2 bits at most), which gives all links' components without pairs of a whole group.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StructField, StructType

from tablewright.llm.common import bitmap, cut, maybe_in

BITS, RADIUS, SHINGLE, SEED = 64, 3, 3, 42
#: Distinct fingerprints for a prefix of the shuffle, on average.
PREFIX_ROWS = 4096
#: Variants spelled out at once in a task.
CHUNK_VARIANTS = 4_000_000
_LOW = [(i, j) for i, j in itertools.combinations(range(32), 2)]
_HIGH = [(i, j) for i, j in itertools.combinations(range(32, 64), 2)]


def fingerprint(text: str) -> int:
    """64 majority bits of the XXH64 of all 3-word shingles of the text with A-Z lower-cased; no word: 0."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < SHINGLE:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        stops = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = [0, *(stops[:-SHINGLE] + 1).tolist()]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[s:e], SEED) for s, e in zip(starts, stops[SHINGLE - 1:].tolist(), strict=True)]
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        block = np.array(hashes[at:at + (1 << 16)], np.uint64)
        ones += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(sum(1 << i for i in np.flatnonzero(2 * ones > len(hashes)).tolist()))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, hash, fp) of each row: hash names the text, fp is the fingerprint as a signed long."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(F.col(f"`{text_col}`")).alias("hash"),
                       F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    out = StructType([rows.schema["id"], StructField("hash", LongType()), StructField("fp", LongType())])
    schema = to_arrow_schema(out)

    def shingled(found: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            prints = np.array([fingerprint(t) for t in batch.column(2).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(prints)], schema=schema)

    return rows.mapInArrow(shingled, out)


def links(distinct: DataFrame, prefix_rows: int = PREFIX_ROWS) -> DataFrame:
    """(a, b): for each prefix a spanning forest of the links between the distinct fingerprints in column ``fp``."""
    n = max(1, distinct.count())
    bits = min(24, max(0, math.ceil(math.log2(n / prefix_rows))))
    routed = distinct.select("fp").mapInArrow(_router(bits), "prefix long, fp long")
    return (routed.repartition("prefix").sortWithinPartitions("prefix")
            .mapInArrow(_meeter(bits), "a long, b long").distinct())


def _odd(fps: np.ndarray) -> np.ndarray:
    return (np.bitwise_count(fps) & 1).astype(bool)


def _router(bits: int):
    """Sends a fingerprint to the prefix of each of its variants."""
    flips = [0] + [1 << i for i in range(bits)]
    odd_flips = [(1 << i) | (1 << j) for i, j in itertools.combinations(range(bits), 2)]

    def route(found: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            signed = batch.column(0).to_numpy(zero_copy_only=False)
            fps = signed.view(np.uint64)
            own = (fps >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(fps), np.int64)
            odd = _odd(fps)
            for flip, who in itertools.chain(((f, slice(None)) for f in flips), ((f, odd) for f in odd_flips)):
                yield pa.RecordBatch.from_arrays([pa.array(own[who] ^ flip), pa.array(signed[who])], names=["prefix", "fp"])

    return route


def _meeter(bits: int):
    def meet(found: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prefix, parts = None, []

        def ended() -> Iterator[pa.RecordBatch]:
            if parts:
                a, b = forest(np.unique(np.concatenate(parts)), prefix, bits)
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for batch in found:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            fps = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            edges = np.flatnonzero(np.diff(keys)) + 1
            for piece_keys, piece in zip(np.split(keys, edges), np.split(fps, edges), strict=True):
                if not len(piece):
                    continue
                if piece_keys[0] != prefix:
                    yield from ended()
                    prefix, parts = int(piece_keys[0]), []
                parts.append(piece.copy())
        yield from ended()

    return meet


def forest(fps: np.ndarray, prefix: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint, root) for the linked ones among ``fps``, by the variants that start with ``prefix``.

    Sub-prefixes are met one after the other, so memory stays bounded however many share the prefix.
    """
    more = max(0, math.ceil(math.log2(max(1, len(fps) * 560 / CHUNK_VARIANTS))))
    more = min(more, 31 - bits)
    label = np.arange(len(fps))
    for sub in range(1 << more):
        a, b = meetings(fps, (prefix << more) | sub, bits + more)
        label = _merge(label, a, b)
    linked = np.flatnonzero(label != np.arange(len(fps)))
    return fps[linked], fps[label[linked]]


def _merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index of each component after adding links a-b."""
    while len(a):
        la, lb = label[a], label[b]
        differ = la != lb
        if not differ.any():
            break
        low, high = np.minimum(la, lb)[differ], np.maximum(la, lb)[differ]
        np.minimum.at(label, high, low)
        while True:
            jumped = label[label]
            if np.array_equal(jumped, label):
                break
            label = jumped
    return label


def meetings(fps: np.ndarray, prefix: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of fingerprints that meet at a variant starting with ``prefix`` and differ in 3 bits or fewer."""
    shift = np.uint64(64 - bits)
    apart = (fps >> shift) ^ np.uint64(prefix) if bits else np.zeros(len(fps), np.uint64)
    far, odd = np.bitwise_count(apart), _odd(fps)
    flipped = fps ^ (apart << shift) if bits else fps.copy()
    here, near = np.flatnonzero(far == 0), np.flatnonzero(far == 1)
    one = [np.uint64(1 << i) for i in range(64 - bits)]
    high = [i for i in range(32, 64 - bits)]
    variants = [fps[here], flipped[near]] + [fps[here] ^ m for m in one]
    owners = [here, near] + [here] * len(one)
    centres, owner = np.concatenate(variants), np.concatenate(owners)
    if not len(centres):
        return here, here
    order = np.argsort(centres, kind="stable")
    centres, owner = centres[order], owner[order]
    first = np.flatnonzero(np.r_[True, centres[1:] != centres[:-1]])
    hub = owner[np.repeat(first, np.diff(np.r_[first, len(centres)]))]
    pairs_a, pairs_b = [hub], [owner]
    values, hubs = centres[first], owner[first]
    even_here, odd_here, odd_near = here[~odd[here]], here[odd[here]], near[odd[near]]
    double = [(even_here, fps, (1 << i) | (1 << j)) for i, j in _LOW]
    double += [(odd_here, fps, (1 << i) | (1 << j)) for i, j in _HIGH if j < 64 - bits]
    double += [(odd_near, flipped, 1 << i) for i in high]
    double += [(np.flatnonzero((far == 2) & odd), flipped, 0)]
    for who, base, mask in double:
        points = base[who] ^ np.uint64(mask)
        at = np.minimum(np.searchsorted(values, points), len(values) - 1)
        hit = values[at] == points
        pairs_a.append(hubs[at[hit]])
        pairs_b.append(who[hit])
    a, b = np.concatenate(pairs_a), np.concatenate(pairs_b)
    good = (a != b) & (np.bitwise_count(fps[a] ^ fps[b]) <= RADIUS)
    return a[good], b[good]


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root): connected components of edges (a, b) by alternating large and small stars; root: the least node.

    All steps are joins and aggregates of edges, each round written once; nothing gathers a component.
    """
    edges = cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(), "edges")
    state = _state(edges)
    for _ in range(rounds):
        if state[0] == 0:
            break
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lower, "u")
        small = (small.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(lower.select("u", F.col("m").alias("v"))).distinct())
        edges = cut(small, "edges")
        was, state = state, _state(edges)
        if was == state:
            break
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, hash, fp, component_id, rep): each row's fingerprint and component, over links of 3 differing bits or fewer.

    ``component_id`` is the component's least non-null id, ``rep`` its least (id, hash), the row to keep.
    Null and empty texts have fingerprint 0 and are linked like any other; repeated rows are in one component;
    an empty table gives an empty table. Other columns are ignored.
    """
    prints = cut(fingerprints(docs, id_col, text_col), "prints")
    by_print = cut(prints.groupBy("fp").agg(F.min("id").alias("least"), F.min(F.struct("id", "hash")).alias("rep")), "distinct")
    roots = components(links(by_print.select("fp")))
    placed = by_print.join(roots, by_print["fp"] == roots["node"], "left").withColumn("root", F.coalesce("root", "fp"))
    whole = placed.groupBy("root").agg(F.min("least").alias("component_id"), F.min("rep").alias("rep"))
    of_print = placed.select("fp", "root").join(whole, "root").select("fp", "component_id", "rep")
    return prints.join(of_print, "fp").select("id", "hash", "fp", "component_id", "rep")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that represent their component: the least id; of equal ids one text, once."""
    found = cut(near_duplicates(docs, id_col, text_col).select("id", "hash", "rep"), "classes")
    own = F.struct("id", "hash").eqNullSafe(F.col("rep"))
    losers = cut(found.where(~own).select("id", "hash").distinct(), "losers")
    repeated = cut(found.where(own).groupBy("id", "hash").agg(F.count("*").alias("n")).where("n > 1").select("id", "hash"), "repeated")
    named = docs.withColumn("__llm_id", F.col(f"`{id_col}`")).withColumn("__llm_hash", F.xxhash64(F.col(f"`{text_col}`")))

    def same(keys: DataFrame):
        return F.col("__llm_id").eqNullSafe(keys["id"]) & (F.col("__llm_hash") == keys["hash"])

    # Only rows that may go, or that may be there twice, are shuffled.
    suspect = maybe_in(bitmap(losers.union(repeated), "id", "hash"), "__llm_id", "__llm_hash")
    checked = named.where(suspect).join(losers, same(losers), "left_anti").dropDuplicates(["__llm_id", "__llm_hash"])
    return named.where(~suspect).unionByName(checked).drop("__llm_id", "__llm_hash")
