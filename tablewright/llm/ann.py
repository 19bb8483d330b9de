"""Approximate nearest neighbours by balanced posting lists.

A bounded sample is bisected into equal halves until its cells are small; their means are the centroids. Every
vector goes to the list of its nearest centroid and, near a boundary, to further ones. A graph that links each
centroid to its neighbours, held by every task, finds the centroids near a point; a query reads the lists whose
distance is within a ratio of the nearest one's, a ratio fitted on the sample. Lists are dealt in blocks of
bounded size, each block meets the queries that read its list, and tasks merge the nearest they saw.

Nearness is the inner product, turned into distance: a vector gets one component more, so that all have the
length of the longest.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.common import cut

#: Vectors fitted on at most; vectors of a list on average, for the number of centroids (at most SAMPLE / 8).
SAMPLE, LIST_SIZE = 16_384, 512
#: Lists for one vector at most, and how much farther than the nearest centroid they may be.
REPLICAS, BOUNDARY = 3, 1.2
#: Share of the sample's own neighbours that the pruning ratio must reach.
SAMPLE_RECALL = 0.97
#: Vectors of a block; neighbours of a centroid in the graph; centroids expanded in one step.
BLOCK, DEGREE, STEP = 8_192, 24, 4
#: Points that walk the graph at once.
WALKERS = 256
#: Queries whose nearest a task holds before it hands them on.
HELD_QUERIES = 50_000


@dataclass(frozen=True)
class Index:
    centroids: np.ndarray  # (lists, dimensions + 1)
    graph: np.ndarray      # (lists, degree)
    longest: float         # norm of the longest vector
    ratio: float           # lists farther than this times the nearest are not read
    width: int             # lists read at most by distance

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        """Vectors with the component that gives all the longest one's norm."""
        rest = np.sqrt(np.maximum(self.longest ** 2 - (vectors ** 2).sum(axis=1), 0))
        return np.column_stack([vectors, rest])

    def asking(self, vectors: np.ndarray) -> np.ndarray:
        """Queries on the same sphere; their length doesn't change who is nearest."""
        return np.column_stack([vectors * (self.longest / np.linalg.norm(vectors, axis=1))[:, None], np.zeros(len(vectors))])

    def search(self, points: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(distances, lists): the nearest centroids that a best-first walk on the graph finds, nearest first."""
        if len(points) > WALKERS:
            parts = [self.search(points[i:i + WALKERS], width) for i in range(0, len(points), WALKERS)]
            return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        n, k = len(points), len(self.centroids)
        width = min(width, k)
        known = np.full((n, k), np.inf)
        walked = np.zeros((n, k), bool)
        rows = np.arange(n)[:, None]
        starts = np.unique(np.linspace(0, k - 1, min(k, 8)).astype(int))
        squares = (self.centroids ** 2).sum(axis=1)
        own = (points ** 2).sum(axis=1)
        known[:, starts] = self._distances(points, np.broadcast_to(starts, (n, len(starts))), squares, own)
        live = np.arange(n)
        while len(live):
            edge = np.partition(known[live], width - 1, axis=1)[:, width - 1:width]
            ahead = np.where(walked[live] | (known[live] > edge), np.inf, known[live])
            step = min(STEP, k)
            chosen = np.argpartition(ahead, step - 1, axis=1)[:, :step]
            useful = np.isfinite(np.take_along_axis(ahead, chosen, 1))
            going = useful.any(axis=1)
            live, chosen, useful = live[going], chosen[going], useful[going]
            if not len(live):
                break
            walked[live[:, None], chosen] |= useful
            near = self.graph[chosen].reshape(len(live), -1)
            found = self._distances(points[live], near, squares, own[live])
            found = np.where(np.repeat(useful, self.graph.shape[1], axis=1), found, np.inf)
            known[live[:, None], near] = np.minimum(known[live[:, None], near], found)
        best = np.argsort(known, axis=1, kind="stable")[:, :width]
        return known[rows, best], best

    def _distances(self, points: np.ndarray, lists: np.ndarray, squares: np.ndarray, own: np.ndarray) -> np.ndarray:
        dots = np.einsum("nd,nkd->nk", points, self.centroids[lists])
        return np.sqrt(np.maximum(own[:, None] + squares[lists] - 2 * dots, 0))

    def homes(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) pairs: the nearest list of each vector, and those nearly as near."""
        distance, lists = self.search(self.lifted(vectors), max(REPLICAS, 8))
        near = distance[:, :REPLICAS] <= BOUNDARY * distance[:, :1]
        near[:, 0] = True
        near &= np.isfinite(distance[:, :REPLICAS])
        row, at = np.nonzero(near)
        return row, lists[row, at]

    def probes(self, vectors: np.ndarray, sizes: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) pairs that queries read: lists within the ratio, and more while these hold fewer than
        ``least`` vectors."""
        distance, lists = self.search(self.asking(vectors), self.width)
        read = distance <= self.ratio * distance[:, :1]
        read[:, 0] = True
        held = np.cumsum(sizes[lists], axis=1)
        read |= (held - sizes[lists]) < least
        short = held[:, -1] < least  # the walk's lists don't suffice: read all
        row, at = np.nonzero(read & np.isfinite(distance) & ~short[:, None])
        every = np.flatnonzero(short)
        return (np.concatenate([row, np.repeat(every, len(sizes))]),
                np.concatenate([lists[row, at], np.tile(np.arange(len(sizes)), len(every))]))


def fit(sample: np.ndarray, longest: float, lists: int, k: int = 20) -> Index:
    """Index over a sample of vectors, equal ones counting once, for about ``lists`` lists."""
    sample = np.random.default_rng(0).permutation(np.unique(sample, axis=0))
    lists = min(lists, max(1, len(sample) // 8))
    bare = Index(np.zeros((1, sample.shape[1] + 1)), np.zeros((1, 1), int), longest, 1.0, 1)
    lifted = bare.lifted(sample)
    cells = [np.arange(len(sample))]
    while len(cells) < lists:
        cells.sort(key=len)
        cell = cells.pop()
        if len(cell) < 2:
            cells.append(cell)
            break
        spread = lifted[cell] - lifted[cell].mean(axis=0)
        axis = np.linalg.svd(spread[:2048], full_matrices=False)[2][0]
        order = cell[np.argsort(spread @ axis, kind="stable")]
        cells += [order[:len(order) // 2], order[len(order) // 2:]]
    centroids = np.array([lifted[c].mean(axis=0) for c in cells])
    for _ in range(4):  # towards the nearest centroid; sizes stay alike as all start alike
        nearest = (lifted @ centroids.T - 0.5 * (centroids ** 2).sum(axis=1)).argmax(axis=1)
        for i in range(len(centroids)):
            if (nearest == i).any():
                centroids[i] = lifted[nearest == i].mean(axis=0)
    apart = ((centroids[:, None] - centroids[None]) ** 2).sum(axis=2) if len(centroids) <= 512 else _apart(centroids)
    graph = np.argsort(apart, axis=1, kind="stable")[:, 1:DEGREE + 1] if len(centroids) > 1 else np.zeros((1, 1), int)
    # A ring keeps the graph in one piece.
    graph = np.column_stack([graph, (np.arange(len(centroids)) + 1) % len(centroids)])
    index = Index(centroids, graph, longest, np.inf, len(centroids))
    row, home = index.homes(sample)
    asked = sample[:256]
    scores = asked @ sample.T
    scores[np.arange(len(asked)), np.arange(len(asked))] = -np.inf
    want = np.argsort(-scores, axis=1)[:, :max(1, min(k, len(sample) - 1))]
    distance, order = index.search(index.asking(asked), len(centroids))
    by_list = np.empty_like(distance)
    np.put_along_axis(by_list, order, distance / np.maximum(distance[:, :1], 1e-300), axis=1)
    starts = np.searchsorted(row, np.arange(len(sample) + 1))
    needed = np.array([[by_list[q, home[starts[v]:starts[v + 1]]].min() for v in want[q]] for q in range(len(asked))])
    ratio = float(np.quantile(needed, SAMPLE_RECALL, method="higher")) * (1 + 1e-9)
    width = int((by_list <= ratio).sum(axis=1).max())
    return Index(centroids, graph, longest, ratio, min(len(centroids), width + width // 2 + 1))


def _apart(centroids: np.ndarray) -> np.ndarray:
    squares = (centroids ** 2).sum(axis=1)
    return squares[:, None] + squares - 2 * centroids @ centroids.T


def _usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    fine = F.forall("vector", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return (vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), vector.alias("vector"))
            .where(F.col("id").isNotNull() & F.col("vector").isNotNull() & fine & F.exists("vector", lambda x: x != 0)))


def nearest(vectors: DataFrame, every: int, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
            list_size: int = LIST_SIZE) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose id is divisible by ``every`` the k rows of largest
    inner product that the index finds, all other rows being candidates; ties go to the smaller id.

    Null vectors, zero vectors, those with null, NaN or infinite components, those not of the most frequent
    length, and rows without id take no part. Rows with one id count as one vector, by its best score. Every
    usable row is indexed; the sample only shapes the lists. Empty and one-row tables give an empty table.
    """
    # A row that is there again is the same vector: it must not fill lists, or cuts of the best.
    usable = cut(_usable(vectors, id_col, vector_col).dropDuplicates(["id", "vector"]), "usable")
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
    shape = (usable.groupBy(F.size("vector").alias("d")).agg(F.count("*").alias("n"), F.max(norm).alias("longest"))
             .orderBy(F.desc("n"), "d").first())
    spark = vectors.sparkSession
    if shape is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    usable = usable.where(F.size("vector") == shape.d)
    share = min(1.0, SAMPLE / shape.n)
    picked = usable.where(F.pmod(F.xxhash64("id", F.lit("sample")), F.lit(1 << 30)) < int(share * (1 << 30)))
    sampled = picked.select("vector").limit(2 * SAMPLE).toArrow().column(0).combine_chunks()
    sample = _matrix(sampled) if len(sampled) else np.array([usable.first().vector])
    lists = int(min(max(1, shape.n // list_size), max(1, len(sample) // 8)))
    index = spark.sparkContext.broadcast(fit(sample, shape.longest, lists, k))
    homes = cut(usable.mapInArrow(_home(index), "list int, id long, vector array<double>"), "homes")
    # One id counts once in a list, however many vectors it has there, and REPLICAS times at most in all of them, so
    # that lists of REPLICAS * k + 1 hold more than k ids.
    placed = homes.groupBy("list", "id").agg(F.count("*").alias("rows"))
    spread = placed.groupBy("id").agg(F.count("*").alias("lists")).where(F.col("lists") > REPLICAS)
    share = F.coalesce(REPLICAS / F.col("lists"), F.lit(1.0))
    # One row for each list: at most SAMPLE / 4.
    counts = {r.list: r for r in placed.join(spread, "id", "left").groupBy("list").agg(
        F.sum("rows").alias("rows"), F.sum(share).alias("ids")).collect()}
    rows, sizes = (np.array([counts[i][c] if i in counts else 0 for i in range(len(index.value.centroids))]) for c in ("rows", "ids"))
    blocks = np.maximum(1, -(-rows // BLOCK))
    dealt = homes.mapInArrow(_deal(blocks), "list int, block int, kind int, id long, vector array<double>")
    asked = (usable.where(F.pmod("id", F.lit(every)) == 0)
             .mapInArrow(_ask(index, sizes, blocks, REPLICAS * k + 1), "list int, block int, kind int, id long, vector array<double>"))
    met = (dealt.unionByName(asked).repartition("list", "block").sortWithinPartitions("list", "block", "kind")
           .mapInArrow(_meet(k), "query_id long, vec_id long, score double"))
    best = met.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _home(index):
    def place(found: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _sliced(found, 1024):
            row, lists = index.value.homes(_matrix(batch.column(1)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(lists.astype(np.int32)), batch.column(0).take(pa.array(row)), batch.column(1).take(pa.array(row))],
                names=["list", "id", "vector"])

    return place


def _sliced(found: Iterable[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in found:
        for at in range(0, batch.num_rows, size):
            yield batch.slice(at, size)


def _block_of(ids: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """An id's block of a list, by a multiplicative hash."""
    return ((ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % blocks.astype(np.uint64)).astype(np.int32)


def _deal(blocks: np.ndarray):
    def deal(found: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            lists, ids = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(_block_of(ids, blocks[lists])), pa.array(np.zeros(len(ids), np.int32)),
                 batch.column(1), batch.column(2)], names=["list", "block", "kind", "id", "vector"])

    return deal


def _ask(index, sizes: np.ndarray, blocks: np.ndarray, least: int):
    def ask(found: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _sliced(found, 256):
            row, lists = index.value.probes(_matrix(batch.column(1)), sizes, least)
            times = blocks[lists]
            row, lists = np.repeat(row, times), np.repeat(lists, times)
            block = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
            yield pa.RecordBatch.from_arrays(
                [pa.array(lists.astype(np.int32)), pa.array(block.astype(np.int32)), pa.array(np.ones(len(row), np.int32)),
                 batch.column(0).take(pa.array(row)), batch.column(1).take(pa.array(row))],
                names=["list", "block", "kind", "id", "vector"])

    return ask


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest scores, ties to smaller ids, each id once."""
    order = np.lexsort((ids, -scores))
    ids, scores = ids[order], scores[order]
    first = np.sort(np.unique(ids, return_index=True)[1])[:k]
    return ids[first], scores[first]


def _meet(k: int):
    def meet(found: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ids, vectors, held, groups = None, [], [], {}, None

        def flush() -> Iterator[pa.RecordBatch]:
            queries = np.repeat(np.fromiter(held, np.int64, len(held)), [len(h[0]) for h in held.values()])
            if len(queries):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(queries), pa.array(np.concatenate([h[0] for h in held.values()])),
                     pa.array(np.concatenate([h[1] for h in held.values()]))], names=["query_id", "vec_id", "score"])
            held.clear()

        for batch in _sliced(found, 1024):
            lists, blocks, kinds = (batch.column(i).to_numpy() for i in range(3))
            own, rows = batch.column(3).to_numpy(), _matrix(batch.column(4))
            edges = np.flatnonzero((np.diff(lists) != 0) | (np.diff(blocks) != 0) | (np.diff(kinds) != 0)) + 1
            for part in np.split(np.arange(len(own)), edges):
                if not len(part):
                    continue
                place = (lists[part[0]], blocks[part[0]])
                if place != at:
                    at, ids, vectors, groups = place, [], [], None
                if kinds[part[0]] == 0:
                    ids.append(own[part])
                    vectors.append(rows[part].copy())
                    continue
                if not ids:
                    continue
                if groups is None:  # all of the block is there: the rows of an id side by side
                    order = np.argsort(np.concatenate(ids), kind="stable")
                    ids, vectors = [np.concatenate(ids)[order]], [np.concatenate(vectors)[order]]
                    groups = np.flatnonzero(np.r_[True, ids[0][1:] != ids[0][:-1]])
                rough = rows[part] @ vectors[0].T
                # The cut is made over ids: the query's own one and k others.
                by_id = rough if len(groups) == len(ids[0]) else np.maximum.reduceat(rough, groups, axis=1)
                cut_at = max(0, by_id.shape[1] - k - 1)
                least = np.partition(by_id, cut_at, axis=1)[:, cut_at]
                slack = 1e-9 * np.abs(rough).max(axis=1)
                for q, scores, least_, slack_, vector in zip(own[part].tolist(), rough, least, slack, rows[part], strict=True):
                    near = np.flatnonzero((scores >= least_ - slack_) & (ids[0] != q))
                    exact = (vectors[0][near] * vector).sum(axis=1)  # the same sum for equal vectors, wherever they lie
                    if q in held:
                        near_ids, exact = np.concatenate([held[q][0], ids[0][near]]), np.concatenate([held[q][1], exact])
                    else:
                        near_ids = ids[0][near]
                    held[q] = _best(near_ids, exact, k)
                if len(held) > HELD_QUERIES:
                    yield from flush()
        yield from flush()

    return meet
