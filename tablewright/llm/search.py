"""Ranked lexical search: the best documents of each query by term impacts, with pair-bound MaxScore.

The documents are indexed in shards. A shard holds the postings of its terms with their impacts (what a term adds to a
document's score), each term's largest impact, and for pairs of terms their intersection's largest joint impact. A
query goes through a shard's terms from the lightest up; as long as the lightest ones together cannot lift a document
over the score to beat, only documents with one of the other terms are looked at. What terms can add together is bound
by pairs: two neighbours in that order add at most their joint maximum, or one of their single maxima.

The score to beat starts at what the intersection lists tell: the k-th largest joint impact of a pair over all documents.

Queries are taken in blocks, so that what every task knows is bounded; the postings of a block are those of its terms.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.common import cut

#: Queries of a block, and the bytes of text from which on a block is full.
BLOCK_QUERIES, BLOCK_BYTES = 1_000, 1 << 20
#: Documents and postings from which on a shard is full.
SHARD_DOCS, SHARD_POSTINGS = 8_192, 500_000
LIGHTEN, SATURATE = 25, 12  # share of the length in percent, weight of the length against the occurrences

#: All but ASCII letters and digits and non-ASCII characters is a separator; A-Z is lower-cased. Over bytes of UTF-8.
FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
BLANKS = re.compile(rb"[^0-9A-Za-z\x80-\xFF]")


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(FOLD).split()


def search(docs: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text",
           query_col: str = "item_id", query_text_col: str = "text") -> DataFrame:
    """(query_col, rank, id_col, score): of each query the k documents with the highest scores above 0, ties to the
    smaller id.

    Each row of docs is a document, repeated ones too; a null id is the smallest. Equal rows of queries are one query;
    rows with one id and different texts are ranked apart. Texts that are null or without terms match nothing; no
    documents or no queries give no rows. Other columns are ignored.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    asked = cut(queries.select(F.col(f"`{query_col}`").alias("query"), F.col(f"`{query_text_col}`").alias("text")).distinct()
                .withColumn("number", F.monotonically_increasing_id()), "queries")
    found = [_search_block(rows, block, k) for block in _blocks(asked)]
    if not found:
        found = [docs.sparkSession.createDataFrame([], "number long, id long, score long")]
    best = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_first("id"))
    ranked = reduce(DataFrame.unionAll, found).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.join(asked.select("number", "query"), "number").select(
        F.col("query").alias(query_col), "rank", F.col("id").alias(id_col), "score")


def _blocks(asked: DataFrame) -> Iterator[list[tuple[int, dict[bytes, int]]]]:
    """(number, its terms with their repeats) of the queries, in blocks; the driver holds one block at a time."""
    block, size = [], 0
    for row in asked.select("number", "text").toLocalIterator():
        terms = {}
        for t in terms_of(row.text):
            terms[t] = terms.get(t, 0) + 1
        if terms:
            block.append((row.number, terms))
            size += sum(map(len, terms))
        if len(block) >= BLOCK_QUERIES or size >= BLOCK_BYTES:
            yield block
            block, size = [], 0
    if block:
        yield block


@dataclass
class Query:
    """Its terms from the lightest weight up, how often it has each, and the list of each neighbouring pair."""

    number: int
    terms: np.ndarray
    times: np.ndarray
    pairs: np.ndarray
    least: int = 1  # documents with less are out


@dataclass
class Plan:
    """What every task knows of a block of queries: bounded by the block."""

    weights: np.ndarray
    total_docs: int
    total_terms: int
    k: int
    pairs: list[tuple[int, int]] = field(default_factory=list)
    queries: list[Query] = field(default_factory=list)


def make_plan(block: list[tuple[int, dict[bytes, int]]], vocabulary: dict[bytes, int], held: dict[int, int],
              total_docs: int, total_terms: int, k: int) -> Plan:
    weights = np.array([math.floor(1000 * math.log((2 * total_docs + 2) / (2 * held.get(i, 0) + 1))) for i in range(len(vocabulary))], np.int64)
    plan, lists = Plan(weights, total_docs, total_terms, k), {}
    for number, terms in block:
        ids = np.array([vocabulary[t] for t in terms], np.int64)
        times = np.array(list(terms.values()), np.int64)
        order = np.lexsort((ids, times * weights[ids]))
        ids, times = ids[order], times[order]
        pairs = [lists.setdefault((min(a, b), max(a, b)), len(lists)) for a, b in zip(ids[:-1].tolist(), ids[1:].tolist(), strict=True)]
        plan.queries.append(Query(number, ids, times, np.array(pairs, np.int64)))
    plan.pairs = list(lists)
    return plan


def _search_block(rows: DataFrame, block: list, k: int) -> DataFrame:
    """(number, id, score): of each query at least its k best documents."""
    spark = rows.sparkSession
    vocabulary = {t: i for i, t in enumerate(sorted(set().union(*(terms for _, terms in block))))}
    shared = spark.sparkContext.broadcast(vocabulary)
    counted = cut(rows.mapInArrow(_count_terms(shared), "id long, n long, terms array<int>, times array<long>"), "terms")
    total = counted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    held = {r.term: r["count"] for r in counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect()}
    plan = make_plan(block, vocabulary, held, total[0], total[1], k)
    built = spark.sparkContext.broadcast(plan)
    # Documents of any task fill its shards; a row is a shard, the last one of a task its lists' largest impacts.
    index = cut(counted.where(F.size("terms") > 0).mapInArrow(_index(built), INDEX), "index")
    tops = index.where("ids is null").select(F.explode(F.arrays_zip("term_of", "most")).alias("x")).select("x.term_of", "x.most")
    kth = tops.withColumn("at", F.row_number().over(Window.partitionBy("term_of").orderBy(F.desc("most")))).where(F.col("at") == k)
    set_least(plan, {r.term_of: r.most for r in kth.collect()})
    ready = spark.sparkContext.broadcast(plan)
    return cut(index.where("ids is not null").mapInArrow(_ask(ready), "number long, id long, score long"), "hits")


def _count_terms(shared):
    """Each document with terms: how many it has, and of those that are asked for how often it has each."""
    def count(found: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for whole in found:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                lengths, terms, times, texts = [], [], [], batch.column(1).to_pylist()
                for text in texts:
                    words, mine = 0, {}
                    for part in _parts(text):
                        split = part.translate(FOLD).split()
                        words += len(split)
                        for i in map(known.get, split):
                            if i is not None:
                                mine[i] = mine.get(i, 0) + 1
                    lengths.append(words)
                    terms.append(list(mine))
                    times.append(list(mine.values()))
                made = pa.RecordBatch.from_arrays([batch.column(0), pa.array(lengths, pa.int64()), pa.array(terms, pa.list_(pa.int32())),
                                                   pa.array(times, pa.list_(pa.int64()))], names=["id", "n", "terms", "times"])
                yield made.filter(pa.array([n > 0 for n in lengths]))

    return count


def _parts(text: str | None, size: int = 1 << 22) -> Iterator[bytes]:
    """The text's bytes, long ones in parts that end at a separator."""
    raw, at = (text or "").encode("utf-8", "replace"), 0
    while len(raw) - at > size:
        gap = BLANKS.search(raw, at + size)
        if not gap:
            break
        yield raw[at:gap.start()]
        at = gap.end()
    yield raw[at:]


#: Of a shard: its documents' ids; of each term its list's start, of each posting the document's place and the impact;
#: the largest impact of each term; of each pair with an intersection the largest joint impact.
#: The last row of a task: ids null, ``term_of`` a list's number (pairs after all terms), ``most`` one of its k largest impacts.
INDEX = ("ids array<long>, term_of array<int>, starts array<int>, places array<int>, impacts array<long>, most array<long>, "
         "pair_of array<int>, joint array<long>")


def _index(built):
    def index(found: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = built.value
        tops = _Tops(plan.k)
        for ids, lengths, terms, times, place in _shards(found):
            shard = build_shard(plan, ids, lengths, terms, times, place)
            tops.add(shard)
            yield _index_row(ids, shard.term_of, shard.starts, shard.places, shard.impacts, shard.most, shard.pair_of, shard.joint)
        yield _index_row(None, *tops.lists(), pair_of=None, joint=None)

    return index


def _shards(found: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """(ids, lengths, term and times of each posting, the place of its document) of documents in bounded groups."""
    held, docs, postings = [], 0, 0
    for whole in found:
        sizes = np.diff(whole.column(2).offsets.to_numpy())
        at = 0
        while at < whole.num_rows:
            most = np.searchsorted(np.cumsum(sizes[at:]), SHARD_POSTINGS - postings, "left") + 1
            n = int(min(most, SHARD_DOCS - docs, whole.num_rows - at))
            held.append(whole.slice(at, n))
            at, docs, postings = at + n, docs + n, postings + int(sizes[at:at + n].sum())
            if docs >= SHARD_DOCS or postings >= SHARD_POSTINGS:
                yield _arrays(held)
                held, docs, postings = [], 0, 0
    if held:
        yield _arrays(held)


def _arrays(held: list[pa.RecordBatch]) -> tuple:
    sizes = np.concatenate([np.diff(b.column(2).offsets.to_numpy()) for b in held])
    return (pa.chunked_array([b.column(0) for b in held]), np.concatenate([b.column(1).to_numpy() for b in held]),
            np.concatenate([b.column(2).flatten().to_numpy() for b in held]), np.concatenate([b.column(3).flatten().to_numpy() for b in held]),
            np.repeat(np.arange(len(sizes), dtype=np.int32), sizes))


def _index_row(ids, term_of, starts=None, places=None, impacts=None, most=None, pair_of=None, joint=None) -> pa.RecordBatch:
    def one(values, kind):
        return pa.array([None], pa.list_(kind)) if values is None else pa.ListArray.from_arrays(
            pa.array([0, len(values)], pa.int32()), pa.array(values, kind))

    return pa.RecordBatch.from_arrays(
        [one(None if ids is None else ids.combine_chunks(), pa.int64()), one(term_of, pa.int32()), one(starts, pa.int32()), one(places, pa.int32()),
         one(impacts, pa.int64()), one(most, pa.int64()), one(pair_of, pa.int32()), one(joint, pa.int64())],
        names=["ids", "term_of", "starts", "places", "impacts", "most", "pair_of", "joint"])


@dataclass
class Shard:
    n_docs: int
    term_of: np.ndarray
    starts: np.ndarray
    places: np.ndarray
    impacts: np.ndarray
    most: np.ndarray
    pair_of: np.ndarray
    joint: np.ndarray
    tops: list = field(default_factory=list)

    def __post_init__(self):
        self.list_at = {t: n for n, t in enumerate(self.term_of.tolist())}
        self.joint_at = dict(zip(self.pair_of.tolist(), self.joint.tolist(), strict=True))

    def postings(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        n = self.list_at[term]
        stop = self.starts[n + 1] if n + 1 < len(self.starts) else len(self.places)
        return self.places[self.starts[n]:stop], self.impacts[self.starts[n]:stop]


def build_shard(plan: Plan, ids, lengths: np.ndarray, terms: np.ndarray, times: np.ndarray, place: np.ndarray) -> Shard:
    light = 100 - LIGHTEN + (LIGHTEN * lengths.astype(np.int64) * plan.total_docs) // max(plan.total_terms, 1)
    impact = plan.weights[terms] * ((1_000_000_000 * times) // (1000 * times + SATURATE * light[place]))
    order = np.argsort(terms, kind="stable")
    terms, place, impact = terms[order], place[order], impact[order]
    term_of, starts = np.unique(terms, return_index=True)
    shard = Shard(len(ids), term_of.astype(np.int32), starts.astype(np.int32), place, impact, np.maximum.reduceat(impact, starts),
                  np.zeros(0, np.int32), np.zeros(0, np.int64))
    shard.tops = [(t, shard.postings(t)[1]) for t in term_of.tolist()]
    pair_of, joint, of_term, last = [], [], np.full(len(ids), -1, np.int64), None
    for n, (a, b) in sorted(enumerate(plan.pairs), key=lambda x: x[1]):
        if a not in shard.list_at or b not in shard.list_at:
            continue
        if a != last:
            if last is not None:
                of_term[shard.postings(last)[0]] = -1
            places, impacts = shard.postings(a)
            of_term[places], last = impacts, a
        places, impacts = shard.postings(b)
        both = of_term[places]
        sums = (both + impacts)[both >= 0]
        if len(sums):
            pair_of.append(n)
            joint.append(int(sums.max()))
            shard.tops.append((len(plan.weights) + n, sums))
    shard.pair_of, shard.joint = np.array(pair_of, np.int32), np.array(joint, np.int64)
    shard.__post_init__()
    return shard


class _Tops:
    """The k largest impacts of each list that a task has seen."""

    def __init__(self, k: int):
        self.k, self.best = k, {}

    def add(self, shard: Shard) -> None:
        for n, impacts in shard.tops:
            seen = np.concatenate([self.best[n], impacts]) if n in self.best else impacts
            self.best[n] = seen if len(seen) <= self.k else np.partition(seen, -self.k)[-self.k:]

    def lists(self) -> tuple:
        row = np.repeat(np.array(list(self.best), np.int32), [len(x) for x in self.best.values()])
        return row, None, None, None, np.concatenate([np.zeros(0, np.int64), *self.best.values()])


def set_least(plan: Plan, kth: dict[int, int]) -> None:
    """A query's k-th best score is at least the k-th largest impact of each of its terms, taken as often as it has it,
    and of each of its pairs."""
    for q in plan.queries:
        of_terms = [n * kth.get(t, 0) for t, n in zip(q.terms.tolist(), q.times.tolist(), strict=True)]
        of_pairs = [n * kth.get(len(plan.weights) + p, 0) for p, n in zip(q.pairs.tolist(), np.minimum(q.times[:-1], q.times[1:]).tolist(), strict=True)]
        q.least = max(1, *of_terms, *of_pairs)


def bounds(query: Query, shard: Shard, by_pairs: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(terms of the query in the shard, what the first n of them can add to a document at most, for n from 0)."""
    here = np.array([n for n, t in enumerate(query.terms.tolist()) if t in shard.list_at], np.int64)
    impacts = [int(shard.most[shard.list_at[t]]) for t in query.terms[here].tolist()]
    singles = [n * x for n, x in zip(query.times[here].tolist(), impacts, strict=True)]
    most = [0]
    for at, n in enumerate(here.tolist()):
        bound = most[at] + singles[at]
        if by_pairs and at and here[at - 1] == n - 1:
            both, joint = max(singles[at - 1:at + 1]), shard.joint_at.get(int(query.pairs[n - 1]))
            if joint is not None:
                few = int(min(query.times[n - 1:n + 1]))
                both = max(both, few * joint + sum(s - few * x for s, x in zip(singles[at - 1:at + 1], impacts[at - 1:at + 1], strict=True)))
            bound = min(bound, most[at - 1] + both)
        most.append(bound)
    return here, np.array(most, np.int64)


def ask(query: Query, shard: Shard, least: int, k: int, by_pairs: bool = True) -> tuple[np.ndarray, np.ndarray, int]:
    """(places, scores, postings read): the documents of the shard that may be among the k best, scored whole."""
    here, most = bounds(query, shard, by_pairs)
    light = int(np.searchsorted(most, least, "left")) - 1  # terms that together stay below the score to beat
    if light >= len(here):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), 0
    light, read = max(light, 0), 0
    score = np.zeros(shard.n_docs, np.int64)
    for n in here[light:].tolist():
        places, impacts = shard.postings(int(query.terms[n]))
        score[places] += query.times[n] * impacts
        read += len(places)
    chosen = np.flatnonzero(score)
    for at in range(light, 0, -1):
        chosen = chosen[score[chosen] + most[at] >= least]
        if not len(chosen):
            break
        n = int(here[at - 1])
        places, impacts = shard.postings(int(query.terms[n]))
        if len(chosen) * 16 < len(places):  # look the few up
            found = np.minimum(np.searchsorted(places, chosen), len(places) - 1)
            hit = places[found] == chosen
            score[chosen[hit]] += query.times[n] * impacts[found[hit]]
            read += len(chosen)
        else:
            score[places] += query.times[n] * impacts
            read += len(places)
    chosen = chosen[score[chosen] >= least]
    return chosen, score[chosen], read


def _ask(ready):
    """Of each task the k best documents of each query; the score to beat grows with the shards of the task."""
    def answer(found: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = ready.value
        least = [q.least for q in plan.queries]
        best = [(np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)) for _ in plan.queries]
        for batch in found:
            for r in range(batch.num_rows):
                ids, *rest = (batch.column(c)[r].values for c in range(8))
                empty, numbers = ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()
                shard = Shard(len(ids), *(a.to_numpy() for a in rest))
                for i, q in enumerate(plan.queries):
                    places, scores, _ = ask(q, shard, least[i], plan.k)
                    if len(places):
                        best[i] = _best(plan.k, best[i], (numbers[places], ~empty[places], scores))
                        if len(best[i][2]) == plan.k:
                            least[i] = max(least[i], int(best[i][2][-1]))
        for q, (numbers, filled, scores) in zip(plan.queries, best, strict=True):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(scores), q.number)), pa.array(numbers, mask=~filled), pa.array(scores)],
                                             names=["number", "id", "score"])

    return answer


def _best(k: int, *parts: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[np.ndarray, ...]:
    """The k first by score, null ids and then smaller ids first."""
    numbers, filled, scores = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((numbers, filled, -scores))[:k]
    return numbers[order], filled[order], scores[order]
