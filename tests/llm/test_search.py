import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tablewright.llm import search as se

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, queries, k=20):
    """{number of the query: [(id, score)]}, best first, by scoring every document."""
    rows = [(i, Counter(t)) for i, text in docs if (t := terms(text))]
    n_docs, total = len(rows), sum(sum(c.values()) for _, c in rows)
    df = Counter(t for _, c in rows for t in c)
    out = {}
    for number, text in queries:
        scores = []
        for i, c in rows:
            m = 75 + 25 * sum(c.values()) * n_docs // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t in terms(text))
            if score > 0:
                scores.append((i, score))
        out[number] = sorted(scores, key=lambda x: (-x[1], x[0] is not None, x[0] or 0))[:k]
    return out


def sample(rng, n):
    words = ["The", "of", "and", "Élan", "naïve", "x1y2", "日本語", "d'or", "e-mail", "a\x00b"] + [f"w{i}" for i in range(200)]
    weights = [50, 40, 30] + [3] * 7 + [200 / (i + 5) for i in range(200)]
    return [" ".join(rng.choices(words, weights, k=rng.randint(1, 80))) for _ in range(n)]


@pytest.mark.parametrize("shard, block", [(8192, 1000), (16, 1000), (50, 3)])
def test_equals_scoring_everything(spark, monkeypatch, shard, block):
    monkeypatch.setattr(se, "SHARD_DOCS", shard)
    monkeypatch.setattr(se, "BLOCK_QUERIES", block)
    monkeypatch.setattr(se, "SHARD_POSTINGS", 400)
    rng = random.Random(11)
    texts = sample(rng, 300)
    docs = list(enumerate(texts)) + [(i, texts[5]) for i in range(400, 440)] + [(500, None), (501, ""), (502, " - ;"), (None, texts[7]), (3, texts[3])]
    queries = [(i, t) for i, t in enumerate(sample(rng, 8))] + [(20, texts[5]), (21, None), (22, "...."), (23, "unheard of"), (24, "unheard")]
    frame = spark.createDataFrame([(i, t, 1, 2) for i, t in docs], "doc_id long, text string, rank int, number int").repartition(3)
    asked = spark.createDataFrame(queries + [(20, texts[5])], "item_id long, text string")
    found = {}
    for r in se.search(frame, asked).collect():
        found.setdefault(r.item_id, {})[r.rank] = (r.doc_id, r.score)
    want = {q: best for q, best in brute(docs, queries).items() if best}
    assert {q: [best[n + 1] for n in range(len(best))] for q, best in found.items()} == want


def index_of(texts, queries, k=5):
    """A plan and one shard over texts, as a task builds them."""
    block = [(n, dict(Counter(se.terms_of(q)))) for n, q in enumerate(queries)]
    vocabulary = {t: i for i, t in enumerate(sorted({t for _, c in block for t in c}))}
    counts = [Counter(vocabulary[t] for t in se.terms_of(x) if t in vocabulary) for x in texts]
    lengths = np.array([len(se.terms_of(x)) for x in texts])
    plan = se.make_plan(block, vocabulary, Counter(t for c in counts for t in c), len(texts), int(lengths.sum()), k)
    place = np.repeat(np.arange(len(texts)), [len(c) for c in counts]).astype(np.int32)
    term, times = (np.array([x for c in counts for x in pick(c)]) for pick in (dict.keys, dict.values))
    return plan, se.build_shard(plan, list(range(len(texts))), lengths, term, times, place)


def test_bounds_hold_and_pairs_tighten_them():
    rng = random.Random(12)
    texts, queries = sample(rng, 400), sample(rng, 10)
    plan, shard = index_of(texts, queries)
    tighter = 0
    for q in plan.queries:
        here, paired = se.bounds(q, shard)
        _, single = se.bounds(q, shard, by_pairs=False)
        for n in range(len(here) + 1):
            score = np.zeros(len(texts), np.int64)
            for t in here[:n]:
                places, impacts = shard.postings(int(q.terms[t]))
                score[places] += q.times[t] * impacts
            assert score.max() <= paired[n] <= single[n]
        tighter += int((paired < single).sum())
    assert tighter > 50


def test_pair_bounds_skip_more_and_lose_nothing():
    rng = random.Random(13)
    texts = sample(rng, 2000)
    queries = [" ".join(rng.sample(t.split(), min(12, len(t.split())))) for t in texts[:20]]
    plan, shard = index_of(texts, queries)
    read = {True: 0, False: 0}
    for q, (number, best) in zip(plan.queries, brute(list(enumerate(texts)), list(enumerate(queries)), 5).items(), strict=True):
        least = best[-1][1]
        for by_pairs in read:
            places, scores, n = se.ask(q, shard, least, 5, by_pairs)
            assert sorted(zip(places.tolist(), scores.tolist(), strict=True), key=lambda x: (-x[1], x[0]))[:5] == best
            read[by_pairs] += n
    every = sum(len(shard.postings(int(t))[0]) for q in plan.queries for t in q.terms if int(t) in shard.list_at)
    assert read[True] < read[False] < every


def test_empty_tables(spark):
    docs, queries = "doc_id long, text string", "item_id long, text string"
    some, asked = spark.createDataFrame([(1, "a b")], docs), spark.createDataFrame([(1, "a")], queries)
    none = spark.createDataFrame([], docs)
    assert se.search(none, asked).count() == 0 and se.search(some, spark.createDataFrame([], queries)).count() == 0
    assert [tuple(r) for r in se.search(some, asked).collect()] == [(1, 1, 1, brute([(1, "a b")], [(1, "a")])[1][0][1])]


def test_long_texts_are_read_in_parts():
    raw = ("word, " * 1000 + "x" * 50 + " é.").encode()
    parts = list(se._parts(raw.decode(), 100))
    assert len(parts) > 50 and [t for p in parts for t in p.translate(se.FOLD).split()] == se.terms_of(raw.decode())
