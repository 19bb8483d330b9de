import numpy as np
import pytest

from tablewright.llm import ann


def brute(rows, every, k):
    good = [(i, np.array(v, float)) for i, v in rows
            if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v) and len(v) == 8]
    out = {}
    for q, a in good:
        if q % every == 0:
            best = {}
            for i, b in good:
                if i != q:
                    best[i] = max(best.get(i, -np.inf), float((b * a).sum()))
            out[q] = sorted(((-s, i) for i, s in best.items()))[:k]
    return out


def clustered(rng, n, spread=0.3):
    centres = rng.normal(size=(12, 8))
    return centres[rng.integers(0, 12, n)] + spread * rng.normal(size=(n, 8))


@pytest.mark.parametrize("block", [8192, 64])
def test_recall_and_exact_scores(spark, monkeypatch, block):
    monkeypatch.setattr(ann, "BLOCK", block)
    rng = np.random.default_rng(4)
    vectors = clustered(rng, 3000) * rng.uniform(0.5, 2, (3000, 1))  # lengths differ: nearest is not the same as closest
    vectors[100:700] = vectors[100]  # a third of a list is one vector
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    got = ann.nearest(frame, 20, list_size=100).collect()
    want, found = brute(rows, 20, 20), {}
    for r in got:
        found.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    assert found.keys() == want.keys()
    hits = total = 0
    for q, best in want.items():
        mine = [found[q][i + 1] for i in range(len(found[q]))]
        assert len(mine) == 20 and mine == sorted(mine, key=lambda x: (-x[1], x[0])) and q not in {i for i, _ in mine}
        for i, s in mine:
            assert s == pytest.approx(float((vectors[i] * vectors[q]).sum()), abs=1e-12)
        hits += len({i for i, _ in mine} & {i for _, i in best})
        total += len(best)
    assert hits / total >= 0.9


def test_ties_and_unusable_rows(spark):
    one = [1.0] + [0.0] * 7
    rows = [(i, one) for i in range(60)] + [(100, None), (120, [0.0] * 8), (140, [None] + [1.0] * 7), (160, [float("nan")] * 8),
                                            (180, [float("inf")] * 8), (200, [1.0] * 5), (None, one), (3, [2.0] * 8)]
    frame = spark.createDataFrame([(i, v, 7) for i, v in rows], "vec_id long, embedding array<float>, rank int")
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in ann.nearest(frame, 20).collect()}
    want = brute(rows, 20, 20)
    assert got == {(q, n + 1): (i, -s) for q, best in want.items() for n, (s, i) in enumerate(best)}
    assert {q for q, _ in got} == {0, 20, 40}


@pytest.mark.parametrize("noise", [0, 1e-3])
def test_an_id_with_many_rows(spark, noise):
    rng = np.random.default_rng(6)
    rows = [(i, v.tolist()) for i, v in enumerate(clustered(rng, 400))]
    rows += [(i, (2 * np.array(rows[i][1]) + noise * rng.normal(size=8)).tolist()) for i in (0, 7, 20) for _ in range(150)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    found = {}
    for r in ann.nearest(frame, 20, list_size=2000).collect():  # one list, so that all is met
        found.setdefault(r.query_id, {})[r.rank] = r.vec_id
    want = {q: [i for _, i in best] for q, best in brute(rows, 20, 20).items()}
    assert found.keys() == want.keys() and all(len(x) == 20 for x in found.values())
    for q in want:
        if q not in (0, 20):  # of several rows of a query the best score of any counts
            assert [found[q][n + 1] for n in range(20)] == want[q]


def test_few_rows(spark):
    schema = "vec_id long, embedding array<float>"
    assert ann.nearest(spark.createDataFrame([], schema), 20).count() == 0
    assert ann.nearest(spark.createDataFrame([(0, [1.0, 2.0])], schema), 20).count() == 0
    got = ann.nearest(spark.createDataFrame([(0, [1.0, 2.0]), (1, [3.0, -1.0]), (2, [0.5, 0.5])], schema), 20).collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in sorted(got, key=lambda r: r.rank)] == [(0, 1, 2, 1.5), (0, 2, 1, 1.0)]


def test_graph_walk_finds_the_nearest_centroids():
    rng = np.random.default_rng(5)
    sample = clustered(rng, 4000)
    index = ann.fit(sample, float(np.linalg.norm(sample, axis=1).max()), 200)
    points = index.lifted(clustered(rng, 200) / 4)
    _, lists = index.search(points, 8)
    exact = np.argsort(((points[:, None] - index.centroids[None]) ** 2).sum(axis=2), axis=1)[:, :8]
    assert np.mean([len(set(a) & set(b)) for a, b in zip(lists, exact)]) > 7.5
