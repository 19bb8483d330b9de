import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from tablewright.llm import lm


def all_spellings(text, score):
    """Sum of probabilities over all segmentations, by plain recursion."""
    if not text:
        return 1.0
    return sum(math.exp(score[text[:k]]) * all_spellings(text[k:], score) for k in range(1, len(text) + 1) if text[:k] in score)


@pytest.fixture(scope="module")
def random_scores():
    model = lm._vocabulary(None)
    raw = np.random.default_rng(1).random(model.get_piece_size()) + 0.1
    return np.log(raw / raw.sum())


def test_forward_sums_all_segmentations(random_scores):
    model, lattice = lm._vocabulary(None), lm.Lattice(random_scores)
    score = {model.id_to_piece(i): random_scores[i] for i in range(259, model.get_piece_size())}
    for word in ("a", "there", "thenation", "élan", "x1y2"):
        assert lattice.word(word) == pytest.approx(math.log(all_spellings("▁" + word, score)), abs=1e-9)


def test_characters_without_piece_and_long_words(random_scores):
    lattice = lm.Lattice(random_scores)
    rare = "\U00010380"
    assert rare not in lattice.table
    assert lattice.word(rare) == pytest.approx(lattice.table["▁"] + sum(lattice.byte[b] for b in rare.encode()))
    assert -1e6 < lattice.word("ab" * 20_000) < -1e4


@pytest.mark.parametrize("hot", [0, 5, 100_000])
def test_scores_equal_plain_counting(spark, monkeypatch, hot):
    monkeypatch.setattr(lm, "HOT_WORDS", hot)
    rng = random.Random(2)
    words = ["The", "the", "of", "and", "Ünion", "a\x1fb", "rarely", "x" * 60, "▁", "▁y"] + [f"w{i}" for i in range(30)]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(0, 40)))) for i in range(60)]
    rows += [(100, None), (101, ""), (None, "the of"), (3, rows[3][1])]
    docs = spark.createDataFrame([(i, t, 1.0) for i, t in rows], "doc_id long, text string, score double").repartition(3)
    got = lm.score_documents(docs).collect()

    def tokens(text):
        return (text or "").encode().lower().split()

    held = [zlib.crc32(str(i if i is not None else "").encode()) % 7 == 2 for i, _ in rows]
    counts = Counter(w for (_, t), h in zip(rows, held, strict=True) if not h for w in tokens(t))
    ends = held.count(False)
    n, v = sum(counts.values()) + ends, len(counts) + 1
    pieces = Counter({2: ends})
    for w, c in counts.items():
        for p in lm._vocabulary(None).encode(w.decode()):
            pieces[p] += c
    size = lm._vocabulary(None).get_piece_size()
    lattice = lm.Lattice(np.log(np.array([pieces[i] + 1 for i in range(size)]) / (sum(pieces.values()) + size)))
    want = []
    for (i, t), h in zip(rows, held, strict=True):
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens(t)) + math.log10((ends + 1) / (n + v + 1))
        score = (sum(lattice._forward("▁" + w.decode()) for w in tokens(t)) + lattice.end) / math.log(10)
        want.append((i, h, len(tokens(t)) + 1, sum(counts[w] > 0 for w in tokens(t)) + 1, n, round(base, 6), round(score, 6)))
    have = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in got]
    assert sorted(have, key=str) == sorted(want, key=str)


def test_empty(spark):
    assert lm.score_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0
