import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tablewright.llm.packing import _knapsack, configurations, pack, piece_lengths, plan, token_ids

SLOW = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80))
def test_ids_are_those_of_the_tokenizers_library(text):
    assert token_ids(text).tolist() == [*SLOW.encode(text, add_special_tokens=False).ids, 2]


@settings(max_examples=30, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 400), max_size=40))
def test_plan_places_every_piece_once(counts):
    runs, free, placed = plan(counts, 64), defaultdict(list), defaultdict(list)
    for r in runs:
        placed[r.length] += range(r.rank, r.rank + r.count)
        for i in range(r.count):
            free[r.first + i].append((r.offset, r.length))
    assert {n: sorted(p) for n, p in placed.items()} == {n: list(range(c)) for n, c in counts.items()}
    for parts in free.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    assert sorted(free) == list(range(len(free)))


def test_plan_is_tight():
    rng = random.Random(5)
    counts = Counter(min(1024, int(rng.lognormvariate(6.2, 1)) + 1) for _ in range(60_000))
    runs = plan(counts)
    used, least = 1 + max(r.first + r.count - 1 for r in runs), sum(n * c for n, c in counts.items()) / 1024
    assert used < 1.01 * least and len(runs) < 20_000
    assert len(plan({n: 1000 * c for n, c in counts.items()})) < 20_000


def test_knapsack_and_configurations():
    assert _knapsack(np.array([3, 5, 7]), np.array([3.0, 5.5, 7.0]), 13)[0] == 2 * 5.5 + 0 * 3 + 3.0
    for column, n in configurations([60, 40, 30], [100, 100, 100], 100):
        assert n > 0 and sum(k * s for k, s in zip(column, (60, 40, 30), strict=True)) <= 100


def test_pieces():
    assert piece_lengths(1, 4) == [1] and piece_lengths(4, 4) == [4] and piece_lengths(9, 4) == [1, 4, 4]


def test_pack(spark):
    rng = random.Random(6)
    texts = [" ".join(rng.choices(["one", "Two!", "3", "vier\n", "é", ""], k=rng.randint(0, 900))) for _ in range(300)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(1000, None), (None, "a"), (5, texts[5]), (1001, "long " * 5000)]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, piece int, part string").repartition(5)
    got = pack(docs, capacity=128, with_ids=True).collect()
    by_doc = defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and len(r.ids) == r.length <= 128
    want = defaultdict(list)
    for i, t in rows:
        want[i].append(SLOW.encode(t or "", add_special_tokens=False).ids + [2])
    for i, pieces in by_doc.items():
        copies = len(want[i])
        for start in sorted({p.start for p in pieces}):
            assert len([p for p in pieces if p.start == start]) == copies
        one = sorted({p.start: p for p in pieces}.values(), key=lambda p: p.start)
        assert [x for p in one for x in p.ids] == want[i][0]
        assert [p.length for p in one] == piece_lengths(len(want[i][0]), 128) and [p.piece for p in one] == list(range(len(one)))
    assert by_doc.keys() == want.keys()
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        assert [o for o, _ in sorted(parts)] == np.cumsum([0, *(n for _, n in sorted(parts))])[:-1].tolist()
        assert sum(n for _, n in parts) <= 128
    assert pack(docs.limit(0)).count() == 0
