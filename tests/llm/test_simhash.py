import itertools
import random

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from tablewright.llm.simhash import fingerprint, forest, keep_one, links, near_duplicates

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def plain_fingerprint(text):
    words, word = [], ""
    for ch in text + " ":
        if ch in " \t\n\x0b\x0c\r":
            words, word = words + [word] * bool(word), ""
        else:
            word += chr(ord(ch) + 32) if "A" <= ch <= "Z" else ch
    if not words:
        return 0
    shingles = [words[i:i + 3] for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(" ".join(s).encode(), 42) for s in shingles]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abAÉ \n\t\x1f\xa0ß", max_size=60))
def test_fingerprint(text):
    assert fingerprint(text) == plain_fingerprint(text)


def plain_components(values):
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a, b in itertools.combinations(values, 2):
        if (a ^ b).bit_count() <= 3:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {v: find(v) for v in values}


def near_values(rng, n):
    values = set()
    while len(values) < n:
        v = rng.getrandbits(64)
        for _ in range(rng.randint(1, 6)):
            values.add(v)
            for _ in range(rng.randint(1, 4)):
                v ^= 1 << rng.randrange(64)
    return sorted(values)


def test_all_triples_of_bits_meet():
    rng = random.Random(1)
    base = rng.getrandbits(64)
    for start in (base, base ^ 1):
        for bits in itertools.chain(itertools.combinations(range(64), 3), itertools.combinations(range(64), 2)):
            if rng.random() > 0.03:
                continue
            other = start
            for b in bits:
                other ^= 1 << b
            a, _ = forest(np.array(sorted((start, other)), np.uint64), 0, 0)
            assert len(a) == 1, bits


def test_links_equal_brute_force(spark):
    values = near_values(random.Random(2), 1500)
    want = plain_components(values)
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    frame = spark.createDataFrame([(v,) for v in signed], "fp long")
    for per_prefix in (4096, 40):  # no prefix, and six bits of it
        rows = links(frame, per_prefix).collect()
        root = {v: v for v in values}

        def find(v):
            while root[v] != v:
                v = root[v]
            return v

        for r in rows:
            a, b = sorted((find(r.a % 2**64), find(r.b % 2**64)))
            root[b] = a
        groups = lambda of: sorted(sorted(v for v in values if of(v) == r) for r in {of(v) for v in values})
        assert groups(find) == groups(want.get)


def test_documents(spark):
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdef", k=4)) for _ in range(300)]
    texts = [" ".join(rng.choices(words, k=200)) for _ in range(40)]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(100 + i, t.upper()) for i, t in enumerate(texts[:10])] + [(200 + i, t + " xyz") for i, t in enumerate(texts[:20])]
    rows += [(300, None), (301, ""), (302, " \n"), (None, texts[3]), (4, texts[4]), (7, "another text under the same id")]
    rng.shuffle(rows)
    docs = spark.createDataFrame([(i, t, "fp", "least", 1) for i, t in rows], "doc_id long, text string, fp string, rep string, n_chars int")
    got = near_duplicates(docs).collect()
    prints = {fingerprint(t or "") for _, t in rows}
    of = plain_components(sorted(prints))
    want = sorted(((i, fingerprint(t or "")) for i, t in rows), key=str)
    assert sorted(((r.id, r.fp % 2**64) for r in got), key=str) == want
    for r in got:
        assert r.component_id == min(i for i, t in rows if i is not None and of[fingerprint(t or "")] == of[r.fp % 2**64])
    kept = keep_one(docs).collect()
    assert len(kept) == len(set(of.values())) and kept[0].asDict().keys() == set(docs.columns)
    assert len({of[fingerprint(r.text or "")] for r in kept}) == len(kept)


def test_empty(spark):
    assert near_duplicates(spark.createDataFrame([], DOCS)).count() == 0
    assert keep_one(spark.createDataFrame([], DOCS)).count() == 0
