import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import regex

from tablewright.llm import langid as li


def spellings(text, score):
    """Sum over all segmentations, by plain recursion."""
    return 1.0 if not text else sum(math.exp(score[text[:k]]) * spellings(text[k:], score) for k in range(1, len(text) + 1) if text[:k] in score)


@pytest.fixture(scope="module")
def scores():
    raw = np.random.default_rng(1).random((li._vocabulary(None).get_piece_size(), 3)) + 0.1
    return np.log(raw / raw.sum(axis=0))


def test_words_sum_all_segmentations(scores):
    model, lattice = li._vocabulary(None), li.Lattice(scores)
    words = ["a", "there", "thenation", "élan", "x1y2", "was", "a"]
    got = lattice.words(words)
    for k in range(3):
        score = {model.id_to_piece(i): scores[i, k] for i in range(259, model.get_piece_size())}
        assert got[:, k] == pytest.approx([math.log(spellings("▁" + w, score)) for w in words], abs=1e-9)


def test_long_words_and_characters_without_piece(scores):
    lattice = li.Lattice(scores)
    word = "thenation\U00010380élan" * 3
    assert len(word) < li.LONG and lattice._alone("▁" + word) == pytest.approx(lattice.words([word])[0], abs=1e-9)
    rare = "\U00010380"
    assert lattice.words([rare])[0] == pytest.approx(scores[lattice.table["▁"]] + sum(scores[lattice.bytes[b]] for b in rare.encode()))
    long = lattice.words(["ab" * 20_000, "a"])
    assert (long[0] < -1e4).all() and (long[1] > -30).all()


def documents(n):
    rng = random.Random(4)
    words = {"de": "der die und nicht Straße über ich haben".split(), "en": "the of and not street over have that".split(),
             "fr": "le la et ne rue été nous avons".split()}
    rows = []
    for i in range(n):
        lang = rng.choice(["de", "en", "en", "fr"])
        rows.append((i, " ".join(rng.choices(words[lang], k=rng.randint(1, 12))), lang))
    odd = [None, "", "  ", "123 - 45!", "٠١", "日本語", "the\nof\tand", "y" * 200 + " the the", rows[0][1]]
    rows += [(n + i, t, lang) for i, (t, lang) in enumerate(zip(odd, ["de", "en", "en", None, "fr", "fr", "en", None, "de"], strict=True))]
    return rows + [(None, "der die das", "de"), (None, None, None), rows[3], rows[3]]


@pytest.mark.parametrize("small", [False, True])
def test_equals_plain_model(spark, monkeypatch, small):
    if small:
        for name in ("TASK_WORDS", "KEPT_WORDS", "LONG"):
            monkeypatch.setattr(li, name, 5)
    rows = documents(80)
    frame = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, lang string, score double").repartition(3)
    got = [(r.doc_id, r.held_out, r.lang_pred, round(r.score, 9)) for r in li.predict_languages(frame).collect()]
    held = [zlib.crc32(str("" if i is None else i).encode()) % 4 == 2 for i, _, _ in rows]
    model, texts, pieces = li._vocabulary(None), Counter(), {}
    for (_, t, lang), h in zip(rows, held, strict=True):
        if not h and t is not None and lang is not None:
            texts[lang] += 1
            for w in li.words_of(t):
                pieces.setdefault(lang, Counter()).update(model.encode(w))
    langs, size = sorted(texts), model.get_piece_size()
    raw = np.array([[pieces.get(x, {}).get(i, 0) + li.SMOOTH for x in langs] for i in range(size)])
    lattice = li.Lattice(np.log(raw / raw.sum(axis=0)))
    want = []
    for (i, t, _), h in zip(rows, held, strict=True):
        if t is None or not regex.search(r"\p{L}", t):
            want.append((i, h, "und", 0.0))
            continue
        total = np.log([texts[x] / sum(texts.values()) for x in langs]) + sum(lattice._alone("▁" + w) for w in li.words_of(t))
        share = np.exp(total - total.max())
        want.append((i, h, langs[int(total.argmax())], round(float(share.max() / share.sum()), 9)))
    assert sorted(got, key=str) == sorted(want, key=str)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = docs.select("doc_id", "lang").join(li.predict_languages(docs), "doc_id").where("held_out").collect()
    assert len(found) > 200 and np.mean([r.lang == r.lang_pred for r in found]) >= 0.98
    assert all(0 <= r.score <= 1 for r in found)


def test_nothing_to_learn_from(spark):
    schema = "doc_id long, text string, lang string"
    assert li.predict_languages(spark.createDataFrame([], schema)).count() == 0
    got = li.predict_languages(spark.createDataFrame([(1, "some text", None), (2, None, "en")], schema)).collect()
    assert {(r.doc_id, r.lang_pred, r.score) for r in got} == {(1, "und", 0.0), (2, "und", 0.0)}


def test_too_many_languages_are_refused(spark, monkeypatch):
    monkeypatch.setattr(li, "MODEL_SIZE", 50_000)
    with pytest.raises(ValueError, match="more than 1 languages"):
        li.predict_languages(spark.createDataFrame([(i, "text", f"l{i % 3}") for i in range(40)], "doc_id long, text string, lang string"))
