import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tablewright.llm import align as al
from tablewright.llm.common import text_groups


def plain(texts):
    """Measures of each text by whole encodings and byte intervals."""
    both, found = al._tokenizers((None, None)), []
    for text in texts:
        raw = (" " + (text or "")).encode()
        a, b = (both.a.encode(" " + text, add_special_tokens=False).ids, both.b.encode(text)) if text else ([], [])
        ends = []
        for ids, entries in ((a, both.a_bytes), (b, both.b_bytes)):
            at, spans = 0, []
            for i in ids:
                spans.append((at, at + len(entries[i]), i))
                at = spans[-1][1]
            ends.append(spans)
        if not text or any(b"".join(e[i] for i in ids) != raw for ids, e in ((a, both.a_bytes), (b, both.b_bytes))):
            found.append(None)
            continue
        links = [(x, y) for s, e, x in ends[0] for u, v, y in ends[1] if s < v and u < e]
        shared = sorted({e for _, e, _ in ends[0]} & {e for _, e, _ in ends[1]})
        groups, start = [], 0
        for stop in shared:
            groups.append("|".join(",".join(str(i) for s, e, i in side if start <= s and e <= stop) for side in ends))
            start = stop
        found.append((len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    counts = Counter(link for f in found if f for link in f[3])
    most = {}
    for (_, y), n in counts.items():
        most[y] = max(most.get(y, 0), n)
    return [(*f[:3], len(f[3]), sum(counts[k] == most[k[1]] for k in f[3]), sum(counts[k] for k in f[3]), f[4]) if f
            else (0, 0, 0, 0, 0, 0, "") for f in found]


def sample():
    rng = random.Random(3)
    words = ["The", "of", "nation", "don't", "they'll", "élan", "x1y2", "日本語", "1234", "foo.\nBar", "--", "a\x00b", "ﬁ", "\U00010380", "<s>", "<|endoftext|>"]
    texts = [" ".join(rng.choices(words, k=rng.randint(1, 30))) for _ in range(40)]
    texts += ["", None, " ", "  two  blanks  ", "\n\nline \n end ", "tab\t x", "▁mark", "x ▁ y", "a b", "x\x1cy \x1c z", "\r\n;\r", "no" * 300]
    return texts + texts[:5] * 3 + ["copy of one"] * 30


@pytest.mark.parametrize("hot", [500_000, 20, 0])
def test_measures_equal_plain_counting(spark, monkeypatch, hot):
    monkeypatch.setattr(al, "HOT_PAIRS", hot)
    texts = sample()
    docs = spark.createDataFrame([(i, t, 7, "x") for i, t in enumerate(texts)], "doc_id long, text string, n_a int, key string").repartition(3)
    got = {r.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in al.align_documents(docs).collect()}
    assert got == dict(enumerate(plain(texts)))


def test_long_texts_in_parts_and_few_kept_stretches(monkeypatch):
    monkeypatch.setattr(al, "KEPT_STRETCHES", 3)
    both, rng = al.Tokenizers(None, None), random.Random(5)
    text = " ".join("".join(rng.choices("abcdé\n", k=rng.randint(1, 8))) for _ in range(3000)) + "  ▁no"
    for body in (text, text[:-5]):
        whole = both.overlay(" " + body, both.a.encode(" " + body, add_special_tokens=False).ids, both.b.encode(body))
        held = al._Text(True)
        for group in text_groups([body], al.GAP, 100):
            for _, part in group:
                stretches = al.GAP.split(part)
                known = both.learn(set(stretches))
                held.add([known[s] for s in stretches])
        if whole is None:
            assert held.measures()[:5] == (0, 0, 0, 0, "")
        else:
            a, b, groups, links, spelled = whole
            pairs = np.frombuffer(links, np.int64).tolist()
            assert held.measures()[:5] == (a, b, groups, len(pairs), hashlib.sha256(spelled.encode()).hexdigest())
            assert dict(zip(*(x.tolist() for x in held.measures()[5:]), strict=True)) == Counter(pairs)


def test_the_quick_encoder_is_the_files_own():
    both = al._tokenizers((None, None))
    texts = [" " + t for t in sample() if t] + ["<|endoftext|> x", "a\u2028b  \u00a0c", "\U0001F600 \u200d", "é" * 500, "0123456789 " * 50, "\t\t\r\n\n  x"]
    assert [both.a_ids(t) for t in texts] == [both.a.encode(t, add_special_tokens=False).ids for t in texts]
    assert both.a_ids.__self__.name == "from-file"


def test_no_piece_goes_on_after_a_space():
    """Of A the pre-tokenizer sees to that."""
    assert not any(b" " in e.lstrip(b" ") for e in al._tokenizers((None, None)).b_bytes)


def test_null_ids_and_empty_table(spark):
    rows = [(None, "same text"), (None, "same text"), (4, "same text")]
    got = al.align_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id is None for r in got)) == [False, True, True] and len({tuple(r)[1:] for r in got}) == 1
    assert al.align_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0
