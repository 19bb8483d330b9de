import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from tablewright.llm.packing import piece_lengths, token_ids
from tablewright.llm.quality import LineRules, base_counts, clean
from tablewright.llm.simhash import fingerprint


def corpus():
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 6))) for _ in range(400)]
    line = lambda: " ".join(rng.choices(words, k=rng.randint(6, 25))) + "."
    texts = ["\n".join(line() for _ in range(rng.randint(2, 12))) for _ in range(150)]
    texts += texts[:10] + [t.replace("a", "A", 1) for t in texts[10:20]] + [None, "", "short one.", "a | b | c | d " * 20]
    shared = "This line is in 17 of the documents here."
    texts += [f"{t}\n{shared.replace('17', str(i))}" for i, t in enumerate(texts[20:40])]
    return [(i, t, "en", f"s{i % 3 if i % 2 else 0}", len(t or "")) for i, t in enumerate(texts)]


def plain_lines(rows):
    """Line dedup in plain Python: (doc_id, text, dropped)."""
    norm = lambda raw: b" ".join(re.sub("[0-9]+", "0", raw).encode().split()).decode()
    docs, by_leaf = defaultdict(set), defaultdict(set)
    for i, t in rows:
        for raw in (t or "").split("\n"):
            tokens = norm(raw).split(" ")
            if len(tokens) >= 5 and 2 * norm(raw).count("0") <= len(tokens):
                docs[norm(raw)].add(i)
                by_leaf[len(tokens), tuple(tokens[:3])].add(norm(raw))
    template = {n: n for n in docs}
    for leaf, norms in by_leaf.items():
        if len(norms) > 1:
            support = defaultdict(set)
            for n in norms:
                for at, token in enumerate(n.split(" ")):
                    support[at, token] |= docs[n]
            for n in norms:
                held = [token if len(support[at, token]) > 1 else None for at, token in enumerate(n.split(" "))]
                if None in held and sum(x is not None for x in held) >= 0.8 * len(held):
                    template[n] = (leaf, tuple(held))
    owners = defaultdict(set)
    for n, t in template.items():
        owners[t] |= docs[n]
    out = []
    for i, t in rows:
        kept = [raw for raw in (t or "").split("\n") if norm(raw) not in template or min(owners[template[norm(raw)]]) == i]
        out.append((i, "\n".join(kept), len((t or "").split("\n")) - len(kept)))
    return out


def test_stages_equal_plain_python(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    stages = dict(corpus_pipeline.STAGES)

    kept = stages["quality_rules"](spark, docs, "")
    want = []
    for i, t, *_ in rows:
        n, *_, repeat = base_counts(t or "")
        text, *_, too_much = clean(t or "", LineRules())
        if n >= 20 and 100 * repeat <= 30 * n and not too_much:
            want.append((i, text))
    got = sorted((r.doc_id, r.text) for r in kept.collect())
    assert got == sorted(want) and kept.columns == docs.columns and len(got) > 100

    deduped = stages["line_dedup"](spark, kept, "")
    want = sorted((i, t) for i, t, dropped in plain_lines(got) if dropped == 0 or t.split())
    got = sorted((r.doc_id, r.text) for r in deduped.collect())
    assert got == want and deduped.columns == docs.columns
    assert sum("This line is in" in t for _, t in got) == 1

    single = stages["near_dedup"](spark, deduped, "")
    prints = [(i, fingerprint(t)) for i, t in got]
    group = {i: i for i, _ in prints}
    for _ in range(6):
        for (i, a), (j, b) in itertools.combinations(prints, 2):
            if (a ^ b).bit_count() <= 3:
                group[i] = group[j] = min(group[i], group[j])
    assert sorted(r.doc_id for r in single.collect()) == sorted(set(group.values()))
    assert single.columns == docs.columns

    mixed = stages["source_mixing"](spark, single, "")
    have = [(r.doc_id, r.source, len(r.text)) for r in single.collect()]
    sizes = Counter()
    for _, s, n in have:
        sizes[s] += n
    want = Counter()
    for i, s, _ in have:
        rate = sum(sizes.values()) / len(sizes) / sizes[s]
        u = (int(hashlib.md5(f"mix:{i}".encode()).hexdigest()[:13], 16) + 0.5) / 2 ** 52
        count, below, p = 0, math.exp(-rate), math.exp(-rate)
        while below < u:
            count += 1
            p *= rate / count
            below += p
        want[i] += count
    assert Counter(r.doc_id for r in mixed.collect()) == +want and mixed.columns == docs.columns

    packed = stages["packing"](spark, mixed, "").collect()
    text = {r.doc_id: r.text for r in mixed.collect()}
    expected = Counter()
    for r in mixed.collect():
        ids, start = token_ids(text[r.doc_id]), 0
        for k, n in enumerate(piece_lengths(len(ids), 1024)):
            expected[r.doc_id, k, start, n, zlib.crc32(np.asarray(ids[start:start + n], "<u4").tobytes())] += 1
            start += n
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == expected
    filled = defaultdict(list)
    for r in packed:
        filled[r.sequence_id].append((r.offset, r.length))
    for parts in filled.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 1024


@pytest.mark.parametrize("rows", [[], [(None, None, None, None, None)], [(1, "", "en", "a", 0)] * 3])
def test_stages_on_odd_tables(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES:
        if name == "quality_rules":
            assert stage(spark, docs, "").count() == 0
        elif name == "near_dedup":
            assert stage(spark, docs, "").count() == min(1, len(rows))
        elif name in ("line_dedup", "packing"):
            assert stage(spark, docs, "").count() == len(rows)
        else:
            stage(spark, docs, "").count()


def test_run_keeps_no_copy_and_loses_no_document(spark, tmp_path):
    spark.createDataFrame(corpus(), "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert got and set(got[0].asDict()) == {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"}


def test_stages_leave_further_columns_out(spark):
    text = "One sentence with a good many words in it, so that the rules are content with what they see here today."
    docs = spark.createDataFrame([(1, text, "en", "a", 3, "x", "y", 1, True)],
                                 "doc_id long, text string, lang string, source string, n_chars long, clean_text string, hash string, "
                                 "piece int, kept boolean")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, "")
        assert got.columns == docs.columns[:5] and (name == "source_mixing" or got.first().text == text)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() == 1
