"""Quality rules, line dedup, mixing, URL rules and chat rotation on small tables and odd ones."""

import math
import random
import re
import time
from collections import Counter
from statistics import NormalDist

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from oracle import compare, connect
from tablewright.llm import quality as quality_module
from tablewright.llm import queries
from tablewright.llm.chat import rotate
from tablewright.llm.line_dedup import drop_recurring
from tablewright.llm.mixing import large_count, mix_sources, normal_quantile, repetition_rates
from tablewright.llm.quality import LineRules, base_counts, clean, failing, quality, repeated_words
from tablewright.llm.urlfilter import filter_urls

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, name):
    assert compare(queries.QUERIES[name](spark, SF), connect(SF), queries.ORACLE[name]) is None


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=60))
def test_repeated_words(words):
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = {i + k for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for k in range(8)}
    assert repeated_words(words) == len(covered)


def test_base_counts():
    assert base_counts("") == (0, 0, 0, 0, 0)
    assert base_counts("a b\n\na b\n \n#x\x1f*\u00a0é") == (5, 10, 2, 1, 0)
    assert base_counts("w " * 20) == (20, 20, 0, 0, 20)


@pytest.mark.parametrize("line, rule", [
    ("", None), ("A plain sentence that ends well.", None), ("A heading without mark", None),
    ("Home | About | Contact | Imprint", "navigation"), ("Released under the MIT License.", "boilerplate"),
    ("wo%%% rd*** an&&& ot###", "symbols"), ("BUY!! NOW!! OR!! NEVER!!", "shouting"),
    ("this line has a good many words in it and never comes to an", "punctuation")])
def test_line_rules(line, rule):
    assert failing(line, LineRules()) == rule
    assert clean(line, LineRules())[2] == (rule is not None)


def test_by_sentence():
    rules = LineRules(by_sentence=True)
    whole = "The first sentence of this line is long enough to be read. The second one of it is, too, and ends here."
    tail = " this part has a good many words in it and never comes to an"
    assert clean(whole + tail, rules) == (whole, 1, 0, 14, False)
    assert clean(whole + " and a short rest", rules)[:3] == (whole + " and a short rest", 1, 0)
    assert clean(tail.strip(), rules)[2] == 1 and clean("Released under the MIT License.", rules)[2] == 1
    for line in ("A design in Tokyo.", "Much bread more.", "The catalog in Tokyo is old.", "I read more than you do. " * 6):
        assert clean(line, rules) == (line, 1, 0, 0, False)
    wrapped = ("this is a text that was set to a width of some seventy letters or so\nand goes on from line to line with many words in it "
               "until the end\nof its last sentence is there, after some more of the words it has.")
    assert clean(wrapped, rules)[0] == wrapped and clean(wrapped.rstrip(".") + " more", rules)[1:3] == (3, 3)
    arabic = "كلمة " * 14 + "كلمة؟"
    assert clean(arabic, rules)[0] == arabic and clean("x " * 14 + ". " + "_ " * 50, rules)[2] == 0


@pytest.mark.parametrize("odd", ["." * 1_000_000 + "a", "a" + "." * 1_000_000, "!)" * 400_000 + "x", " " * 1_000_000 + "z", ". " * 400_000 + "end", "x\n" * 300_000,
                                 "。" * 500_000 + "。a", "~ " * 500_000])
@pytest.mark.parametrize("by_sentence", [False, True])
def test_time_grows_with_the_line_alone(odd, by_sentence):
    start = time.process_time()
    clean("some words that begin the line and are more than twelve of them here " + odd, LineRules(by_sentence=by_sentence))
    assert time.process_time() - start < 4


def test_the_whole_end_of_a_line_is_read():
    line = "this line has a good many words in it and comes to an end." + " ~" * 30
    assert failing(line, LineRules()) is None and failing(line.replace(".", ""), LineRules()) == "punctuation"
    assert clean(line, LineRules(by_sentence=True))[2] == 0


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from(".!?)\"。؟ a_é~"), max_size=30))
def test_ends_equal_the_plain_patterns(line):
    marks = re.escape("".join(quality_module._FINAL))
    assert quality_module.ends_with_mark(line, quality_module._FINAL) == bool(re.search(rf"[{marks}]+[^\w]*$", line))
    plain = re.compile(rf"[{quality_module._MARKS}]+[{re.escape(quality_module._CLOSING)}]*(?:\s+|(?<=[。！？｡．])(?=\w))")
    assert quality_module._tail(line) == max([0, *(m.end() for m in plain.finditer(line))])


def test_quality_rows(spark):
    prose = "One line of prose with quite a few good words in it, as it should be, and a second part that says something new. "
    rows = [(1, prose), (1, prose), (2, None), (None, prose), (3, "x | " * 300), (4, "a b " * 50_000)]
    frame = spark.createDataFrame([(i, t, 3, True) for i, t in rows], "doc_id long, text string, n_words int, kept boolean")
    assert Counter((r.doc_id, r.kept) for r in quality(frame).collect()) == Counter(
        [(1, True), (1, True), (2, False), (None, True), (3, False), (4, False)])
    assert quality(frame.limit(0)).count() == 0


def test_line_dedup_rows(spark):
    same = "all rows of this kind say the same"
    rows = [(1, f"{same}\nown words of the first one"), (2, f"{same}\nshort line"), (2, f"{same}\nshort line"), (3, f" {same} \n\n" * 3),
            (None, same), (4, None), (5, ""), (6, "1 2 3 4 5 6"), (7, "1 2 3 4 5 6"),
            (8, "in this room user bob has left us"), (9, "in this room user eve has left us"), (10, "word " * 100_000)]
    frame = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, n_lines int, leaf string")
    got = sorted(((r.doc_id, r.text, r.n_dropped) for r in drop_recurring(frame).collect()), key=str)
    want = [(1, rows[0][1], 0), (2, "short line", 1), (2, "short line", 1), (3, "\n\n\n", 3), (None, same, 0), (4, None, 0), (5, "", 0),
            (6, rows[7][1], 0), (7, rows[8][1], 0), (8, rows[9][1], 0), (9, "", 1), (10, rows[11][1], 0)]
    assert got == sorted(want, key=str)
    assert drop_recurring(frame.limit(0)).count() == 0


@pytest.mark.parametrize("vary, values, n, length", [(4, 30, 1200, 10), (7, 6, 300, 10), (2, 60, 300, 5), (9, 4, 200, 24)])
def test_line_dedup_by_similarity_finds_every_variant_of_a_crowd(spark, vary, values, n, length):
    rng = random.Random(vary)
    places = set(rng.sample(range(3, length), min(vary, length - 3)))
    value = lambda: chr(97 + (k := rng.randrange(values)) % 26) + chr(97 + k // 26)
    lines = list(dict.fromkeys(tuple(value() if at in places else f"w{chr(97 + at)}" for at in range(length)) for _ in range(n)))
    want = {i for i, a in enumerate(lines) if any(10 * sum(x == y for x, y in zip(a, b)) >= 8 * length for b in lines[:i])}
    frame = spark.createDataFrame([(i, " ".join(a)) for i, a in enumerate(lines)], "doc_id long, text string")
    got = {r.doc_id for r in drop_recurring(frame, by_similarity=True).collect() if r.n_dropped}
    assert len(want) > n // 20 and (want - got, got - want) == (set(), set())


def test_line_dedup_by_similarity(spark):
    rows = [(8, "in this room user bob has left us"), (9, "in this room user eve has left us"), (11, "in this room user bob has left us"),
            (12, "in this room user eve has left us"), (13, "in this room there was nobody but us"),
            (20, "the report of may was sent to ann in oslo today"), (21, "the report of may was sent to bob in rome today"),
            (22, "the report of june was sent to bob in oslo today"), (23, "the report of june was sent to bob in oslo today")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id for r in drop_recurring(frame, by_similarity=True).collect() if r.n_dropped} == {9, 11, 12, 21, 22, 23}
    assert {r.doc_id for r in drop_recurring(frame).collect() if r.n_dropped} == {11, 12, 23}  # as the SQL has it
    assert drop_recurring(frame.limit(0), by_similarity=True).count() == 0


def test_line_dedup_figures(spark):
    log = '0.0.0.0 GET from 10.1.2.3 at 2024-01-02T10:11:12 was {} by user 17'
    token = 'token = "7abc3ff9ca1fb22e1c" From reha reenti oution thti.'
    rows = [(1, f"{log.format('served')}\n1 2 3 4 5 6\n12 34 56 total 78 90"), (2, f"{log.format('served')}\n1 2 3 4 5 6\n12 34 56 total 78 90"),
            (3, token), (4, token), (5, "12 34 56 total 78 91")]
    got = {r.doc_id: r.text for r in drop_recurring(spark.createDataFrame(rows, "doc_id long, text string"), by_similarity=True).collect()}
    assert got == {1: rows[0][1], 2: "1 2 3 4 5 6", 3: token, 4: "", 5: rows[4][1]}


def test_mixing_rates_and_rows(spark):
    rng = random.Random(9)
    rows = [(i, "x" * rng.randint(1, 9), "a" if i % 3 else "b") for i in range(3000)] + [(5000, "xyz", None), (None, "x", "a"), (5001, None, "c")]
    frame = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, source string, _copy int").repartition(4)
    weights = spark.createDataFrame([("a", 1.0), ("b", 3.0), (None, 0.5), ("none", 2.0)], "source string, weight double")
    rates = {r.source: r for r in repetition_rates(frame, weights, 4.0).collect()}
    size = Counter()
    for _, t, s in rows:
        size[s] += len(t or "")
    for s, w in (("a", 1.0), ("b", 3.0), (None, 0.5)):
        assert rates[s].rate == pytest.approx(w / 4.5 * sum(size.values()) * 4 / size[s])
        assert rates[s].cdf[-1] == pytest.approx(1, abs=1e-9)
    assert rates["c"].rate == 0 and rates[None].low > 0  # a tiny source is repeated often
    mixed = mix_sources(frame, weights, 4.0).collect()
    assert [r._order for r in mixed] == sorted(r._order for r in mixed) and "c" not in {r.source for r in mixed}
    chars = Counter()
    for r in mixed:
        chars[r.source] += len(r.text)
    assert chars["b"] / chars["a"] == pytest.approx(3, rel=0.1)
    counts = Counter(r.doc_id for r in mixed if r.source == "a")
    lam = rates["a"].rate
    share = [sum(1 for i, _, s in rows if s == "a" and counts[i] == k) / sum(s == "a" for *_, s in rows) for k in range(4)]
    assert share == pytest.approx([math.exp(-lam) * lam ** k / math.factorial(k) for k in range(4)], abs=0.04)
    assert all(sorted(r._copy for r in mixed if r.doc_id == i) == list(range(counts[i])) for i in list(counts)[:20])
    assert mix_sources(frame.limit(0)).count() == 0


def test_rates_of_any_size(spark):
    """A source of three letters against one of 3e10: the rate is some 1e10 and has no table."""
    sizes = spark.createDataFrame([("tiny", "abc"), ("huge", "x" * 1000)], "source string, text string")
    weights = spark.createDataFrame([("tiny", 1.0), ("huge", 1e-7)], "source string, weight double")
    rates = {r.source: r for r in repetition_rates(sizes, weights, 1e8).collect()}
    assert rates["tiny"].rate == pytest.approx(1003 / 3 * 1e8, rel=1e-6) and rates["tiny"].cdf == []
    us = [1e-12, 0.001, 0.02, 0.3, 0.5, 0.9, 0.99, 1 - 1e-9]
    frame = spark.createDataFrame([(rate, u) for rate in (2e4, 1e10) for u in us], "rate double, u double")
    got = frame.select("rate", "u", large_count(F.col("rate"), F.col("u")).alias("n"), normal_quantile(F.col("u")).alias("z")).collect()
    for r in got:
        assert r.z == pytest.approx(NormalDist().inv_cdf(r.u), abs=1e-7)
        assert abs(r.n - (r.rate + math.sqrt(r.rate) * r.z)) < 2 + r.z * r.z / 5
    for r in got[:len(us)]:  # the exact inverse, by adding up from far below
        k = int(r.rate - 12 * math.sqrt(r.rate))
        p = math.exp(k * math.log(r.rate) - r.rate - math.lgamma(k + 1))
        total = p
        while total < r.u:
            k += 1
            p *= r.rate / k
            total += p
        assert abs(r.n - k) <= (1 if r.u < 1 - 1e-6 else 2)


def test_many_copies_are_made_in_pieces(spark, monkeypatch):
    from tablewright.llm import mixing

    rows = [(i, "word " * 40, "large") for i in range(200)] + [(900, "w", "small"), (901, "w", "small")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    whole = Counter((r.doc_id, r._copy, r._order) for r in mix_sources(frame).collect())
    monkeypatch.setattr(mixing, "PIECE", 7)
    assert Counter((r.doc_id, r._copy, r._order) for r in mix_sources(frame).collect()) == whole
    assert max(c for i, c, _ in whole if i == 900) > 9_000 and set(whole.values()) == {1}


def plain_verdict(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([len(rest), *(rest.find(c) for c in "/?#" if c in rest)])
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:].split("?")[0].split("#")[0]
    fits = [(len(h) + len(p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *max(fits, default=(0, 0, None, "allow"))[2:])


def test_url_rules(spark):
    rng = random.Random(10)
    labels = ["a", "b", "com", "org", "a-b", "x"]
    host = lambda: ".".join(rng.choices(labels, k=rng.randint(1, 4)))
    path = lambda: "/" + "/".join(rng.choices(["", "en", "e", "fr", "1"], k=rng.randint(0, 3)))
    rules = list({(host(), path()): rng.choice(["allow", "block"]) for _ in range(60)}.items())
    rules = [(h, p, v) for (h, p), v in rules]
    urls = [f"{rng.choice(['http', 'https'])}://{host()}{path()}{rng.choice(['', '?q=/', '#x'])}" for _ in range(500)]
    urls += [None, "", "no scheme/a", "http://", "HTTP://A.Com", "http://a.com?x://b/", "http://.com/", "http://hot.com/fr/"] + ["http://a.b.com/e"] * 200
    frame = spark.createDataFrame([(i // 2, u, "h") for i, u in enumerate(urls)], "page_id long, url string, host string").repartition(3)
    table = spark.createDataFrame([*rules, (None, "/", "block"), ("", "/", "block")], "host string, path string, verdict string")
    got = Counter((r.page_id, r.host, r.path, r.rule, r.verdict) for r in filter_urls(frame, table).collect())
    assert got == Counter((i // 2, *plain_verdict(u, rules)) for i, u in enumerate(urls))
    assert filter_urls(frame.limit(0), table).count() == 0
    assert {r.verdict for r in filter_urls(frame, table.limit(0), default="block").collect()} == {"block"}


def test_chat_rotation(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "ann", "Hi <|end|>"), (1, 2, "bob", None), (1, 2, "bob", None), (1, 3, None, "who?"),
            (2, 0, "system", "alone"), (None, 5, "ann", "x"), (3, None, "ann", "y")]
    frame = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, speaker string")
    got = {(r.conv_id, r.speaker): r for r in rotate(frame).collect()}
    assert got.keys() == {(1, "ann"), (1, "bob"), (1, "unknown"), (None, "ann"), (3, "ann")}
    r = got[1, "ann"]
    assert r.text == ("<|system|>\nBe kind.<|end|>\n<|assistant|>\nHi < |end| ><|end|>\n<|user name=bob|>\n<|end|>\n"
                      "<|user name=unknown|>\nwho?<|end|>\n")
    for key, row in got.items():
        spoken = "".join(row.text[s.start:s.end] for s in row.spans)
        assert row.n_loss_chars == len(spoken) and spoken.endswith("<|end|>\n") and row.text[:row.spans[0].start].endswith("<|assistant|>\n"), key
    assert got[1, "bob"].n_turns == 4
    long = spark.createDataFrame([(1, i, f"p{i % 3}", "w " * 50) for i in range(300)], "conv_id long, turn int, role string, text string")
    assert Counter(r.block for r in rotate(long, block_turns=100).collect()) == {0: 3, 1: 3, 2: 3}
    assert rotate(frame.limit(0)).count() == 0
