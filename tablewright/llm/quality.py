"""Quality rules, line first: each line is judged by punctuation, navigation, symbol, shouting and boilerplate
rules, failing lines go, and a document that loses too much of its text, or fails the base counts, is rejected."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

SPACE = "".join(map(chr, (*range(9, 14), 32)))
SYMBOLS = "#*$%&|<>"
WINDOW = 8
#: Phrases that mark a line as boilerplate, lower case.
BOILERPLATE = (
    "lorem ipsum", "javascript", "terms of use", "terms of service", "privacy policy", "cookie policy", "uses cookies",
    "use cookies", "all rights reserved", "licensed under", "released under the", "click here", "sign in to",
    "log in to", "subscribe to our", "share this", "read more", "skip to content", "powered by", "copyright ©",
)
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_lines_dropped", "n_words_lost")


@dataclass(frozen=True)
class LineRules:
    """Thresholds of the method; the base counts have the fixed ones of :func:`base_counts`."""

    min_words: int = 20                # fewer words: base failure
    max_repeat_percent: int = 30       # more words in repeated windows: base failure
    max_symbols_per_word: float = 0.5  # of a line
    max_separator_share: float = 0.2   # words of a line that only separate
    max_shouted_share: float = 0.5     # words of a line that end in !!
    #: A line this long or longer must end in a mark of punctuation.
    unfinished_words: int = 12
    max_lost_share: float = 0.5        # words of a document in failing lines
    boilerplate: tuple[str, ...] = BOILERPLATE
    #: Judge long lines by their sentences and phrases by whole words; the query's SQL doesn't.
    by_sentence: bool = False
    phrase_words: int = 25             # a line with more words is no boilerplate, by sentence


def words_of(text: str) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+``: bytes split on just these six characters."""
    return text.encode("utf-8", "surrogatepass").split()


def repeated_words(words: list) -> int:
    """Words covered by windows of 8 words that are found twice or more, the first included.

    Ranks of pairs, then of pairs of pairs: equal ranks are equal windows, nothing is hashed.
    """
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    seen: dict = {}
    rank = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    step = 1
    while step < WINDOW:
        pair = rank[:-step] * (int(rank.max()) + 1) + rank[step:]
        found, rank = np.unique(pair, return_inverse=True)
        if len(found) == len(pair):  # nor can longer windows repeat
            return 0
        step *= 2
    twice = np.bincount(rank)[rank] > 1
    ends = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(ends, at, 1)
    np.add.at(ends, at + WINDOW, -1)
    return int((np.cumsum(ends)[:-1] > 0).sum())


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of a whole text."""
    words = words_of(text)
    chars = len(text) - sum(map(text.count, SPACE))
    symbols = sum(map(text.count, SYMBOLS))
    seen, again = set(), 0
    for line in text.split("\n"):
        if line.strip(SPACE):
            again += line in seen
            seen.add(line)
    return len(words), chars, symbols, again, repeated_words(words)


_SEPARATOR = re.compile(r"[|•·»›>/\\→←–—-]+")
_SEPARATES = re.compile(r"(?<!\S)[|•·»›>/\\→←–—-]")
#: One of these, and no letter or digit after it, ends a line.
_FINAL = frozenset(".!?…。！？:;\"'”’»)]")


def ends_with_mark(line: str, marks: frozenset[str]) -> bool:
    """One of the marks comes after the last letter, digit or underscore. Read from the end as far as need be."""
    for c in reversed(line):
        if c in marks:
            return True
        if c.isalnum() or c == "_":
            return False
    return False


def unfinished(line: str, n_words: int, rules: LineRules) -> bool:
    return n_words >= rules.unfinished_words and not ends_with_mark(line, _FINAL)


#: Further scripts' ends of sentences and closing brackets, beside those of _FINAL.
_MARKS = ".!?…。！？；：｡．؟۔؛।॥։።፧။།៕"
_CLOSING = "\"'”’»)]」』）】》"
_ENDS = frozenset(_MARKS + ":;" + _CLOSING)
#: From the first of several marks on, and without going back, so that runs of marks of any length are read once.
_SENTENCE = re.compile(rf"(?<![{_MARKS}])[{_MARKS}]++[{re.escape(_CLOSING)}]*+(?:\s++|(?<=[。！？｡．])(?=\w))")
#: Wider lines are not set to a width, so they are no parts of a wrapped sentence.
WRAPPED = 120
_PHRASES: dict[tuple[str, ...], re.Pattern] = {}


def _phrase(rules: LineRules) -> re.Pattern:
    if rules.boilerplate not in _PHRASES:
        _PHRASES[rules.boilerplate] = re.compile("|".join(rf"(?<!\w){re.escape(p)}(?!\w)" for p in rules.boilerplate) or r"(?!)")
    return _PHRASES[rules.boilerplate]


def _tail(line: str) -> int:
    """Where the line's last sentence, which has no end mark, begins."""
    at = 0
    for m in _SENTENCE.finditer(line):
        at = m.end()
    return at


def _goes_on(lines: list[str], i: int, width: int) -> bool:
    """The line is wrapped: the next one begins with a small letter, or its first word had no room in this one."""
    following = lines[i + 1].strip() if i + 1 < len(lines) else ""
    if not following or len(lines[i]) > WRAPPED:
        return False
    return following[0].islower() or len(lines[i].rstrip()) + 1 + len(following.split(None, 1)[0]) > width


def _unended(lines: list[str], rules: LineRules) -> set[int]:
    """The lines that are long enough to need an end mark, have none, and don't go on to a line with one."""
    out, i = set(), 0
    need = [len(words_of(x)) >= rules.unfinished_words and not ends_with_mark(x, _ENDS) for x in lines]
    start = [0] * len(lines)  # of the paragraph; its longest line shows how wide it is set
    width: dict[int, int] = {}
    for k, x in enumerate(lines):
        start[k] = start[k - 1] if k and x.strip() and lines[k - 1].strip() else k
        width[start[k]] = max(width.get(start[k], 0), len(x.rstrip()))
    while i < len(lines):
        if not need[i]:
            i += 1
            continue
        stop = i
        while need[stop] and _goes_on(lines, stop, width[start[i]]):
            stop += 1
        if need[stop] and _tail(lines[stop]) == 0 or stop == i:
            out.update(range(i, stop + 1))
        elif need[stop]:  # the wrapped sentence ends within the last line, whose own tail has no end
            out.add(stop)
        elif not ends_with_mark(lines[stop], _ENDS) and _tail(lines[stop]) == 0:  # goes on to a short line without a mark
            out.update(range(i, stop))
        i = stop + 1
    return out


def clean_by_sentence(text: str, rules: LineRules) -> tuple[str, int, int, int, bool]:
    """As :func:`clean`; of a long line without an end mark only the unfinished sentence is charged and cut. A line
    counts as dropped when all of it goes."""
    kept, total, dropped, lost, words = [], 0, 0, 0, 0
    lines = text.split("\n")
    unended = _unended(lines, rules)
    for i, line in enumerate(lines):
        n = len(words_of(line))
        total, words = total + (n > 0), words + n
        rule = failing(line, rules) if n else None
        if rule in (None, "punctuation"):
            at = _tail(line) if i in unended else len(line)
            tail = len(words_of(line[at:]))
            if tail < rules.unfinished_words:  # as a short line, it needs no mark
                kept.append(line)
                continue
            lost += tail
            if at:
                kept.append(line[:at].rstrip(SPACE))
                continue
        else:
            lost += n
        dropped += 1
    return "\n".join(kept), total, dropped, lost, lost > rules.max_lost_share * words


def failing(line: str, rules: LineRules) -> str | None:
    """The rule that a line fails, or None. A line without a word passes."""
    n = len(words_of(line))
    words = line.split()
    if n == 0:
        return None
    low = line.lower()
    if n <= rules.phrase_words and _phrase(rules).search(low) if rules.by_sentence else any(phrase in low for phrase in rules.boilerplate):
        return "boilerplate"
    if n > 1 and sum(1 for w in words if _SEPARATOR.fullmatch(w)) > rules.max_separator_share * n:
        return "navigation"
    if sum(map(line.count, SYMBOLS)) > rules.max_symbols_per_word * n:
        return "symbols"
    if n > 1 and sum(1 for w in words if w.endswith("!!")) > rules.max_shouted_share * n:
        return "shouting"
    return "punctuation" if unfinished(line, n, rules) else None


def clean(text: str, rules: LineRules) -> tuple[str, int, int, int, bool]:
    """(text without failing lines, lines with a word, lines dropped, words lost, loses too much)."""
    if rules.by_sentence:
        return clean_by_sentence(text, rules)
    kept, lines, dropped, lost, words = [], 0, 0, 0, 0
    low = text.lower()
    # What no line of the document can hold, no line need be searched for.
    plain = not ("!!" in text or any(map(text.__contains__, SYMBOLS)) or any(p in low for p in rules.boilerplate)
                 or _SEPARATES.search(text))
    for line in text.split("\n"):
        n = len(words_of(line))
        lines, words = lines + (n > 0), words + n
        if unfinished(line, n, rules) if plain else failing(line, rules):
            dropped, lost = dropped + 1, lost + n
        else:
            kept.append(line)
    return "\n".join(kept), lines, dropped, lost, lost > rules.max_lost_share * words


def quality(docs: DataFrame, rules: LineRules = LineRules(), text_col: str = "text") -> DataFrame:
    """The input's columns and, for each row: the base counts, ``base_failed``, ``kept``, line counts and
    ``clean_text``, the text without failing lines.

    ``base_failed``: fewer words than ``min_words``, or more than ``max_repeat_percent`` of them in repeated
    windows. ``kept``: not base_failed, and at most ``max_lost_share`` of the words are in failing lines.
    A null text counts as one without words (rejected, clean text empty). Every row is judged by itself, so
    repeated rows get equal verdicts and an empty table gives an empty table. Columns of the input named like
    an added one are replaced.
    """
    added = [StructField(n, LongType()) for n in COUNTS] + [
        StructField("base_failed", BooleanType()), StructField("kept", BooleanType()), StructField("clean_text", StringType())]
    docs = docs.drop(*[f.name for f in added])
    out = StructType(docs.schema.fields + added)
    schema = to_arrow_schema(out)

    def judge(found: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = schema.names.index(text_col)
        for batch in found:
            rows = [[] for _ in added]
            for text in batch.column(at).to_pylist():
                text = text or ""
                base = base_counts(text)
                cleaned, lines, dropped, lost, too_much = clean(text, rules)
                bad = base[0] < rules.min_words or 100 * base[4] > rules.max_repeat_percent * base[0]
                for cell, value in zip(rows, (*base, lines, dropped, lost, bad, not bad and not too_much, cleaned), strict=True):
                    cell.append(value)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(r, schema.field(f.name).type) for r, f in zip(rows, added, strict=True))], schema=schema)

    return docs.mapInArrow(judge, out)
