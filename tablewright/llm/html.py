"""Main-text extraction by maximum-scoring subsequence.

A page is a row of tokens: words and tags. Words score by where they stand (running text, a link, furniture such
as a menu or a form), tags by their name; scores are log-likelihood ratios learned from labelled pages, whose
content region is known, so words of content are positive and tags negative. One linear scan finds the
contiguous region of the largest total; furniture inside it is taken out and its blocks are the text.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StringType, StructField, StructType

#: Labelled pages that weights are learned from at most.
LABELLED_PAGES = 4_096
#: Score of a word and a tag without any labelled page.
WORD, TAG = 1.0, -3.25
#: No learned score is lower: what no labelled page has inside would else sink with the number of pages.
LEAST = -4.0
#: Elements whose content is never text; that never close; that are furniture of a page; that end a block.
RAW = frozenset("script style noscript template textarea title iframe".split())
#: Elements with markup of their own that is no text; of a formula just the words are taken, each once.
UNREAD, FORMULA = frozenset("svg object annotation annotation-xml".split()), "math"
FOREIGN = frozenset(("svg", FORMULA))
#: Tags of a page that foreign markup can't have, but in these elements of it.
BREAKOUT = frozenset("article main section nav header footer aside blockquote body br center code dd div dl dt em embed figure form h1 h2 h3 h4 "
                     "h5 h6 hr img li menu ol p pre ruby span strong table ul".split())
INTEGRATES = frozenset("foreignobject desc title mi mo mn ms mtext annotation-xml object".split())
WRAPPER_LEVEL, LAYOUT_LEVEL, HARD_LEVEL = 1, 2, 3
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
FURNITURE = frozenset("nav header footer aside form menu dialog button select".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr "
    "ul".split())
#: Elements that a new one of these ends.
CLOSED_BY = {"p": BLOCKS - {"body", "html"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"},
             "th": {"td", "th", "tr"}, "option": {"option"}}
#: Words in a class, id or role that mark furniture.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored sponsoredlink promo promotion banner popup modal overlay "
    "nav navbar navigation menu breadcrumb breadcrumbs sidebar footer masthead toolbar pagination pager "
    "cookie cookies consent gdpr notice notices newsletter subscribe subscription signup login search searchbox "
    "comment comments disqus respond reply replies related recommended recommendations share sharing social widget "
    "complementary contentinfo search dialog alert response responses discussion aside".split())
#: The same, outside content only; and what makes a class speak of something else, as in with-sidebar.
OUTER_MARKS, NEGATIONS = frozenset("header top side".split()), frozenset("has with no without is not".split())
#: Inside content a name marks furniture if it has just such words and these that say nothing of their own; a name with other
#: words, as in related-work, or of a word that articles use as well is one that links or fields have to bear out.
GENERIC = frozenset("article articles area bar block body bottom box button buttons container content group header heading icon icons inline inner "
                    "item items js label left link links list main more news outer page panel post posts right section site slot stories story "
                    "text title top unit wrap wrapper".split())
AMBIGUOUS = frozenset("dialog discussion response responses search".split())
FIELDS = frozenset("input select textarea button".split())
#: Furniture that may be wrapped around a whole page, by name or by words of a class that speak of its layout.
WRAPPERS, LAYOUT = frozenset(["form"]), frozenset("sidebar nav navbar header top side toolbar banner search overlay modal".split())
_LABEL = re.compile(r"article|main", re.I)
_ARTICLE = re.compile(r"<(?:article|main)[\s/>]", re.I)
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?>[^>\"']+|\"[^\"]*\"|'[^']*')*+)>|([^<]+|<)", re.S)
_BROKEN_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")  # quotes that don't match
_HINTS = re.compile(r"""(?<![\w-])(?:class|id|(role))\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"(?<![\w-])(?:hidden(?![\w-])|aria-hidden\s*=\s*[\"']?true|style\s*=\s*[\"'][^\"']*display\s*:\s*none)", re.I)
_PARTS = re.compile(r"[a-z]+")


@dataclass(frozen=True)
class Token:
    kind: str        # class that carries a score, such as "word", "word:link", "word:furniture", "p", "/p"
    text: str        # of a run of text, else empty
    words: int
    ends_block: bool
    content: bool    # inside the page's own article or main element
    owner: int       # number of that element on the page, also for furniture in it; else 0


def _is_furniture(name: str, attributes: str, in_content: bool, allowed: frozenset = frozenset()) -> bool:
    if name in FURNITURE and not (name == "header" and in_content) and name not in allowed:
        return True
    if name in ("body", "html") or not attributes:
        return False
    marks = (MARKS if in_content else MARKS | OUTER_MARKS) - allowed
    for is_role, parts in _names(attributes):
        sure = marks if is_role or not in_content else marks - AMBIGUOUS if (MARKS | GENERIC).issuperset(parts) else ()
        if parts[0] not in NEGATIONS and not set(sure).isdisjoint(parts):
            return True
    return bool(_HIDDEN.search(attributes))


def _names(attributes: str) -> Iterator[tuple[bool, list[str]]]:
    """(whether it is a role, words) of each class, id and role."""
    for role, *value in _HINTS.findall(attributes):
        for hint in "".join(value).split():
            if parts := _PARTS.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", " ", hint).lower()):
                yield bool(role), parts


def _is_suspect(attributes: str) -> bool:
    """Whether a name inside content has a word of furniture."""
    return bool(attributes) and any(parts[0] not in NEGATIONS and not MARKS.isdisjoint(parts) for _, parts in _names(attributes))


def tokens(page: str) -> list[Token]:
    """The page's tags and runs of text, in order; comments, declarations and raw elements are none.

    An article in a wrapper whose class speaks of layout counts if the page has no other."""
    out = _tokens(page, False)
    if not any(t.content for t in out) and _ARTICLE.search(page):
        out = _tokens(page, True)
    return out


class _Open(list):
    """Open elements: (name, level of furniture in or above, content in or above, owner, "unread" or "formula" in or above).

    Counts each name and keeps, for every element, the place of the nearest one at or above it that ends a paragraph's
    formatting and of the nearest one that foreign markup ends at, so that no depth of elements makes a tag costly.

    Watched elements, from ``watch`` on, are furniture if most of their words are links or if they have a field."""

    def __init__(self):
        super().__init__()
        self.names: Counter = Counter()
        self.block_at, self.foreign_at = [], []
        self.n_words = self.n_links = self.n_fields = 0
        self.watched: list[tuple[int, int, int, int, int]] = []
        self.furniture: list[tuple[int, int]] = []

    def watch(self, at: int) -> None:
        """The element that is pushed next, whose tokens begin at ``at``."""
        self.watched.append((len(self), at, self.n_words, self.n_links, self.n_fields))

    def push(self, element: tuple[str, int, bool, int, str]) -> None:
        name, here = element[0], len(self)
        self.names[name] += 1
        self.block_at.append(here if name in BLOCKS or name in FURNITURE else self.block_at[-1] if here else -1)
        self.foreign_at.append(here if name in INTEGRATES or name in FOREIGN else self.foreign_at[-1] if here else -1)
        self.append(element)

    def cut(self, depth: int, at: int) -> None:
        """Ends all elements from this depth on, before token ``at``."""
        while self.watched and self.watched[-1][0] >= depth:
            _, start, words, links, fields = self.watched.pop()
            if 2 * (self.n_links - links) > self.n_words - words or self.n_fields > fields:
                self.furniture.append((start, at))
        for element in self[depth:]:
            self.names[element[0]] -= 1
        for kept in (self, self.block_at, self.foreign_at):
            del kept[depth:]

    def close(self, name: str, at: int) -> None:
        """Up to the last open element of this name, if there is one."""
        if self.names[name]:
            depth = len(self) - 1
            while self[depth][0] != name:
                depth -= 1
            self.cut(depth, at)


def _tokens(page: str, in_wrapper: bool) -> list[Token]:
    out: list[Token] = []
    stack = _Open()
    at, n, owners = 0, len(page), 0
    while at < n:
        m = _TOKEN.match(page, at)
        if m is None:  # a tag without its end
            break
        at = m.end()
        close, name, attributes, text = m.groups()
        if text == "<" and (m := _BROKEN_TAG.match(page, at - 1)):
            at, (close, name, attributes), text = m.end(), m.groups(), None
        level, content, owner, foreign = stack[-1][1:] if stack else (0, False, 0, "")
        if text is not None:
            if foreign != "unread":
                text = entities.unescape(text)
                count = len(text.split())
                kind = "word:furniture" if level else "word:link" if any(s[0] == "a" for s in stack[-4:]) else "word"
                stack.n_words += count
                stack.n_links += count if kind == "word:link" else 0
                out.append(Token(kind, text, count, False, content, owner))
            continue
        if name is None:
            continue
        name = name.lower()
        if close:
            stack.close(name, len(out))
            if not (stack and stack[-1][4]) and name not in UNREAD and name not in FOREIGN:
                out.append(Token("/" + name, "", 0, name in BLOCKS, content, owner))
            continue
        if foreign and name in BREAKOUT:  # markup that was never closed ends where the page's own goes on
            depth = stack.foreign_at[-1]
            if depth >= 0 and stack[depth][0] not in INTEGRATES:
                stack.cut(depth, len(out))
        while stack and name in CLOSED_BY.get(stack[-1][0], ()):
            stack.cut(len(stack) - 1, len(out))
        if name in BLOCKS and stack:  # formatting that was never closed ends with its block's paragraph
            depth = stack.block_at[-1]
            if depth >= 0 and stack[depth][0] == "p" and name in CLOSED_BY["p"]:
                stack.cut(depth, len(out))
        level, content, owner, foreign = stack[-1][1:] if stack else (0, False, 0, "")
        if not foreign and name != FORMULA:
            out.append(Token(name, "", 0, name in BLOCKS, content, owner))
        stack.n_fields += name in FIELDS
        closed = name in VOID or attributes.rstrip().endswith("/")
        if name in RAW and not (foreign and closed):
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)[^>]*>?", re.I).search(page, at)
            at = end.end() if end else n
        elif not closed:
            own = 0 if foreign else _level(name, attributes, content)
            if not owner and _LABEL.fullmatch(name) and level <= (LAYOUT_LEVEL if in_wrapper or name == "main" else WRAPPER_LEVEL):
                level = 0
            level = max(level, own)
            content = not level and (content or bool(_LABEL.fullmatch(name)))
            if content and not owner:
                owners += 1
                owner = owners
            foreign = "unread" if foreign == "unread" or name in UNREAD else "formula" if foreign or name == FORMULA else ""
            if content and _is_suspect(attributes):
                stack.watch(len(out))
            stack.push((name, level, content, owner, foreign))
    stack.cut(0, len(out))
    done = 0
    for start, end in sorted(stack.furniture):
        for i in range(max(start, done), end):
            out[i] = replace(out[i], kind="word:furniture" if out[i].text else out[i].kind, content=False)
        done = max(done, end)
    return out


def _level(name: str, attributes: str, in_content: bool) -> int:
    """0: no furniture; WRAPPER_LEVEL, LAYOUT_LEVEL: may be around a page's article by its name, by its class; HARD_LEVEL."""
    if not _is_furniture(name, attributes, in_content):
        return 0
    if not _is_furniture(name, attributes, in_content, WRAPPERS):
        return WRAPPER_LEVEL
    return HARD_LEVEL if _is_furniture(name, attributes, in_content, WRAPPERS | LAYOUT) else LAYOUT_LEVEL


def learned(counts: Iterable[tuple[str, bool, int]]) -> dict[str, float]:
    """Scores from (kind, inside content, number): log-likelihood ratios, smoothed; words of content stay positive
    and tags negative."""
    inside, outside = Counter(), Counter()
    for kind, content, n in counts:
        (inside if content else outside)[kind] += n
    if not inside:
        return {}
    kinds = set(inside) | set(outside)
    a, b = sum(inside.values()) + len(kinds), sum(outside.values()) + len(kinds)
    scores = {k: math.log((inside[k] + 1) / a) - math.log((outside[k] + 1) / b) for k in kinds}
    return {k: min(max(s, 0.05), 4.0) if k == "word" else max(min(s, -0.05), LEAST) for k, s in scores.items()}


def best_region(scores: list[float]) -> tuple[int, int]:
    """[start, end) of the contiguous run with the largest sum, the first and longest of several; empty if none is positive."""
    best, region, total, start = 0.0, (0, 0), 0.0, 0
    for i, score in enumerate(scores):
        if total < 0:
            total, start = 0.0, i
        total += score
        if total > best or (total == best and best > 0 and region[0] == start):
            best, region = total, (start, i + 1)
    return region


def main_text(page: str | None, scores: dict[str, float]) -> str:
    """Blocks of the best region, without furniture, joined by two line ends."""
    row = tokens(page or "")
    default = {"word": scores.get("word", WORD), "word:link": scores.get("word:link", -0.5), "word:furniture": scores.get("word:furniture", -2.0)}
    # Furniture in the article neither counts against its two sides nor parts them.
    start, end = best_region([0.0 if t.owner and not t.content else default[t.kind] * t.words if t.kind in default
                              else scores.get(t.kind, TAG) for t in row])
    # The region's first and last block are taken whole: a heading of few words costs its tags more than it scores.
    first = next((t for t in row[start:end] if t.kind == "word" and t.words), None)
    last = next((t for t in reversed(row[start:end]) if t.content), first)
    owned = first is not None and first.content
    while start and (row[start - 1].owner == first.owner if owned else not (row[start - 1].ends_block or row[start - 1].kind == "word:furniture")):
        start -= 1
    while end < len(row) and (row[end].owner == last.owner if owned else not (row[end].ends_block or row[end].kind == "word:furniture")):
        end += 1
    blocks, block = [], []
    for t in row[start:end]:
        if t.ends_block:
            blocks.append("".join(block))
            block = []
        elif t.text and t.kind != "word:furniture" and (t.content or not owned):
            block.append(t.text)
        elif t.kind in ("br", "td", "th"):
            block.append(" ")
    blocks.append("".join(block))
    return "\n\n".join(b for b in (" ".join(b.split()) for b in blocks) if b)


def learn(pages: DataFrame, html_col: str = "html", labelled: int = LABELLED_PAGES) -> dict[str, float]:
    """Scores learned from at most about ``labelled`` pages that mark their content by article or main elements."""
    marked = pages.select(F.col(f"`{html_col}`").alias("html")).where(F.col("html").rlike("(?i)<(article|main)[ >]"))
    n = marked.count()
    if n == 0:
        return {}
    picked = marked.where(F.pmod(F.xxhash64("html"), F.lit(1 << 20)) <= int(min(1.0, labelled / n) * (1 << 20)))

    def count(found: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in found:
            for page in batch.column(0).to_pylist():
                for t in tokens(page):
                    kind = t.kind if t.kind.startswith("word") or t.kind.strip("/") in KNOWN else "other"
                    seen[kind, t.content and t.kind != "word:furniture"] += t.words if t.kind.startswith("word") else 1
        rows = [(k, c, n) for (k, c), n in seen.items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.bool_(), pa.int64()))],
                                         names=["kind", "content", "n"])

    # Kinds are words, known elements and one for all others: a few hundred rows.
    totals = picked.mapInArrow(count, "kind string, content boolean, n long").groupBy("kind", "content").agg(F.sum("n").alias("n"))
    return learned([(r.kind, r.content, r.n) for r in totals.collect()])


KNOWN = BLOCKS | RAW | UNREAD | VOID | FURNITURE | frozenset(
    "a abbr b bdi bdo big cite code data del dfn em font head i ins kbd label mark output q s samp small span strike strong sub sup time "
    "tt u var".split())


def extract(pages: DataFrame, scores: dict[str, float] | None = None, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """(id_col, url_col, text) of each row; scores are learned from the table's own labelled pages if not given.

    A null or empty page has an empty text. Each row is extracted for itself, repeated rows and null ids too; an
    empty table gives an empty table. Other columns are ignored.
    """
    scores = learn(pages, html_col) if scores is None else scores
    rows = pages.select(F.col(f"`{id_col}`"), F.col(f"`{url_col}`"), F.col(f"`{html_col}`").alias("html_"))
    out = StructType([*rows.schema.fields[:2], StructField("text", StringType())])
    schema = to_arrow_schema(out)

    def read(found: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            texts = [main_text(p, scores) for p in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], schema=schema)

    return rows.mapInArrow(read, out)

