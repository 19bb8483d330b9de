"""Language identification by unigram pieces, over all spellings of a text.

A public vocabulary is fixed; each language has its own probability of each piece, learned from the vocabulary's
spelling of that language's training words. A text's likelihood in a language is the product of its words', and a word's
is the sum over all ways to spell it by pieces, found by a forward recursion in log space for all languages at once.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from tablewright.llm.common import cut, text_groups

#: Distinct words and characters that a task counts before it spells them, and words and their characters that it keeps weighed.
TASK_WORDS, TASK_CHARS, KEPT_WORDS, KEPT_CHARS = 200_000, 32_000_000, 400_000, 8_000_000
#: Words from this length on are weighed one by one.
LONG = 64
#: Numbers of the model, a piece of a language being one: it is sent to every task.
MODEL_SIZE = 32_000_000
SMOOTH = 0.1
WORD_START, UNKNOWN = "▁", "und"
SPACE = re.compile(r"[\x20\x09-\x0D]+")
LETTER = regex.compile(r"\p{L}")


@lru_cache(maxsize=2)
def _vocabulary(path: str | None):
    import public_tokenizers
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path("piece_bpe_32k.model"))


def is_held_out(doc_id: Column) -> Column:
    """crc32 of the id as text has the remainder 2 by 4; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def predict_languages(docs: DataFrame, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text",
                      lang_col: str = "lang") -> DataFrame:
    """(id_col, held_out, lang_pred, score) of each row: the likeliest language and its share of all languages' likelihood.

    Learned from rows that are not held out and have a text and a language, repeated rows too. A null text, one without
    letters, and any text if there is nothing to learn from is ``und`` with score 0. Equal likelihoods go to the smaller
    name; a language counts as often as its training texts do. An empty table gives an empty table; other columns are
    ignored. ValueError if languages times pieces exceed MODEL_SIZE.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").alias("lang"))
    rows = rows.withColumn("held_out", is_held_out(F.col("id")))
    model = rows.sparkSession.sparkContext.broadcast(learn(rows, vocabulary))
    out = StructType([StructField(id_col, docs.schema[id_col].dataType), StructField("held_out", BooleanType()),
                      StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    return rows.select("id", "held_out", "text").mapInArrow(_predict(model, vocabulary, to_arrow_schema(out)), out)


def learn(rows: DataFrame, vocabulary: str | None = None) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(languages in order, log share of the training texts of each, log probability of each piece in each)."""
    learned = rows.where(~F.col("held_out") & F.col("text").isNotNull() & F.col("lang").isNotNull()).select("lang", "text")
    counts = cut(learned.mapInArrow(lambda found: _count_pieces(found, vocabulary), "lang string, piece int, n long")
                 .groupBy("lang", "piece").agg(F.sum("n").alias("n")), "pieces")
    texts = counts.where("piece = -1")
    size = _vocabulary(vocabulary).get_piece_size()
    if texts.count() * size > MODEL_SIZE:
        raise ValueError(f"more than {MODEL_SIZE // size} languages")
    # At most one row for each language and piece.
    prior = {r.lang: r.n for r in texts.collect()}
    langs = sorted(prior)
    place = {lang: i for i, lang in enumerate(langs)}
    found = counts.where("piece >= 0").toArrow()
    pieces = np.full((size, len(langs)), SMOOTH)
    pieces[found["piece"].to_numpy(), [place[x] for x in found["lang"].to_pylist()]] += found["n"].to_numpy()
    return langs, np.log(np.array([prior[x] for x in langs], float) / max(sum(prior.values()), 1)), np.log(pieces) - np.log(pieces.sum(axis=0))


def words_of(text: str) -> list[str]:
    return [w for w in SPACE.split(text.lower()) if w]


def _count_pieces(found: Iterable[pa.RecordBatch], vocabulary: str | None) -> Iterator[pa.RecordBatch]:
    """How often each language's words have each piece, in the vocabulary's own spelling; its texts as piece -1."""
    model = _vocabulary(vocabulary)
    words: dict[str, Counter] = {}
    texts: Counter = Counter()
    chars = 0

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, counts in words.items():
            total = np.zeros(model.get_piece_size(), np.int64)
            spelled, times = model.encode(list(counts), num_threads=1), np.fromiter(counts.values(), np.int64, len(counts))
            sizes = np.fromiter(map(len, spelled), np.int64, len(spelled))
            np.add.at(total, np.fromiter((i for s in spelled for i in s), np.int64, int(sizes.sum())), np.repeat(times, sizes))
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(used), pa.string()), pa.array(used.astype(np.int32)), pa.array(total[used])],
                                             names=["lang", "piece", "n"])
        words.clear()

    for whole in found:
        for at in range(0, whole.num_rows, 512):
            batch = whole.slice(at, 512)
            langs = batch.column(0).to_pylist()
            texts.update(langs)
            for group in text_groups(batch.column(1).to_pylist(), SPACE):
                for n, part in group:
                    words.setdefault(langs[n], Counter()).update(words_of(part))
                    chars += len(part)
                if sum(map(len, words.values())) > TASK_WORDS or chars > TASK_CHARS:
                    yield from flush()
                    chars = 0
    yield from flush()
    yield pa.RecordBatch.from_arrays([pa.array(list(texts), pa.string()), pa.array([-1] * len(texts), pa.int32()), pa.array(list(texts.values()), pa.int64())],
                                     names=["lang", "piece", "n"])


class Lattice:
    """Log likelihoods of words in all languages; ``scores`` has a row for each piece and a column for each language."""

    def __init__(self, scores: np.ndarray, vocabulary: str | None = None):
        model = _vocabulary(vocabulary)
        self.scores, self.bytes, self.table = scores, np.zeros(256, np.int64), {}
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i)):
                for k in range(1, len(piece)):
                    self.table.setdefault(piece[:k], -1)  # a prefix of pieces
                self.table[piece] = i
        # The prefixes as the nodes of a tree: the edge from a node by a character is one sorted number.
        nodes = {"": 0} | {prefix: n for n, prefix in enumerate(self.table, 1)}
        edges = np.array([nodes[p[:-1]] << 21 | ord(p[-1]) for p in self.table], np.int64)
        order = np.argsort(edges)
        self.edges, self.child = edges[order], order + 1
        self.piece_of = np.array([-1, *self.table.values()], np.int64)

    def _spelled(self, character: str) -> np.ndarray:
        return self.scores[self.bytes[list(character.encode("utf-8", "replace"))]].sum(axis=0)

    def words(self, words: list[str]) -> np.ndarray:
        """A row for each word: all spellings of the word with its start mark."""
        out = np.zeros((len(words), self.scores.shape[1]))
        short = [n for n, w in enumerate(words) if len(w) < LONG]
        step = max(64, 16_384 // max(self.scores.shape[1], 1))
        for at in range(0, len(short), step):
            out[short[at:at + step]] = self._together([WORD_START + words[n] for n in short[at:at + step]])
        for n, w in enumerate(words):
            if len(w) >= LONG:
                out[n] = self._alone(WORD_START + w)
        return out

    def _together(self, texts: list[str]) -> np.ndarray:
        """Short texts position by position: of all texts at once those pieces that start at a place and have one length."""
        sizes = np.array([len(t) for t in texts])
        code = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.int64)
        text, start = np.repeat(np.arange(len(texts)), sizes), np.cumsum(sizes) - sizes
        offset = np.arange(len(code)) - start[text]
        # Pieces by their length: from every place down the tree, as long as it has an edge and the text goes on.
        at, node, pieces, single = np.arange(len(code)), np.zeros(len(code), np.int64), [], np.zeros(len(code), bool)
        while len(at):
            d = len(pieces)
            edge = node << 21 | code[at + d]
            place = np.minimum(np.searchsorted(self.edges, edge), len(self.edges) - 1)
            found = self.edges[place] == edge
            at, node = at[found], self.child[place[found]]
            piece = self.piece_of[node]
            pieces.append((at[piece >= 0], self.scores, piece[piece >= 0]))
            if not d:
                single[at[piece >= 0]] = True
            on = sizes[text[at]] > offset[at] + d + 1
            at, node = at[on], node[on]
        bare = np.flatnonzero(~single)
        kinds, kind = np.unique(code[bare], return_inverse=True)
        in_bytes = np.zeros((len(kinds), self.scores.shape[1]))
        for n, k in enumerate(kinds):
            in_bytes[n] = self._spelled(chr(k))
        steps = [(1, bare, in_bytes, kind)]
        steps += [(d, *arcs) for d, arcs in enumerate(pieces, 1)]
        longest = int(sizes.max())
        ordered = []
        for d, where, table, row in steps:
            order = np.argsort(offset[where], kind="stable")
            ordered.append((d, text[where[order]], table, row[order], np.searchsorted(offset[where[order]], np.arange(longest + 1))))
        alpha = np.full((longest + 1, len(texts), self.scores.shape[1]), -np.inf)
        alpha[0] = 0
        for i in range(longest):
            for d, who, table, row, bounds in ordered:
                part = slice(bounds[i], bounds[i + 1])
                if part.start < part.stop:
                    alpha[i + d, who[part]] = np.logaddexp(alpha[i + d, who[part]], alpha[i, who[part]] + table[row[part]])
        return alpha[sizes, np.arange(len(texts))]

    def _arcs(self, text: str, i: int) -> Iterator[tuple[int, int]]:
        """(end, piece) of the pieces that start at i; end 0: the character has none and is spelled in bytes."""
        single = False
        for j in range(i + 1, len(text) + 1):
            piece = self.table.get(text[i:j])
            if piece is None:
                break
            if piece >= 0:
                single = single or j == i + 1
                yield j, piece
        if not single:
            yield 0, 0

    def _alone(self, text: str) -> np.ndarray:
        """A text of any length, keeping as many places as the longest piece has."""
        ahead = {0: np.zeros(self.scores.shape[1])}
        for i in range(len(text)):
            here = ahead.pop(i, None)
            if here is None:
                continue
            for j, piece in self._arcs(text, i):
                j, more = (j, self.scores[piece]) if j else (i + 1, self._spelled(text[i]))
                ahead[j] = np.logaddexp(ahead[j], here + more) if j in ahead else here + more
        return ahead[len(text)]


def _predict(shared, vocabulary: str | None, schema: pa.Schema):
    def predict(found: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, prior, pieces = shared.value
        lattice, kept, rows, chars = Lattice(pieces, vocabulary), {}, np.zeros((0, len(langs))), 0
        room = min(KEPT_WORDS, 16_000_000 // max(len(langs), 1))
        for whole in found:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                texts = [t or "" for t in batch.column(2).to_pylist()]
                total, letters = np.tile(prior, (len(texts), 1)), np.zeros(len(texts), bool)
                for group in text_groups(texts, SPACE):
                    if len(kept) > room or chars > KEPT_CHARS:
                        kept, rows, chars = {}, rows[:0], 0
                    split = [(n, words_of(part)) for n, part in group]
                    new = list(dict.fromkeys(w for _, words in split for w in words if w not in kept)) if langs else []
                    if new:
                        kept.update(zip(new, range(len(kept), len(kept) + len(new)), strict=True))
                        rows, chars = np.concatenate([rows, lattice.words(new)]), chars + sum(map(len, new))
                    for (n, words), (_, part) in zip(split, group, strict=True):
                        letters[n] = letters[n] or LETTER.search(part) is not None
                        if langs and words:
                            total[n] += rows[np.fromiter(map(kept.__getitem__, words), np.int64, len(words))].sum(axis=0)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *_verdicts(langs, total, letters)], schema=schema)

    return predict


def _verdicts(langs: list[str], total: np.ndarray, letters: np.ndarray) -> tuple[pa.Array, pa.Array]:
    if not langs:
        return pa.array([UNKNOWN] * len(letters), pa.string()), pa.array(np.zeros(len(letters)))
    best = total.argmax(axis=1)
    share = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
    return (pa.array([langs[b] if known else UNKNOWN for b, known in zip(best, letters, strict=True)], pa.string()),
            pa.array(np.where(letters, share, 0.0)))
