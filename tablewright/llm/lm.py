"""Language-model scores from a subword lattice.

The pieces of an existing vocabulary get unigram scores from the training words; a text's probability is the
sum over all ways to spell its words by pieces, found by a forward recursion over each word in log space. Next to
it stands a plain word model with add-one smoothing. Both count over the whole training part of the corpus.

Each distinct word's likelihood is worked out once. Frequent words (a bounded number of bounded length) are known to
every task; a rare word's count and likelihood come by a join.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from tablewright.llm.common import cut

#: Words known to every task, and the most bytes that such a word can have.
HOT_WORDS, HOT_BYTES = 200_000, 48
#: Distinct words a task counts before it hands them on.
TASK_WORDS = 400_000
WORD_START, END_PIECE = "▁", 2


@lru_cache(maxsize=2)
def _vocabulary(path: str | None):
    import public_tokenizers
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path("piece_bpe_32k.model"))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").lower().split()


class Lattice:
    """Log likelihood of words under unigram scores (natural logarithms) of all pieces."""

    def __init__(self, scores: np.ndarray, vocabulary: str | None = None):
        model = _vocabulary(vocabulary)
        self.byte, self.table = [0.0] * 256, {}
        for i, score in enumerate(scores.tolist()):
            if model.is_byte(i):
                self.byte[int(model.id_to_piece(i)[3:5], 16)] = score
            elif not (model.is_control(i) or model.is_unknown(i)):
                piece = model.id_to_piece(i)
                for k in range(1, len(piece)):
                    self.table.setdefault(piece[:k], None)  # a prefix of pieces
                self.table[piece] = score
        self.end = float(scores[END_PIECE])

    def word(self, word: str) -> float:
        """All segmentations of the word with its start mark; a character without a piece is spelled in bytes."""
        return self._forward(WORD_START + word)

    def _forward(self, text: str) -> float:
        n, table, nothing = len(text), self.table, -math.inf
        alpha = [nothing] * (n + 1)
        alpha[0] = 0.0
        for i in range(n):
            a = alpha[i]
            if a == nothing:
                continue
            single = False
            for j in range(i + 1, n + 1):
                score = table.get(text[i:j], False)
                if score is False:
                    break
                if score is not None:
                    single = single or j == i + 1
                    v, b = a + score, alpha[j]
                    if b == nothing:
                        alpha[j] = v
                    else:
                        alpha[j] = v + math.log1p(math.exp(b - v)) if v > b else b + math.log1p(math.exp(v - b))
            if not single:
                v, b = a + sum(self.byte[x] for x in text[i].encode("utf-8")), alpha[i + 1]
                alpha[i + 1] = float(np.logaddexp(v, b))
        return alpha[n]


def is_held_out(doc_id: Column) -> Column:
    """crc32 of the id as text has the remainder 2 by 7; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 7 == 2


def score_documents(docs: DataFrame, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, held_out, n_tokens, n_known, train_tokens, base_score, score) of each row.

    Tokens are the words with A-Z lower-cased, then one end. ``score`` is the log10 probability of the text by
    the subword model, ``base_score`` by the word model. Null and empty texts are an end alone. Every row is
    scored and counted for itself, repeated rows and null ids too; an empty table gives an empty table.
    Other columns are ignored.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).withColumn("held_out", is_held_out(F.col("id")))
    words = cut(rows.select("text", "held_out").mapInArrow(_count_words, "word string, n long")
                .groupBy("word").agg(F.sum("n").alias("c")), "words")
    totals = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0)).first()
    ends = rows.where(~F.col("held_out")).count()
    n, v = totals[0] + ends, totals[1] + (ends > 0)
    scores = piece_scores(words, ends, vocabulary)
    words = cut(words.mapInArrow(_likelihoods(scores, vocabulary), "word string, c long, likelihood double"), "likelihoods")
    # At most HOT_WORDS rows of at most HOT_BYTES bytes.
    hot = (words.where(F.octet_length("word") <= HOT_BYTES).orderBy(F.desc("c"), "word").limit(HOT_WORDS)).toArrow().to_pydict()
    shared = rows.sparkSession.sparkContext.broadcast(
        {w.encode(): (c, z) for w, c, z in zip(hot["word"], hot["c"], hot["likelihood"], strict=True)})
    spelled = StructType([
        StructField("row", LongType()), rows.schema["id"], StructField("held_out", BooleanType()), StructField("word", StringType()),
        StructField("n", IntegerType()), StructField("n_tokens", LongType()), StructField("n_known", LongType()),
        StructField("base_score", DoubleType()), StructField("score", DoubleType())])
    parts = cut(rows.withColumn("row", F.monotonically_increasing_id()).select("row", "id", "held_out", "text")
                .mapInArrow(_scorer(shared, n, v, ends, float(scores[END_PIECE]), to_arrow_schema(spelled)), spelled), "scores")
    times = F.col("n")
    rare = (parts.where("word is not null").select("row", "word", "n").join(words, "word")
            .groupBy("row").agg(F.sum(times * F.log10((F.col("c") + 1) / float(n + v + 1))).alias("rare_base"),
                                F.sum(times * F.col("likelihood")).alias("rare_score"),
                                F.sum(F.when(F.col("c") > 0, times).otherwise(0)).alias("rare_known")))
    whole = parts.where("word is null").join(rare, "row", "left")
    more = lambda name: F.coalesce(name, F.lit(0))
    return whole.select(F.col("id").alias(id_col), "held_out", "n_tokens", (F.col("n_known") + more("rare_known")).alias("n_known"),
                        F.lit(n).cast("long").alias("train_tokens"), (F.col("base_score") + more("rare_base")).alias("base_score"),
                        ((F.col("score") + more("rare_score")) / math.log(10)).alias("score"))


def _count_words(found: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's words with their training counts; words that only held-out texts have count 0."""
    counts: Counter = Counter()

    def flush() -> Iterator[pa.RecordBatch]:
        words = [w.decode() for w in counts]
        for at in range(0, len(words), 100_000):
            yield pa.RecordBatch.from_arrays(
                [pa.array(words[at:at + 100_000]), pa.array(list(counts.values())[at:at + 100_000], pa.int64())], names=["word", "n"])
        counts.clear()

    for batch in found:
        for text, held_out in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words = words_of(text)
            if held_out:
                counts.update(dict.fromkeys(words, 0))
            else:
                counts.update(words)
            if len(counts) > TASK_WORDS:
                yield from flush()
    yield from flush()


def piece_scores(words: DataFrame, ends: int, vocabulary: str | None = None) -> np.ndarray:
    """Natural log probability of each piece: its share, add-one smoothed, in the vocabulary's own spelling of
    all training words, each as often as it occurs, with one end piece for each text."""
    def spell(found: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _vocabulary(vocabulary)
        total = np.zeros(model.get_piece_size(), np.int64)
        for batch in found:
            spelled = model.encode(batch.column(0).to_pylist(), num_threads=1)
            weights = np.repeat(batch.column(1).to_numpy(), [len(s) for s in spelled])
            ids = np.fromiter((i for s in spelled for i in s), np.int64, len(weights))
            np.add.at(total, ids, weights)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["piece", "n"])

    # At most one row for each piece of the vocabulary.
    counted = (words.where("c > 0").select("word", "c").mapInArrow(spell, "piece long, n long")
               .groupBy("piece").agg(F.sum("n").alias("n")).collect())
    counts = np.ones(_vocabulary(vocabulary).get_piece_size())
    for r in counted:
        counts[r.piece] += r.n
    counts[END_PIECE] += ends
    return np.log(counts) - math.log(counts.sum())


def _likelihoods(scores: np.ndarray, vocabulary: str | None):
    def weigh(found: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(scores, vocabulary)
        for batch in found:
            weights = pa.array([lattice.word(w) for w in batch.column(0).to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, weights], names=["word", "c", "likelihood"])

    return weigh


def _scorer(shared, n: int, v: int, ends: int, end_score: float, schema: pa.Schema):
    """A row with what the frequent words add up to for each document, and one for each of its rare words."""
    def score(found: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, whole = shared.value, math.log10(n + v + 1)
        for batch in found:
            cells: list[list] = [[] for _ in schema]
            for row, id_, held_out, text in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                words = words_of(text)
                base, total, known = math.log10(ends + 1) - whole, end_score, int(ends > 0)
                for word, k in Counter(words).items():
                    if word in hot:
                        c, likelihood = hot[word]
                        base += k * (math.log10(c + 1) - whole)
                        total += k * likelihood
                        known += k * (c > 0)
                    else:
                        for cell, value in zip(cells, (row, None, None, word.decode(), k, None, None, None, None), strict=True):
                            cell.append(value)
                for cell, value in zip(cells, (row, id_, held_out, None, None, len(words) + 1, known, base, total), strict=True):
                    cell.append(value)
                if len(cells[0]) > 50_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cells, schema.types, strict=True)], schema=schema)
                    cells = [[] for _ in schema]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cells, schema.types, strict=True)], schema=schema)

    return score
