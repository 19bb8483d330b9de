"""How the tokens of two tokenizers lie over each other, text by text and over the corpus.

Rows are shuffled by their full text; each distinct text is tokenised and aligned once, and its pairs of ids count as
often as the text occurs. What is found for a text goes back to all its rows by a join.

Inside a text, a single space between two characters that are no white space starts a token of either tokenizer: A's
pattern begins a word there, and no piece of B has a space but in front. So a task aligns each stretch between such
spaces once as well.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import cut, text_groups

#: Pairs known to every task: those with the highest counts, 17 bytes each.
HOT_PAIRS = 500_000
#: Stretches and their characters that a task keeps aligned (twice as many at most), and pairs that it counts before it
#: hands them on.
KEPT_STRETCHES, KEPT_CHARS, TASK_PAIRS = 100_000, 2_000_000, 1_000_000
GAP = re.compile(r"(?<=\S) (?=\S)")

ALIGNED = ("key binary, copies long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
           "pairs array<long>, times array<long>")
MEASURES = ("n_a", "n_b", "n_groups", "n_links", "groups_sha256")


def align_documents(docs: DataFrame, a_vocabulary: str | None = None, b_vocabulary: str | None = None,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of each row.

    A is a byte-level BPE that encodes a space and the text, B a piece model that adds that space itself. Offsets
    where tokens of both end cut the tokens into groups; a link is a pair of tokens whose byte ranges overlap. A pair of
    ids counts its links over the whole corpus, repeated rows included. Null and empty texts, and those that the
    tokens of A or B do not spell byte by byte, have zeros and ''. Rows with equal texts have equal measures; an empty
    table gives an empty table; other columns are ignored.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    texts = rows.groupBy("text").agg(F.count("*").alias("copies"))
    paths = (a_vocabulary, b_vocabulary)
    aligned = cut(texts.mapInArrow(lambda found: _align(found, paths), ALIGNED), "aligned")
    ranked = cut(pair_counts(aligned, _tokenizers(paths).width), "pairs")
    weighed = cut(aligned.select("key", "pairs", "times").mapInArrow(_weigh(_hot_pairs(ranked)), "key binary, pair long, times long, n_best long, count_sum long"), "weighed")
    rare = (weighed.where("pair is not null").select("key", "pair", "times").join(ranked, "pair")
            .groupBy("key").agg(F.sum(F.when(F.col("top"), F.col("times")).otherwise(0)).alias("more_best"),
                                F.sum(F.col("times") * F.col("n")).alias("more_sum")))
    sums = weighed.where("pair is null").select("key", "n_best", "count_sum").join(rare, "key", "left")
    of_text = aligned.select("key", *MEASURES).join(sums, "key")
    keyed = rows.select("id", F.unhex(F.sha2("text", 256)).alias("key"))
    return keyed.join(of_text, "key").select(
        F.col("id").alias(id_col), *MEASURES[:-1], (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"), "groups_sha256")


def pair_counts(aligned: DataFrame, width: int) -> DataFrame:
    """(pair, n, top): links of each pair of ids in the whole corpus, and whether no pair with that B id has more."""
    counts = cut(aligned.select("copies", "pairs", "times").mapInArrow(_sum_pairs, "pair long, n long")
                 .groupBy("pair").agg(F.sum("n").alias("n")), "pair-counts")
    best = counts.groupBy((F.col("pair") % width).alias("b")).agg(F.max("n").alias("most"))
    return (counts.withColumn("b", F.col("pair") % width).join(best, "b")
            .select("pair", "n", (F.col("n") == F.col("most")).alias("top")))


class Tokenizers:
    """Both tokenizers, the bytes of their entries, and the stretches that this worker has aligned."""

    def __init__(self, a_vocabulary: str | None, b_vocabulary: str | None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import public_tokenizers
        import sentencepiece
        from tokenizers import Tokenizer

        path = a_vocabulary or public_tokenizers.path("byte_bpe_50k.json")
        self.a = Tokenizer.from_file(path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_vocabulary or public_tokenizers.path("piece_bpe_32k.model"))
        self.width = self.b.get_piece_size()
        byte_of = _byte_characters()
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for entry, i in self.a.get_vocab().items():
            self.a_bytes[i] = bytes(byte_of[c] for c in entry) if all(c in byte_of for c in entry) else entry.encode()
        self.b_bytes = [self._piece_bytes(i) for i in range(self.width)]
        self.a_ids = self._quick(path, public_tokenizers.PATTERN) or (
            lambda text: self.a.encode(text, add_special_tokens=False).ids)
        self.a_text, self.b_text = [str(i) for i in range(len(self.a_bytes))], [str(i) for i in range(self.width)]
        self.a_size, self.b_size = np.array(list(map(len, self.a_bytes))), np.array(list(map(len, self.b_bytes)))
        self.young: dict[str, tuple | None] = {}
        self.old: dict[str, tuple | None] = {}
        self.chars = 0

    def _quick(self, path: str, pattern: str):
        """The same encoding by a library that is twice as fast on short texts, if the file's merges are in the order of
        the ids that they make and its words are those of the usual pattern; else None."""
        import tiktoken

        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        plain = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
        merges = [m.split(" ") if isinstance(m, str) else m for m in made["model"]["merges"]]
        vocabulary = made["model"]["vocab"]
        if made["pre_tokenizer"] != plain or made["normalizer"] or [vocabulary[a + b] for a, b in merges] != list(range(256, 256 + len(merges))):
            return None
        ranks = {self.a_bytes[i]: i for i in range(256 + len(merges))}
        return tiktoken.Encoding("from-file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def _piece_bytes(self, i: int) -> bytes:
        if self.b.is_control(i) or self.b.is_unknown(i):
            return b""
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def learn(self, stretches: set[str]) -> dict[str, tuple | None]:
        """A dictionary that holds all these: (tokens of A, of B, groups, linked pairs as bytes, groups as text), None if not spelled."""
        if len(self.young) > KEPT_STRETCHES or self.chars > KEPT_CHARS:
            self.old, self.young, self.chars = self.young, {}, 0
        young, old = self.young, self.old
        new = []
        for s in stretches:
            if s not in young:
                self.chars += len(s)
                if s in old:
                    young[s] = old[s]
                else:
                    new.append(s)
        if new:
            spaced = [" " + s for s in new]
            young.update(zip(new, self.overlays(spaced, list(map(self.a_ids, spaced)), self.b.encode(new, num_threads=1)), strict=True))
        return young

    def overlays(self, texts: list[str], a_ids: list[list[int]], b_ids: list[list[int]]) -> list[tuple | None]:
        """``overlay`` of many texts: laid end to end they are one text, as every text ends a token of both."""
        raws = [t.encode("utf-8", "replace") for t in texts]
        a, b = (np.fromiter(chain.from_iterable(ids), np.int64) for ids in (a_ids, b_ids))
        stop, raw = np.cumsum(list(map(len, raws))), b"".join(raws)
        ends, tokens = [], []
        for ids, flat, sizes, entries in ((a_ids, a, self.a_size, self.a_bytes), (b_ids, b, self.b_size, self.b_bytes)):
            end, token = np.cumsum(sizes[flat]), np.cumsum(list(map(len, ids)))
            if (token[0] == 0 or (np.diff(token) == 0).any() or (end[token - 1] != stop).any()
                    or b"".join(map(entries.__getitem__, flat.tolist())) != raw):
                return [self.overlay(*x) for x in zip(texts, a_ids, b_ids, strict=True)]
            ends.append(end)
            tokens.append(token)
        both = np.union1d(*ends)
        links = (a[np.searchsorted(ends[0], both)] * self.width + b[np.searchsorted(ends[1], both)]).astype(np.int64).tobytes()
        shared = np.intersect1d(*ends, assume_unique=True)
        names_a, names_b = ([names[i] for i in flat.tolist()] for names, flat in ((self.a_text, a), (self.b_text, b)))
        groups, p, r = [], 0, 0
        for q, s in zip((np.searchsorted(ends[0], shared) + 1).tolist(), (np.searchsorted(ends[1], shared) + 1).tolist(), strict=True):
            left = names_a[p] if q - p == 1 else ",".join(names_a[p:q])
            groups.append(f"{left}|{names_b[r]}" if s - r == 1 else f"{left}|{','.join(names_b[r:s])}")
            p, r = q, s
        out, link, group = [], 0, 0
        for n_a, n_b, link_stop, group_stop in zip(map(len, a_ids), map(len, b_ids), (8 * (np.searchsorted(both, stop) + 1)).tolist(),
                                                   (np.searchsorted(shared, stop) + 1).tolist(), strict=True):
            out.append((n_a, n_b, group_stop - group, links[link:link_stop], ";".join(groups[group:group_stop])))
            link, group = link_stop, group_stop
        return out

    def overlay(self, text: str, a: list[int], b: list[int]) -> tuple | None:
        raw, la, lb = text.encode("utf-8", "replace"), self.a_bytes, self.b_bytes
        if b"".join([la[x] for x in a]) != raw or b"".join([lb[x] for x in b]) != raw:
            return None
        links, groups, i, j, a_from, b_from = [], [], 0, 0, 0, 0
        a_end, b_end, whole, width = len(la[a[0]]), len(lb[b[0]]), len(raw), self.width
        while True:
            links.append(a[i] * width + b[j])
            if a_end == b_end:
                groups.append(f"{','.join(map(str, a[a_from:i + 1]))}|{','.join(map(str, b[b_from:j + 1]))}")
                if a_end == whole:
                    return len(a), len(b), len(groups), np.array(links, np.int64).tobytes(), ";".join(groups)
                i, j = i + 1, j + 1
                a_from, b_from = i, j
                a_end, b_end = a_end + len(la[a[i]]), b_end + len(lb[b[j]])
            elif a_end < b_end:
                i += 1
                a_end += len(la[a[i]])
            else:
                j += 1
                b_end += len(lb[b[j]])


def _byte_characters() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: itself if it is printable, else the next
    one from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(0x100 + n): b for n, b in enumerate(others)}


@lru_cache(maxsize=2)
def _tokenizers(paths: tuple[str | None, str | None]) -> Tokenizers:
    return Tokenizers(*paths)


class _Text:
    """What the parts of one text add up to."""

    def __init__(self, spelled: bool):
        self.spelled, self.counts, self.pairs, self.hash = spelled, np.zeros(3, np.int64), [], hashlib.sha256()

    def add(self, entries: list[tuple | None]) -> None:
        if not self.spelled or None in entries:
            self.spelled = False
            return
        n_a, n_b, n_groups, links, groups = zip(*entries, strict=True)
        if self.counts[0]:
            self.hash.update(b";")
        self.counts += (sum(n_a), sum(n_b), sum(n_groups))
        self.hash.update(";".join(groups).encode())
        self.pairs.append(np.unique(np.frombuffer(b"".join(links), np.int64), return_counts=True))

    def measures(self) -> tuple:
        """(n_a, n_b, n_groups, n_links, hash of the groups, distinct pairs, how often each is linked)"""
        if not self.spelled:
            return 0, 0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int64)
        pairs, times = self.pairs[0] if len(self.pairs) == 1 else _summed(*map(np.concatenate, zip(*self.pairs, strict=True)))
        return (*self.counts.tolist(), int(times.sum()), self.hash.hexdigest(), pairs, times)


def _summed(pairs: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs and the sums of their times."""
    distinct, place = np.unique(pairs, return_inverse=True)
    total = np.zeros(len(distinct), np.int64)
    np.add.at(total, place, times)
    return distinct, total


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    starts = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(a) for a in arrays], out=starts[1:])
    return pa.ListArray.from_arrays(pa.array(starts), pa.array(np.concatenate(arrays) if arrays else np.zeros(0, np.int64)))


def _align(found: Iterable[pa.RecordBatch], paths: tuple[str | None, str | None]) -> Iterator[pa.RecordBatch]:
    both = _tokenizers(paths)
    for whole in found:
        for at in range(0, whole.num_rows, 512):
            batch = whole.slice(at, 512)
            texts = batch.column(0).to_pylist()
            held = [_Text(bool(t)) for t in texts]
            for group in text_groups(texts, GAP):
                cutted = [(n, GAP.split(part)) for n, part in group if part]
                known = both.learn(set().union(*(stretches for _, stretches in cutted)))
                for n, stretches in cutted:
                    held[n].add([known[s] for s in stretches])
            measures = list(zip(*(h.measures() for h in held), strict=True))
            keys = [hashlib.sha256(t.encode("utf-8", "replace")).digest() for t in texts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), batch.column(1), *(pa.array(m, pa.int64()) for m in measures[:4]),
                 pa.array(measures[4]), _lists(measures[5]), _lists(measures[6])],
                names=["key", "copies", *MEASURES, "pairs", "times"])


def _sum_pairs(found: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's pairs with their links, each text's as often as the text occurs."""
    pairs, times = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in found:
        lists, copies = batch.column(1), np.repeat(batch.column(0).to_numpy(), np.diff(batch.column(1).offsets.to_numpy()))
        more = batch.column(2).flatten().to_numpy() * copies
        pairs, times = _summed(np.concatenate([pairs, lists.flatten().to_numpy()]), np.concatenate([times, more]))
        if len(pairs) > TASK_PAIRS:
            yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(times)], names=["pair", "n"])
            pairs, times = pairs[:0], times[:0]
    yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(times)], names=["pair", "n"])


def _hot_pairs(ranked: DataFrame):
    """Broadcast (pair, n, top) of the most frequent pairs, sorted by pair: all of a power of two or more that together are
    at most HOT_PAIRS."""
    sizes = ranked.groupBy(F.floor(F.log2("n")).cast("int").alias("power")).count().collect()
    room, least = HOT_PAIRS, 63
    for power, size in sorted(sizes, reverse=True):
        if size > room:
            break
        room, least = room - size, power
    hot = ranked.where(F.floor(F.log2("n")) >= least).toArrow()
    order = np.argsort(hot["pair"].to_numpy())
    return ranked.sparkSession.sparkContext.broadcast(tuple(hot[c].to_numpy()[order] for c in ("pair", "n", "top")))


def _weigh(shared):
    """Of each text what its frequent pairs add up to, and a row for each of its rare pairs."""
    def weigh(found: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n, top = shared.value
        for batch in found:
            keys, rows = batch.column(0), np.diff(batch.column(1).offsets.to_numpy())
            row = np.repeat(np.arange(batch.num_rows), rows)
            pairs, times = batch.column(1).flatten().to_numpy(), batch.column(2).flatten().to_numpy()
            place = np.minimum(np.searchsorted(known, pairs), max(len(known) - 1, 0))
            hot = known[place] == pairs if len(known) else np.zeros(len(pairs), bool)
            best, total = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            if hot.any():
                np.add.at(best, row[hot], times[hot] * top[place[hot]])
                np.add.at(total, row[hot], times[hot] * n[place[hot]])
            names = ["key", "pair", "times", "n_best", "count_sum"]
            none = pa.nulls(batch.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays([keys, none, none, pa.array(best), pa.array(total)], names=names)
            rare = np.flatnonzero(~hot)
            for at in range(0, len(rare), 50_000):
                some = rare[at:at + 50_000]
                none = pa.nulls(len(some), pa.int64())
                yield pa.RecordBatch.from_arrays([keys.take(pa.array(row[some])), pa.array(pairs[some]), pa.array(times[some]), none, none], names=names)

    return weigh
