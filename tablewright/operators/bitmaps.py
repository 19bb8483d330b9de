"""A bitmap of hashes: lets a scan leave out nearly all rows that a join would drop, before they are shuffled."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.tables import materialize

#: 64-bit words of a bitmap: 8 KB at least, 8 MB at most, whatever number of hashes it holds.
LEAST_WORDS, MOST_WORDS = 1 << 10, 1 << 20
#: Bits for each hash, as long as the bitmap may grow.
BITS = 16


@dataclass(frozen=True)
class Bitmap:
    """One row with an array of words, read by every task as a subquery's value."""

    words: int
    table: DataFrame

    def may_hold(self, hashed: Column) -> Column:
        """True for every hash of the bitmap and, the fuller it is, for others as well."""
        word = F.element_at(self.table.scalar(), (_word(hashed, self.words) + 1).cast("int"))
        return F.call_function("shiftrightunsigned", word, _bit(hashed)).bitwiseAND(F.lit(1).cast("long")) == 1


def _word(hashed: Column, words: int) -> Column:
    return F.pmod(F.call_function("shiftright", hashed, F.lit(6)), F.lit(words).cast("long"))


def _bit(hashed: Column) -> Column:
    return F.pmod(hashed, F.lit(64).cast("long")).cast("int")


def bitmap_of(hashes: DataFrame, column: str) -> Bitmap | None:
    """The bitmap of a written table of 64-bit hashes, None if there are none."""
    n = hashes.count()
    if not n:
        return None
    words = LEAST_WORDS
    while words < MOST_WORDS and words * 64 < n * BITS:
        words *= 2
    hashed = F.col(column)
    bits = F.call_function("shiftleft", F.lit(1).cast("long"), _bit(hashed))
    seen = hashes.select(_word(hashed, words).alias("word"), bits.alias("bits")).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    every = hashes.sparkSession.range(words).withColumnRenamed("id", "word").join(seen, "word", "left")
    listed = F.sort_array(F.collect_list(F.struct("word", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))))
    return Bitmap(words, materialize(every.agg(F.transform(listed, lambda w: w["bits"]).alias("words")), "bitmap"))
