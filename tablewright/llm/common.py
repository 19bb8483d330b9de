"""What the operators share: tables, durable intermediate tables, text helpers."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster shares; a local session without that setting (tests) gets its own."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="tablewright-llm-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def cut(df: DataFrame, label: str) -> DataFrame:
    """Write a table once into the shared folder and read it back.

    Cuts lineage, survives lost executors, and gives the planner the table's real size, so that
    Spark itself broadcasts it only below its own byte threshold.
    """
    path = f"{shared_folder(df.sparkSession)}/tablewright-llm/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lower_ascii(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def own_columns(df: DataFrame, *names: str) -> DataFrame:
    """Just these columns, so that no further column can clash with what an operator adds."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def batches(rows: Iterator[dict] | Iterator[tuple], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches of bounded length."""
    names, block = schema.names, []
    for row in rows:
        block.append(row)
        if len(block) >= size:
            yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in block], schema=schema)
            block = []
    if block:
        yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in block], schema=schema)


#: 64-bit words of a bitmap: half a megabyte, whatever number of keys it has seen.
BITMAP_WORDS = 1 << 16


def bitmap(keys: DataFrame, *columns: str) -> DataFrame:
    """One row: a bitmap of fixed size of the keys' hashes. It lets a scan leave out most rows that a join would
    drop, before they are shuffled; with very many keys it lets all through."""
    place = _place(*columns)
    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(place, F.lit(64)).cast("int"))
    seen = keys.select(F.floor(place / 64).cast("long").alias("word"), one.alias("bits")).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    every = keys.sparkSession.range(BITMAP_WORDS).withColumnRenamed("id", "word").join(seen, "word", "left")
    words = F.sort_array(F.collect_list(F.struct("word", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))))
    return cut(every.agg(F.transform(words, lambda w: w["bits"]).alias("bitmap")), "bitmap")


def _place(*columns: str) -> Column:
    return F.pmod(F.xxhash64(*columns, F.lit("bitmap")), F.lit(64 * BITMAP_WORDS))


def maybe_in(found: DataFrame, *columns: str) -> Column:
    """False only for rows whose key the bitmap has not seen."""
    place = _place(*columns)
    word = F.element_at(found.scalar(), F.floor(place / 64).cast("int") + 1)
    return F.call_function("shiftrightunsigned", word, F.pmod(place, F.lit(64)).cast("int")).bitwiseAND(F.lit(1).cast("long")) == 1


def text_groups(texts: Iterable[str], gap: re.Pattern, size: int = 1 << 20) -> Iterator[list[tuple[int, str]]]:
    """(number of the text, part of it) in groups of about ``size`` characters. Longer texts are cut at gaps, and what
    the gap matches is left out; a stretch without any gap stays whole."""
    group, held = [], 0
    for number, text in enumerate(texts):
        at = 0
        while True:
            found = gap.search(text, at + size) if len(text) - at > size else None
            part = text[at:found.start() if found else len(text)]
            if held and held + len(part) > size:
                yield group
                group, held = [], 0
            group.append((number, part))
            held += len(part)
            if not found:
                break
            at = found.end()
    if group:
        yield group
