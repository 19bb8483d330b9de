"""URL filter: a sort-merge range join of reversed-host keys with a stack of nested rules.

A host is turned round (``a.b.org`` becomes ``org.b.a.``), so a rule's host and all its subdomains are
one interval of keys. Urls are dealt by range of (key, url), so a hot host spreads over many ranges;
each rule goes to every range its interval meets. Within a range one sorted sweep keeps the rules whose
intervals are open on a stack and tests their paths, innermost host first.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StringType, StructField, StructType

from tablewright.llm.common import batches, cut, lower_ascii, own_columns

#: Sorts after every key that continues a prefix.
LAST = "\U0010ffff"


def host_of(url: Column) -> Column:
    """Text between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(lower_ascii(F.regexp_extract(_rest(url), r"^[^/?#]*", 0)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def _key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def filter_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id",
                url_col: str = "url") -> DataFrame:
    """Judge every row's url: (id, host, path, rule, verdict).

    ``rules`` has host, path and verdict. A rule fits its host and all subdomains if the url's path starts
    with the rule's; of several the longest (host and path together) wins, then the longer host; of equal
    rules with different verdicts ``block`` wins. Without a rule the verdict is ``default``.

    A null url, or one without ``://``, has an empty host and path and fits no rule. Rows stay one each,
    repeated or with a null id too. Rules with a null or an empty host are left out. Other columns are ignored.
    """
    pages = own_columns(pages, id_col, url_col).select(
        F.col(f"`{id_col}`").alias("id"), host_of(F.col(f"`{url_col}`")).alias("host"),
        path_of(F.col(f"`{url_col}`")).alias("path"))
    urls = cut(pages.withColumn("key", _key(F.col("host")))
               .repartitionByRange("key", "path", "id")
               .sortWithinPartitions("key")
               .withColumn("part", F.spark_partition_id()), "urls")
    # One row for each partition, whatever the table's size.
    bounds = sorted((r.low, r.high, r.part) for r in
                    urls.groupBy("part").agg(F.min("key").alias("low"), F.max("key").alias("high")).collect())
    kept = own_columns(rules, "host", "path", "verdict").where(
        "host is not null and host != '' and path is not null and verdict is not null")
    kept = (kept.select(lower_ascii(F.col("host")).alias("host"), "path", "verdict")
            .groupBy("host", "path").agg(F.max(F.when(F.col("verdict") == "block", 1).otherwise(0)).alias("blocks"),
                                         F.min("verdict").alias("least"))
            .select("host", "path", F.when(F.col("blocks") == 1, "block").otherwise(F.col("least")).alias("verdict"),
                    _key(F.col("host")).alias("key")))
    placed = kept.mapInArrow(_placer(bounds), "part int, host string, path string, verdict string, key string")
    both = urls.select("part", "key", F.lit(1).alias("kind"), "id", "host", "path", F.lit(None).cast("string").alias("verdict"))
    both = both.unionByName(placed.withColumn("kind", F.lit(0)), allowMissingColumns=True)
    out = StructType([StructField(id_col, pages.schema["id"].dataType)]
                     + [StructField(n, StringType()) for n in ("host", "path", "rule", "verdict")])
    return (both.repartition("part").sortWithinPartitions("part", "key", "kind")
            .mapInArrow(_sweeper(default, to_arrow_schema(out)), out))


def _placer(bounds: list[tuple[str, str, int]]):
    """Copies each rule into the ranges its interval of keys meets."""
    lows, highs = [b[0] for b in bounds], [b[1] for b in bounds]

    def place(found: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("part", pa.int32())] + [(n, pa.string()) for n in ("host", "path", "verdict", "key")])
        rows = ((bounds[i][2], r["host"], r["path"], r["verdict"], r["key"]) for b in found for r in b.to_pylist()
                for i in range(bisect_left(highs, r["key"]), bisect_right(lows, r["key"] + LAST)))
        yield from batches(rows, schema)

    return place


def _sweeper(default: str, schema: pa.Schema):
    def judged(found: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        part, stack = None, []  # stack: (key prefix, host, path -> verdict, path lengths, longest first)
        for batch in found:
            for part_, key, kind, id_, host, path, verdict in zip(
                    *(batch.column(n).to_pylist() for n in ("part", "key", "kind", "id", "host", "path", "verdict")),
                    strict=True):
                if part_ != part:
                    part, stack = part_, []
                while stack and not key.startswith(stack[-1][0]):
                    stack.pop()
                if kind == 0:
                    if not stack or stack[-1][0] != key:
                        stack.append((key, host, {}, []))
                    stack[-1][2][path] = verdict
                    if len(path) not in stack[-1][3]:
                        stack[-1][3].append(len(path))
                        stack[-1][3].sort(reverse=True)
                    continue
                best = (-1, -1, None, default)
                for _, rule_host, paths, lengths in stack:
                    for n in lengths:
                        if n <= len(path) and (hit := paths.get(path[:n])):
                            best = max(best, (len(rule_host) + n, len(rule_host), rule_host + path[:n], hit))
                            break
                yield id_, host, path, best[2], best[3]

    return lambda found: batches(judged(found), schema)
