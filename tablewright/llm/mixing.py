"""Mixing sources to target weights by Poisson replication, DataFrame functions only.

Each source gets a repetition rate: its target share of the mix over its present size. A document is
repeated as often as the inverse of the Poisson distribution with that mean says at a number in (0, 1)
that is hashed from seed and document. Copies are then ordered by a hash, over all partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import cut

#: Standard deviations covered on each side of the mean by the table of the distribution; beyond: below 1e-30.
SPAN = 12
#: From this rate on the distribution is inverted by its expansion around the normal one, which is then off by less than
#: a thousandth of a copy before rounding.
LARGE = 10_000.0
#: Copies of a document made in one step; more are made piece by piece, in tasks of their own.
PIECE = 1_000

# ---- Fixed values: rational approximation of the normal quantile (P. J. Acklam), relative error below 1.2e-9 ----
_CENTRE_A = (-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02, 1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00)
_CENTRE_B = (-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02, 6.680131188771972e+01, -1.328068155288572e+01, 1.0)
_TAIL_C = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00, -2.549732539343734e+00, 4.374664141464968e+00, 2.938163982698783e+00)
_TAIL_D = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00, 3.754408661907416e+00, 1.0)
_TAIL = 0.02425
# ---- End of fixed values ------------------------------------------------------


def uniform_weights(docs: DataFrame) -> DataFrame:
    """(source, weight): all sources of the table alike."""
    return docs.select("source").distinct().withColumn("weight", F.lit(1.0))


def hash_number(*parts: Column) -> Column:
    """A number in (0, 1) from the first 52 bits of the parts' MD5; nulls count as empty text."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def repetition_rates(docs: DataFrame, weights: DataFrame, epochs: float = 1.0) -> DataFrame:
    """(source, size, weight, rate, low, cdf): size in characters, rate = mean repetitions of a document.

    The rates make the sources' expected characters proportional to ``weight`` and the mix ``epochs`` times
    as long as the input. A source without weight, of weight 0 or below, or without characters gets rate 0.
    ``cdf`` holds P(count <= low), P(count <= low + 1), ...; it is empty for rates above LARGE, which need no table.
    """
    sizes = docs.groupBy("source").agg(F.sum(F.coalesce(F.length("text"), F.lit(0)).cast("long")).alias("size"))
    weights = weights.groupBy("source").agg(F.max("weight").cast("double").alias("weight"))
    named = (sizes.join(weights.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
             .withColumn("weight", F.when((F.col("size") > 0) & (F.col("weight") > 0), F.col("weight")).otherwise(0.0)))
    # One row for each source: a total over them is small.
    total = named.agg(F.sum("weight").alias("all_weight"), F.sum("size").alias("all_size"))
    rated = named.crossJoin(F.broadcast(total)).withColumn(  # one row, by construction
        "rate", F.when(F.col("weight") > 0, F.col("weight") / F.col("all_weight") * F.col("all_size") * float(epochs)
                       / F.col("size")).otherwise(0.0))
    reach, listed = SPAN * F.sqrt("rate") + 20, F.col("rate") <= LARGE
    return (rated.withColumn("low", F.when(listed, F.greatest(F.lit(0.0), F.floor(F.col("rate") - reach))).otherwise(0.0).cast("int"))
            .withColumn("high", F.when(listed, F.ceil(F.col("rate") + reach)).otherwise(0.0).cast("int"))
            .withColumn("cdf", F.when(listed, _cdf(F.col("rate"), F.col("low"), F.col("high"))).otherwise(F.array().cast("array<double>")))
            .select("source", "size", "weight", "rate", "low", "cdf"))


def _polynomial(factors: tuple[float, ...], x: Column) -> Column:
    out = F.lit(factors[0])
    for f in factors[1:]:
        out = out * x + f
    return out


def normal_quantile(u: Column) -> Column:
    """z with P(Z <= z) = u, for u in (0, 1)."""
    centre, tail = u - 0.5, F.sqrt(-2 * F.log(F.least(u, 1 - u)))
    square = centre * centre
    middle = _polynomial(_CENTRE_A, square) * centre / _polynomial(_CENTRE_B, square)
    outer = _polynomial(_TAIL_C, tail) / _polynomial(_TAIL_D, tail)
    return F.when(u < _TAIL, outer).when(u > 1 - _TAIL, -outer).otherwise(middle)


def large_count(rate: Column, u: Column) -> Column:
    """The inverse of the Poisson distribution for large rates: the least count whose probability to be reached is u."""
    z, root = normal_quantile(u), F.sqrt(rate)
    near = rate + root * z + (z * z - 1) / 6 + (z - z * z * z) / (72 * root)
    return F.greatest(F.lit(0).cast("long"), F.ceil(near - 0.5).cast("long"))


def _cdf(rate: Column, low: Column, high: Column) -> Column:
    """P(count <= k) for k from low to high, the first probability taken by logarithms, so large rates stay exact."""
    logs = F.aggregate(F.sequence(F.lit(1), F.greatest(low, F.lit(1))), F.lit(0.0), lambda s, k: s + F.log(k.cast("double")))
    first = F.exp(F.when(low > 0, low * F.log(rate) - logs).otherwise(0.0) - rate)
    start = F.struct(first.alias("p"), F.array(first).alias("cdf"))
    grown = F.aggregate(
        F.when(high > low, F.sequence(low + 1, high)).otherwise(F.array().cast("array<int>")), start,
        lambda s, k: F.struct((s["p"] * rate / k).alias("p"),
                              F.concat(s["cdf"], F.array(F.element_at(s["cdf"], -1) + s["p"] * rate / k)).alias("cdf")))
    return F.when(rate > 0, grown["cdf"]).otherwise(F.array(F.lit(1.0)))


def mix_sources(docs: DataFrame, weights: DataFrame | None = None, epochs: float = 1.0, seed: str = "mix") -> DataFrame:
    """The input's columns, each document repeated by its count, in globally shuffled order.

    ``_copy`` numbers a document's repetitions from 0, ``_rate`` is the source's rate and ``_order`` the
    shuffle key, by which any reader gets the same order again. Without ``weights`` all sources weigh alike.

    Null sources are a source. A null or empty text counts no characters; its repetitions follow its source's
    rate. Rows with equal doc_id repeat alike (their number depends on seed and doc_id alone; a null doc_id is
    an id). A present column named like an added one is replaced. An empty table gives an empty table.
    """
    docs = docs.drop("_copy", "_rate", "_order")
    rates = cut(repetition_rates(docs, uniform_weights(docs) if weights is None else weights, epochs)
                .select(F.col("source").alias("__llm_source"), F.col("rate").alias("_rate"), F.col("low").alias("__llm_low"),
                        F.col("cdf").alias("__llm_cdf")), "rates")
    u = hash_number(F.lit(seed), F.col("doc_id"))
    listed = F.col("__llm_low").cast("long") + F.size(F.filter("__llm_cdf", lambda p: p < u))
    counted = (docs.join(rates, F.col("source").eqNullSafe(F.col("__llm_source")))
               .withColumn("__llm_count", F.when(F.col("_rate") > LARGE, large_count(F.col("_rate"), u)).otherwise(listed))
               .where("__llm_count > 0").drop("__llm_source", "__llm_low", "__llm_cdf"))
    copies = counted.where(F.col("__llm_count") <= PIECE).withColumn(
        "_copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__llm_count") - 1))).drop("__llm_count")
    # Sources that repeat much: a document's copies are made in pieces, dealt out over all tasks.
    if (rates.agg(F.max("_rate")).first()[0] or 0) > PIECE / 2:
        pieces = counted.where(F.col("__llm_count") > PIECE).withColumn(
            "__llm_piece", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("__llm_count") - 1) / PIECE).cast("long"))))
        pieces = pieces.repartition(F.xxhash64("doc_id", "__llm_piece"))
        first = F.col("__llm_piece") * PIECE
        more = F.explode(F.sequence(first, F.least(first + PIECE, F.col("__llm_count")) - 1))
        copies = copies.unionByName(pieces.withColumn("_copy", more).drop("__llm_count", "__llm_piece"))
    order = F.md5(F.concat_ws(":", F.lit(seed), F.lit("order"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
                              F.col("_copy").cast("string")))
    return copies.withColumn("_order", order).orderBy("_order")
