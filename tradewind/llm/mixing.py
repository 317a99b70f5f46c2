"""Mixing sources to target weights by Poisson replication. DataFrame functions only.

Each source gets the mean repetition rate that brings its expected share to its target weight. A document's
count inverts the Poisson distribution of that mean at a uniform number hashed from seed and id; documents
are exploded by their counts and shuffled globally by a hash of seed, id and copy.

Defined results: rows with equal ids get equal counts; a null source is a source of its own (weighted by
the key None); sources without a weight get weight 0 when weights are given; weights that sum to 0 are refused; a null id is hashed as the
word null; an empty table gives an empty result; a column of the input named like the copy column is replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import stored

#: The table of sources is broadcast up to this many rows and joined by shuffle beyond; the result is the same.
BROADCAST_ROWS = 100_000
SALTS = 64


def uniform(seed: int, id_col: Column) -> Column:
    """A number in [0, 1) from the first 12 hexadecimal digits of an md5."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("null")))
    return F.conv(F.left(F.md5(text.cast("binary")), F.lit(12)), 16, 10).cast("double") / float(16**12)


def poisson(mean: Column, u: Column) -> Column:
    """The Poisson number of the given mean at ``u``: how many of the distribution function's steps lie at or below it.

    Logarithms keep large means from underflow; the sequence ends far beyond where a 48-bit ``u`` can reach.
    """
    last = F.ceil(mean + 9 * F.sqrt(mean) + 24).cast("int")
    first = F.exp(-mean)
    start = F.struct((-mean).alias("log_p"), first.alias("below"), (first <= u).cast("int").alias("n"))

    def add(state: Column, k: Column) -> Column:
        log_p = state["log_p"] + F.log(mean / k)
        below = state["below"] + F.exp(log_p)
        return F.struct(log_p.alias("log_p"), below.alias("below"), (state["n"] + (below <= u).cast("int")).alias("n"))

    drawn = F.aggregate(F.sequence(F.lit(1), last), start, add, lambda s: s["n"])
    return F.when(mean > 0, drawn).otherwise(0)


def source_means(docs: DataFrame, source_col: str, weights: dict[str | None, float] | None, size: float | None = None) -> DataFrame:
    """(source, mean) of every source. Weights default to equal ones; ``size`` is the expected rows out, as many as in by default."""
    counts = stored(docs.groupBy(F.col(source_col).alias("source")).agg(F.count("*").alias("n")), "source-counts")
    totals = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("k")).first()
    if weights is None:
        share = F.lit(1.0 / max(totals.k, 1))
    else:
        total = math.fsum(weights.values())
        if not total > 0 or min(weights.values()) < 0:
            raise ValueError("weights must not be negative, and one must be above 0")
        share = F.lit(float(weights.get(None, 0.0)) / total)
        named = [x for kv in weights.items() if kv[0] is not None for x in (F.lit(kv[0]), F.lit(kv[1] / total))]
        if named:
            share = F.when(F.col("source").isNull(), share).otherwise(F.coalesce(F.element_at(F.create_map(*named), F.col("source")), F.lit(0.0)))
    mean = share * float(size if size is not None else totals.n) / F.col("n")
    return counts.select("source", mean.alias("mean"))


def mix(
    docs: DataFrame,
    weights: dict[str | None, float] | None = None,
    id_col: str = "doc_id",
    source_col: str = "source",
    seed: int = 20,
    size: float | None = None,
    copy_col: str = "copy",
) -> DataFrame:
    """``docs`` with each row as often as drawn, numbered from 1 in ``copy_col``, in shuffled order."""
    kept = [c for c in docs.columns if c != copy_col]
    rows = docs.select(F.struct(*kept).alias("row"), F.col(id_col).alias("id"), F.col(source_col).alias("of"))
    means = source_means(docs, source_col, weights, size)
    if means.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        placed = rows.join(F.broadcast(means), F.col("of").eqNullSafe(F.col("source")))
    else:  # a hot source is spread over salts
        salted = means.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        placed = rows.withColumn("own_salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
        placed = placed.join(salted, F.col("of").eqNullSafe(F.col("source")) & (F.col("own_salt") == F.col("salt")))
    drawn = placed.withColumn("n", poisson(F.col("mean"), uniform(seed, F.col("id")))).where("n > 0")
    copies = drawn.select("row", "id", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy"))
    order = F.xxhash64(F.lit(seed), F.col("id"), F.col("copy"))
    shuffled = copies.repartition(order).sortWithinPartitions(order, "id", "copy")
    return shuffled.select("row.*", F.col("copy").alias(copy_col))
