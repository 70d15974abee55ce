"""Mixing sources to target weights by Poisson replication.

A source's rate is its target share of the wanted rows over its own rows. Each document draws a
uniform number from a hash of (seed, doc_id), inverts the Poisson distribution of its source's
rate, and occurs that many times; a hash of (seed, doc_id, copy) shuffles the result globally.

The null source is a source of its own. A source without a target weight gets none of the mix;
weights need not add up to 1. Repeated rows draw the same count. An empty table gives an empty
result. Added columns replace clashing ones.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from ordermill.llm.common import key_bits, stored, whole_row

#: Sources up to which their table (a rate and its distribution each) is broadcast; beyond, a plain join.
BROADCAST_SOURCES = 1000
#: Exponent of the default target weights: 0 mixes sources evenly, 1 keeps their sizes.
SMOOTHING = 0.5
SEED = "mix-1"


@F.pandas_udf(ArrayType(DoubleType()))
def poisson_cdf(rate: pd.Series) -> pd.Series:
    """P(count <= k) for k = 0, 1, ... up to where it is 1 in double precision; empty for rate 0."""
    def one(r: float) -> np.ndarray:
        if not r > 0:
            return np.zeros(0)
        top = int(r + 14 * math.sqrt(r) + 30)
        return np.cumsum([math.exp(k * math.log(r) - r - math.lgamma(k + 1)) for k in range(top)])

    return rate.map(one)


def uniform(seed: str, *parts: Column) -> Column:
    """A number in [0, 1) from a hash of the parts."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("-")) for p in parts])
    return key_bits(text, f"{seed}:") / F.lit(float(1 << 60))


def rates(docs: DataFrame, weights: dict[str | None, float] | None = None, rows: float | None = None) -> DataFrame:
    """(source, n, rate), stored: target weights default to size ** SMOOTHING, wanted rows to the rows there are."""
    sizes = stored(docs.groupBy("source").agg(F.count(F.lit(1)).alias("n")), "sources")
    if weights is None:
        weighted = sizes.withColumn("w", F.pow(F.col("n").cast("double"), F.lit(SMOOTHING)))
    else:
        if any(w < 0 for w in weights.values()):
            raise ValueError("weights must not be negative")
        target = docs.sparkSession.createDataFrame(list(weights.items()), "source string, w double")
        weighted = (sizes.alias("s").join(target.alias("t"), F.col("s.source").eqNullSafe(F.col("t.source")))
                    .select("s.source", "n", "w"))
    weight = float(weighted.agg(F.sum("w")).first()[0] or 0)
    wanted = float(rows) if rows is not None else float(sizes.agg(F.sum("n")).first()[0] or 0)
    share = F.col("w") / F.lit(weight) if weight else F.lit(0.0)
    return weighted.select("source", "n", (share * F.lit(wanted) / F.col("n")).alias("rate"))


def mix(docs: DataFrame, weights: dict[str | None, float] | None = None, rows: float | None = None,
        seed: str = SEED) -> DataFrame:
    """``docs`` with rows repeated or left out by their source's rate, shuffled; adds ``rate`` and ``copy`` (from 0)."""
    docs = docs.drop("rate", "copy")
    known = stored(rates(docs, weights, rows).withColumn("cdf", poisson_cdf("rate"))
                   .select(F.col("source").alias("of"), "rate", "cdf"), "rates")
    few = known.count() <= BROADCAST_SOURCES
    # the documents travel as one column, so that no name of theirs meets one of these
    whole = docs.select(whole_row(docs), "source", "doc_id")
    joined = whole.join(F.broadcast(known) if few else known, F.col("source").eqNullSafe(F.col("of")))
    drawn = joined.withColumn("u", uniform(seed, F.col("doc_id")))
    copies = F.size(F.filter("cdf", lambda c: c <= F.col("u")))
    copied = (drawn.withColumn("copies", copies).where("copies > 0")
              .withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1))))
    place = uniform(f"{seed}:place", F.col("doc_id"), F.col("copy"))
    return copied.withColumn("place", place).repartition("place").sortWithinPartitions("place").select("row.*", "rate", "copy")
