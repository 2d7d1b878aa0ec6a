"""Mixing sources to target weights by repetition rates.

Sizes are summed per source; targets give each source a rate = target / size. A document is emitted
floor(rate) times, and once more if a draw from its id lies below the rate's fraction. Only the
source totals, a row per source, meet in one place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from coldtrace.llm.common import n_words, small_side, uniform

#: Weights dealt to the sources in order of code points, NULL last.
WEIGHTS = (1, 2, 3)
#: A source is repeated at most so many times.
MOST = 3
SEED = "mix"


def source_targets(
    sized: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST
) -> DataFrame:
    """Per source: words, weight, target and rate.

    The sources share the words of all by weight. A target stops at `most` times its source's
    words, the excess is shared again by weight. With the sources ordered by limit over weight, the
    limited ones come first: each source is tried as the first one that is not.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = W.orderBy(F.asc_nulls_last("source"))
    cycle = F.array(*[F.lit(w) for w in weights])
    limits = totals.withColumn("rank", F.row_number().over(by_name)).select(
        "*",
        F.element_at(cycle, F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).alias("weight"),
        (F.col("source_size") * most).alias("limit"),
    )
    by_ratio = W.orderBy(F.col("limit") / F.col("weight"), "rank")
    everything = W.partitionBy()
    tried = limits.select(
        "*",
        F.sum("source_size").over(everything).alias("all_words"),
        (F.sum("limit").over(by_ratio.rowsBetween(W.unboundedPreceding, -1))).alias("limited"),
        F.sum("weight").over(by_ratio.rowsBetween(0, W.unboundedFollowing)).alias("open_weight"),
    ).withColumn("share", (F.col("all_words") - F.coalesce("limited", F.lit(0))) / F.col("open_weight"))
    fits = F.col("share") * F.col("weight") <= F.col("limit")
    # The first source that fits has the most weight open.
    first = F.max_by("share", F.when(fits, F.col("open_weight"))).over(everything)
    final = tried.withColumn("share", first)
    target = F.least(F.col("limit").cast("double"), F.col("share") * F.col("weight"))
    return final.select(
        "source",
        "source_size",
        "weight",
        F.coalesce(target, F.col("limit").cast("double")).alias("target"),
    ).withColumn(
        "rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    )


def with_copies(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """All columns of `docs` with `__size`, its source's figures and `__copies`.

    A NULL text has no words, a NULL source is a source of its own. Documents without an id draw by
    their text. Rows that repeat draw alike.
    """
    sized = docs.withColumn("__size", n_words(F.col("text")))
    totals = source_targets(sized.select("source", F.col("__size").alias("size")))
    rates = small_side(
        totals.select(
            F.col("source").alias("__source"),
            F.col("source_size").alias("__source_size"),
            F.col("target").alias("__target"),
            F.col("rate").alias("__rate"),
        )
    )
    key = F.coalesce(
        F.col("doc_id").cast("string"), F.concat(F.lit("t"), F.coalesce("text", F.lit("")))
    )
    whole = F.floor("__rate")
    extra = (uniform(key, seed) < F.col("__rate") - whole).cast("long")
    joined = sized.join(rates, sized["source"].eqNullSafe(rates["__source"]), "left")
    return joined.withColumn("__copies", whole + extra).drop("__source")


def mix(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """The mixed documents themselves: every row as often as its copies, columns unchanged."""
    return (
        with_copies(docs, seed)
        .filter(F.col("__copies") > 0)
        .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int"))))
        .select(*docs.columns)
    )
