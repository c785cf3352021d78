"""Mixing sources to target weights by whole and coin-drawn copies of documents.

``source_rates`` adds up the words of each source, shares out the words of the mix
by weight, and derives the source's repetition rate. ``with_copies`` then gives each
document ``floor(rate)`` copies and one more with the probability of the fraction.
The coin is a digest of the document's id and a seed, so reruns agree and any
partitioning gives the same mix.

Single coins miss the target of a source by chance, most where few long documents
hold its words. All ``SEEDS`` seeds are tried for every source in one grouped pass
and the one that comes nearest to the target is kept with the source's rate.

Defined cases: a null text has no words and a null source is a source of its own,
last in order. Documents without words follow the coin like others and add nothing.
Rows that repeat an id share its coin. A source without words has target and rate 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trafficloom.llm.common import stored, word_count

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST = 2.0
SEEDS = 16


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Id, source and words of each document, without its text."""
    return docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size")
    )


def coin(doc_id: Column, seed: int) -> Column:
    """A number in [0, 1) from the id and the seed: 32 of the 128 bits of a digest."""
    digest = F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(f":{seed // 4}")))
    part = F.substring(digest, 1 + 8 * (seed % 4), 8)
    return F.conv(part, 16, 10).cast("long") / F.lit(4294967296.0)


def source_targets(totals: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Targets for rows (source, source_size), one per source.

    The targets are ``least(most * size, level * weight)`` for the level at which they
    add up. In the order of ``most * size / weight``, the sources before some place
    are full and the rest share what these leave; the first place whose own level
    is not above its ratio is that place. The windows run over one row per source.
    """
    cycle = F.array(*(F.lit(float(w)) for w in weights))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(by_name) - 1) % len(weights)
    ranked = totals.select(
        "source",
        "source_size",
        (F.lit(float(most)) * F.col("source_size")).alias("full"),
        F.get(cycle, place).alias("weight"),
    ).withColumn("ratio", F.col("full") / F.col("weight"))
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rest = F.lit(float(share)) * F.sum("source_size").over(everything) - F.coalesce(F.sum("full").over(before), F.lit(0.0))
    weight_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    levels = ranked.withColumn("level", rest / weight_left)
    fits = F.when(F.col("level") <= F.col("ratio"), F.col("level"))
    level = F.first(fits, ignorenulls=True).over(everything)
    return levels.withColumn("chosen", level).select(
        "source",
        "source_size",
        F.coalesce(F.least("full", F.col("chosen") * F.col("weight")), F.col("full")).alias("target"),
    )


def source_rates(
    sizes: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    seeds: int = SEEDS,
) -> DataFrame:
    """One row per source: source, source_size, target, whole, part, seed."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rates = stored(
        source_targets(totals, weights, share, most)
        .withColumn("whole", F.floor(rate))
        .withColumn("part", rate - F.floor(rate)),
        "mix-rates",
    )
    drawn = [
        F.sum(F.when(coin(F.col("doc_id"), k) < F.col("part"), F.col("size")).otherwise(0)).alias(f"drawn_{k}")
        for k in range(seeds)
    ]
    joined = sizes.join(rates.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
    tried = joined.groupBy("source").agg(*drawn)
    missed = F.array(
        *(
            F.struct(
                F.abs(F.col("whole") * F.col("source_size") + F.col(f"drawn_{k}") - F.col("target")).alias("by"),
                F.lit(k).alias("seed"),
            )
            for k in range(seeds)
        )
    )
    chosen = tried.withColumnRenamed("source", "of").join(rates, F.col("of").eqNullSafe(F.col("source")))
    return stored(
        chosen.select("source", "source_size", "target", "whole", "part", F.array_min(missed)["seed"].alias("seed")),
        "mix-seeds",
    )


def with_copies(docs: DataFrame, rates: DataFrame, seeds: int = SEEDS) -> DataFrame:
    """Rows with doc_id and source, with their number of ``copies`` and, as a struct ``mix``,
    their source's row.

    The rates have one row per source, which Spark broadcasts if its size allows and
    otherwise shuffles; a hot source is split by the adaptive skew join.
    """
    plan = rates.select(F.struct("*").alias("mix"))
    joined = docs.join(plan, F.col("source").eqNullSafe(F.col("mix.source")))
    value = F.lit(2.0)
    for k in range(seeds):
        value = F.when(F.col("mix.seed") == k, coin(F.col("doc_id"), k)).otherwise(value)
    extra = F.when(value < F.col("mix.part"), 1).otherwise(0)
    return joined.withColumn("copies", (F.col("mix.whole") + extra).cast("long"))


def mixed(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """The mix itself: every document as many times as it is taken, columns as given."""
    sizes = stored(sized(docs, id_col, text_col, source_col), "mix-sizes")
    # The document travels as one struct, so no column of it can clash with the mix's own.
    whole = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), F.struct("*").alias("document"))
    copied = with_copies(whole, source_rates(sizes, weights, share, most)).filter("copies > 0")
    repeats = F.sequence(F.lit(1), F.col("copies").cast("int"))
    return copied.withColumn("copy", F.explode(repeats)).select("document.*")
