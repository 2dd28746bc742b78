"""Edit-distance joins without a cross join.

Two strings whose ratio (1 - distance / longer length) reaches ``t`` differ by at most
d = (1 - t) * longer edits.  One edit destroys at most two padded bigrams, so they share
all but 2d of them, and with bigrams in one global order, rarest first, a shared one
stands among the first 2d + 1 of each.  Only those are joined, between strings of like length, and every hit is verified
with the real distance, so the result is exact.  Repeated bigrams of a string count as
different ones (numbered), which keeps the bound right.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from showgrain.functions.columns import similarity
from showgrain.session import broadcast_if_small, written


def _bigrams(df: DataFrame, column: str) -> DataFrame:
    padded = F.concat(F.lit("\x02"), F.col(column), F.lit("\x03"))
    pieces = F.transform(F.sequence(F.lit(1), F.length(column) + 1), lambda i: F.substr(padded, i, F.lit(2)))
    out = df.withColumn("_all", pieces).select("*", F.posexplode("_all").alias("_pos", "_g"))
    n = F.row_number().over(Window.partitionBy(column, "_g").orderBy("_pos"))
    return out.withColumn("gram", F.concat("_g", n.cast("string"))).select(column, "gram")


def _prefix(df: DataFrame, column: str, order: DataFrame, ratio: float) -> DataFrame:
    edits = F.floor(F.length(column) / ratio * (1 - ratio) + 1e-9)
    ranked = df.join(order, "gram", "left").withColumn("_n", F.row_number().over(Window.partitionBy(column).orderBy(F.coalesce("freq", F.lit(0)), "gram")))
    return ranked.filter(F.col("_n") <= 2 * edits + 1).select(column, "gram")


def similar_pairs(left: DataFrame, right: DataFrame, ratio: float) -> DataFrame:
    """``l``, ``r``, ``score`` of all pairs of distinct non-empty strings with that ratio or more.

    left has column ``l``, right has ``r``; null and empty strings take no part.
    """
    a = left.filter("l is not null and l <> ''").select("l").distinct()
    b = right.filter("r is not null and r <> ''").select("r").distinct()
    ga, gb = written(_bigrams(a, "l"), "bigrams"), written(_bigrams(b, "r"), "bigrams")
    order = broadcast_if_small(written(gb.groupBy("gram").agg(F.count("*").alias("freq")), "bigram-order"), 200_000)
    # the length is part of the key: a common gram brings only strings of like length together
    lengths = F.sequence(F.ceil(F.length("l") * ratio - 1e-9).cast("int"), F.floor(F.length("l") / ratio + 1e-9).cast("int"))
    asked = _prefix(ga, "l", order, ratio).withColumn("len", F.explode(lengths))
    held = _prefix(gb, "r", order, ratio).withColumn("len", F.length("r"))
    hits = asked.join(held, ["gram", "len"])
    longer, shorter = F.greatest(F.length("l"), F.length("r")), F.least(F.length("l"), F.length("r"))
    hits = hits.filter(longer - shorter <= (1 - ratio) * longer + 1e-9).select("l", "r").distinct()
    return hits.withColumn("score", similarity("l", "r")).filter(F.col("score") >= ratio - 1e-12)


def best_two(pairs: DataFrame, target: str, entity: str) -> DataFrame:
    """Best entity of each target with its score and the next entity's; ties by entity."""
    one = pairs.groupBy(target, entity).agg(F.max("score").alias("score"))
    ranked = one.withColumn("n", F.row_number().over(Window.partitionBy(target).orderBy(F.desc("score"), entity)))
    two = ranked.filter("n <= 2")
    return two.groupBy(target).agg(
        F.max(F.when(F.col("n") == 1, F.col(entity))).alias(entity),
        F.max(F.when(F.col("n") == 1, F.col("score"))).alias("score"),
        F.coalesce(F.max(F.when(F.col("n") == 2, F.col("score"))), F.lit(0.0)).alias("second"),
    )


def decided(best: DataFrame, matched: float = 0.95, possible: float = 0.80, gap: float = 0.05) -> DataFrame:
    """best with ``status``: matched, ambiguous or unmatched."""
    status = (
        F.when(F.col("score") < possible, "unmatched")
        .when((F.col("second") >= possible) & (F.col("score") - F.col("second") < gap), "ambiguous")
        .when(F.col("score") < matched, "ambiguous")
        .otherwise("matched")
    )
    return best.withColumn("status", status)
