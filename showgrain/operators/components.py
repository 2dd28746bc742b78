"""Connected components of a graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from showgrain.session import written


def components(edges: DataFrame) -> DataFrame:
    """``label``, ``rep``: the smallest label of each connected component of ``a``-``b`` edges.

    Smallest labels spread over edges and along representatives (pointer jumping) until
    nothing changes; every round is written, so lineage stays short.
    """
    both = written(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    state = written(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("label"), F.least("a", "m").alias("rep")), "reps")
    while True:
        seen = both.join(state.select(F.col("label").alias("b"), F.col("rep").alias("r")), "b").groupBy("a").agg(F.min("r").alias("r"))
        spread = state.join(seen, state["label"] == seen["a"], "left").select("label", "rep", F.least("rep", F.coalesce("r", "rep")).alias("near"))
        far = state.select(F.col("label").alias("near"), F.col("rep").alias("jump"))
        after = written(spread.join(far, "near", "left").select("label", "rep", F.least("near", F.coalesce("jump", "near")).alias("new")), "reps")
        changed = after.filter("rep <> new").limit(1).count()
        state = after.select("label", F.col("new").alias("rep"))
        if not changed:
            return state
