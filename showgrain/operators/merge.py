"""Writes as set operations: field merges under locks, staging, upserts, slugs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def refreshed(published: DataFrame, incoming: DataFrame, key: str, rules: dict[str, str], provenance: str = "field_sources") -> DataFrame:
    """Published rows with fields of their incoming row, field by field.

    rules: field -> 'always' (taken even if null), 'value' (taken if it has one) or
    'unset' (taken only where provenance is venue, none or missing).  A field whose
    provenance is 'manual' is locked.  ``changed`` lists the fields that changed.
    """
    p, i = published.alias("p"), incoming.alias("i")
    j = p.join(i, F.col(f"p.{key}") == F.col(f"i.{key}"), "left")
    hit = F.col(f"i.{key}").isNotNull()
    out: list[Column] = [F.col(f"p.{c}") for c in published.columns if c not in rules]
    changed = []
    for field, rule in rules.items():
        source = F.coalesce(F.col(f"p.{provenance}")[field], F.lit("none"))
        new = F.col(f"i.{field}")
        take = hit & (source != "manual")
        if rule == "value":
            take &= new.isNotNull() & (new.cast("string") != "")
        elif rule == "unset":
            take &= new.isNotNull() & source.isin("venue", "none")
        value = F.when(take, new).otherwise(F.col(f"p.{field}"))
        out.append(value.alias(field))
        changed.append(F.when(~value.eqNullSafe(F.col(f"p.{field}")), F.lit(field)))
    return j.select(*out, F.array_compact(F.array(*changed)).alias("changed"))


def upserted(current: DataFrame, incoming: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Rows of both; for equal keys the incoming one, of several the last in order."""
    both = current.withColumn("_p", F.lit(0)).unionByName(incoming.withColumn("_p", F.lit(1)))
    w = Window.partitionBy(*keys).orderBy(F.desc("_p"), F.desc(order))
    return both.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n", "_p")


def inserted_or_ignored(current: DataFrame, incoming: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Rows of both; for equal keys the one that was there, of several incoming the first."""
    both = current.withColumn("_p", F.lit(0)).unionByName(incoming.withColumn("_p", F.lit(1)))
    w = Window.partitionBy(*keys).orderBy("_p", order)
    return both.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n", "_p")


def numbered_slugs(df: DataFrame, base: str, order: str, taken: DataFrame | None = None) -> DataFrame:
    """``slug``: the base for its first row, base-2, base-3 ... for later ones; after those taken."""
    n = F.row_number().over(Window.partitionBy(base).orderBy(order))
    if taken is not None:
        counts = taken.select(F.regexp_replace("slug", r"-\d+$", "").alias("_b"), F.coalesce(F.regexp_extract("slug", r"-(\d+)$", 1).try_cast("int"), F.lit(1)).alias("_k"))
        counts = counts.groupBy("_b").agg(F.max("_k").alias("_k"))
        df = df.join(counts, df[base] == counts["_b"], "left").drop("_b")
        n = n + F.coalesce("_k", F.lit(0))
    out = df.withColumn("_n", n).withColumn("slug", F.when(F.col("_n") == 1, F.col(base)).otherwise(F.concat_ws("-", base, F.col("_n").cast("string"))))
    return out.drop("_n", "_k")


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that break uniqueness; null keys are exempt, as in a partial index."""
    some = df.filter(" and ".join(f"{k} is not null" for k in keys))
    return some.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")
