"""Writes that look at what stands already, as set operations on the whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from showgrain.operators.merge import inserted_or_ignored


def staged(held: DataFrame, incoming: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Incoming rows to append as pending: the first of each key that does not stand already."""
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
    fresh = incoming.withColumn("_n", first).filter("_n = 1").drop("_n")
    return fresh.join(held.select(*keys).distinct(), keys, "left_anti").withColumn("review_status", F.lit("pending"))


def replaced_pending(held: DataFrame, incoming: DataFrame, group: str, status: str = "review_status") -> DataFrame:
    """Pending rows of the groups that come in are rejected and the new ones stand as pending."""
    groups = incoming.select(F.col(group).alias("_g")).distinct()
    hit = held.join(groups, held[group] == groups["_g"], "left")
    out = hit.withColumn(status, F.when(F.col("_g").isNotNull() & (F.col(status) == "pending"), "rejected").otherwise(F.col(status))).drop("_g")
    return out.unionByName(incoming.withColumn(status, F.lit("pending")))


def upserted_by_status(held: DataFrame, incoming: DataFrame, keys: list[str], fields: list[str], status: str = "review_status") -> DataFrame:
    """Merge by key: new keys are inserted, pending rows refreshed, rejected ones revived, others left as they are.

    ``done`` tells which: insert, refresh, revive or skip, and keep for rows that nothing came in for.
    incoming has one row a key.
    """
    h, i = held.alias("h"), incoming.alias("i")
    j = h.join(i, [F.col(f"h.{k}").eqNullSafe(F.col(f"i.{k}")) for k in keys], "full_outer")
    was, came = F.col(f"h.{status}"), F.col("i._came").isNotNull()
    done = F.when(F.col("h._held").isNull(), "insert").when(~came, "keep").when(was == "pending", "refresh").when(was == "rejected", "revive").otherwise("skip")
    take = done.isin("insert", "refresh", "revive")
    pick = lambda c: F.when(take, F.col(f"i.{c}")).otherwise(F.col(f"h.{c}")).alias(c)
    return j.select(*[F.coalesce(F.col(f"h.{k}"), F.col(f"i.{k}")).alias(k) for k in keys], *[pick(f) for f in fields], F.when(take, F.lit("pending")).otherwise(was).alias(status), done.alias("done"))


def upsert_sides(held: DataFrame, incoming: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides marked as present, as ``upserted_by_status`` wants them."""
    return held.withColumn("_held", F.lit(1)), incoming.withColumn("_came", F.lit(1))


def ensured(dim: DataFrame, wanted: DataFrame, key: str, order: str) -> DataFrame:
    """The dimension with a row for every wanted key: get or create."""
    return inserted_or_ignored(dim, wanted.filter(F.col(key).isNotNull()), [key], order)


def marked(df: DataFrame, ids: DataFrame, key: str, column: str, value: Column) -> DataFrame:
    """``column`` set for the rows whose key is among the ids, in one pass however many there are."""
    side = ids.select(F.col(key).alias("_k")).distinct()
    return df.join(side, df[key] == side["_k"], "left").withColumn(column, F.when(F.col("_k").isNotNull(), value).otherwise(F.col(column))).drop("_k")


def seeded(names: DataFrame, known: list[DataFrame], name: str, form: Column, order: str, most: int | None = None) -> DataFrame:
    """Names whose form is in none of the known forms (column ``form``), first spelling of each; ``most`` is the batch a run may add."""
    first = F.row_number().over(Window.partitionBy("form").orderBy(order, name))
    out = names.withColumn("form", form).filter("form <> ''")
    for k in known:
        out = out.join(k.select("form").distinct(), "form", "left_anti")
    out = out.withColumn("_n", first).filter("_n = 1").drop("_n")
    return out if most is None else out.orderBy(order, "form").limit(most)


def write_json(df: DataFrame, path: str) -> None:
    """One JSON object a row, nulls written too."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
