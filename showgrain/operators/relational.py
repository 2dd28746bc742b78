"""Filters, joins, aggregates, windows and set operations over event relations.

Dimension sides are broadcast only after a count proved them small; everything else is
left to Catalyst and adaptive execution.  All first/last/best choices carry an explicit
tie-break, so results do not depend on partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from showgrain.functions.columns import no_value
from showgrain.session import broadcast_if_small


# --- filters ----------------------------------------------------------------------
def valid_events(df: DataFrame, as_of: Column, horizon_days: Column, start: str = "starts_at", end: str = "ends_at") -> DataFrame:
    """Rows with a title that start within the horizon and began less than a day ago or have not ended."""
    s, e = F.col(start), F.col(end)
    ahead = F.unix_timestamp(s) <= F.unix_timestamp(as_of) + horizon_days * 86400
    current = (F.unix_timestamp(s) >= F.unix_timestamp(as_of) - 86400) | F.coalesce(e > as_of, F.lit(False))
    return df.filter(no_value("title").isNotNull() & s.isNotNull() & ahead & current)


def within_grace(df: DataFrame, as_of: Column, grace_hours: int, start: str = "starts_at") -> DataFrame:
    return df.filter(F.unix_timestamp(start) >= F.unix_timestamp(as_of) - grace_hours * 3600)


# --- joins ------------------------------------------------------------------------
def embed(df: DataFrame, dim: DataFrame, key: str, dim_key: str, columns: dict[str, str], how: str = "left") -> DataFrame:
    """``df`` with columns of its to-one row in ``dim`` (new name -> dim column)."""
    side = broadcast_if_small(dim.select(F.col(dim_key).alias("_k"), *[F.col(c).alias(n) for n, c in columns.items()]))
    return df.join(side, df[key] == side["_k"], how).drop("_k")


def without_known(df: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys are not among the known; rows with a null key stay."""
    return df.join(known.select(*keys).distinct(), keys, "left_anti")


def with_fallback(first: DataFrame, second: DataFrame, group: str | None = None) -> DataFrame:
    """``first``, or where it has nothing ``second``; by ``group`` if one is named."""
    both = first.withColumn("_p", F.lit(0)).unionByName(second.withColumn("_p", F.lit(1)))
    if group is None:
        return both.join(F.broadcast(both.agg(F.min("_p").alias("_m"))), F.col("_p") == F.col("_m")).drop("_p", "_m")
    w = Window.partitionBy(group)
    return both.withColumn("_m", F.min("_p").over(w)).filter("_p = _m").drop("_p", "_m")


def merged(left: DataFrame, right: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """Full outer merge of two sources; the left value wins where it has one."""
    l, r = left.alias("l"), right.alias("r")
    j = l.join(r, [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys], "full_outer")
    pick = lambda c: F.coalesce(F.col(f"l.{c}"), F.col(f"r.{c}")).alias(c)
    return j.select(*[pick(c) for c in [*keys, *fields]])


def token_overlap(df: DataFrame, dim: DataFrame, name: str, dim_id: str, dim_name: str, shared: int = 2) -> DataFrame:
    """Names met with dimension names that share ``shared`` words of over two letters, best first.

    Joined on words, not on all pairs; common words cost most, so both sides are distinct names.
    """
    def words(c: str) -> Column:
        clean = F.trim(F.regexp_replace(F.regexp_replace(F.lower(c), r"[^a-z0-9 ]", ""), r" +", " "))
        return F.array_distinct(F.filter(F.split(clean, " "), lambda w: F.length(w) > 2))

    a = df.select(name).filter(no_value(name).isNotNull()).distinct().select(name, F.explode(words(name)).alias("w"))
    b = dim.select(dim_id, F.explode(words(dim_name)).alias("w"))
    hits = a.join(b, "w").groupBy(name, dim_id).agg(F.count("*").alias("n_shared")).filter(F.col("n_shared") >= shared)
    w = Window.partitionBy(name).orderBy(F.desc("n_shared"), dim_id)
    return hits.withColumn("n", F.row_number().over(w)).filter("n = 1").drop("n")


#: Lengths of the pieces by which texts and patterns meet, longest first.
PIECES = (16, 8, 4, 2, 1)


def _pieces(text: str, n: int) -> Column:
    """All pieces of ``n`` characters of a text that is not empty."""
    at = F.filter(F.sequence(F.lit(1), F.length(text)), lambda i: i <= F.length(text) - (n - 1))
    return F.transform(at, lambda i: F.substring(F.col(text), i, F.lit(n)))


def contains_pattern(df: DataFrame, patterns: DataFrame, text: str, bound: int = 5000) -> DataFrame:
    """Rows with the patterns their text contains, and a score: the length, +20 if it opens the text.

    patterns: ``series_id``, ``pattern``; broadcast up to ``bound`` of them.  Beyond, a pattern is
    met by its opening piece of the longest of ``PIECES`` that it fills, wherever in the text
    that stands, so both ways give the same rows.  Empty patterns stand in no text.
    """
    side = patterns.select("series_id", "pattern").filter("pattern <> ''")
    holds = F.contains(F.col(text), F.col("pattern"))
    if side.limit(bound + 1).count() <= bound:
        pairs = df.join(F.broadcast(side), holds)
    else:
        length = F.length("pattern")
        size = F.coalesce(*[F.when(length >= n, F.lit(n)) for n in PIECES])
        keyed = side.withColumn("_piece", F.left("pattern", size))
        used = [r.n for r in keyed.select(F.length("_piece").alias("n")).distinct().collect()]  # at most five lengths
        pieces = F.flatten(F.array(*[_pieces(text, n) for n in used]))
        pairs = df.filter(F.length(text) > 0).withColumn("_piece", F.explode(F.array_distinct(pieces))).join(keyed, "_piece").filter(holds).drop("_piece")
    return pairs.withColumn("score", F.length("pattern") + F.when(F.startswith(F.col(text), F.col("pattern")), 20).otherwise(0))


def in_box(df: DataFrame, south: float, west: float, north: float, east: float, lat: str = "lat", lng: str = "lng") -> DataFrame:
    """Rows within a box of degrees; a box over the date line has its west edge east of its east edge. Rows without a place are out."""
    within = F.col(lng).between(west, east) if west <= east else (F.col(lng) >= west) | (F.col(lng) <= east)
    return df.filter(F.col(lat).between(south, north) & within)


# --- order-dependent --------------------------------------------------------------
def first_wins(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(order)
    return df.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def last_wins(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(F.desc(order))
    return df.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def top_k(df: DataFrame, keys: list[str], k: int, *order: Column) -> DataFrame:
    """The first ``k`` rows of each group, numbered from 1 in ``rank``."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= k)


def inferred_ends(df: DataFrame, day: list[str], start: str, longest_s: int = 7200) -> DataFrame:
    """``ends_s``: until the next start of the day, two hours at most; two hours for the last one.

    ``start`` is in seconds; equal starts count as no gap and take the full length.
    """
    gap = F.lead(start).over(Window.partitionBy(*day).orderBy(start, "_ord")) - F.col(start)
    length = F.when(gap.isNull() | (gap <= 0), F.lit(longest_s)).otherwise(F.least(gap, F.lit(longest_s)))
    return df.withColumn("ends_s", F.col(start) + length)


def first_values(df: DataFrame, keys: list[str], order: str, columns: list[str]) -> DataFrame:
    """Per key the first non-null value of each column in order."""
    pick = [F.min_by(c, F.when(no_value(c).isNotNull(), F.col(order))).alias(c) for c in columns]
    return df.groupBy(*keys).agg(*pick)


def contiguous(df: DataFrame, keys: list[str], order: str, flag: Column) -> DataFrame:
    """``segment``: how many headers stood up to each row, so rows between headers share a number."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("segment", F.sum(F.when(flag, 1).otherwise(0)).over(w))
