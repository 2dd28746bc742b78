"""Queries of the general problems, for the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from showgrain.operators import packed, timestamps
from showgrain.plans.startsql import P5_FOUND
from showgrain.session import broadcast_if_small, table


def p5_found(spark: SparkSession, root: str) -> DataFrame:
    return timestamps.normalised_starts(table(spark, root, "partner_event"), table(spark, root, "venue_event_sources"))


def p6_found(spark: SparkSession, root: str) -> DataFrame:
    feeds = table(spark, root, "venue_event_sources").filter("venue_id is null and id is not null").select(F.col("id").alias("source_id")).distinct()
    titles = table(spark, root, "partner_event").join(broadcast_if_small(feeds), "source_id", "left_anti")
    titles = titles.select(F.lit("partner_event").alias("source_table"), F.col("_ord").alias("record_id"), F.col("title").alias("text"), F.lit(True).alias("is_title"))
    lineups = table(spark, root, "prekindle_event").select(
        F.lit("prekindle_event").alias("source_table"), F.col("id").alias("record_id"), F.col("lineup").alias("text"), F.lit(False).alias("is_title")
    )
    artists = table(spark, root, "artist")
    values = artists.select(F.col("name").alias("value")).union(artists.select(F.explode("aliases")))
    return packed.unpack(titles.unionByName(lineups), values)


def queries() -> dict:
    return {"p5_found": p5_found, "p6_found": p6_found}


def oracle_sql() -> dict[str, str]:
    return {"p5_found": P5_FOUND}
