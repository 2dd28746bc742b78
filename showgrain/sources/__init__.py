"""Parsers of landed pages, one per family of platform; fetching is outside the engine.

Every parser takes ``url``, ``body`` rows and gives the same columns (``EVENT``); a page
with nothing to read gives no rows, a malformed part of one is skipped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EVENT = ["url", "_pos", "source_event_id", "title", "starts_text", "ends_text", "venue_name", "description", "ticket_url", "image_url", "price_text"]


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed files, one row each: ``url`` (the file) and ``body``."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("url"), F.col("value").alias("body"))


def event_row(**columns: Column) -> list[Column]:
    """The ``EVENT`` columns; those not given are null."""
    return [columns.get(c, F.lit(None).cast("int" if c == "_pos" else "string")).alias(c) for c in EVENT]
