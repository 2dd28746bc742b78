"""Queries of the problems of this subpackage, for the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from showgrain.llm import leakage, linkage, lookalike, matching, names, packing, residue, truncated
from showgrain.operators import timestamps
from showgrain.session import table, written

#: City feeds: sources without a venue of their own.
CITY_FEEDS = ("metro_gig_guide", "weekend_planner", "lakeside_listings")


def venue_rows(spark: SparkSession, root: str) -> DataFrame:
    """partner_event without the city feeds."""
    return table(spark, root, "partner_event").filter(~F.coalesce(F.col("source_partner").isin(*CITY_FEEDS), F.lit(False)))


def p1_found(spark: SparkSession, root: str) -> DataFrame:
    partner = table(spark, root, "partner_event").select(F.lit("partner_event").alias("source_table"), F.col("_ord").alias("record_id"), "description", F.col("source_id").alias("source"))
    extracted = table(spark, root, "extracted_event").select(F.lit("extracted_event").alias("source_table"), F.col("id").alias("record_id"), "description", F.col("source_id").alias("source"))
    return residue.residue(partner.unionByName(extracted))


def p2_found(spark: SparkSession, root: str) -> DataFrame:
    return names.variants(table(spark, root, "enriched_partner_event"), table(spark, root, "artist"))


#: Batches that arrive together in the deduplication query: up to this number, and later ones.
ARRIVALS = (6,)


def p3_found(spark: SparkSession, root: str) -> DataFrame:
    rows = venue_rows(spark, root)
    starts = written(timestamps.starts(rows, table(spark, root, "venue_event_sources")), "starts")
    history = linkage.History(spark)
    history.add(linkage.existing_records(table(spark, root, "existing_event")), "existing")
    batch = F.coalesce("batch_no", F.lit(ARRIVALS[0]))
    for lo, hi in zip((None, *ARRIVALS), (*ARRIVALS, None), strict=True):
        arrived = (F.lit(True) if lo is None else batch > lo) & (F.lit(True) if hi is None else batch <= hi)
        history.add(linkage.partner_records(rows.filter(arrived), starts), f"to-{hi}")
    return linkage.repeated(history.found())


def p4_found(spark: SparkSession, root: str) -> DataFrame:
    return lookalike.alike_pairs(venue_rows(spark, root))


def p7_matches(spark: SparkSession, root: str) -> DataFrame:
    """City-feed rows with the accepted show they describe, a score and a confidence."""
    feeds = table(spark, root, "partner_event").filter(F.col("source_partner").isin(*CITY_FEEDS))
    sources = table(spark, root, "venue_event_sources")
    starts = written(timestamps.starts(feeds, sources), "feed-starts")
    zones = sources.filter("venue_id is not null").groupBy("venue_id").agg(F.min("timezone").alias("typed")).select("venue_id", timestamps.zone_name("typed").alias("zone"))
    return matching.match_pairs(feeds, starts, table(spark, root, "existing_event"), table(spark, root, "venue"), zones)


def p7_found(spark: SparkSession, root: str) -> DataFrame:
    return p7_matches(spark, root).select("_ord", "existing_id")


def p8_packed(spark: SparkSession, root: str) -> DataFrame:
    """The container of every text, or of the pieces of a text that alone exceeds one."""
    return packing.packed(table(spark, root, "documents"))


def p9_found(spark: SparkSession, root: str) -> DataFrame:
    found = leakage.leaks(table(spark, root, "documents"), table(spark, root, "eval_item"))
    return found.filter("kind = 'exact'").select("doc_id", "item_id").distinct()


def p9_reparameterised(spark: SparkSession, root: str) -> DataFrame:
    """Documents that hold an item only with other numbers, names or units."""
    found = leakage.leaks(table(spark, root, "documents"), table(spark, root, "eval_item"), loose=True)
    kinds = found.groupBy("doc_id", "item_id").agg(F.max(F.col("kind") == "exact").alias("exact"))
    return kinds.filter("not exact").select("doc_id", "item_id")


def p10_found(spark: SparkSession, root: str) -> DataFrame:
    return truncated.truncated(table(spark, root, "documents"))


def p10_by_source(spark: SparkSession, root: str) -> DataFrame:
    return truncated.truncation_by_source(table(spark, root, "documents"))


def queries() -> dict:
    return {
        "p1_found": p1_found,
        "p2_found": p2_found,
        "p3_found": p3_found,
        "p4_found": p4_found,
        "p7_found": p7_found,
        "p7_matches": p7_matches,
        "p8_packed": p8_packed,
        "p9_found": p9_found,
        "p9_reparameterised": p9_reparameterised,
        "p10_found": p10_found,
        "p10_by_source": p10_by_source,
    }


def oracle_sql() -> dict[str, str]:
    windows = "SELECT {i}, unnest(list_transform(range(1, len(w) - 10), lambda k: array_to_string(w[k : k + 11], ' '))) AS win FROM (SELECT {i}, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') AS w FROM {t} WHERE text IS NOT NULL) WHERE len(w) >= 12"
    return {
        "p9_found": f"WITH d AS ({windows.format(i='doc_id', t='documents')}), e AS ({windows.format(i='item_id', t='eval_item')}) SELECT DISTINCT doc_id, item_id FROM d JOIN e USING (win)",
    }
