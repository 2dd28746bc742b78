"""What a crawl reads off pages ahead of the events: links, the next page, where paging ends, embedded settings, media maps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from showgrain.functions.columns import no_value
from showgrain.functions.links import image_points
from showgrain.sources.html import _absolute


def event_links(pages: DataFrame, pattern: str = r"/events?/[^\"'#?]+") -> DataFrame:
    """``url``, ``link``: the distinct event links of each page, in order (``_pos``)."""
    found = F.array_distinct(F.regexp_extract_all("body", F.lit(rf"(?i)href=[\"']([^\"']*{pattern}[^\"']*)[\"']"), 1))
    return pages.select("url", F.posexplode(found).alias("_pos", "l")).select("url", "_pos", _absolute(F.col("l"), F.col("url")).alias("link"))


def next_link(body: Column | str, sign: str = r"(?:next|›|»|chevron-right|nav-next)") -> Column:
    """Where a month's or list's page leads on: the link that is marked or named as next."""
    body = F.col(body) if isinstance(body, str) else body
    marked = F.regexp_extract(body, r"(?i)<(?:a|link)\b[^>]*\brel=[\"']next[\"'][^>]*\bhref=[\"']([^\"']+)[\"']", 1)
    named = F.regexp_extract(body, rf"(?is)<a\b[^>]*\bhref=[\"']([^\"'#]+)[\"'][^>]*>(?:(?!</a>).)*{sign}", 1)
    return F.coalesce(no_value(marked), no_value(named))


def until_short(rows: DataFrame, keys: list[str], page: str, size: int) -> DataFrame:
    """Rows of the pages that a run reads: up to and with the first page of under ``size`` rows."""
    counts = rows.groupBy(*keys, page).agg(F.count("*").alias("_n"))
    ends = counts.filter(F.col("_n") < size).groupBy(*keys).agg(F.min(page).alias("_end"))
    return rows.join(ends, keys, "left").filter(F.col("_end").isNull() | (F.col(page) <= F.col("_end"))).drop("_end")


def while_new(rows: DataFrame, keys: list[str], page: str, ident: str) -> DataFrame:
    """Rows of the pages up to the first that brings no id that an earlier page did not have."""
    first = rows.groupBy(*keys, ident).agg(F.min(page).alias("_first"))
    fresh = first.groupBy(*keys, F.col("_first").alias(page)).agg(F.count("*").alias("_fresh"))
    pages = rows.select(*keys, page).distinct().join(fresh, [*keys, page], "left")
    stale = pages.filter("_fresh is null").groupBy(*keys).agg(F.min(page).alias("_end"))
    return rows.join(stale, keys, "left").filter(F.col("_end").isNull() | (F.col(page) < F.col("_end"))).drop("_end")


def embedded_settings(body: Column | str, name: str = "config") -> Column:
    """Settings that a page carries in base64 in a data attribute, as JSON text; null where they are no JSON."""
    body = F.col(body) if isinstance(body, str) else body
    raw = F.regexp_extract(body, rf"(?i)data-{name}=[\"']([A-Za-z0-9+/=]+)[\"']", 1)
    text = F.try_to_binary(F.when(raw != "", raw), F.lit("base64")).cast("string")
    return F.when(F.try_parse_json(text).isNotNull(), text)


def media_map(pages: DataFrame, ident: str = r"(?i)/shows?/(\d+)") -> DataFrame:
    """``show_id`` with its best image: images of blocks that link to the show, by their points; ties take the first."""
    blocks = pages.select("url", F.posexplode(F.regexp_extract_all("body", F.lit(r"(?is)<(?:article|li|section)\b.*?</(?:article|li|section)>"), 0)).alias("_pos", "b"))
    shown = blocks.select("url", "_pos", no_value(F.regexp_extract("b", ident, 1)).alias("show_id"), F.posexplode(F.regexp_extract_all("b", F.lit(r"(?i)<img\b[^>]*\bsrc=[\"']([^\"']+)[\"']"), 1)).alias("_img", "image_url"))
    scored = shown.filter("show_id is not null").withColumn("_points", image_points("image_url"))
    w = Window.partitionBy("show_id").orderBy(F.desc("_points"), "url", "_pos", "_img")
    return scored.withColumn("_n", F.row_number().over(w)).filter("_n = 1").select("show_id", "image_url")
