"""JSON lists of events from APIs: one mapping per platform, one parser for all.

A platform is data: where its list (and a second one, ``more``) stands and under which path each field is found.  A
callback around the JSON (JSONP) is taken off first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from showgrain.functions.columns import no_value
from showgrain.sources import EVENT, event_row

#: Paths of the common list shapes (fixed values): field -> JSON path within an item.
PLATFORMS = {
    "calendar": {"list": "$.events", "source_event_id": "$.id", "title": "$.title", "starts_text": "$.start_date", "ends_text": "$.end_date", "description": "$.description", "ticket_url": "$.website", "image_url": "$.image.url", "price_text": "$.cost", "venue_name": "$.venue.venue"},
    "city_feed": {"list": "$.data", "source_event_id": "$.ID", "title": "$.post_title", "starts_text": "$.event_starts_sort_field", "description": "$.post_content", "ticket_url": "$.guid", "image_url": "$.image", "venue_name": "$.venue_name"},
    "table_rows": {"list": "$", "source_event_id": "$.id", "title": "$.title", "starts_text": "$.date", "ends_text": "$.end_date", "description": "$.description", "ticket_url": "$.ticket_url", "image_url": "$.image_url"},
    "widget": {"list": "$.events", "source_event_id": "$.id", "title": "$.title", "starts_text": "$.date", "description": "$.headliner", "ticket_url": "$.dtfLinks[0]", "image_url": "$.imageUrl", "price_text": "$.price", "venue_name": "$.venue"},
    "site_json": {"list": "$.upcoming", "more": "$.past", "source_event_id": "$.id", "title": "$.title", "starts_text": "$.startDate", "ends_text": "$.endDate", "description": "$.excerpt", "ticket_url": "$.fullUrl", "image_url": "$.assetUrl", "venue_name": "$.location.addressTitle"},
    "epoch_rows": {"list": "$.events", "source_event_id": "$.id", "title": "$.title", "starts_text": "$.start", "ends_text": "$.end"},
}


def parse(pages: DataFrame, platform: str | dict) -> DataFrame:
    """One row per item that has a title and a start; pages that are no JSON give none."""
    paths = PLATFORMS[platform] if isinstance(platform, str) else platform
    body = F.regexp_replace("body", r"(?s)^\s*[\w.$]+\s*\((.*)\)\s*;?\s*$", "$1")
    whole = lambda p: F.when(F.lit(p == "$"), F.col("j")).otherwise(F.get_json_object("j", p))
    lists = [F.coalesce(F.from_json(whole(paths[p]), "array<string>"), F.array().cast("array<string>")) for p in ("list", "more") if p in paths]
    items = pages.select("url", body.alias("j")).filter(F.try_parse_json("j").isNotNull()).select("url", F.posexplode(F.concat(*lists)).alias("_pos", "item"))
    get = {f: no_value(F.get_json_object("item", p)) for f, p in paths.items() if f in EVENT}
    return items.select(*event_row(url=F.col("url"), _pos=F.col("_pos"), **get)).filter("title is not null and starts_text is not null")


def extras(column: str) -> F.Column:
    """A list of key_name/key_value objects as a map; a repeated key keeps its last value."""
    pairs = F.from_json(column, "array<struct<key_name:string,key_value:string>>")
    keys = F.array_distinct(F.transform(pairs, lambda p: p["key_name"]))
    return F.map_from_entries(F.transform(keys, lambda k: F.struct(k, F.element_at(F.filter(pairs, lambda p: p["key_name"] == k), -1)["key_value"])))
