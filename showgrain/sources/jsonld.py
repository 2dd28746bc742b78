"""JSON-LD in pages: single objects, arrays and @graph; fields that are a value, a list or an object."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from showgrain.functions.columns import no_value
from showgrain.sources import event_row

#: Types that are events (fixed values).
EVENT_TYPES = "Event|MusicEvent|ComedyEvent|TheaterEvent|Festival|SocialEvent|SportsEvent|DanceEvent|ChildrensEvent|FoodEvent|ExhibitionEvent|ScreeningEvent|EducationEvent|LiteraryEvent"


def _one(path: str, *more: str) -> Column:
    """The first of several JSON paths that holds a value; of a list its first item."""
    tries = []
    for p in (path, *more):
        v = F.get_json_object("item", p)
        tries.append(no_value(F.when(v.startswith("[") | v.startswith("{"), None).otherwise(v)))
    return F.coalesce(*tries)


def parse(pages: DataFrame) -> DataFrame:
    """One row per event object of each page; malformed blocks are skipped."""
    scripts = F.regexp_extract_all("body", F.lit(r"(?is)<script[^>]*application/ld\+json[^>]*>(.*?)</script>"), 1)
    b = pages.select("url", F.posexplode(scripts).alias("_block", "json")).withColumn("json", F.trim("json"))
    listed = F.when(F.col("json").startswith("["), F.col("json")).otherwise(F.coalesce(F.get_json_object("json", "$.@graph"), F.concat(F.lit("["), F.col("json"), F.lit("]"))))
    items = b.filter(F.try_parse_json("json").isNotNull()).select("url", "_block", F.posexplode(F.from_json(listed, "array<string>")).alias("_item", "item"))
    kind = F.coalesce(F.get_json_object("item", "$.@type"), F.lit(""))
    events = items.filter(kind.rlike(rf"^\[?\"?({EVENT_TYPES})\b|\"({EVENT_TYPES})\""))
    return events.select(
        *event_row(
            url=F.col("url"), _pos=(F.col("_block") * 10_000 + F.col("_item")).cast("int"), source_event_id=_one("$.identifier", "$.@id", "$.url"), title=_one("$.name"), starts_text=_one("$.startDate"), ends_text=_one("$.endDate"),
            venue_name=_one("$.location.name", "$.location[0].name", "$.location"), description=_one("$.description"), ticket_url=_one("$.offers.url", "$.offers[0].url", "$.url"),
            image_url=_one("$.image.url", "$.image[0].url", "$.image[0]", "$.image"), price_text=_one("$.offers.price", "$.offers[0].price", "$.offers.lowPrice", "$.offers[0].lowPrice"),
        )
    ).filter("title is not null and starts_text is not null")
