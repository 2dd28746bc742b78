"""Listing pages of platforms with a layout of their own, each layout a table of where things stand.

A page is cut where a block begins; within a block fields are read by the class of their
element, an attribute or a variable.  Date and clock come out as one text for the timestamp
dictionary, so no layout parses dates.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from showgrain.functions.columns import decode_entities, no_value, strip_html
from showgrain.sources import event_row
from showgrain.sources.html import _absolute


def by_class(name: str, tag: str = r"[a-z0-9]+") -> str:
    """Pattern of what an element of a class holds."""
    return rf"(?is)<({tag})\b[^>]*class=[\"'][^\"']*\b{name}\b[^\"']*[\"'][^>]*>(.*?)</\1>"


def attribute(name: str) -> str:
    return rf"(?is)()\b{name}=[\"']([^\"']*)[\"']"


def var(name: str) -> str:
    return rf"(?is)<(var)\b[^>]*class=[\"']{name}[\"'][^>]*>(.*?)</var>"


@dataclass(frozen=True)
class Layout:
    """Where a block begins, and patterns (group 2) of its fields; of several the first that holds something counts."""

    block: str
    title: tuple[str, ...]
    when: tuple[str, ...]  # all that hold something, joined by a blank
    ident: tuple[str, ...] = ()
    ends: tuple[str, ...] = ()
    venue: tuple[str, ...] = ()
    text: tuple[str, ...] = ()
    link: tuple[str, ...] = ()
    image: tuple[str, ...] = (r"(?is)()<img\b[^>]*\bsrc=[\"']([^\"']+)[\"']",)
    price: tuple[str, ...] = (r"()(\$\d+(?:\.\d+)?(?:\s*[–—-]\s*\$\d+(?:\.\d+)?)?)",)
    #: The day stands ahead of several blocks: its own marker, and where the day is in it.
    day: tuple[str, str] | None = None
    #: Rows to leave out: a field and a pattern it must not match.
    without: dict[str, str] = field(default_factory=dict)
    #: Clock that a start gets that has none, and the one for titles that match.
    clock: str = ""
    clock_for: tuple[str, str] = ("", "")


_LINK = r"(?is)()<a\b[^>]*\bhref=[\"']([^\"'#][^\"']*)[\"']"
_H = r"(?is)<(h[1-6])\b[^>]*>(.*?)</\1>"

# --- fixed values -----------------------------------------------------------------
#: Class names, attributes and variables of the platforms' pages.
LAYOUTS = {
    "agenda": Layout(r"<div class=\"ai1ec-event ", (by_class("ai1ec-event-title"),), (by_class("ai1ec-event-time"),), (r"(?i)()instance_id=(\d+)",), link=(attribute("data-ticket-url"), _LINK)),
    "events_manager": Layout(r"<div\b[^>]*\bevent_notes\b", (by_class("event_name"), attribute("alt")), (by_class("event_date"),), (r"(?i)()event_id=(\d+)",), text=(r"(?is)<(p)\b[^>]*>(.*?)</p>",), link=(r"(?is)()href=[\"']([^\"']*event_id=\d+[^\"']*)[\"']", _LINK)),
    "pinboard": Layout(r"<div\b[^>]*\bevent-calendar-card\b", (_H, attribute("aria-label")), (attribute("data-event-start-date"), attribute("data-event-start-time")), (attribute("data-event-id"), r"(?i)()\bid=[\"'](\d+)[\"']"), ends=(attribute("data-event-end-date"), attribute("data-event-end-time")), text=(by_class("event-info-text"),), link=(_LINK,)),
    "holders": Layout(r"<div\b[^>]*\bevents-holder\b", (var("atc_title"), _H), (var("atc_date_start"), var("atc_timezone")), ends=(var("atc_date_end"),), text=(var("atc_description"), by_class("event-info-text")), link=(_LINK,)),
    "occurrences": Layout(r"class=\"event-detail\"", (by_class("event-title"), attribute("title")), (by_class("event-datetime"), by_class("event-when")), (attribute("data-occurrence-id"), attribute("data-event-id")), text=(by_class("event-notes"),), link=(r"(?is)()href=[\"'](https?://[^\"']*/event/[^\"']+)[\"']", _LINK)),
    "day_list": Layout(r"<article\b[^>]*\bace-cal-list-event-content\b", (by_class("ace-cal-list-event-name"),), (by_class("ace-cal-list-event-time"),), (r"(?i)()itemNumber=(\d+)",), venue=(by_class("ace-cal-list-event-venue"),), text=(by_class("ace-cal-list-event-synopsis"),), link=(r"(?is)()href=[\"']([^\"']*itemNumber=\d+[^\"']*)[\"']", _LINK), day=(r"<li\b[^>]*\bace-cal-list-day\b", r"(?i)\bDate_(\d{4}-\d{2}-\d{2})")),
    "user_items": Layout(r"<li\b[^>]*\blist-item\b", (by_class("list-item-content__title"),), (by_class("list-item-content__description"),), text=(by_class("list-item-content__description"),), link=(_LINK,), clock="20:00", clock_for=(r"(?i)matin[eé]e", "14:00")),
    "media_cards": Layout(r"<div\b[^>]*\bcard events\b", (by_class("media-heading"), _H), (by_class("event-date"), by_class("date")), link=(_LINK,), clock="19:00"),
    "columns": Layout(r"<div class=\"event-column d-flex\s*\">", (r"(?is)<(h3)[^>]*>(.*?)</h3>",), (by_class("event-date"),), text=(by_class("event-tag"),), link=(_LINK,), image=(r"(?is)()background-image:\s*url\([\"']?([^)\"']+)",), without={"description": r"(?i)\bconcert"}),
    "rooms": Layout(r"<li\b[^>]*\bevent-row\b", (_H,), (by_class("event-day"), by_class("event-time")), (r"(?i)()/shows/(\d+)",), venue=(by_class("event-room"),), link=(_LINK,)),
    "list_items": Layout(r"<div\b[^>]*\beventColl-item\b", (by_class("eventColl-eventInfo--title"), by_class("eventColl-title"), _H), (by_class("eventColl-date"), by_class("eventColl-time")), link=(_LINK,), text=(by_class("eventColl-desc"),)),
}
# ----------------------------------------------------------------------------------


def _found(patterns: tuple[str, ...], block: str = "_block") -> list[Column]:
    return [no_value(F.trim(F.regexp_replace(decode_entities(strip_html(F.regexp_extract(block, p, 2))), r"\s+", " "))) for p in patterns]


def _first(patterns: tuple[str, ...], block: str = "_block") -> Column:
    return F.coalesce(*_found(patterns, block)) if patterns else F.lit(None).cast("string")


def parse(pages: DataFrame, layout: str | Layout) -> DataFrame:
    """One row per block that has a title and a time; repeated blocks of a page (same title and time) count once."""
    lay = LAYOUTS[layout] if isinstance(layout, str) else layout
    cut = lambda c, marker: F.slice(F.split(c, rf"(?i)(?={marker})"), 1, 1 << 20)
    if lay.day:
        days = pages.select("url", F.posexplode(cut(F.col("body"), lay.day[0])).alias("_p", "_part"))
        days = days.withColumn("_day", no_value(F.regexp_extract("_part", lay.day[1], 1))).filter("_day is not null")
        blocks = days.select("url", "_day", "_p", F.posexplode(cut(F.col("_part"), lay.block)).alias("_q", "_block")).withColumn("_pos", (F.col("_p") * 10_000 + F.col("_q")).cast("int"))
    else:
        blocks = pages.select("url", F.lit(None).cast("string").alias("_day"), F.posexplode(cut(F.col("body"), lay.block)).alias("_pos", "_block"))
    blocks = blocks.filter(F.col("_block").rlike(rf"(?i)^{lay.block}"))
    title = _first(lay.title)
    told = F.concat_ws(" ", "_day", *_found(lay.when))
    if lay.clock:
        by_title = F.when(F.col("title").rlike(lay.clock_for[0]), lay.clock_for[1]).otherwise(lay.clock) if lay.clock_for[0] else F.lit(lay.clock)
        has_clock = F.col("_told").rlike(r"(?i)\d{1,2}:\d{2}|\d\s*[ap]\.?m\b")
        told_full = F.when(has_clock, F.col("_told")).otherwise(F.concat_ws(" ", "_told", by_title))
    else:
        told_full = F.col("_told")
    read = blocks.withColumn("title", title).withColumn("_told", told).filter("title is not null and _told <> ''").withColumn("_told", told_full)
    ends = no_value(F.concat_ws(" ", *_found(lay.ends))) if lay.ends else F.lit(None).cast("string")
    out = read.select(
        *event_row(
            url=F.col("url"), _pos=F.col("_pos"), source_event_id=_first(lay.ident), title=F.col("title"), starts_text=F.col("_told"), ends_text=ends, venue_name=_first(lay.venue), description=_first(lay.text),
            ticket_url=_absolute(F.coalesce(*[no_value(F.regexp_extract("_block", p, 2)) for p in lay.link], F.lit("")), F.col("url")) if lay.link else F.lit(None).cast("string"),
            image_url=F.coalesce(*[no_value(F.regexp_extract("_block", p, 2)) for p in lay.image]), price_text=_first(lay.price),
        )
    )
    for name, pattern in lay.without.items():
        out = out.filter(~F.coalesce(F.col(name), F.lit("")).rlike(pattern))
    kept = out.groupBy("url", "title", "starts_text").agg(F.min("_pos").alias("_pos"))
    return out.join(kept, ["url", "title", "starts_text", "_pos"], "left_semi")


def richest(pages: DataFrame, rows: DataFrame, site: Column) -> DataFrame:
    """Of several pages of one site the rows of the page that gave most; ties take the first address."""
    counted = rows.groupBy("url").agg(F.count("*").alias("_n")).join(pages.select("url", site.alias("_site")).distinct(), "url")
    best = counted.groupBy("_site").agg(F.max_by("url", F.struct("_n", F.lit(0))).alias("_any"), F.max("_n").alias("_most"))
    first = counted.join(best, "_site").filter("_n = _most").groupBy("_site").agg(F.min("url").alias("url"))
    return rows.join(first.select("url"), "url", "left_semi")


def discovery(pages: DataFrame) -> DataFrame:
    """The answer of a calendar call: a JSON map of days or list of posts with a ``sortkey`` wall time."""
    body = F.regexp_extract("body", r"(?s)(\[.*\])", 1)
    items = pages.select("url", F.posexplode(F.from_json(body, "array<string>")).alias("_pos", "item"))
    get = lambda *p: F.coalesce(*[no_value(F.get_json_object("item", x)) for x in p])
    stamp = F.regexp_replace(get("$.sortkey"), r"^(\d{4})(\d{2})(\d{2})(\d{2})(\d{2})(\d{2})?$", "$1-$2-$3 $4:$5")
    return items.select(*event_row(url=F.col("url"), _pos=F.col("_pos"), source_event_id=get("$.id", "$.ID"), title=decode_entities(get("$.title", "$.post_title")), starts_text=stamp, venue_name=get("$.venue"), ticket_url=get("$.permalink", "$.link"), image_url=get("$.image", "$.thumbnail"))).filter("title is not null and starts_text is not null")


def feed_items(pages: DataFrame) -> DataFrame:
    """Items of an RSS feed that carry a start in an event element or in their publication date."""
    items = pages.select("url", F.posexplode(F.regexp_extract_all("body", F.lit(r"(?is)<item\b.*?</item>"), 0)).alias("_pos", "_block"))
    tag = lambda n: no_value(F.trim(decode_entities(F.regexp_replace(F.regexp_extract("_block", rf"(?is)<(?:[a-z0-9]+:)?{n}\b[^>]*>(.*?)</(?:[a-z0-9]+:)?{n}>", 1), r"(?s)<!\[CDATA\[(.*?)\]\]>", "$1"))))
    return items.select(*event_row(url=F.col("url"), _pos=F.col("_pos"), source_event_id=tag("guid"), title=tag("title"), starts_text=F.coalesce(tag("startdate"), tag("pubDate")), ends_text=tag("enddate"), ticket_url=tag("link"), description=strip_html(tag("description")))).filter("title is not null and starts_text is not null")


def sitemap(pages: DataFrame, most: int | None = None) -> DataFrame:
    """Addresses of a sitemap with when they changed, newest first; ``most`` is the number of pages a run may fetch."""
    entries = pages.select("url", F.explode(F.regexp_extract_all("body", F.lit(r"(?is)<url>.*?</url>"), 0)).alias("e"))
    out = entries.select("url", F.trim(F.regexp_extract("e", r"(?is)<loc>(.*?)</loc>", 1)).alias("page"), no_value(F.regexp_extract("e", r"(?is)<lastmod>(.*?)</lastmod>", 1)).alias("changed")).filter("page <> ''")
    return out if most is None else out.orderBy(F.desc_nulls_last("changed"), "page").limit(most)
