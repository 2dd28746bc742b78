"""Which platform a page belongs to: ordered rules, first match wins; and feeds it links to."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from showgrain.functions.columns import no_value

#: Platform and the signs of it in an address or page, in order (fixed values). Signs that must stand together are looked for from the start of the text only.
SIGNS = [
    ("ical", r"\.ics(\?|$|\n)|webcal:|text/calendar|begin:vcalendar"),
    ("google_calendar", r"calendar\.google\.com|google\.com/calendar"),
    ("eventbrite", r"eventbrite\.com|eventbrite-widget"),
    ("bandsintown", r"bandsintown\.com|bandsintown-widget"),
    ("axs", r"axs\.com"),
    ("event_discovery", r"event-discovery|get_events_for_calendar"),
    ("seatengine", r"seatengine\.com|id=[\"']se-calendar[\"']"),
    ("ace_calendar", r"ace-calendar\.js|ace-api/events|ace-cal-list-|calendarkeyword"),
    ("squarespace_events", r"(?s)\A(?=.*(squarespace|sqspcdn))(?=.*(eventlist-event|eventlist-title))"),
    ("squarespace_user_items", r"(?s)\A(?=.*user-items-list)(?=.*list-item-content__(title|button))"),
    ("zoogle", r"zoogletools\.com|data-occurrence-id|calendar_feature_"),
    ("columns", r"(?s)\A(?=.*event-column d-flex)(?=.*event-tag)(?=.*event-date)"),
    ("media_cards", r"(?s)\A(?=.*upcoming-shows)(?=.*card events)(?=.*media-left)"),
    ("livenation", r"livenation|ticketmaster\.com"),
    ("webflow", r"(?s)\A(?=.*(website-files\.com|webflow))(?=.*/events/)"),
    ("spacecrafted", r"spacecrafted\.com|eventcoll-item|itemscollectioncontent"),
    ("spotapps", r"(?s)\A(?=.*event-calendar-card)(?=.*(pinboardagendacontainer|data-event-start-date|events-pinboard-view))|\A(?=.*static\.spotapps\.co)(?=.*(event-image|events-holder|atc_date_start|event-calendar-card))|\A(?=.*events-holder)(?=.*event-time)(?=.*atc_date_start)"),
    ("events_manager", r"(?s)em-cal-body|em-cal-days|event_notes|events-manager/v1|\A(?=.*event_name)(?=.*event_date)(?=.*event_id=)"),
    ("mec", r"/all-events/|modern-events-calendar|mec-calendar|cat_ids~"),
    ("prekindle", r"prekindle\.com/api/events/organizer/|pk-cal-widget|pk-cal-loader|data-org-id"),
    ("tec", r"tribe-events|the-events-calendar|tec-events|tribe_events|/events/month/"),
    ("eventon", r"eventon|ajde_events|ajde_evcal|evcal_"),
    ("mec", r"mec-events|mec_event"),
    ("wordpress", r"wp-content|wordpress|wp-json"),
]


def platform(url: Column | str, body: Column | str | None = None) -> Column:
    """The first platform whose sign stands in the address or the page; 'custom_html' for none."""
    text = F.lower(F.concat_ws("\n", *[F.col(c) if isinstance(c, str) else c for c in (url, body) if c is not None]))
    out = F.lit("custom_html")
    for name, sign in reversed(SIGNS):
        out = F.when(F.coalesce(text.rlike(sign), F.lit(False)), name).otherwise(out)
    return out


def feed_link(body: Column | str) -> Column:
    """The first calendar feed a page links to, with http for webcal; null for none."""
    link = F.regexp_extract(F.col(body) if isinstance(body, str) else body, r"(?i)href=\"((?:webcal|https?)://[^\"]+\.ics[^\"]*|webcal://[^\"]+)\"", 1)
    return no_value(F.regexp_replace(link, r"(?i)^webcal:", "https:"))
