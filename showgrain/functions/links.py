"""Links, images and small texts as Spark columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from showgrain.functions.columns import _col, decode_entities, no_value, normalize_title, url_host

# --- fixed values -----------------------------------------------------------------
#: What an image address gains or loses by what stands in it, as patterns on lower case.
IMAGE_POINTS = [
    (r"event_detail_page|event-detail", 40), (r"16_9|16:9", 20), (r"/uploads/", 30), (r"\.svg(\?|$)", -80), (r"footer", -60), (r"-p-\d+\.", -15), (r"\d{3,4}w[,\s]", 20), (r"logo|wordmark", -50),
]
#: Words that follow a band's name without changing it.
BAND_ENDINGS = ["trio", "band", "and friends"]
# ----------------------------------------------------------------------------------


def at_host(url: Column | str, hosts: list[str]) -> Column:
    """Whether a link leads to one of the hosts or to a host under one; false for no link."""
    host = url_host(url)
    tests = [(host == h) | host.endswith(f".{h}") for h in hosts]
    out = F.lit(False)
    for t in tests:
        out = out | t
    return F.coalesce(out, F.lit(False))


def usable_link(url: Column | str) -> Column:
    """A link without outer blanks; null for none, for '#' and for scripts."""
    u = F.trim(_col(url))
    return F.when((u != "") & (u != "#") & ~F.lower(u).startswith("javascript:"), u)


def plain_title(title: Column | str) -> Column:
    """A title decoded and out of its brackets."""
    t = decode_entities(title)
    t = F.regexp_replace(t, r"^[\[({]\s*", "")
    return F.trim(F.regexp_replace(t, r"\s*[\])}]$", ""))


def band_form(name: Column | str) -> Column:
    """A name's title form without what may follow a band's name."""
    form = normalize_title(name)
    for word in BAND_ENDINGS:
        form = F.regexp_replace(form, rf"\s+{word}$", "")
    return F.trim(form)


def series_name(name: Column | str, names: list[str]) -> Column:
    """Whether a title names a series, with or without an announcement and a colon before it."""
    n = F.trim(F.regexp_replace(F.lower(_col(name)), r"\s+", " "))
    bare = F.trim(F.regexp_replace(n, r"^(?:live music|free concert|special event)\s*:\s*", ""))
    return F.coalesce(n.isin(names) | bare.isin(names), F.lit(False))


def image_points(url: Column | str) -> Column:
    """How likely an image shows the event."""
    low = F.lower(_col(url))
    out = F.lit(0)
    for pattern, points in IMAGE_POINTS:
        out = out + F.when(low.rlike(pattern), points).otherwise(0)
    return F.when(no_value(url).isNotNull(), out)


def first_snippet(text: Column | str, least_words: int = 15) -> Column:
    """The first line of prose with so many words: no heading, link or image; null for none."""
    lines = F.transform(F.split(_col(text), "\n"), lambda x: F.trim(F.regexp_replace(x, r"[ \t\r]+", " ")))
    prose = F.filter(lines, lambda x: ~x.rlike(r"^[#\[!]") & (F.size(F.split(x, " ")) >= least_words))
    return F.get(prose, 0)


def vendor_id(url: Column | str) -> Column:
    """The event's id in a link of the form .../event/ID or .../events/ID."""
    return no_value(F.regexp_extract(_col(url), r"(?i)/events?/([A-Za-z0-9]+)(?:[/?#]|$)", 1))


def unwrapped(url: Column | str) -> Column:
    """The address that an image proxy carries in its ``url`` parameter, else the address itself."""
    inner = F.regexp_extract(_col(url), r"[?&]url=([^&]+)", 1)
    return F.when(inner != "", F.url_decode(inner)).otherwise(_col(url))


def flat_form(entries: Column | str) -> Column:
    """A map of maps as form fields: ``outer[inner]`` -> value; null values stay away."""
    pairs = F.flatten(
        F.transform(F.map_entries(_col(entries)), lambda o: F.transform(F.map_entries(o["value"]), lambda i: F.struct(F.concat(o["key"], F.lit("["), i["key"], F.lit("]")).alias("key"), i["value"].alias("value"))))
    )
    return F.map_from_entries(F.filter(pairs, lambda p: p["value"].isNotNull()))


def json_before_noise(text: Column | str) -> Column:
    """The longest opening part of a text that ends in a bracket and is JSON; null for none."""
    t = _col(text)
    ends = F.filter(F.sequence(F.length(t), F.lit(1)), lambda i: F.substring(t, i, F.lit(1)).isin("}", "]"))
    parts = F.transform(ends, lambda i: F.substring(t, F.lit(1), i))
    # a path that is not there gives null in JSON and out of it; the whole tells whether it was read
    return F.when(F.length(t) > 0, F.get(F.filter(parts, lambda p: F.get_json_object(p, "$").isNotNull()), 0))
