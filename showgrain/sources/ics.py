"""iCalendar files: folded lines, properties with parameters, escaped text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from showgrain.functions.columns import no_value
from showgrain.sources import event_row


def _property(block: Column, name: str) -> Column:
    return F.trim(F.regexp_extract(block, rf"(?m)^{name}(?:;[^:\n]*)?:(.*)$", 1))


def _text(c: Column) -> Column:
    r"""\n, \, and \; unescaped, then \\."""
    c = F.regexp_replace(c, r"\\[nN]", "\n")
    c = F.replace(F.replace(c, F.lit("\\,"), F.lit(",")), F.lit("\\;"), F.lit(";"))
    return F.replace(c, F.lit("\\\\"), F.lit("\\"))


def parse(pages: DataFrame) -> DataFrame:
    """One row per VEVENT that has SUMMARY and DTSTART; recurrence rules are not expanded.

    A TZID stands in ``starts_text`` as ``TZID=zone:time`` for the timestamp dictionary.
    """
    body = F.regexp_replace(F.regexp_replace("body", "\r\n?", "\n"), r"\n[ \t]", "")
    blocks = F.regexp_extract_all(body, F.lit(r"(?s)BEGIN:VEVENT\n(.*?)\nEND:VEVENT"), 1)
    b = pages.select("url", F.posexplode(blocks).alias("_pos", "block"))
    stamp = lambda n: F.when(
        F.regexp_extract("block", rf"(?m)^{n};[^:\n]*TZID=([^:;\n]+)", 1) != "",
        F.concat(F.lit("TZID="), F.regexp_extract("block", rf"(?m)^{n};[^:\n]*TZID=([^:;\n]+)", 1), F.lit(":"), _property(F.col("block"), n)),
    ).otherwise(no_value(_property(F.col("block"), n)))
    p = lambda n: no_value(_text(_property(F.col("block"), n)))
    out = b.select(
        *event_row(url=F.col("url"), _pos=F.col("_pos"), source_event_id=p("UID"), title=p("SUMMARY"), starts_text=stamp("DTSTART"), ends_text=stamp("DTEND"), venue_name=p("LOCATION"), description=p("DESCRIPTION"), ticket_url=p("URL"))
    )
    return out.filter("title is not null and starts_text is not null")
