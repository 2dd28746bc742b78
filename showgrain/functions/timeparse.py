"""One parser for every way a source writes the start of a show.

``parse_instant`` is a pure function of (text, zone, reference day).  It runs on the
distinct values only (see ``operators.timestamps``), so it is written for coverage:
it finds one date and one clock time in the text and a zone behind them.
"""

from __future__ import annotations

import re
import unicodedata
from datetime import UTC, date, datetime, timedelta, timezone
from functools import lru_cache
from zoneinfo import ZoneInfo, available_timezones

DEFAULT_ZONE = "America/Chicago"

# --- fixed values -----------------------------------------------------------------
#: Zone names people type, lower case, beside the IANA names.
ZONE_NAMES = {
    "central": "America/Chicago",
    "central time": "America/Chicago",
    "central standard time": "America/Chicago",
    "central daylight time": "America/Chicago",
    "central time (us & canada)": "America/Chicago",
    "cst6cdt": "America/Chicago",
    "ct": "America/Chicago",
    "cst": "America/Chicago",
    "cdt": "America/Chicago",
    "chicago": "America/Chicago",
    "eastern": "America/New_York",
    "eastern time": "America/New_York",
    "eastern standard time": "America/New_York",
    "eastern daylight time": "America/New_York",
    "eastern time (us & canada)": "America/New_York",
    "est5edt": "America/New_York",
    "et": "America/New_York",
    "est": "America/New_York",
    "edt": "America/New_York",
    "new york": "America/New_York",
    "mountain": "America/Denver",
    "mountain time": "America/Denver",
    "mountain standard time": "America/Denver",
    "mountain daylight time": "America/Denver",
    "mountain time (us & canada)": "America/Denver",
    "mst7mdt": "America/Denver",
    "mt": "America/Denver",
    "mst": "America/Denver",
    "mdt": "America/Denver",
    "denver": "America/Denver",
    "arizona": "America/Phoenix",
    "us mountain standard time": "America/Phoenix",
    "phoenix": "America/Phoenix",
    "pacific": "America/Los_Angeles",
    "pacific time": "America/Los_Angeles",
    "pacific standard time": "America/Los_Angeles",
    "pacific daylight time": "America/Los_Angeles",
    "pacific time (us & canada)": "America/Los_Angeles",
    "pst8pdt": "America/Los_Angeles",
    "pt": "America/Los_Angeles",
    "pst": "America/Los_Angeles",
    "pdt": "America/Los_Angeles",
    "los angeles": "America/Los_Angeles",
    "alaska": "America/Anchorage",
    "hawaii": "Pacific/Honolulu",
    "utc": "UTC",
    "gmt": "UTC",
    "z": "UTC",
}
#: Abbreviations with an offset of their own, in hours.
FIXED_OFFSETS = {
    "utc": 0,
    "gmt": 0,
    "z": 0,
    "est": -5,
    "edt": -4,
    "cst": -6,
    "cdt": -5,
    "mst": -7,
    "mdt": -6,
    "pst": -8,
    "pdt": -7,
    "akst": -9,
    "akdt": -8,
    "hst": -10,
}
#: Abbreviations that mean the local time of a zone.
GENERIC_ZONES = {
    "et": "America/New_York",
    "ct": "America/Chicago",
    "mt": "America/Denver",
    "pt": "America/Los_Angeles",
}
#: Month names by number: English, Spanish, German; matched by whole word or common short form.
MONTH_NAMES = {
    1: "january jan enero ene januar jänner",
    2: "february feb febrero februar",
    3: "march mar marzo märz mär",
    4: "april apr abril abr",
    5: "may mayo mai",
    6: "june jun junio juni",
    7: "july jul julio juli",
    8: "august aug agosto ago",
    9: "september sept sep septiembre set",
    10: "october oct octubre oktober okt",
    11: "november nov noviembre",
    12: "december dec diciembre dic dezember dez",
}
# ----------------------------------------------------------------------------------

MONTHS = {w: n for n, words in MONTH_NAMES.items() for w in words.split()}
_MON = "(?P<mon>" + "|".join(sorted(MONTHS, key=len, reverse=True)) + r")\b\.?"
_YEAR = r"(?P<y>\d{4})"
_DATES = [
    re.compile(rf"(?<!\d){_YEAR}[-/](?P<m>\d{{1,2}})[-/](?P<d>\d{{1,2}})(?!\d)"),
    re.compile(rf"(?<!\d)(?P<d>\d{{1,2}})-{_MON}-(?P<y>\d{{4}}|\d{{2}})(?!\d)", re.I),
    re.compile(r"(?<!\d)(?P<m>\d{1,2})/(?P<d>\d{1,2})/(?P<y>\d{4}|\d{2})(?!\d)"),
    re.compile(r"(?<!\d)(?P<d>\d{1,2})\.\s?(?P<m>\d{1,2})\.\s?(?P<y>\d{4}|\d{2})(?!\d)"),
    re.compile(rf"\b{_MON}\s*(?P<d>\d{{1,2}})(?:st|nd|rd|th)?(?!\d)(?:,?\s*(?P<y>\d{{4}})(?!\d))?", re.I),
    re.compile(rf"(?<!\d)(?P<d>\d{{1,2}})(?:st|nd|rd|th|\.)?\s*(?:de\s+)?{_MON}(?:,?\s*(?:de\s+)?(?P<y>\d{{4}})(?!\d))?", re.I),
    re.compile(r"(?<![\d/])(?P<m>\d{1,2})/(?P<d>\d{1,2})(?![\d/])"),
    re.compile(r"(?<![\d.])(?P<d>\d{1,2})\.(?P<m>\d{1,2})\.(?![\d])"),
]
_CLOCK = re.compile(
    r"(?<![\d:.+-])(?P<h>\d{1,2})(?:(?:[:h]|\.(?=\d\d\s*(?:[ap]\.?m|uhr)))(?P<mi>\d{2})(?::(?P<s>\d{2})(?:[.,]\d+)?)?)?"
    r"\s*(?P<ap>[ap](?:\.?\s?m\b\.?|\b))?(?![\d:])",
    re.I,
)
_NAMED_CLOCK = re.compile(r"\b(noon|midnight)\b", re.I)
_DOORS = re.compile(r"\b(?:doors?|einlass|puertas)\b[^/|;\d]*?$", re.I)
_SHOW = re.compile(r"\b(?:show|starts?|music|beginn|begins?)\b[^\d]*$", re.I)
_OFFSET = re.compile(r"^\s*(?:(?:utc|gmt)\s*)?([+-])(\d{2}):?(\d{2})?\s*(?:\([A-Za-z ]+\))?\s*$", re.I)
_ABBREVIATION = re.compile(r"\b(" + "|".join([*FIXED_OFFSETS, *GENERIC_ZONES]) + r")\b(?!')", re.I)
_INVISIBLE = re.compile("[­​-‏⁠﻿]")
_BASIC = re.compile(r"^(\d{4})(\d{2})(\d{2})T(\d{2})(\d{2})(\d{2})?(?:[.,]\d+)?\s*(.*)$")
_TZID = re.compile(r"^;?TZID=([^:]+):(.*)$", re.I)


@lru_cache(maxsize=1)
def _iana() -> dict[str, str]:
    return {z.lower(): z for z in available_timezones()}


def resolve_zone(name: str | None) -> str | None:
    """The IANA name a hand-typed zone means; None where it means nothing we know."""
    if name is None or not name.strip():
        return DEFAULT_ZONE
    key = " ".join(_INVISIBLE.sub("", name).lower().split())
    found = ZONE_NAMES.get(key) or _iana().get(key.replace(" ", "_"))
    if found:
        return {"cst6cdt": "America/Chicago", "est5edt": "America/New_York", "mst7mdt": "America/Denver", "pst8pdt": "America/Los_Angeles"}.get(found.lower(), found)
    m = re.match(r"^(?:utc|gmt)?([+-])(\d{1,2}):?(\d{2})?$", key)
    return f"{m[1]}{int(m[2]):02d}:{m[3] or '00'}" if m else None


@lru_cache(maxsize=256)
def _zone(name: str):
    m = re.match(r"^([+-])(\d{2}):(\d{2})$", name)
    if m:
        return timezone((1 if m[1] == "+" else -1) * timedelta(hours=int(m[2]), minutes=int(m[3])))
    return ZoneInfo(name)


def wall_to_utc(wall: datetime, zone: str) -> datetime:
    """Earlier instant for a repeated wall time; a skipped one moves forward by the gap."""
    return wall.replace(tzinfo=_zone(zone), fold=0).astimezone(UTC)


def _nearest_year(month: int, day: int, ref: date) -> date | None:
    best = None
    for y in (ref.year - 1, ref.year, ref.year + 1):
        try:
            d = date(y, month, day)
        except ValueError:
            continue
        if best is None or abs((d - ref).days) < abs((best - ref).days):
            best = d
    return best


def _find_date(text: str, ref: date | None) -> tuple[date, str] | None:
    """The one date of the text and the text without it; None for no date or an undecided one."""
    found: list[date] = []
    for pattern in _DATES:
        rest = text
        for m in pattern.finditer(text):
            g = m.groupdict()
            month = MONTHS[g["mon"].lower().rstrip(".")] if g.get("mon") else int(g["m"])
            year = g.get("y")
            try:
                if year:
                    d = date(int(year) + (2000 if len(year) == 2 else 0), month, int(g["d"]))
                elif ref is None:
                    continue
                else:
                    d = _nearest_year(month, int(g["d"]), ref)
            except ValueError:
                continue
            if d is None:
                continue
            found.append(d)
            rest = rest.replace(m[0], " \x00 ", 1)
        if found:
            return (found[0], rest) if len(set(found)) == 1 else None
    return None


def _hour(h: int, ap: str | None) -> int | None:
    if ap:
        if not 1 <= h <= 12:
            return h if ap[0] in "pP" and 12 < h < 24 else None
        return h % 12 + (12 if ap[0] in "pP" else 0)
    return h if 0 <= h <= 23 else None


def _find_clock(text: str) -> tuple[tuple[int, int, int], str] | None:
    """The show's clock time and what stands behind it."""
    times = []
    for m in _CLOCK.finditer(text):
        if m["mi"] is None and m["ap"] is None:
            continue
        h, mi, s = _hour(int(m["h"]), m["ap"]), int(m["mi"] or 0), int(m["s"] or 0)
        if h is None or mi > 59 or s > 60:
            continue
        before = text[: m.start()]
        label = 2 if _DOORS.search(before) else 0 if _SHOW.search(before) else 1
        times.append((label, m.start(), (h, mi, min(s, 59)), text[m.end() :]))
    for m in _NAMED_CLOCK.finditer(text):
        times.append((1, m.start(), (12 if m[1].lower() == "noon" else 0, 0, 0), text[m.end() :]))
    times = [t for t in times if t[0] < 2]
    if not times:
        return None
    best = min(times)
    return best[2], best[3]


def parse_instant(text: str | None, zone: str | None, ref: date | None) -> int | None:
    """Seconds since 1970 of the start that ``text`` tells to the minute, else None.

    zone: IANA name used where the text has none of its own.  ref: the day to which a
    date without a year is nearest.
    """
    if not text:
        return None
    t = " ".join(_INVISIBLE.sub("", unicodedata.normalize("NFKC", text)).split())
    zone = zone or DEFAULT_ZONE
    m = _TZID.match(t)
    if m:
        zone, t = resolve_zone(m[1].strip("\"'")) or zone, m[2].strip()
    if t.isascii() and t.isdigit():
        return int(t) // {10: 1, 13: 1000, 16: 1_000_000}[len(t)] if len(t) in (10, 13, 16) else None
    m = _BASIC.match(t)
    try:
        if m:
            wall, behind = datetime(int(m[1]), int(m[2]), int(m[3]), int(m[4]), int(m[5]), int(m[6] or 0)), m[7]
        else:
            # the T of an ISO form parts date and time
            t = re.sub(r"(?<=\d)[Tt](?=\d{2}(?::|\d{2}|\b))", " ", t)
            if not (dated := _find_date(t, ref)):
                return None
            if not (clock := _find_clock(dated[1])):
                return None
            wall, behind = datetime(dated[0].year, dated[0].month, dated[0].day, *clock[0]), clock[1]
        if o := _OFFSET.match(behind):
            hours, minutes = int(o[2]), int(o[3] or 0)
            if hours <= 14 and minutes < 60:
                offset = timedelta(hours=hours, minutes=minutes) * (1 if o[1] == "+" else -1)
                return int((wall - offset).replace(tzinfo=UTC).timestamp())
        if a := _ABBREVIATION.search(behind):
            short = a[1].lower()
            if short in GENERIC_ZONES:
                return int(wall_to_utc(wall, GENERIC_ZONES[short]).timestamp())
            return int((wall - timedelta(hours=FIXED_OFFSETS[short])).replace(tzinfo=UTC).timestamp())
        return int(wall_to_utc(wall, zone).timestamp())
    except (ValueError, OverflowError):
        return None


def find_day(text: str | None, ref: date | None) -> date | None:
    """The one calendar day a text names, with or without a clock time."""
    if not text:
        return None
    t = " ".join(_INVISIBLE.sub("", unicodedata.normalize("NFKC", text)).split())
    try:
        found = _find_date(t, ref)
    except (ValueError, OverflowError):
        return None
    return found[0] if found else None
