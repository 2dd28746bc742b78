"""Title grammar: the act a title is about, and the bill it announces.

Rule order matters, so the grammar runs per distinct title in Arrow batches; splitting
itself is that of ``operators.packed``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from showgrain.functions.text import mixed_script_fold
from showgrain.operators.packed import STATUS, Known, split_values, undecorated

# --- fixed values -----------------------------------------------------------------
#: Openings that credit an act without naming it.
CREDITS = r"(?:a\s+)?(?:tribute to|the music of|celebrating|salute to)\s+"
PRESENTS = r"^.{2,60}?\s+(?:presents?|presenting)\s*:?\s+"
GUEST = r"\s(?:feat|ft)\.?\s|\sfeaturing\s|\swith\s+special\s+guests?\s"
OPENER = r"\sw/\s?|\swith\s|\splus\s+"
# ----------------------------------------------------------------------------------

_NONE = Known([])


def band_name(title: str | None, venue: str | None = None, series: frozenset[str] = frozenset()) -> str:
    """The act of a title: announcements, venue, tour and guests taken off, the first of a bill.

    A series (lower case names) that stands before its guest is no act: the guest is.
    """
    if not title:
        return ""
    t = re.sub(r"^[\[({]\s*|\s*[\])}]$|\.+$", "", mixed_script_fold(title).strip()).strip()
    if venue:
        v = re.escape(venue.strip())
        t = re.sub(rf"\s*(?:[-–—|]|\bat\b|@)\s*(?:the\s+)?{v}\s*$", "", t, flags=re.I)
    t = re.sub(rf"^(?:{STATUS})\s*[–—:!-]\s*", "", t, flags=re.I)
    # a line-up in brackets that was cut off with its closing bracket
    t = re.sub(r"^(.{3,}?)\s*\([A-Z][^)]*$", r"\1", t)
    t = re.sub(r"^.+\stribute\s*:\s*(?=\S)", "", t, flags=re.I)
    t = re.sub(r"^(.{2,}?)\s+album\s+release\b.*$", r"\1", t, flags=re.I)
    t = re.sub(r"^([^:]{2,}?)\s*:\s*[^:]*tour\b[^:]*$", r"\1", t, flags=re.I)
    if m := re.search(OPENER, t, re.I):
        head = re.sub(r"\s+", " ", t[: m.start()]).strip().lower()
        if head in series or head.split(":")[-1].strip() in series:
            t = t[m.end() :]
    t = undecorated(t, _NONE)
    t = re.sub(PRESENTS, "", t, flags=re.I)
    t = re.sub(rf"^{CREDITS}", "", t, flags=re.I)
    t = re.sub(r"\s+(?:&|and)\s+friends$", "", t, flags=re.I)
    acts = split_values(t, _NONE)
    return (acts[0] if acts else t).strip(" .,-–—")


def bill(title: str | None) -> list[tuple[str, str, int]]:
    """(name, role, order) of the acts of a title: headliner, support, opener, special_guest."""
    if not title:
        return []
    t = undecorated(mixed_script_fold(title).strip(), _NONE)
    m = re.search(GUEST, t, re.I)
    main, guests = (t[: m.start()], t[m.end() :]) if m else (t, "")
    m = re.search(OPENER, main, re.I)
    main, openers = (main[: m.start()], main[m.end() :]) if m else (main, "")
    out, seen = [], set()
    for text, roles in ((main, ("headliner", "support")), (openers, ("support", "opener")), (guests, ("special_guest", "special_guest"))):
        for k, name in enumerate(split_values(text, _NONE) or ([text.strip()] if text.strip() else [])):
            if name.lower() not in seen:
                seen.add(name.lower())
                out.append((name, roles[min(k, 1)], len(out) + 1))
    return out


def _bands(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        yield b.assign(band_name=[band_name(t, v) for t, v in zip(b.title, b.venue_name, strict=True)])


def _bills(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = [(t, *slot) for t in b.title for slot in bill(t)]
        yield pd.DataFrame(rows, columns=["title", "name", "role", "billing_order"]).astype({"billing_order": "int32"})


def band_names(rows: DataFrame) -> DataFrame:
    """Distinct ``title``, ``venue_name`` with ``band_name``."""
    return rows.select("title", "venue_name").filter("title is not null").distinct().mapInPandas(_bands, "title string, venue_name string, band_name string")


def lineups(rows: DataFrame) -> DataFrame:
    """Distinct ``title`` with one row per act: ``name``, ``role``, ``billing_order``."""
    return rows.select("title").filter(F.trim("title") != "").distinct().mapInPandas(_bills, "title string, name string, role string, billing_order int")
