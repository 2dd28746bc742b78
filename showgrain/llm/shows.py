"""What two records of shows are compared by: title form, identifiers, start, bit vectors."""

from __future__ import annotations

import re

import xxhash
from pyspark.sql import functions as F

from showgrain.functions.text import bare, mixed_script_fold
from showgrain.operators.packed import Known, split_values, undecorated

# --- fixed values -----------------------------------------------------------------
#: Announcements that listings put before or behind a title.
ANNOUNCED = "just announced|sold out|new show|new date|added|cancell?ed|postponed|rescheduled|low tickets|final tickets|tickets|on sale now"
#: What city feeds put around a title.
FEED_BEFORE = "live|live music|concert|tonight|an evening with|see|event"
FEED_BEHIND = "in concert|live in concert|on tour|one night only|tonight|tickets|live|live music|free|free show|all ages|21\\+|18\\+|solo acoustic"
#: Query parameters of links that tell where a visitor came from.
TRACKING = "utm_[a-z]+|fbclid|gclid|msclkid|mc_[a-z]+|ref|aff|affiliate|source|campaign"
#: Other spellings of kinds of venues.
VENUE_WORDS = {"theatre": "theater", "theatr": "theater", "thtr": "theater", "amph": "amphitheater", "amphitheatre": "amphitheater", "brewing": "brewery", "co": "", "company": "", "brewpub": "brewery", "ctr": "center", "centre": "center", "the": "", "at": "", "club": "", "music": "", "rd": "road", "ave": "avenue", "st": "street", "ln": "lane", "blvd": "boulevard", "dr": "drive"}
# ----------------------------------------------------------------------------------

_BEFORE = re.compile(rf"^(?:\[?\(?(?:{ANNOUNCED})\]?\)?\s*[:–—!-]?\s+|\[[^\]]*\]\s*)+", re.I)
_BEHIND = re.compile(rf"(?:\s*[–—-]\s*(?:{ANNOUNCED}|free)|\s*[(\[](?:all ages|21\+|18\+|{ANNOUNCED}|free)[)\]])+$", re.I)
_FEED_BEFORE = re.compile(rf"^(?:(?:{FEED_BEFORE})\s*:\s+|an\s+e\w{{4,8}}\s+w\w{{1,4}}\s+)+", re.I)
_FEED_BEHIND = re.compile(rf"(?:\s+(?:[–—-]\s*)?(?:in concert|live)|\s*[–—-]\s*(?:{FEED_BEHIND})|\s*[(\[](?:{FEED_BEHIND})[)\]])+$", re.I)
_NOTHING = Known([])
_FRIENDS = re.compile(r"\s+(?:(?:and|&|\+|with)\s+(?:friends|guests|more|special guests?)|tonight)$", re.I)
_WORD = re.compile(r"[^\W_]+")


def title_form(title: str | None) -> str:
    """A venue listing's title without announcements: bare words, single blanks."""
    if not title:
        return ""
    t = mixed_script_fold(title).strip()
    for _ in range(2):
        t = _BEHIND.sub("", _BEFORE.sub("", t)).strip()
    return " ".join(_WORD.findall(bare(t)))


def act_form(title: str | None) -> str:
    """A title down to the acts: also without what feeds, venues and tours add."""
    if not title:
        return ""
    t = mixed_script_fold(title).strip()
    for _ in range(3):
        t = _BEHIND.sub("", _BEFORE.sub("", t)).strip()
        t = _FEED_BEHIND.sub("", _FEED_BEFORE.sub("", t)).strip()
        t = undecorated(t, _NOTHING) or t
    return " ".join(_WORD.findall(bare(t)))


def head_form(title: str | None) -> str:
    """The first act of a title, which is all that some feeds name."""
    if not title:
        return ""
    acts = split_values(_FEED_BEHIND.sub("", _FEED_BEFORE.sub("", _BEHIND.sub("", _BEFORE.sub("", mixed_script_fold(title).strip())))), _NOTHING, title=True)
    return act_form(_FRIENDS.sub("", acts[0])) if acts else act_form(title)


def venue_form(name: str | None, cities: frozenset[str] = frozenset()) -> str:
    """A venue's name in plain words, without a closing city and with one spelling for its kind."""
    if not name:
        return ""
    t = bare(mixed_script_fold(name)).strip()
    m = re.match(r"^(.*\S)\s*(?:,|\s[-–—]|\s[|(])\s*([^,()|]+?)\)?$", t)
    if m and (m[2] in cities or not cities):
        t = m[1]
    ws = [VENUE_WORDS.get(w, w) for w in _WORD.findall(t)]
    return " ".join(w for w in ws if w) or t


def grams(form: str, q: int = 2) -> list[str]:
    """Distinct q-grams of the words of a form, so that their order does not matter."""
    out = set()
    for w in form.split():
        p = f"^{w}$"
        out.update(p[i : i + q] for i in range(len(p) - q + 1))
    return sorted(out)


def bit_vector(items: list[str], bits: int, hashes: int = 2) -> list[int]:
    """The items hashed into a fixed number of bits, as signed 64-bit words."""
    v = 0
    for x in items:
        h = xxhash.xxh64_intdigest(x)
        for k in range(hashes):
            v |= 1 << ((h >> (16 * k)) & 0xFFFF) % bits
    words = [(v >> (64 * i)) & 0xFFFFFFFFFFFFFFFF for i in range(bits // 64)]
    return [w - (1 << 64) if w >= 1 << 63 else w for w in words]


def identifier(col: str) -> F.Column:
    """A source's identifier without host and revision marks; null for no value."""
    c = F.lower(F.trim(col))
    # a revision mark follows the host or the number itself
    c = F.regexp_replace(c, r"(?<=[0-9a-z])(-[a-z]|[_-]v\d+)$", "")
    c = F.regexp_replace(c, r"@.*$", "")
    return F.nullif(c, F.lit(""))


def page(col: str) -> F.Column:
    """A ticket link down to the page it names: host, path and identifying parameters."""
    c = F.lower(F.trim(col))
    c = F.regexp_replace(F.regexp_replace(c, r"^[a-z]+://(www\.)?", ""), r"#.*$", "")
    path = F.regexp_replace(F.substring_index(c, "?", 1), r"/+$", "")
    query = F.when(F.contains(c, F.lit("?")), F.regexp_replace(c, r"^[^?]*\?", "")).otherwise("")
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(rf"^({TRACKING})(=|$)")))
    return F.nullif(F.concat_ws("?", path, F.nullif(F.array_join(kept, "&"), F.lit(""))), F.lit(""))
