"""The starts of all listings in SQL: what the timestamp operator is checked with.

Written apart from the operator's parser, for the texts of the tables only: a chain of
common table expressions that ends in ``told`` (``_ord``, ``s`` in seconds, ``canonical``).
"""

from __future__ import annotations

#: A date with its parts, each family of writing one pattern; the first that fits decides.
_FAMILIES = {
    "iso": (r"(\d{4})-(\d{1,2})-(\d{1,2})", "y m d"),
    "named": (r"\b(\d{1,2})-([A-Za-z]{3,9})-(\d{4})", "d mon y"),
    "slash": (r"\b(\d{1,2})/(\d{1,2})/(\d{4}|\d{2})\b", "m d y"),
    "dots": (r"\b(\d{1,2})\.(\d{1,2})\.(\d{4})\b", "d m y"),
    "month_first": (r"(?i)\b(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\.?\s+(\d{1,2})(?:st|nd|rd|th)?\b(?:,?\s+(\d{4})\b)?", "mon d y"),
    "day_first": (r"(?i)\b(\d{1,2})(?:st|nd|rd|th)?\.?\s+(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\.?(?:,?\s+(\d{4})\b)?", "d mon y"),
    "bare": (r"\b(\d{1,2})/(\d{1,2})\b", "m d"),
}


def _part(name: str) -> str:
    """SQL of one part of the date, by family."""
    whens = []
    for family, (pattern, parts) in _FAMILIES.items():
        order = parts.split()
        if name in order:
            got = f"regexp_extract(body, '{pattern}', {order.index(name) + 1})"
        elif name == "m" and "mon" in order:
            got = f"list_position(['jan','feb','mar','apr','may','jun','jul','aug','sep','oct','nov','dec'], lower(left(regexp_extract(body, '{pattern}', {order.index('mon') + 1}), 3)))::VARCHAR"
        else:
            got = "''"
        whens.append(f"WHEN family = '{family}' THEN {got}")
    return "CASE " + " ".join(whens) + " END"


_FAMILY = "CASE " + " ".join(f"WHEN regexp_matches(body, '{p}') THEN '{f}'" for f, (p, _) in _FAMILIES.items()) + " END"
_REST = "CASE " + " ".join(f"WHEN family = '{f}' THEN regexp_replace(body, '{p}', ' ')" for f, (p, _) in _FAMILIES.items()) + " END"
_CLOCK = r"(?i)(?:^|[^0-9:.+-])(\d{1,2})(?:[:h](\d{2}))?(?::(\d{2})(?:\.\d+)?)?\s*(?:([ap])(?:\.?\s?m\b\.?|\b))?"
_DOORS = r"(?i)\b(?:doors?)\b[^/|;0-9]*\d{1,2}(?:[:h]\d{2})?\s*(?:[ap]\.?\s?m?\b\.?)?"
_CLOCKED = r"(?i)\d{1,2}(?:[:h]\d{2}|\s*[ap]\b|\s*[ap]\.?\s?m\b)"
_WALL = "make_timestamp(y, m, d, h, mi, sec::DOUBLE)"


STARTS = rf"""
zoned AS (SELECT id AS sid, CASE WHEN regexp_matches(k, 'arizona|phoenix') THEN 'America/Phoenix' WHEN regexp_matches(k, 'pacific|los_angeles|pst8pdt|^pt$') THEN 'America/Los_Angeles'
  WHEN regexp_matches(k, 'mountain|denver|mst7mdt|^mt$') THEN 'America/Denver' WHEN regexp_matches(k, 'eastern|new.york|est5edt|^et$') THEN 'America/New_York' ELSE 'America/Chicago' END AS zone
  FROM (SELECT id, lower(trim(coalesce(timezone, ''))) AS k FROM venue_event_sources)),
rows_ AS (SELECT _ord, starts_at, raw_date_text, coalesce(zone, 'America/Chicago') AS zone, fetched_at::DATE AS ref,
  coalesce(regexp_matches(starts_at, '^\d{{4}}-\d{{2}}-\d{{2}}T\d{{2}}:\d{{2}}:\d{{2}}(\.\d{{3}})?Z$'), false) AS canonical FROM partner_event LEFT JOIN zoned ON source_id = sid),
texts AS (SELECT DISTINCT t, zone, ref FROM (SELECT starts_at AS t, zone, ref FROM rows_ UNION ALL SELECT raw_date_text, zone, ref FROM rows_) WHERE regexp_matches(t, '[0-9]')),
bodies AS (SELECT t, zone, ref, CASE WHEN t LIKE 'TZID=%' THEN regexp_extract(t, '^TZID=([^:]+):', 1) ELSE zone END AS place,
  regexp_replace(regexp_replace(regexp_replace(trim(regexp_replace(t, '\s+', ' ', 'g')), '^TZID=[^:]+:', ''), '^(\d{{4}})(\d{{2}})(\d{{2}})T(\d{{2}})(\d{{2}})(\d{{2}})?', '\1-\2-\3 \4:\5:\6'), '(\d)T(\d)', '\1 \2') AS body FROM texts),
families AS (SELECT *, {_FAMILY} AS family FROM bodies),
parts AS (SELECT *, {_part('y')} AS y_, {_part('m')} AS m_, {_part('d')} AS d_, regexp_replace({_REST}, '{_DOORS}', ' ') AS rest FROM families WHERE family IS NOT NULL),
dated_ AS (SELECT *, CASE WHEN y_ = '' THEN NULL WHEN length(y_) = 2 THEN 2000 + y_::INT ELSE y_::INT END AS y0, try_cast(m_ AS INT) AS m, try_cast(d_ AS INT) AS d,
  regexp_extract(rest, '{_CLOCKED}.*$') AS late, regexp_extract(' ' || regexp_extract(rest, '{_CLOCKED}.*$'), '{_CLOCK}', ['h', 'mi', 'sec', 'ap']) AS c FROM parts),
clocks AS (SELECT *, coalesce(y0, year(ref) + CASE WHEN date_diff('day', ref, make_date(year(ref), m, least(d, 28))) > 182 THEN -1 WHEN date_diff('day', ref, make_date(year(ref), m, least(d, 28))) < -182 THEN 1 ELSE 0 END) AS y,
  c.h::INT % CASE WHEN c.ap <> '' THEN 12 ELSE 24 END + CASE WHEN lower(c.ap) = 'p' THEN 12 ELSE 0 END AS h, coalesce(try_cast(c.mi AS INT), 0) AS mi, coalesce(try_cast(c.sec AS INT), 0) AS sec,
  trim(regexp_replace(' ' || late, '{_CLOCK}', '')) AS behind FROM dated_ WHERE late <> '' AND m BETWEEN 1 AND 12 AND d BETWEEN 1 AND 31),
walls AS (SELECT t, zone, ref, {_WALL} AS wall, behind,
  CASE WHEN regexp_matches(behind, '^[+-]\d{{2}}') THEN (CASE WHEN behind[1] = '-' THEN -1 ELSE 1 END) * (behind[2:3]::INT * 60 + coalesce(try_cast(regexp_extract(behind, '^[+-]\d{{2}}:?(\d{{2}})', 1) AS INT), 0))
    WHEN regexp_matches(behind, '\b(Z|UTC|GMT)\b') THEN 0 WHEN regexp_matches(behind, '\bEDT\b') THEN -240 WHEN regexp_matches(behind, '\b(EST|CDT)\b') THEN -300 WHEN regexp_matches(behind, '\b(CST|MDT)\b') THEN -360
    WHEN regexp_matches(behind, '\b(MST|PDT)\b') THEN -420 WHEN regexp_matches(behind, '\bPST\b') THEN -480 END AS shift,
  CASE WHEN regexp_matches(behind, '\bET\b') THEN 'America/New_York' WHEN regexp_matches(behind, '\bCT\b') THEN 'America/Chicago' WHEN regexp_matches(behind, '\bMT\b') THEN 'America/Denver' WHEN regexp_matches(behind, '\bPT\b') THEN 'America/Los_Angeles' ELSE place END AS place FROM clocks),
local_ AS (SELECT *, epoch(wall)::BIGINT AS w, epoch(timezone(place, wall))::BIGINT AS e FROM walls),
instants AS (SELECT t, zone, ref, CASE WHEN shift IS NOT NULL THEN w - shift * 60 WHEN timezone(place, to_timestamp(e - 3600)) = wall THEN e - 3600 ELSE e END AS s FROM local_
  UNION ALL SELECT t, zone, ref, t::BIGINT // CASE WHEN length(t) = 13 THEN 1000 ELSE 1 END FROM texts WHERE regexp_matches(t, '^(\d{{10}}|\d{{13}})$')),
told AS (SELECT r._ord, r.canonical, CASE WHEN canonical THEN epoch(strptime(substr(r.starts_at, 1, 19), '%Y-%m-%dT%H:%M:%S'))::BIGINT ELSE coalesce(a.s, b.s) END AS s
  FROM rows_ r LEFT JOIN instants a ON NOT canonical AND a.t = r.starts_at AND a.zone = r.zone AND a.ref = r.ref LEFT JOIN instants b ON NOT canonical AND b.t = r.raw_date_text AND b.zone = r.zone AND b.ref = r.ref)"""

P5_FOUND = f"WITH {STARTS} SELECT _ord, strftime(make_timestamp(s * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS starts_at_utc FROM told WHERE NOT canonical AND s IS NOT NULL"
