from datetime import UTC, date, datetime

import pytest

from showgrain.functions.timeparse import find_day, parse_instant, resolve_zone

REF = date(2026, 10, 1)


def at(*a):
    return int(datetime(*a, tzinfo=UTC).timestamp())


CASES = [
    ("2026-11-09T19:30:00-06:00", at(2026, 11, 10, 1, 30)),
    ("2026-09-08T19:45:00.862762-05:00", at(2026, 9, 9, 0, 45)),
    ("20260902T013000Z", at(2026, 9, 2, 1, 30)),
    ("20260901T233000", at(2026, 9, 2, 4, 30)),
    ("TZID=America/Denver:20270127T213000", at(2027, 1, 28, 4, 30)),
    ("1788402600", 1788402600),
    ("1788930000000", 1788930000),
    ("Fri, 04 Sep 2026 20:00:00 -0700", at(2026, 9, 5, 3, 0)),
    ("01.09.2026 18:30", at(2026, 9, 1, 23, 30)),
    ("10/11/2026 8:00 pm", at(2026, 10, 12, 1, 0)),
    ("2026-09-07 23:15 GMT", at(2026, 9, 7, 23, 15)),
    ("Dec 29, 2026 5:00 PM MST", at(2026, 12, 30, 0, 0)),
    ("Oct 6, 2026 8 p.m. CDT", at(2026, 10, 7, 1, 0)),
    ("10-Oct-2026 20:00", at(2026, 10, 11, 1, 0)),
    ("Thursday October 22 · Doors 5:30pm / Show 6:30pm CDT", at(2026, 10, 22, 23, 30)),
    ("Fri 01/01/27 - 7pm", at(2027, 1, 2, 1, 0)),
    ("THU 10/1 @ 7:00p", at(2026, 10, 2, 0, 0)),
    ("22 January 2027, 19h30 CST", at(2027, 1, 23, 1, 30)),
    ("10 Jan · 19:00", at(2027, 1, 11, 1, 0)),
    ("7/4/2026 7pm CT", at(2026, 7, 5, 0, 0)),
    # a wall time that occurs twice, one that is skipped
    ("11/1/2026 1:30 am", at(2026, 11, 1, 6, 30)),
    ("3/14/2027 2:30 am", at(2027, 3, 14, 8, 30)),
    ("2026-09-11", None),
    ("TBA", None),
    ("", None),
    (None, None),
    ("Oct 3 or Oct 4, 8pm", None),
    ("99/99/2026 8pm", None),
    ("Doors 7pm, Oct 3 2026", None),
]


@pytest.mark.parametrize("text,expected", CASES)
def test_instants(text, expected):
    assert parse_instant(text, "America/Chicago", REF) == expected


def test_zones_and_days():
    assert resolve_zone(" america/chicago ") == "America/Chicago"
    assert resolve_zone("Central Time (US & Canada)") == resolve_zone(None) == resolve_zone("") == "America/Chicago"
    assert resolve_zone("America/New York") == "America/New_York"
    assert resolve_zone("Arizona") == "America/Phoenix"
    assert resolve_zone("nowhere at all") is None
    assert find_day("2026-12-24", REF) == date(2026, 12, 24)
    assert find_day("coming soon", REF) is None
    assert parse_instant("x" * 200_000, None, REF) is None
