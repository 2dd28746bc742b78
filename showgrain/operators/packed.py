"""Several values packed in one field: split into one row per value, position kept.

Segmentation is guided by a dictionary of known whole values.  A multi-pattern automaton
(Aho-Corasick) over all of them finds those a text holds.  A delimiter inside a hit that has a
list sign of its own is protected, as is one inside quotes.  The remaining delimiters cut
the text into pieces, and dynamic programming picks the cheapest cover of the pieces by
values: a known or quoted value is free, a piece of two or more words is cheap, a single unknown
word dear, and up to ``PARTS`` pieces may be rejoined over weak delimiters (comma, &, and, /) to
a known value, for nothing, or where one of them is a single word ("Draydale, Dorothy"): the
parts of one name, of which a name has no more than that.

Distinct texts are split, not rows.  Up to ``DICTIONARY_BOUND`` values one automaton is
broadcast.  Beyond it each text is joined with just the values whose first word it holds and
which stand in its consistent form, so both ways give the same rows.

Defined results: rows without an id take no part; null and empty texts give no row; empty entries and closing words ("and
more") are no values; a repeated value keeps each of its positions; very long texts are
split whole; an empty dictionary protects nothing.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from showgrain.functions.frames import frame
from showgrain.functions.text import mixed_script_fold
from showgrain.session import written

DICTIONARY_BOUND = 200_000
PARTS = 4  # pieces that a name written in parts can have
SALTS = 16

# --- fixed values -----------------------------------------------------------------
#: Words at the end of a list that name nobody.
CLOSING = r"(?:(?:and|&|\+|y|und|plus|with)\s+)?(?:(?:many|much|muchos|lots|viele)\s+)?(?:more|others|friends|guests?|special guests?|support|tba|tbd|more tba|mehr|weitere|más|mas|otros|etc)(?:\s+(?:more|tba|artists|acts))?"
#: Announcements before a name, closed by a colon or a dash.
STATUS = r"just announced|sold out|new show|new date|new|added|cancell?ed|postponed|rescheduled|free|tonight|low tickets|final tickets|early show|late show|special event"
#: What follows a name after a colon.
AFTER_COLON = r"(?:a\w{2,6}\s+r\w{4,8}\s+s\w{2,4}$|(?:album|record|ep|single|cd|vinyl|release|tour|live|anniversary|farewell|reunion|acoustic|unplugged|night \w+|part \w+)\b.*)"
# ----------------------------------------------------------------------------------

_STRONG = r"\r?\n|<br\s*/?>|;|\||//|\s·\s|\s•\s|\s\+\s|\s[xX×]\s|\svs?\.?\s|\sw/\s?|\s(?:with|w)\s+(?:very\s+)?special\s+guests?:?\s|\s(?:feat|ft)\.?\s|\sfeaturing\s|\swith\s|\sand\s+special\s+guests?:?\s"
_WEAK = r",\s*(?:and|&|y|und)\s|,|\s&\s|\sand\s|\s/\s|/"
_DELIMITER = re.compile(f"(?P<strong>{_STRONG})|(?P<weak>{_WEAK})", re.I)
_NUMBERED = re.compile(r"(?:(?<=^)|(?<=[\s,;]))\(?\d{1,2}[.)]\s+")
_BULLET = re.compile(r"^\s*[•*·▪◦‣–—-]\s+", re.M)
_QUOTED = re.compile(r"\"[^\"\n]*\"|“[^”\n]*”|«[^»\n]*»|„[^“”\n]*[“”]|(?:(?<=^)|(?<=[,;|\[(\s]))'(?=\S)[^\n]*?(?<=\S)'(?=\s*(?:[,;|\])]|$|\n))")
_EDGE = " \t\r\n\"“”„«»'‘’`,;|•*·▪◦‣"
_CLOSING = re.compile(rf"^{CLOSING}[.!…]*$", re.I)
#: "An evening with", also misspelt.
_EVENING = re.compile(r"^(?:an?\s+)?(?:intimate\s+|acoustic\s+|special\s+)?(?:e\w{4,8}g|e[vn]\w{3,7}|night|afternoon|conversation)\s+w\w{1,4}\s+|^\w{1,3}\s+e\w{4,8}\s+w\w{1,4}\s+", re.I)
_WORDS = re.compile(r"[^\W\d_][\w'’.-]*")


def has_sign(value: str) -> bool:
    """True for a value in which a split could go wrong."""
    return bool(_DELIMITER.search(f"{value}"))


class Known:
    """Known values, found in a text by one automaton; ``spans`` tells those with a list sign."""

    def __init__(self, values: list[str]):
        import ahocorasick

        self.values = {v.lower() for v in values if v}
        self.signed = {v for v in self.values if has_sign(v)}
        self.automaton = ahocorasick.Automaton()
        for v in self.values:
            self.automaton.add_word(v, v)
        if self.values:
            self.automaton.make_automaton()

    def spans(self, text: str) -> list[tuple[int, int]]:
        """Leftmost longest hits on word bounds, without overlap."""
        low = text.lower()
        if not self.values or len(low) != len(text):
            return []
        hits = []
        for end, v in self.automaton.iter(low):
            if v not in self.signed:
                continue
            a, b = end - len(v) + 1, end + 1
            if (a == 0 or not (low[a - 1].isalnum() and low[a].isalnum())) and (b == len(low) or not (low[b].isalnum() and low[b - 1].isalnum())):
                hits.append((a, b))
        out, last = [], -1
        for a, b in sorted(hits, key=lambda s: (s[0], -s[1])):
            if a >= last:
                out.append((a, b))
                last = b
        return out


def undecorated(title: str, known: Known) -> str:
    """A title without announcements before and notes behind the names."""
    t = title.strip()
    for _ in range(4):
        before = t
        t = re.sub(r"^\[[^\]]*\]\s*", "", t)
        t = re.sub(rf"^(?:{STATUS})\s*(?:[–—:!-]|\s-)\s*", "", t, flags=re.I)
        m = re.match(r"^([^:,;|/+&\"]{1,30}):\s+(.+)$", t)
        if m and len(m[1].split()) <= 3 and not re.match(AFTER_COLON, m[2], re.I):
            t = m[2]
        t = _EVENING.sub("", t)
        t = re.sub(r"\s*\([^()]*\)$", "", t)
        if t == before:
            break
    t = re.sub(rf":\s+{AFTER_COLON}$", "", t, flags=re.I)
    guarded = known.spans(t)
    for m in re.finditer(r"\s[–—]\s|\s-\s|\s(?:at|@)\s|\shosted by\s", t, re.I):
        if not any(a <= m.start() < b for a, b in guarded):
            t = t[: m.start()]
            break
    t = re.sub(r"\s*\([^()]*\)$", "", t).strip()
    return re.sub(r"\s+live!?$", "", t, flags=re.I)


def _word_count(piece: str) -> int:
    ws = _WORDS.findall(piece)
    return 2 if len(ws) == 1 and not ws[0][0].isascii() and ord(ws[0][0]) > 0x24F and len(ws[0]) > 3 else len(ws)


def split_values(text: str | None, known: Known, title: bool = False) -> list[str]:
    """The values of a packed text in order; a list of one or none where it packs nothing."""
    if not text or not text.strip():
        return []
    t = mixed_script_fold(text).strip()
    t = undecorated(t, known) if title else t
    if t.startswith("[") and t.endswith("]"):
        try:
            items = json.loads(t)
            return [x for x in (_clean(str(i)) for i in items if i is not None) if x]
        except ValueError:
            t = t[1:-1]
    t = _BULLET.sub("\n", t)
    t = _NUMBERED.sub("\n", t)
    quoted = [m.span() for m in _QUOTED.finditer(t)]
    guarded = quoted + known.spans(t)
    pieces, signs, at = [], [], 0
    for m in _DELIMITER.finditer(t):
        if any(a <= m.start() and m.end() <= b or a < m.start() < b for a, b in guarded):
            continue
        pieces.append((at, m.start()))
        signs.append(m.lastgroup)
        at = m.end()
    pieces.append((at, len(t)))
    return [v for v in (_clean(t[a:b]) for a, b in _cover(t, pieces, signs, quoted, known)) if v and not _CLOSING.match(v)]


def _clean(piece: str) -> str:
    p = piece.strip(_EDGE)
    p = re.sub(r"^(?:and|&|y|und)\s+(?=\S)", "", p, flags=re.I) if re.match(r"^(?:and|&)\s", p, re.I) else p
    return "" if not re.search(r"\w", p) else p.strip(_EDGE)


def _cover(t: str, pieces: list[tuple[int, int]], signs: list[str], quoted: list[tuple[int, int]], known: Known) -> list[tuple[int, int]]:
    """Cheapest cover of the pieces by values (dynamic programming over piece ends)."""
    counts = [_word_count(t[a:b]) for a, b in pieces]
    whole = [_clean(t[a:b]) for a, b in pieces]
    free = [not w or bool(_CLOSING.match(w)) for w in whole]
    exact = [
        w.lower() in known.values or any(a <= x and y <= b for x, y in quoted) for w, (a, b) in zip(whole, pieces, strict=True)
    ]
    best: list[tuple[float, int]] = [(0.0, 0)]
    for j in range(1, len(pieces) + 1):
        i = j - 1
        cost = 0.0 if free[i] or exact[i] else 1.0 if counts[i] >= 2 else 3.0
        options = [(best[i][0] + cost, i)]
        lone = counts[i] < 2 and not exact[i] and not free[i]
        for i in range(j - 2, max(-1, j - PARTS - 1), -1):
            if _clean(t[pieces[i][0] : pieces[j - 1][1]]).lower() in known.values:
                options.append((best[i][0], i))
                continue
            if signs[i] != "weak" or free[i] or free[j - 1] or exact[i]:
                break
            lone |= counts[i] < 2
            if lone:
                options.append((best[i][0] + 2.0 + 0.5 * (j - i), i))
        best.append(min(options))
    cuts, j = [], len(pieces)
    while j:
        i = best[j][1]
        cuts.append((pieces[i][0], pieces[j - 1][1]))
        j = i
    return cuts[::-1]


def dictionary(values: DataFrame) -> DataFrame:
    """Distinct known values (column ``value``) that are not blank."""
    return values.filter(F.trim("value") != "").select(F.trim("value").alias("value")).distinct()


_ANY_WORD = re.compile(r"[^\W_]+")


def _first_word(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        words = [_ANY_WORD.search(v.lower()) for v in b.value]
        yield b.assign(low=b.value.str.lower(), word=[m[0] if m else "" for m in words])


def _formed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The form in which a text is searched, and its words."""
    for b in batches:
        low = [mixed_script_fold(t).lower() for t in b.text]
        yield frame({"digest": b.digest, "low": low, "words": [["", *dict.fromkeys(_ANY_WORD.findall(x))] for x in low]})


def unpack(rows: DataFrame, values: DataFrame, bound: int = DICTIONARY_BOUND) -> DataFrame:
    """One row per value of each text that packs two or more.

    rows: ``source_table``, ``record_id``, ``text``, ``is_title``; values: ``value``.
    Result: ``source_table``, ``record_id``, ``item_pos`` from 1, ``item_value``.
    """
    held = rows.filter("record_id is not null and coalesce(trim(text), '') <> ''").select("source_table", "record_id", "text", F.coalesce("is_title", F.lit(False)).alias("is_title"))
    held = held.withColumn("digest", F.md5(F.concat_ws("|", F.col("is_title").cast("string"), "text")))
    texts = held.groupBy("digest").agg(F.min("text").alias("text"), F.min("is_title").alias("is_title"))
    guard = dictionary(values)
    schema = "digest string, items array<string>"
    if guard.limit(bound + 1).count() <= bound:
        shared = rows.sparkSession.sparkContext.broadcast(sorted(r.value for r in guard.collect()))
        found = texts.mapInPandas(_split_with(shared), schema)
    else:
        texts = written(texts, "texts")
        # only the values whose first word the text holds can stand in it
        known = guard.mapInPandas(_first_word, "value string, low string, word string")
        asked = texts.select("digest", "text").mapInPandas(_formed, "digest string, low string, words array<string>")
        met = asked.withColumn("word", F.explode("words")).select("digest", F.col("low").alias("form"), "word").join(known, "word").filter(F.contains("form", "low"))
        near = met.groupBy("digest").agg(F.collect_set("value").alias("near"))
        found = texts.join(near, "digest", "left").mapInPandas(_split_near, schema)
    # one title may stand in a third of all rows: the join back is salted
    found = written(found.filter(F.size("items") > 1), "unpacked").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    back = held.select("source_table", "record_id", "digest").withColumn("salt", F.pmod(F.xxhash64("source_table", "record_id"), F.lit(SALTS)).cast("int")).join(found, ["digest", "salt"])
    return back.select("source_table", "record_id", F.posexplode("items").alias("p", "item_value")).select("source_table", "record_id", (F.col("p") + 1).alias("item_pos"), "item_value")


def _split_with(shared):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = Known(shared.value)
        for b in batches:
            yield frame({"digest": b.digest, "items": [split_values(x, known, title) for x, title in zip(b.text, b.is_title, strict=True)]})

    return run


def _split_near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        yield frame({"digest": b.digest, "items": [split_values(x, Known([] if near is None else list(near)), title) for x, title, near in zip(b.text, b.is_title, b.near, strict=True)]})
