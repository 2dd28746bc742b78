"""Evaluation passages that stand inside training documents.

Words (runs of letters and digits, lower case) are canonicalised to templates: numbers,
units and the names of the evaluation set become typed placeholders.  The templates of
all windows of ``WINDOW`` words of the evaluation items are hashed; documents slide the
same window and hits are found by a hash join.  The slots of a hit are then checked:

* equal slot values and words: the passage itself ('exact');
* a consistent one-to-one replacement of values: a re-parameterised copy ('reparameterised').

The evaluation side is an index of distinct window hashes.  Up to ``INDEX_BOUND`` windows
it is broadcast and documents are probed where they are scanned, without any shuffle;
beyond it, only the hashes of document windows are shuffled to be joined, and the text of a
window is made for the hits alone, which gives the same rows.

Defined results: rows without an id take no part; null, empty and short texts (under a window) hold nothing; a document
that repeats a passage is reported once for an item; an item held twice under two ids is
reported for both; empty tables give an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from showgrain.functions.frames import frame
from showgrain.session import spread, written

WINDOW = 12
INDEX_BOUND = 200_000  # distinct evaluation windows up to which the index is broadcast
NAMES_BOUND = 500_000  # names of the evaluation set, which every task holds
SALTS = 8

# --- fixed values -----------------------------------------------------------------
#: Units of measure, English, Spanish and German.
UNITS = frozenset("km mile miles meter meters metre metres feet foot inch inches kg pound pounds ounce ounces minute minutes hour hours day days week weeks month months year years dollar dollars cent cents euro euros percent degrees minuto minutos hora horas día días semana semanas año años stunde stunden tag tage woche wochen jahr jahre".split())
#: Days and months, which vary like numbers.
CALENDAR = frozenset("monday tuesday wednesday thursday friday saturday sunday january february march april june july august september october november december".split())
# ----------------------------------------------------------------------------------

_WORD = re.compile(r"[^\W_]+")
_BASE = 1_000_003


def words(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def names_of(texts: list[str]) -> frozenset[str]:
    """Words that are capitalised within sentences: the names of the evaluation set."""
    found = set()
    for t in texts:
        for m in re.finditer(r"(?<=[a-z,;] )([^\W\d_]+)", t):
            if m[1][:1].isupper() and len(m[1]) > 1:
                found.add(m[1].lower())
    return frozenset(found)


class Canon:
    """Maps words to numbers, all members of one placeholder type to the same number."""

    def __init__(self, names: frozenset[str]):
        self.names, self.codes = names, {}

    def kind(self, w: str, more: frozenset[str] = frozenset()) -> str | None:
        if w.isdigit():
            return "<number>"
        if w in UNITS:
            return "<unit>"
        if w in CALENDAR:
            return "<date>"
        return "<name>" if w in self.names or w in more else None

    def code(self, w: str) -> int:
        c = self.codes.get(w)
        if c is None:
            if len(self.codes) > 500_000:
                self.codes.clear()
            c = self.codes[w] = xxhash.xxh64_intdigest("<name>" if w == "\x00" else self.kind(w) or w)
        return c

    def windows(self, ws: list[str], more: frozenset[str] = frozenset()) -> np.ndarray:
        """Template hash of each window of ``WINDOW`` words; words in ``more`` count as names too."""
        n = len(ws) - WINDOW + 1
        if n <= 0:
            return np.empty(0, dtype=np.uint64)
        coded = map(self.code, ("\x00" if w in more and self.kind(w) is None else w for w in ws)) if more else map(self.code, ws)
        a = np.fromiter(coded, dtype=np.uint64, count=len(ws))
        h = np.zeros(n, dtype=np.uint64)
        for i in range(WINDOW):
            h = h * np.uint64(_BASE) + a[i : i + n]
        return h


def readings(text: str, canon: Canon, loose: bool) -> list[frozenset[str]]:
    """Further names to read a document with: none, and for loose reading those it writes with capitals."""
    own = names_of([text]) - canon.names if loose and text else frozenset()
    return [frozenset(), own] if own else [frozenset()]


def relation(doc: list[str], item: list[str], canon: Canon, more: frozenset[str] = frozenset()) -> str | None:
    """How two windows of one template agree: 'exact', 'reparameterised' or not at all."""
    if doc == item:
        return "exact"
    there, back = {}, {}
    for d, e in zip(doc, item, strict=True):
        kd, ke = canon.kind(d, more), canon.kind(e)
        if kd != ke or (kd is None and d != e):
            return None
        if there.setdefault(e, d) != d or back.setdefault(d, e) != e:
            return None
    return "reparameterised"


def leaks(docs: DataFrame, items: DataFrame, loose: bool = False, bound: int = INDEX_BOUND) -> DataFrame:
    """``doc_id``, ``item_id`` and ``kind`` of every document that holds a window of an item.

    loose: read documents a second time with the names of their own as placeholders, which
    finds copies about other people and places; exact hits are the same either way.
    """
    spark = docs.sparkSession
    eval_rows = items.filter("item_id is not null and coalesce(trim(text), '') <> ''").select("item_id", "text")
    docs = docs.filter("doc_id is not null").select("doc_id", "text")
    names = _names(eval_rows)
    index = written(eval_rows.mapInPandas(_index_of(names), "h long, item_id long, window string").distinct(), "eval-windows")
    if index.limit(bound + 1).count() <= bound:
        held = index.toPandas()
        shared = spark.sparkContext.broadcast((held.h.to_numpy(), held.item_id.to_numpy(), held.window.tolist()))
        pairs = spread(docs).mapInPandas(_probe(names, shared, loose), "doc_id long, item_id long, kind string")
        return pairs.distinct()
    salt = lambda d: d.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = lambda d: d.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    slid = docs.mapInPandas(_slide(names, loose), "doc_id long, h long")
    hit = salted(slid).join(salt(index.select("h").distinct()), ["h", "salt"], "left_semi").select("doc_id", "h").distinct()
    # a document's hits are no more than its windows
    wanted = written(hit.groupBy("doc_id").agg(F.collect_set("h").alias("hits")), "hits")
    shown = docs.join(wanted, "doc_id").mapInPandas(_show(names, loose), "doc_id long, h long, window string, own string")
    met = salted(shown).join(salt(index.withColumnRenamed("window", "item_window")), ["h", "salt"])
    return met.mapInPandas(_relate(names), "doc_id long, item_id long, kind string").distinct()


def _names(eval_rows: DataFrame) -> frozenset[str]:
    """Names found on the executors; distinct words of the evaluation set, not of the corpus."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield frame({"name": sorted(names_of(b.text.tolist()))})

    found = eval_rows.mapInPandas(run, "name string").distinct().limit(NAMES_BOUND + 1).collect()
    if len(found) > NAMES_BOUND:
        raise ValueError(f"over {NAMES_BOUND} names in the evaluation set; raise NAMES_BOUND to the executors' memory")
    return frozenset(r.name for r in found)


def _index_of(names: frozenset[str]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        canon = Canon(names)
        for b in batches:
            h, i, w = [], [], []
            for item, text in zip(b.item_id, b.text, strict=True):
                ws = words(text)
                for k, x in enumerate(canon.windows(ws).view(np.int64).tolist()):
                    h.append(x), i.append(item), w.append(" ".join(ws[k : k + WINDOW]))
            yield frame({"h": h, "item_id": i, "window": w})

    return run


def _probe(names: frozenset[str], shared, loose: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        canon = Canon(names)
        hs, ids, windows = shared.value
        order = np.argsort(hs, kind="stable")
        keys = hs[order]
        for b in batches:
            out = set()
            for doc, text in zip(b.doc_id, b.text, strict=True):
                ws = words(text)
                for more in readings(text, canon, loose):
                    found = canon.windows(ws, more).view(np.int64)
                    if not len(found) or not len(keys):
                        continue
                    lo = np.searchsorted(keys, found, "left")
                    for k in np.flatnonzero((lo < len(keys)) & (keys[np.minimum(lo, len(keys) - 1)] == found)).tolist():
                        here, at = ws[k : k + WINDOW], lo[k]
                        while at < len(keys) and keys[at] == found[k]:
                            j = order[at]
                            kind = relation(here, windows[j].split(" "), canon, more)
                            if kind:
                                out.add((doc, int(ids[j]), kind))
                            at += 1
            yield pd.DataFrame(sorted(out), columns=["doc_id", "item_id", "kind"]).astype({"doc_id": "int64", "item_id": "int64"})

    return run


def _slide(names: frozenset[str], loose: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        canon = Canon(names)
        for b in batches:
            for doc, text in zip(b.doc_id, b.text, strict=True):
                ws = words(text)
                found = [canon.windows(ws, more).view(np.int64) for more in readings(text, canon, loose)]
                h = np.unique(np.concatenate(found))
                if len(h):
                    yield frame({"doc_id": [doc] * len(h), "h": h.tolist()})

    return run


def _show(names: frozenset[str], loose: bool):
    """The windows of a document that have a wanted hash, and of its own names those in them."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        canon = Canon(names)
        for b in batches:
            out = set()
            for doc, text, hits in zip(b.doc_id, b.text, b.hits, strict=True):
                ws, wanted = words(text), np.asarray(hits, dtype=np.int64)
                for more in readings(text, canon, loose):
                    h = canon.windows(ws, more).view(np.int64)
                    for k in np.flatnonzero(np.isin(h, wanted)).tolist():
                        here = ws[k : k + WINDOW]
                        out.add((doc, int(h[k]), " ".join(here), " ".join(w for w in here if w in more)))
            yield pd.DataFrame(sorted(out), columns=["doc_id", "h", "window", "own"]).astype({"doc_id": "int64", "h": "int64"})

    return run


def _relate(names: frozenset[str]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        canon = Canon(names)
        for b in batches:
            kinds = [relation(d.split(" "), e.split(" "), canon, frozenset(o.split())) for d, e, o in zip(b.window, b.item_window, b.own, strict=True)]
            yield b.assign(kind=kinds).dropna(subset=["kind"])[["doc_id", "item_id", "kind"]]

    return run
