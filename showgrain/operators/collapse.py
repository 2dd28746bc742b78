"""Tiered name matches, and the collapse of rows that wait for review."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from showgrain.functions.frames import frame
from showgrain.operators.components import components
from showgrain.operators.dedup import same_show_seconds


def tiers(targets: DataFrame, names: DataFrame, target: str, ident: str, name: str) -> DataFrame:
    """Pairs with ``tier``: 100 equal, 85 one within the other, 90 all, 70 four fifths of the target's words.

    Containment is of whole words and asks for five letters of the shorter one; it is tested before
    the words are counted.  Words are those of two letters or more, and a target needs two of them
    (a word written twice counts twice).  Names under three letters or with a time of day are none.
    Pairs meet over a shared word, so none without one is built.
    """
    split = lambda c: F.filter(F.split(c, " "), lambda w: w != "")
    t = targets.filter(F.col(target) != "").select(target, split(target).alias("_tt")).distinct()
    n = names.filter((F.length(name) >= 3) & ~F.col(name).rlike(r"\d\s*[ap]m\b")).select(ident, name, F.array_distinct(split(name)).alias("_nt")).distinct()
    met = t.select(target, F.explode(F.array_distinct("_tt")).alias("_w")).join(n.select(ident, name, F.explode("_nt").alias("_w")), "_w").select(target, ident, name).distinct()
    p = met.join(t, target).join(n.select(ident, name, "_nt"), [ident, name])
    counted = F.filter("_tt", lambda w: F.length(w) > 1)
    share = F.size(F.filter(counted, lambda w: F.array_contains("_nt", w))) / F.nullif(F.size(counted), F.lit(0))
    padded = lambda c: F.concat(F.lit(" "), c, F.lit(" "))
    within = F.contains(padded(target), padded(name)) | F.contains(padded(name), padded(target))
    tier = (
        F.when(F.col(target) == F.col(name), 100)
        .when(within & (F.least(F.length(target), F.length(name)) >= 5), 85)
        .when((share >= 1) & (F.size(counted) >= 2), 90)
        .when((share >= 0.8) & (F.size(counted) >= 2), 70)
        .otherwise(0)
    )
    return p.withColumn("tier", tier).filter("tier >= 70").select(target, ident, "tier")


class Kept:
    """Rows kept so far of one group, found by fingerprint, ticket or day; the first kept one counts."""

    def __init__(self):
        self.rows: list[tuple] = []  # ord, form, start, ticket, fingerprint, score
        self.opened: list[int] = []
        self.at: dict[tuple, set[int]] = {}

    @staticmethod
    def _keys(row: tuple) -> list[tuple]:
        _, form, start, ticket, fingerprint, _ = row
        keys = [("f", fingerprint)] if fingerprint else []
        keys += [("t", form, ticket)] if ticket else []
        return keys + ([("d", form, start // 86400)] if start is not None else [])

    def _first(self, row: tuple) -> int | None:
        _, form, start, ticket, fingerprint, _ = row
        hits = set(self.at.get(("f", fingerprint), ())) if fingerprint else set()
        hits |= self.at.get(("t", form, ticket), set()) if ticket else set()
        if start is not None:
            for day in range(start // 86400 - 1, start // 86400 + 2):
                hits |= {i for i in self.at.get(("d", form, day), ()) if same_show_seconds(start, self.rows[i][2])}
        return min(hits) if hits else None

    def place(self, row: tuple) -> int:
        """Index of the kept row that ``row`` repeats; its own where it is kept itself.  A better row takes the place."""
        i = self._first(row)
        if i is None:
            i = len(self.rows)
            self.rows.append(row)
            self.opened.append(row[0])
        elif row[5] > self.rows[i][5]:
            for k in self._keys(self.rows[i]):
                self.at[k].discard(i)
            self.rows[i] = row
        else:
            return i
        for k in self._keys(row):
            self.at.setdefault(k, set()).add(i)
        return i


def _collapse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    group, kept = None, Kept()
    for b in batches:
        out = []
        for g, o, form, start, ticket, fp, score in zip(b.group, b.ord, b.form, b.start, b.ticket, b.fingerprint, b.score, strict=True):
            if g != group:
                group, kept = g, Kept()
            i = kept.place((int(o), form, None if pd.isna(start) else int(start), ticket or None, fp or None, 0.0 if pd.isna(score) else float(score)))
            out.append(kept.opened[i])
        yield frame({"ord": b.ord, "slot": out, "score": b.score})


def waiting(rows: DataFrame) -> DataFrame:
    """``ord``, ``slot`` (the row that opened its place) and ``kept`` (whether it holds it at the end).

    In order of ``ord``, a row repeats the first kept one of its venue that has its fingerprint, or
    its title and ticket whatever the start, or its title in one show's window.  Of the two the
    one with the higher ``score`` is kept, the earlier of equals, and is what later rows are
    compared with.  Rows are scanned in streams per connected (title, fingerprint) group:
    titles that share a fingerprint are joined first, so a venue is never held as a whole and
    only kept rows of one group are in memory.  A missing or empty title is one title; a
    missing start is in no window.
    """
    r = rows.withColumn("form", F.coalesce("form", F.lit(""))).withColumn("venue", F.coalesce("venue", F.lit("")))
    # titles that share a fingerprint, over however many steps, go to one group
    by_print = r.filter("fingerprint is not null").select(F.concat_ws("\x01", "venue", F.lit("t"), "form").alias("a"), F.concat_ws("\x01", "venue", F.lit("f"), "fingerprint").alias("b")).distinct()
    roots = components(by_print).select("label", F.col("rep").alias("root"))
    own = r.withColumn("label", F.concat_ws("\x01", "venue", F.lit("t"), "form"))
    g = own.join(roots, "label", "left").withColumn("group", F.coalesce("root", "label"))
    g = g.select("group", "ord", "form", "start", "ticket", "fingerprint", "score").repartition("group").sortWithinPartitions("group", "ord")
    scanned = g.mapInPandas(_collapse, "ord long, slot long, score double")
    best = Window.partitionBy("slot").orderBy(F.desc_nulls_last("score"), "ord")
    return scanned.withColumn("kept", F.row_number().over(best) == 1).select("ord", "slot", "kept")
