"""Order-dependent duplicate detection within and across batches.

``cluster`` keeps the scan semantics: rows in arrival order, each compared with the
winners so far; it is not transitive, so no component algorithm gives the same result.
The work splits without changing it: a match needs equal venue and title form and starts
on one UTC day or at most 18 hours apart, so a group falls apart wherever two successive
starts are neither.  Each such run is scanned as a stream that keeps only its winners.
Runs are numbered over the distinct starts of a venue and title, so rows, however many
there are to a start, are never sorted together for that.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

NEAR_S = 18 * 3600


def same_show_seconds(a: int, b: int) -> bool:
    return a // 86400 == b // 86400 or abs(a - b) <= NEAR_S


class Scan:
    """Winners of one run: list of [start, ticket, score, ord]; ``place`` gives the winner's index.

    A row joins the first winner in its window whose ticket is not another one; without such a
    winner it joins the one that was opened by a row of its ticket and UTC day.
    """

    def __init__(self):
        self.winners: list[list] = []
        self.opened: dict[tuple, int] = {}
        self.by_day: dict[int, set[int]] = {}

    def _near(self, start: int) -> list[int]:
        day = start // 86400
        return sorted(i for d in (day - 1, day, day + 1) for i in self.by_day.get(d, ()))

    def place(self, start: int | None, ticket: str | None, score: float, ord_: int) -> int:
        day = None if start is None else start // 86400
        at = None
        for i in [] if start is None else self._near(start):
            w = self.winners[i]
            if not (ticket and w[1] and ticket != w[1]) and same_show_seconds(start, w[0]):
                at = i
                break
        if at is None:
            at = self.opened.get((day, ticket))
        if at is None:
            at = len(self.winners)
            self.winners.append([start, ticket, score, ord_])
            self.opened[day, ticket] = at
            self.by_day.setdefault(day, set()).add(at)
        elif score > self.winners[at][2]:
            if (before := self.winners[at][0]) is not None:
                self.by_day[before // 86400].discard(at)
            self.winners[at] = [start, ticket, score, ord_]
            self.by_day.setdefault(day, set()).add(at)
        return at


def _scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    run, scan, at = None, Scan(), {}
    for b in batches:
        label = []
        for venue, form, r, start, ticket, score, ord_ in zip(b.venue, b.form, b.run, b.start, b.ticket, b.score, b.ord, strict=True):
            if (venue, form, r) != run:
                run, scan, at = (venue, form, r), Scan(), {}
            i = scan.place(None if pd.isna(start) else int(start), ticket or None, float(score), int(ord_))
            label.append(at.setdefault(i, int(ord_)))
        yield pd.DataFrame({"ord": b.ord, "cluster": label, "score": b.score})


def cluster(rows: DataFrame) -> DataFrame:
    """``ord``, ``cluster`` (ord of its first row), ``kept`` (whether it is the cluster's winner).

    rows: ``ord``, ``venue``, ``form``, ``start`` (seconds), ``ticket``, ``score``.  An empty or
    missing title form is a form of its own.  Rows without a start are in no window; of them,
    those with equal ticket join.  The winner has the highest score, the first of equals.
    """
    rows = rows.withColumn("form", F.coalesce("form", F.lit(""))).withColumn("venue", F.coalesce("venue", F.lit("")))
    starts = rows.filter("start is not null").select("venue", "form", "start").distinct()
    w = Window.partitionBy("venue", "form").orderBy("start")
    before = F.lag("start").over(w)
    new_run = F.when(before.isNull() | ((F.floor(before / 86400) != F.floor(F.col("start") / 86400)) & (F.col("start") - before > NEAR_S)), 1).otherwise(0)
    numbered = starts.withColumn("_new", new_run).withColumn("run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")
    runs = rows.join(numbered, ["venue", "form", "start"]).select("ord", "venue", "form", "run", "start", "ticket", "score").unionByName(
        rows.filter("start is null").select("ord", "venue", "form", F.lit(0).cast("bigint").alias("run"), "start", "ticket", "score")
    )
    scanned = runs.repartition("venue", "form", "run").sortWithinPartitions("venue", "form", "run", "ord").mapInPandas(_scan, "ord long, cluster long, score double")
    top = Window.partitionBy("cluster").orderBy(F.desc("score"), "ord")
    return scanned.withColumn("kept", F.row_number().over(top) == 1).select("ord", "cluster", "kept")


def cascade(new: DataFrame, known: DataFrame) -> DataFrame:
    """``ord``, ``known_id``, ``matched_by`` of new rows that stand among the known, each within the venue.

    First by the source's identifier; then by the first known row that has the fingerprint, or
    the title form in one show's window.  The known are gone through by kind, then id.
    new: ``ord``, ``venue``, ``sid``, ``form``, ``start`` (seconds), ``fingerprint``; known: the same
    with ``id`` and ``kind`` for ``ord``.  Null keys match nothing; an empty title form is a form.
    """
    day = F.floor(F.col("start") / 86400)
    found = []
    for rank, (name, keys) in enumerate((("source_id", ["sid"]), ("exact", ["fingerprint"]))):
        lookup = known.filter(" and ".join(f"{k} is not null" for k in ["venue", *keys])).groupBy("venue", *keys).agg(F.min(F.struct("kind", "id")).alias("k"))
        found.append(new.join(lookup, ["venue", *keys]).select("ord", "k", F.lit(name).alias("matched_by"), F.lit(rank).alias("rank")))
    # a known row has one day, so a pair meets once; of equal keys the first is enough
    firsts = known.filter("venue is not null and form is not null and start is not null").groupBy("venue", "form", "start").agg(F.min(F.struct("kind", "id")).alias("k"))
    firsts = firsts.withColumn("day", day).withColumnRenamed("start", "start2")
    asked = new.select("ord", "venue", "form", "start", F.explode(F.array(day - 1, day, day + 1)).alias("day"))
    near = (F.abs(F.col("start") - F.col("start2")) <= NEAR_S) | (F.floor(F.col("start") / 86400) == F.col("day"))
    found.append(asked.join(firsts, ["venue", "form", "day"]).filter(near).select("ord", "k", F.lit("exact").alias("matched_by"), F.lit(1).alias("rank")))
    hits = found[0].unionByName(found[1]).unionByName(found[2])
    best = hits.groupBy("ord").agg(F.min(F.struct("rank", "k", "matched_by")).alias("m"))
    return best.select("ord", F.col("m.k.id").alias("known_id"), "m.matched_by")


def fuzzy_decision(new: DataFrame, known: DataFrame, similarity, matched: float = 0.85, review: float = 0.55) -> DataFrame:
    """``ord``, ``known_id``, ``score``, ``status`` of new rows that ``cascade`` did not match.

    The most similar known title in one show's window decides: from ``matched`` it is the same show
    unless both have tickets and they differ; from ``review``, or where the row itself is
    less certain than that, somebody has to look; else the row is new.  Ties take the first
    known row by kind and id.  new also has ``ticket`` and ``confidence``, known ``ticket``.
    similarity: column of two title forms.
    """
    day = F.floor(F.col("start") / 86400)
    k = known.filter("venue is not null and start is not null").select("venue", F.coalesce("form", F.lit("")).alias("form2"), F.col("start").alias("start2"), F.coalesce("ticket", F.lit("")).alias("ticket2"), "kind", "id", day.alias("day"))
    n = new.withColumn("form", F.coalesce("form", F.lit("")))
    asked = n.filter("start is not null").select("ord", "venue", "form", "start", F.coalesce("ticket", F.lit("")).alias("ticket"), F.explode(F.array(day - 1, day, day + 1)).alias("day"))
    near = (F.abs(F.col("start") - F.col("start2")) <= NEAR_S) | (F.floor(F.col("start") / 86400) == F.col("day"))
    pairs = asked.join(k, ["venue", "day"]).filter(near).withColumn("score", similarity("form", "form2"))
    # combined before the shuffle: the best pair of each row, no list of them
    best = pairs.groupBy("ord").agg(F.min(F.struct((-F.col("score")).alias("less"), "kind", "id", ((F.col("ticket") == F.col("ticket2")) | (F.col("ticket") == "") | (F.col("ticket2") == "")).alias("fits"))).alias("b"))
    out = n.select("ord", "confidence").join(best, "ord", "left").withColumn("score", -F.col("b.less"))
    same = (F.col("score") >= matched) & F.col("b.fits")
    unsure = (F.coalesce(F.col("score"), F.lit(-1.0)) >= review) | (F.coalesce("confidence", F.lit(0.0)) < review)
    status = F.when(F.coalesce(same, F.lit(False)), "matched_existing").when(unsure, "needs_review").otherwise("new")
    return out.withColumn("status", status).select("ord", F.when(F.col("status") != "new", F.col("b.id")).alias("known_id"), "score", "status")
