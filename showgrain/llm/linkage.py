"""Deduplicating new batches against all history: incremental record linkage.

History is a folder of Parquet tables laid out by era (a quarter year of starts) and venue
bucket: nodes with their blocking keys and features, members of nodes, and a union-find
mapping of nodes to representatives.  A batch is added like this:

1. its rows become nodes: rows equal in everything that is compared have one signature, in
   this batch or an earlier one, so copies, however many, cost one entry;
2. nodes probe the key tables.  Keys: venue and start slot, and venue, identifier and
   five-day window.  Only the eras and venue buckets that the batch's keys fall in are read,
   and of those only nodes with a key of the batch go on: what is read and shuffled depends on
   the batch and on what stands at its places and times, not on the length of history;
3. a pair is a comparison pattern (occurrence, identifier, page, title).  Weights of the
   levels are learned by expectation maximisation over the counts of patterns of all batches
   so far, and kept monotone: more agreement never counts less;
4. links join clusters: representatives of the touched clusters are looked up, and only
   touched nodes and representatives get new mapping rows.

A performance is one show at one venue and start: starts over ``CLOSE_S`` apart are other
performances, unless the source kept its identifier and the start moved ``MOVED_S`` or less.
Titles under the lowest of ``TITLE_STEPS`` link only where identifier and page are both equal.
A record without a start joins the one performance of the venue that its identifier, page or
title names, and stays alone where they name several.

Keys with over ``CROWD`` nodes do not pair all with all.  Their pairs come from a
prefix-filtered join of titles and from role leaders (see ``_crowded``); the clusters are the
same, only redundant pairs are left out.

``add`` with an id that was added before changes nothing, and what an interrupted ``add`` left
behind is overwritten when it is repeated.  ``compact`` rewrites the tables as one part.

Defined results: records without an id take no part; null venues, titles, identifiers and links compare as missing; repeated
rows join the first; ties take the smallest label; empty batches change nothing.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from showgrain.functions.frames import frame
from showgrain.llm import shows
from showgrain.operators.components import components
from showgrain.session import broadcast_if_small, new_folder, passing_tables, written

CLOSE_S = 75 * 60
MOVED_S = 5 * 86400 + 2 * 3600
SLOT_S = 2 * 3600
ERA_S = 91 * 86400
UNDATED = -1_000_000  # era of nodes without a start
SEEN_BEFORE_S, SEEN_AHEAD_S = 60 * 86400, 400 * 86400  # starts that a record without one may mean, around the time it was seen
CROWD = 500
BUCKETS = 8
SALTS = 16
TITLE_STEPS = (0.95, 0.75, 0.5)
LEARN_FROM = 100  # pairs with an equal identifier or page that the weights are learned from, at least
#: Log-odds used until there were enough pairs to learn from.
FIRST_WEIGHTS = {"prior": -1.0, "occ=close": 0.0, "occ=moved": 0.0, "sid=same": 2.2, "sid=none": 0.0, "sid=other": -1.4, "page=same": 2.2, "page=none": 0.0, "page=other": -1.4, "title=3": 3.0, "title=2": 1.4, "title=1": -0.9, "title=0": -4.0}
FIELDS = ("occ", "sid", "page", "title")

NODE = T.StructType(
    [
        T.StructField("sig", T.StringType()),
        T.StructField("venue", T.StringType()),
        T.StructField("instant", T.LongType()),
        T.StructField("sid", T.StringType()),
        T.StructField("page", T.StringType()),
        T.StructField("form", T.StringType()),
        T.StructField("grams", T.ArrayType(T.IntegerType())),
    ]
)
_PLACE = [T.StructField("batch", T.StringType()), T.StructField("era", T.IntegerType()), T.StructField("bucket", T.IntegerType())]
NODES = T.StructType([*NODE.fields, *_PLACE])
MEMBERS = T.StructType([T.StructField("member", T.StringType()), *NODE.fields, T.StructField("seen", T.LongType()), _PLACE[0]])
MAPPING = T.StructType([T.StructField("sig", T.StringType()), T.StructField("parent", T.StringType()), T.StructField("parent_era", T.IntegerType()), T.StructField("version", T.IntegerType()), *_PLACE])
FEATURES = [f.name for f in NODE.fields]


def _forms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        forms = [shows.title_form(t) for t in b.title]
        acts = [shows.act_form(t) or f for t, f in zip(b.title, forms, strict=True)]
        # equal forms have equal grams: they are taken of the form's own acts
        grams = [sorted({xxhash.xxh32_intdigest(g) - (1 << 31) for g in shows.grams(a)}) for a in acts]
        yield frame({"title": b.title, "form": [f"{f}|{a}" if a != f else f for f, a in zip(forms, acts, strict=True)], "grams": grams})


def signed(records: DataFrame) -> DataFrame:
    """Records (``member``) with the features of their node and its signature ``sig``.

    records: ``label``, ``venue``, ``title``, ``instant``, ``source_event_id``, ``ticket_url`` and, if
    known, ``seen`` (seconds).
    """
    seen = F.col("seen") if "seen" in records.columns else F.lit(None).cast("long")
    r = records.filter("label is not null").select("label", "venue", "title", F.col("instant").cast("long").alias("instant"), shows.identifier("source_event_id").alias("sid"), shows.page("ticket_url").alias("page"), seen.cast("long").alias("seen"))
    # titles repeat: their forms are made once for each
    formed = r.select("title").distinct().mapInPandas(_forms, "title string, form string, grams array<int>")
    r = r.join(formed, r["title"].eqNullSafe(formed["title"]), "left").drop("title")
    same = ["venue", "instant", "sid", "page", "form"]
    return r.withColumn("sig", F.md5(F.to_json(F.struct(*same), {"ignoreNullFields": "false"}))).withColumnRenamed("label", "member").select("member", *FEATURES, "seen")


def _placed(nodes: DataFrame, buckets: int) -> DataFrame:
    era = F.when(F.col("instant").isNull(), UNDATED).otherwise(F.floor(F.col("instant") / ERA_S)).cast("int")
    return nodes.withColumn("era", era).withColumn("bucket", F.pmod(F.hash(F.coalesce("venue", F.lit(""))), F.lit(buckets)))


def _keys(kind: str, probe: bool) -> Column:
    """Blocking keys of a dated node: its own, or with its neighbours in time those it probes."""
    size = SLOT_S if kind == "t" else MOVED_S
    own = F.floor(F.col("instant") / size)
    at = F.array(own - 1, own, own + 1) if probe else F.array(own)
    more = [] if kind == "t" else [F.col("sid")]
    keys = F.transform(at, lambda x: F.xxhash64(F.lit(kind), F.coalesce("venue", F.lit("")), *more, x))
    return F.when(F.lit(True) if kind == "t" else F.col("sid").isNotNull(), keys).otherwise(F.array().cast("array<bigint>"))


def _dice(a: str, b: str) -> Column:
    shared = F.size(F.array_intersect(f"{a}.grams", f"{b}.grams"))
    return F.coalesce(2 * shared / F.nullif(F.size(f"{a}.grams") + F.size(f"{b}.grams"), F.lit(0)), F.lit(0.0))


def _pattern(a: str, b: str, dice: Column) -> Column:
    """The comparison pattern of a pair; null where they cannot be one performance."""
    ca, cb = (lambda n: F.col(f"{a}.{n}")), (lambda n: F.col(f"{b}.{n}"))
    gap = F.abs(ca("instant") - cb("instant"))
    same_sid = F.coalesce(ca("sid") == cb("sid"), F.lit(False))
    same_both = same_sid & F.coalesce(ca("page") == cb("page"), F.lit(False))
    # a null-safe equality: a key is a hash, the venue itself decides
    here = ca("venue").eqNullSafe(cb("venue"))
    occ = F.when(here & (gap <= CLOSE_S), "close").when(here & (gap <= MOVED_S) & same_sid, "moved")
    relation = lambda n: F.when(ca(n).isNull() | cb(n).isNull(), "none").when(ca(n) == cb(n), "same").otherwise("other")
    title = F.when(dice >= TITLE_STEPS[0], "3").when(dice >= TITLE_STEPS[1], "2").when(dice >= TITLE_STEPS[2], "1").when(same_both, "0")
    return F.when(occ.isNotNull() & title.isNotNull(), F.concat_ws("|", occ, relation("sid"), relation("page"), title))


def _pair(joined: DataFrame) -> DataFrame:
    """``a``, ``b``, ``pattern`` of joined nodes a and b of which one at least is new."""
    scored = joined.withColumn("pattern", _pattern("a", "b", _dice("a", "b"))).filter("pattern is not null")
    return scored.select(F.least("a.sig", "b.sig").alias("a"), F.greatest("a.sig", "b.sig").alias("b"), "pattern")


def _monotone(weights: dict[str, float]) -> dict[str, float]:
    """Missing levels filled; agreement never counts less than its lack."""
    w = {**FIRST_WEIGHTS, **weights}
    for order in (("sid=same", "sid=none", "sid=other"), ("page=same", "page=none", "page=other"), ("title=3", "title=2", "title=1", "title=0")):
        for more, less in zip(order, order[1:]):
            w[less] = min(w[less], w[more])
    # with one identifier, a start that stayed is no less alike than one that moved
    return w


def _points(levels: list[str], weights: dict[str, float]) -> float:
    occ = "moved" if levels[0] == "close" and levels[1] == "same" and weights["occ=moved"] > weights["occ=close"] else levels[0]
    return weights["prior"] + sum(weights[f"{n}={lv}"] for n, lv in zip(FIELDS, [occ, *levels[1:]], strict=True))


def score(pattern: str, weights: dict[str, float]) -> float:
    return 1 / (1 + math.exp(-max(min(_points(pattern.split("|"), weights), 50), -50)))


def learn(counts: dict[str, int], rounds: int = 60) -> dict[str, float]:
    """Log-odds weight of each field level, by expectation maximisation over pattern counts."""
    rows = [(p.split("|"), n) for p, n in sorted(counts.items())]
    post = [score(p, FIRST_WEIGHTS) for p in sorted(counts)]
    weights = FIRST_WEIGHTS
    for _ in range(rounds):
        m_all = sum(p * n for p, (_, n) in zip(post, rows, strict=True))
        u_all = sum(n for _, n in rows) - m_all
        fitted = {"prior": math.log((m_all + 1) / (u_all + 1))}
        for f, name in enumerate(FIELDS):
            levels = sorted({r[0][f] for r in rows})
            for lv in levels:
                m = sum(p * n for p, (r, n) in zip(post, rows, strict=True) if r[f] == lv)
                u = sum((1 - p) * n for p, (r, n) in zip(post, rows, strict=True) if r[f] == lv)
                fitted[f"{name}={lv}"] = math.log(((m + 0.5) / (m_all + 0.5 * len(levels))) / ((u + 0.5) / (u_all + 0.5 * len(levels))))
        weights = _monotone(fitted)
        post = [1 / (1 + math.exp(-max(min(_points(r, weights), 50), -50))) for r, _ in rows]
    return weights


def _direct(pool: DataFrame, kind: str, crowded: DataFrame | None) -> DataFrame:
    """Pairs of a new node and any other under one key, crowded keys left out."""
    new = pool.filter("is_new and instant is not null").withColumn("key", F.explode(_keys(kind, True)))
    held = pool.filter("instant is not null").withColumn("key", F.explode(_keys(kind, False)))
    if crowded is not None:
        held = held.join(broadcast_if_small(crowded), "key", "left_anti")
    # two new nodes meet from both sides; one of the two pairs is kept
    once = "a.sig <> b.sig and (not b.is_new or a.sig < b.sig)"
    same = F.coalesce(F.col("a.sid") == F.col("b.sid"), F.lit(False))
    pairs = new.alias("a").join(held.alias("b"), F.col("a.key") == F.col("b.key")).filter(once).filter(same if kind == "i" else ~same)
    return _pair(pairs)


def _roles(kind: str) -> Column:
    """The roles a node compares with in a group of nodes of one title and start."""
    star, none = F.lit("*"), F.lit("0")
    pages = F.array_compact(F.array(star, none, F.concat(F.lit("="), "page")))
    sids = F.array(star, none) if kind == "t" else F.array(star)
    return F.flatten(F.transform(sids, lambda s: F.transform(pages, lambda p: F.concat(s, F.lit("|"), p))))


def _filled(kind: str) -> Column:
    """The roles that a node can lead: those it fulfils."""
    page = F.when(F.col("page").isNull(), F.lit("0")).otherwise(F.concat(F.lit("="), "page"))
    sids = F.when(F.col("sid").isNull(), F.array(F.lit("*"), F.lit("0"))).otherwise(F.array(F.lit("*"))) if kind == "t" else F.array(F.lit("*"))
    return F.flatten(F.transform(sids, lambda s: F.array(F.concat(s, F.lit("|*")), F.concat(s, F.lit("|"), page))))


def _crowded(pool: DataFrame, kind: str, crowded: DataFrame) -> DataFrame:
    """Pairs under crowded keys, enough of them for the same clusters.

    Nodes of one venue, title and start are a group.  Groups whose titles can be alike meet by
    prefix-filtered grams.  In a pair of groups, each node is compared with a leader of each role
    of the other group only: any node, one without an identifier, one without a page, one with the
    node's own page, and both.  Where two nodes u and v link, the leader of the role by which v
    links with u agrees with u at least as well, because weights are monotone, and is linked with v
    within its own group; so linked nodes stay connected.  Leaders are taken from history first, and a
    new leader is compared with old nodes too.  Titles that are not alike link by identifier and page
    alone: such nodes are compared with the next start only.
    """
    reach = CLOSE_S if kind == "t" else MOVED_S
    near = pool.filter("instant is not null").withColumn("key", F.explode(_keys(kind, True))).join(broadcast_if_small(crowded), "key", "left_semi")
    own = [F.col("sid")] if kind == "i" else []
    near = written(near.withColumn("s", F.xxhash64("venue", "form", "instant", *own)), "crowd")
    nodes = near.select("s", "sig", "venue", "instant", "sid", "page", "form", "grams", "is_new").distinct()
    groups = near.groupBy("key", "s").agg(F.first("instant").alias("instant"), F.first("grams").alias("grams"), F.max("is_new").alias("is_new"))
    # a Dice of t needs an overlap of t / (2 - t) of the smaller bound: rarest grams first
    order = groups.select(F.explode("grams").alias("g")).groupBy("g").agg(F.count("*").alias("n"))
    ranked = groups.select("key", "s", F.size("grams").alias("size"), F.explode("grams").alias("g")).join(order, "g")
    ranked = ranked.groupBy("key", "s", "size").agg(F.array_sort(F.collect_list(F.struct("n", "g"))).alias("gs"))
    least = TITLE_STEPS[-1] / (2 - TITLE_STEPS[-1])
    prefix = (F.col("size") - F.ceil(F.col("size") * least) + 1).cast("int")
    met = ranked.select("key", "s", F.explode(F.slice("gs", 1, prefix)).alias("x")).select("key", "s", F.col("x.g").alias("g"))
    met = met.alias("p").join(met.alias("q"), ["key", "g"]).filter("p.s < q.s").select(F.col("p.s").alias("p"), F.col("q.s").alias("q")).distinct()
    g = groups.groupBy("s").agg(F.first("instant").alias("instant"), F.first("grams").alias("grams"), F.max("is_new").alias("is_new"))
    alike = met.join(g.alias("a"), F.col("p") == F.col("a.s")).join(g.alias("b"), F.col("q") == F.col("b.s")).filter("a.is_new or b.is_new")
    alike = alike.filter((F.abs(F.col("a.instant") - F.col("b.instant")) <= reach) & (_dice("a", "b") >= TITLE_STEPS[-1])).select("p", "q")
    alike = alike.unionByName(alike.select(F.col("q").alias("p"), F.col("p").alias("q"))).unionByName(g.filter("is_new").select(F.col("s").alias("p"), F.col("s").alias("q")))
    leaders = nodes.withColumn("role", F.explode(_filled(kind))).groupBy("s", "role").agg(F.min_by(F.struct(*FEATURES, "is_new"), F.struct("is_new", "sig")).alias("lead"))
    leaders = leaders.select(F.col("s").alias("q"), "role", "lead.*")
    asking = nodes.withColumnRenamed("s", "p").join(alike, "p").withColumn("role", F.explode(_roles(kind)))
    led = asking.alias("a").join(leaders.alias("b"), (F.col("a.q") == F.col("b.q")) & (F.col("a.role") == F.col("b.role"))).filter("a.sig <> b.sig and (a.is_new or b.is_new)")
    out = _pair(led)
    if kind == "i":
        # one node for each start, then the next start; bounded by the starts of a window
        by = ["venue", "sid", "page", "instant"]
        firsts = nodes.filter("page is not null").groupBy(*by).agg(F.min_by(F.struct(*FEATURES, "is_new"), F.struct("is_new", "sig")).alias("lead"))
        star = nodes.alias("a").join(firsts.select("lead.*").alias("b"), [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in by]).filter("a.sig <> b.sig and (a.is_new or b.is_new)")
        window = F.floor(F.col("instant") / MOVED_S)
        after = F.lead("lead").over(Window.partitionBy("venue", "sid", "page", window).orderBy("instant"))
        ends = firsts.groupBy("venue", "sid", "page", window.alias("w")).agg(F.min_by("lead", "instant").alias("lo"), F.max_by("lead", "instant").alias("hi"))
        border = ends.alias("x").join(ends.alias("y"), [F.col(f"x.{c}").eqNullSafe(F.col(f"y.{c}")) for c in by[:3]] + [F.col("x.w") + 1 == F.col("y.w")]).select(F.col("x.hi").alias("a"), F.col("y.lo").alias("b"))
        chain = firsts.select(F.col("lead").alias("a"), after.alias("b")).filter("b is not null").unionByName(border).filter("a.is_new or b.is_new")
        out = out.unionByName(_pair(star)).unionByName(_pair(chain))
    return out


class History:
    """Accepted records, ready to be probed by the next batch."""

    def __init__(self, spark: SparkSession, path: str | None = None, crowd: int = CROWD):
        self.spark, self.path, self.crowd = spark, path or new_folder(spark, "history"), crowd
        self.version, self.buckets = 0, BUCKETS
        self.done: list[str] = []  # ids of the batches that were added
        self.parts: list[str] = []  # folders that hold the tables
        self.counts: dict[str, int] = {}
        self.weights: dict[str, float] | None = None
        p, fs = self._fs_path("")
        if fs.exists(p):
            states = sorted(s for s in (x.getPath().getName() for x in fs.listStatus(p)) if s.startswith("state-"))
            if states:
                at = self._fs_path(states[-1])[0]
                stream = fs.open(at)
                self.__dict__.update(json.loads(bytes(stream.readAllBytes()).decode()))
                stream.close()

    def _fs_path(self, name: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)
        return p, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _save(self) -> None:
        """A new state file; it gets its name when it is complete."""
        text = json.dumps({k: getattr(self, k) for k in ("version", "buckets", "done", "parts", "counts", "weights")})
        half, fs = self._fs_path(f"half-{self.version:08d}.json")
        out = fs.create(half, True)
        out.write(bytearray(text.encode()))
        out.close()
        fs.rename(half, self._fs_path(f"state-{self.version:08d}.json")[0])

    def _read(self, name: str, schema: T.StructType, more: tuple[str, ...] = ()) -> DataFrame:
        """A table of all added batches (and folders of a running one)."""
        folders = [f"{self.path}/{name}/batch={b}" for b in (*self.parts, *more)]
        there = [f for f in folders if (p := self._fs_path(f[len(self.path) + 1 :]))[1].exists(p[0])]
        if not there:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.path}/{name}").parquet(*there)

    def _write(self, df: DataFrame, name: str, part: str) -> None:
        # few files for each era and bucket; adaptive execution splits what is large
        df.hint("rebalance", "era", "bucket").write.mode("overwrite").partitionBy("era", "bucket").parquet(f"{self.path}/{name}/batch={part}")

    def _pointers(self, eras: list[int], buckets: list[int], more: tuple[str, ...] = ()) -> DataFrame:
        """``sig``, ``parent``, ``parent_era``: the latest mapping rows of the named eras and buckets."""
        held = self._read("mapping", MAPPING, more).filter(F.col("era").isin(eras) & F.col("bucket").isin(buckets))
        return held.groupBy("sig").agg(F.max_by(F.struct("parent", "parent_era"), "version").alias("p")).select("sig", "p.*")

    def roots(self, nodes: DataFrame, more: tuple[str, ...] = ()) -> DataFrame:
        """``sig``, ``root``, ``root_era`` of nodes (``sig``, ``era``, ``bucket``), by following the mapping."""
        at = nodes.select("sig", F.col("sig").alias("root"), F.col("era").alias("root_era"), "bucket").distinct()
        todo = at
        while True:
            places = todo.select("root_era", "bucket").distinct().collect()  # eras x buckets
            if not places:
                return at.select("sig", "root", "root_era")
            up = self._pointers(sorted({r.root_era for r in places}), sorted({r.bucket for r in places}), more).withColumnRenamed("sig", "root")
            at = written(at.join(up, "root", "left").select("sig", F.coalesce("parent", "root").alias("root"), F.coalesce("parent_era", "root_era").alias("root_era"), "bucket", F.col("parent").isNotNull().alias("rose")), "roots")
            todo = at.filter("rose")
            at = at.drop("rose")

    def found(self) -> DataFrame:
        """``member`` (a record's label) and ``rep`` (the smallest label of its performance) of all records so far."""
        members = self._read("members", MEMBERS).select("member", "sig")
        latest = self._read("mapping", MAPPING).groupBy("sig").agg(F.max_by("parent", "version").alias("root"))
        latest = written(latest, "mapping")
        while True:
            up = latest.select(F.col("sig").alias("root"), F.col("root").alias("above"))
            after = written(latest.join(up, "root", "left").select("sig", F.coalesce("above", "root").alias("root"), F.col("above").isNotNull().alias("rose")), "mapping")
            latest = after.drop("rose")
            if not after.filter("rose").limit(1).count():
                break
        first = members.groupBy("sig").agg(F.min("member").alias("first")).join(latest, "sig", "left").withColumn("root", F.coalesce("root", "sig"))
        first = written(first, "first")
        reps = first.select("sig", "root").join(first.groupBy("root").agg(F.min("first").alias("rep")), "root").select("sig", "rep")
        # copies of one show may be a third of all rows: the join back is salted
        salted = reps.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        return members.withColumn("salt", F.pmod(F.hash("member"), F.lit(SALTS))).join(salted, ["sig", "salt"]).select("member", "rep")

    def add(self, records: DataFrame, batch_id: str | int | None = None) -> None:
        """Add a batch of records; copies within it and of accepted ones join their clusters.

        batch_id: a batch that was added under this id is not added again.
        """
        part = f"b{self.version + 1:08d}" if batch_id is None else f"id-{batch_id}"
        if part in self.done:
            return
        # what is made on the way is removed: results stand in the history's own folder
        before = self.version, dict(self.counts), self.weights, list(self.parts)
        try:
            with passing_tables(self.spark):
                self._add(records, part)
        except Exception:
            self.version, self.counts, self.weights, self.parts = before
            raise
        self.done.append(part)
        self.parts.append(part)
        self._save()

    def _add(self, records: DataFrame, part: str) -> None:
        signed(records).write.mode("overwrite").parquet(f"{self.path}/members/batch={part}")
        rows = self._read("members", MEMBERS, (part,)).filter(F.col("batch") == part)
        pool = self._pool(rows)
        self.version += 1
        new = pool.filter("is_new")
        self._write(new.select(*FEATURES, "era", "bucket"), "nodes", part)
        links = self._links(pool)
        if links is not None:
            self._unite(pool, links, part)
        self._place_undated(rows, new, part)

    def _pool(self, rows: DataFrame) -> DataFrame:
        """New nodes and the held ones that stand under a key of theirs; ``is_new`` tells them apart."""
        fresh = _placed(rows.groupBy("sig").agg(*[F.first(c).alias(c) for c in FEATURES[1:]]), self.buckets)
        reach = F.array(*[F.floor((F.col("instant") + d) / ERA_S).cast("int") for d in (-2 * MOVED_S, 0, 2 * MOVED_S)])
        where = F.when(F.col("instant").isNull(), F.array(F.lit(UNDATED))).otherwise(F.array_distinct(reach))
        places = _placed(rows, self.buckets).select("bucket", F.explode(where).alias("era")).distinct().collect()  # eras x buckets
        held = self._read("nodes", NODES).filter(F.col("era").isin(sorted({r.era for r in places})) & F.col("bucket").isin(sorted({r.bucket for r in places})))
        held = held.select(*FEATURES, "era", "bucket")
        # nodes of the batch itself probe whatever stands in their slots and windows; undated ones meet by signature
        probes = F.when(F.col("instant").isNull(), F.array(F.xxhash64("sig"))).otherwise(F.concat(_keys("t", True), _keys("i", True)))
        own = F.when(F.col("instant").isNull(), F.array(F.xxhash64("sig"))).otherwise(F.concat(_keys("t", False), _keys("i", False)))
        asked = fresh.select(F.explode(probes).alias("key")).distinct()
        touched = held.withColumn("key", F.explode(own)).join(asked, "key", "left_semi").drop("key")
        both = touched.withColumn("is_new", F.lit(False)).unionByName(fresh.withColumn("is_new", F.lit(True)))
        columns = [c for c in both.columns if c not in ("sig", "is_new")]
        return written(both.groupBy("sig").agg(*[F.first(c).alias(c) for c in columns], F.min("is_new").alias("is_new")), "pool")

    def _links(self, pool: DataFrame) -> DataFrame | None:
        """``a``, ``b``: pairs of the pool that the weights link; null where there are none."""
        dated = pool.filter("instant is not null")
        sizes = dated.select(F.explode(F.concat(_keys("t", False), _keys("i", False))).alias("key")).groupBy("key").count()
        most = sizes.agg(F.coalesce(F.max("count"), F.lit(0)).alias("count")).select(F.lit("most").alias("pattern"), "count")
        got = {r.pattern: r["count"] for r in most.unionByName(self._chance(dated)).collect()}
        crowded = written(sizes.filter(F.col("count") > self.crowd).select("key"), "crowded") if got.pop("most") > self.crowd else None
        pairs = _direct(pool, "t", crowded).unionByName(_direct(pool, "i", crowded))
        if crowded is not None:
            pairs = pairs.unionByName(_crowded(pool, "t", crowded)).unionByName(_crowded(pool, "i", crowded)).distinct()
        scored = written(pairs, "pairs")
        got |= {r.pattern: r["count"] for r in scored.groupBy("pattern").count().collect()}  # some hundred patterns
        for p, n in got.items():
            if p.endswith("|0?"):
                # pairs of chance: all pairs of a slot but those that were compared
                levels = p.split("|")
                compared = sum(m for q, m in got.items() if (x := q.split("|"))[0] == "close" and x[-1] != "0?" and all((x[i] == "none") == (levels[i] == "none") for i in (1, 2)))
                p, n = p[:-1], max(n - compared, 0)
            self.counts[p] = self.counts.get(p, 0) + n
        seen = sum(n for p, n in self.counts.items() if "|same|" in p)
        self.weights = learn({p: n for p, n in self.counts.items() if n}) if seen >= LEARN_FROM else None
        good = [p for p in got if not p.endswith("?") and score(p, self.weights or FIRST_WEIGHTS) >= 0.5]
        return scored.filter(F.col("pattern").isin(good)).select("a", "b") if good else None

    def _chance(self, dated: DataFrame) -> DataFrame:
        """``pattern``, ``count`` of all pairs of a slot with a new node, by what both have; no pair is built."""
        kinds = [(s, p) for s in (0, 1) for p in (0, 1)]
        is_kind = lambda s, p: (F.col("sid").isNotNull() == F.lit(bool(s))) & (F.col("page").isNotNull() == F.lit(bool(p)))
        n = dated.groupBy(_keys("t", False)[0].alias("key")).agg(
            *[F.count_if(is_kind(s, p)).alias(f"n{s}{p}") for s, p in kinds], *[F.count_if(is_kind(s, p) & ~F.col("is_new")).alias(f"o{s}{p}") for s, p in kinds]
        )
        totals: dict[str, Column] = {}
        for i, (s1, p1) in enumerate(kinds):
            for s2, p2 in kinds[i:]:
                x = f"{s1}{p1}", f"{s2}{p2}"
                pairs = lambda v, x=x: F.col(v + x[0]) * (F.col(v + x[0]) - 1) / 2 if x[0] == x[1] else F.col(v + x[0]) * F.col(v + x[1])
                name = f"close|{'other' if s1 and s2 else 'none'}|{'other' if p1 and p2 else 'none'}|0?"
                totals[name] = totals.get(name, F.lit(0.0)) + pairs("n") - pairs("o")
        summed = n.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(k) for k, c in totals.items()])
        return summed.select(F.explode(F.array(*[F.struct(F.lit(k).alias("pattern"), F.col(f"`{k}`").alias("count")) for k in totals])).alias("x")).select("x.*")

    def _unite(self, pool: DataFrame, links: DataFrame, part: str) -> None:
        """Join the clusters that links touch; mapping rows for touched nodes and representatives only."""
        place = pool.select("sig", "era", "bucket", "is_new")
        ends = links.select(F.col("a").alias("sig")).union(links.select("b")).distinct()
        touched = place.join(ends, "sig").filter("not is_new")
        known = self.roots(touched)
        known = written(known.join(place.select("sig", "bucket"), "sig").filter("sig <> root"), "known")
        reps = components(links.union(known.select("sig", "root")))
        where = place.select("sig", "era", "bucket").unionByName(known.select(F.col("root").alias("sig"), F.col("root_era").alias("era"), "bucket")).distinct()
        moved = reps.filter("label <> rep").join(where.withColumnRenamed("sig", "label"), "label")
        up = where.select(F.col("sig").alias("rep"), F.col("era").alias("parent_era"))
        rows = moved.join(up, "rep").select(F.col("label").alias("sig"), F.col("rep").alias("parent"), "parent_era", F.lit(self.version).alias("version"), "era", "bucket")
        self._write(rows, "mapping", part)

    def _place_undated(self, rows: DataFrame, new: DataFrame, part: str) -> None:
        """Undated nodes that stand alone join the one performance their identifier, page or title names."""
        named = lambda d: d.filter("venue is not null").withColumn("title", F.substring_index("form", "|", 1)).withColumn(
            "name",
            F.explode(F.filter(F.array(*[F.when(F.coalesce(F.col(c), F.lit("")) != "", F.struct(F.lit(i).alias("rank"), F.xxhash64("venue", F.lit(c), c).alias("key"))) for i, c in enumerate(("sid", "page", "title"))]), lambda x: x.isNotNull())),
        ).select("sig", "era", "bucket", "instant", "name.*")
        fresh = named(new)
        buckets = [r.bucket for r in new.select("bucket").distinct().collect()]  # at most BUCKETS values
        held = self._read("nodes", NODES).filter(F.col("bucket").isin(buckets))
        waiting = held.filter(F.col("era") == UNDATED).join(self._pointers([UNDATED], buckets), "sig", "left_anti")
        again = named(waiting).join(fresh.select("key").distinct(), "key", "left_semi")
        lonely = written(fresh.filter("instant is null").unionByName(again.select(*fresh.columns)), "undated")
        if not lonely.limit(1).count():
            return
        seen = rows.agg(F.min("seen").alias("lo"), F.max("seen").alias("hi")).first()
        around = F.lit(True) if seen.lo is None else F.col("era").between((seen.lo - SEEN_BEFORE_S) // ERA_S, (seen.hi + SEEN_AHEAD_S) // ERA_S) | (F.col("era") == UNDATED)
        keys = lonely.select("key").distinct()
        near = written(named(held.filter(around)).unionByName(fresh).join(keys, "key", "left_semi"), "named")
        # the mapping of this batch is in its folder already
        root = self.roots(near.select("sig", "era", "bucket"), (part,))
        near = near.join(root, "sig")
        is_dated = F.col("root_era") != UNDATED
        told = near.groupBy("key").agg(
            F.min(F.when(is_dated, F.struct("root", "root_era"))).alias("lo"), F.max(F.when(is_dated, F.struct("root", "root_era"))).alias("hi"), F.min(F.when(~is_dated, F.col("root"))).alias("first")
        )
        one = F.when(F.col("lo.root") == F.col("hi.root"), F.col("lo")).when(F.col("lo").isNull(), F.struct(F.col("first").alias("root"), F.lit(UNDATED).alias("root_era")))
        hits = lonely.join(told, "key").withColumn("one", one).filter("one is not null and (one.root_era <> %d or one.root < sig)" % UNDATED)
        best = hits.groupBy("sig", "era", "bucket").agg(F.min_by("one", F.struct("rank", "one")).alias("one"))
        rows_ = best.select("sig", F.col("one.root").alias("parent"), F.col("one.root_era").alias("parent_era"), F.lit(self.version).alias("version"), "era", "bucket")
        self._write(rows_, "mapping", f"{part}u")
        self.parts.append(f"{part}u")

    def compact(self) -> None:
        """Rewrite the tables as one part: one row for each node, its mapping followed to the end."""
        with passing_tables(self.spark):
            self._compact(f"c{self.version + 1:08d}")

    def _compact(self, part: str) -> None:
        nodes = self._read("nodes", NODES)
        root = self.roots(nodes.select("sig", "era", "bucket"))
        flat = root.filter("sig <> root").join(nodes.select("sig", "era", "bucket"), "sig")
        self._write(flat.select("sig", F.col("root").alias("parent"), F.col("root_era").alias("parent_era"), F.lit(self.version).alias("version"), "era", "bucket"), "mapping", part)
        self._write(nodes.select(*FEATURES, "era", "bucket"), "nodes", part)
        self._read("members", MEMBERS).drop("batch").write.mode("overwrite").parquet(f"{self.path}/members/batch={part}")
        old, self.parts = self.parts, [part]
        self.version += 1
        self._save()
        for name in ("nodes", "members", "mapping"):
            for b in old:
                p, fs = self._fs_path(f"{name}/batch={b}")
                fs.delete(p, True)


EXISTING, PARTNER = "0|", "1|"  # existing records sort ahead of partner rows, those by arrival


def existing_records(existing: DataFrame) -> DataFrame:
    return existing.filter("id is not null").select(
        F.concat(F.lit(EXISTING), "id").alias("label"), F.col("venue_id").alias("venue"), "title", F.unix_timestamp("starts_at").alias("instant"), "source_event_id", "ticket_url",
        F.unix_timestamp("accepted_at").alias("seen"),
    )


def partner_records(rows: DataFrame, starts: DataFrame) -> DataFrame:
    """rows with ``starts`` (``_ord``, ``instant``), as from the timestamp dictionary."""
    held = rows.select("_ord", "venue_id", "title", "source_event_id", "ticket_url", F.unix_timestamp("fetched_at").alias("seen")).filter("_ord is not null")
    return held.join(starts.select("_ord", "instant"), "_ord", "left").select(
        F.concat(F.lit(PARTNER), F.lpad(F.col("_ord").cast("string"), 19, "0")).alias("label"), F.col("venue_id").alias("venue"), "title", "instant", "source_event_id", "ticket_url", "seen"
    )


def repeated(found: DataFrame) -> DataFrame:
    """``_ord``, ``accepted_key`` of the partner members that repeat an earlier or existing record."""
    later = found.filter(F.col("member").startswith(PARTNER) & (F.col("member") != F.col("rep")))
    key = F.when(F.col("rep").startswith(EXISTING), F.substring("rep", 3, 1 << 20)).otherwise(F.substring("rep", 3, 1 << 20).cast("long").cast("string"))
    return later.select(F.substring("member", 3, 19).cast("long").alias("_ord"), key.alias("accepted_key"))
