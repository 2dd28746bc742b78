"""Matching entities across sources without keys: listings of city feeds and accepted shows.

1. Venue names become fixed bit vectors of their q-grams (``BITS`` bits, one for each gram).
   Close pairs are found exactly by multi-index Hamming hashing: a vector is cut into
   ``CHUNKS`` chunks so that two vectors within ``RADIUS`` bits differ by at most one bit in some
   chunk.  Chunks hold few bits, so a neighbour of one bit is a chunk without one of its bits:
   names and venues are both keyed by their chunks and by those with one bit less, which
   meet just where the chunks differ by one bit or none.  The full distance is taken for the
   hits.  Distinct names are searched, not rows.
2. Listings meet shows of their candidate venues in the same start slots (within
   ``APART_S``; a bare date means the venue's local day).
3. A pair's score is the field-weighted Dice similarity of title, venue and address
   vectors and of the start (accepted shows carry no price).
4. Scores become confidences by calibration: scores of pairs that cannot match (the same
   venue, a start some weeks away) give the distribution of chance, and the share of
   chance at a score is what its confidence lacks.  Both are histograms of ``BINS`` bins,
   so a bounded result reaches the driver.
5. Each listing keeps its best show, if the confidence reaches ``ACCEPT``.

Listings that say the same are compared once and joined back to their rows by a salted key.

Defined results: rows without an id take no part; null or empty venues and titles, and starts that tell no day, match
nothing; repeated listings match each; ties take the nearer start, then the smaller id;
empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import date

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from showgrain.functions.frames import frame
from showgrain.functions.timeparse import find_day
from showgrain.llm import shows
from showgrain.session import broadcast_if_small, spread, written

BITS = 512
TITLE_BITS = 512
RADIUS = 7  # a swap of letters changes six grams, any other typing error four
CHUNKS = 4  # RADIUS < 2 * CHUNKS: some chunk differs by one bit at most
CITIES_BOUND = 100_000  # distinct cities of venues, which every task holds
SALTS = 16
APART_S = 95 * 60
SLOT_S = 2 * 3600
BINS = 40
RIVAL = 0.1  # by which a venue may be less similar to a name than the name's closest venue
ACCEPT = 0.6
CHANCE_DAYS = (21, 24, 35)  # offsets in days at which a venue's shows serve as chance pairs
FIELD_WEIGHTS = {"title": 0.66, "venue": 0.16, "address": 0.1, "start": 0.08}
HEAD = 0.97  # what an equal first act counts beside an equal title
NEAR_LOCAL_S = 86400


def _chunks(vector: list[int]) -> list[tuple[str, list[str]]]:
    """Each chunk of a vector as a key, and the keys of that chunk with one bit less."""
    whole = sum((w & 0xFFFFFFFFFFFFFFFF) << (64 * i) for i, w in enumerate(vector))
    width = BITS // CHUNKS
    out = []
    for c in range(CHUNKS):
        x = (whole >> (width * c)) & ((1 << width) - 1)
        out.append((f"{c}:{x:x}", [f"{c}:{x ^ (1 << i):x}" for i in range(width) if x >> i & 1]))
    return out


def _keyed(column: str, more: str, less: str):
    """Vectors with their chunk keys: as they are ('='), where the other side has a bit more, and where it has one less."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            n, v, k = [], [], []
            for name, form in zip(b[column], b.form, strict=True):
                vec = shows.bit_vector(shows.grams(form), BITS, 1)
                keys = [x for key, fewer in _chunks(vec) for x in (f"=|{key}", f"{more}|{key}", *(f"{less}|{f}" for f in fewer))]
                n += [name] * len(keys)
                v += [vec] * len(keys)
                k += keys
            yield frame({column: n, "bits": v, "chunk": k})

    return run


def _bits_of(column: str):
    """Bit vectors of the whole title and of its first act."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            whole = [shows.bit_vector(shows.grams(shows.act_form(t)), TITLE_BITS) for t in b[column]]
            head = [shows.bit_vector(shows.grams(shows.head_form(t)), TITLE_BITS) for t in b[column]]
            yield frame({column: b[column], f"{column}_bits": whole, f"{column}_head": head})

    return run


def _titled(df: DataFrame, column: str) -> DataFrame:
    schema = f"{column} string, {column}_bits array<long>, {column}_head array<long>"
    return spread(df.select(column).distinct()).mapInPandas(_bits_of(column), schema)


def _forms_of(cities: frozenset[str]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(form=[shows.venue_form(n, cities) for n in b.venue_name])

    return run


def _count_bits(v: F.Column) -> F.Column:
    return F.aggregate(v, F.lit(0), lambda s, w: s + F.bit_count(w))


def _dice(a: str, b: str) -> F.Column:
    """Dice similarity of two bit vectors."""
    both = _count_bits(F.zip_with(a, b, lambda x, y: x.bitwiseAND(y)))
    return F.coalesce(2 * both / F.nullif(_count_bits(F.col(a)) + _count_bits(F.col(b)), F.lit(0)), F.lit(0.0))


def close_venues(names: DataFrame, venues: DataFrame) -> DataFrame:
    """``venue_name``, ``venue_id``, ``venue_dice`` of all pairs within ``RADIUS`` bits.

    names: distinct ``venue_name``; venues: ``id``, ``name``, ``city``.
    """
    held = venues.filter("city is not null").select("city").distinct().limit(CITIES_BOUND + 1).collect()
    if len(held) > CITIES_BOUND:
        raise ValueError(f"over {CITIES_BOUND} distinct cities; raise CITIES_BOUND to the executors' memory")
    cities = frozenset(shows.bare(r.city).strip() for r in held)
    known = venues.select(F.col("id").alias("venue_id"), F.col("name").alias("venue_name")).filter("venue_id is not null and coalesce(trim(venue_name), '') <> ''")
    index = known.mapInPandas(_forms_of(cities), "venue_id string, venue_name string, form string").mapInPandas(_keyed("venue_id", "<", ">"), "venue_id string, bits array<long>, chunk string")
    index = index.withColumnRenamed("bits", "known_bits")
    typed = names.filter("coalesce(trim(venue_name), '') <> ''").select("venue_name").distinct()
    probes = typed.mapInPandas(_forms_of(cities), "venue_name string, form string").mapInPandas(_keyed("venue_name", ">", "<"), "venue_name string, bits array<long>, chunk string")
    hits = probes.withColumnRenamed("bits", "name_bits").join(broadcast_if_small(written(index, "venue-index")), "chunk").select("venue_name", "venue_id", "name_bits", "known_bits").distinct()
    apart = _count_bits(F.zip_with("name_bits", "known_bits", lambda x, y: x.bitwiseXOR(y)))
    near = hits.filter(apart <= RADIUS).select("venue_name", "venue_id", _dice("name_bits", "known_bits").alias("venue_dice"))
    near = near.withColumn("top", F.max("venue_dice").over(Window.partitionBy("venue_name")))
    return near.filter(F.col("venue_dice") >= F.col("top") - RIVAL).drop("top")


def _street(col: str) -> F.Column:
    """House number and street name of an address, without the kind of street."""
    c = F.lower(F.trim(col))
    return F.nullif(F.regexp_extract(c, r"^(\d+\s+[\p{L}]+)", 1), F.lit(""))


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The day of a listing without a time, and the bit vectors of its title and of its first act."""
    for b in batches:
        days = []
        for text, raw, seen, at in zip(b.starts_at, b.raw_date_text, b.seen, b.instant, strict=True):
            ref = date.fromisoformat(seen) if seen else None
            d = (find_day(text, ref) or find_day(raw, ref)) if pd.isna(at) else None
            days.append(d.isoformat() if d else None)
        whole = [shows.bit_vector(shows.grams(shows.act_form(t)), TITLE_BITS) for t in b.title]
        head = [shows.bit_vector(shows.grams(shows.head_form(t)), TITLE_BITS) for t in b.title]
        yield frame({"sig": b.sig, "venue_name": b.venue_name, "address": b.address, "instant": b.instant, "day": days, "title_bits": whole, "title_head": head})


def match_pairs(listings: DataFrame, starts: DataFrame, existing: DataFrame, venues: DataFrame, zones: DataFrame) -> DataFrame:
    """``_ord``, ``existing_id``, ``score``, ``confidence``: the best show of each listing.

    listings: rows of the feeds; starts: ``_ord``, ``instant``; zones: ``venue_id``, ``zone``.
    """
    said = ["title", "venue_name", "address", "starts_at", "raw_date_text", "seen", "instant"]
    rows = listings.filter("_ord is not null").select("_ord", "title", "venue_name", "address", "starts_at", "raw_date_text", F.date_format("fetched_at", "yyyy-MM-dd").alias("seen")).join(starts.select("_ord", "instant"), "_ord", "left")
    # only a bare date is read again, so only there its texts and the day it was seen matter
    for c in ("starts_at", "raw_date_text", "seen"):
        rows = rows.withColumn(c, F.when(F.col("instant").isNull(), F.col(c)))
    rows = written(rows.withColumn("sig", F.md5(F.to_json(F.struct(*said), {"ignoreNullFields": "false"}))).select("_ord", "sig", *said), "listings")
    once = rows.groupBy("sig").agg(*[F.first(c).alias(c) for c in said])
    near = written(close_venues(rows, venues), "close-venues")
    once = spread(once).mapInPandas(_read, "sig string, venue_name string, address string, instant long, day string, title_bits array<long>, title_head array<long>")
    place = venues.select(F.col("id").alias("vid"), F.col("address").alias("vaddress")).join(zones, F.col("vid") == F.col("venue_id"), "left").select("vid", "vaddress", F.coalesce("zone", F.lit("America/Chicago")).alias("zone"))
    at = near.join(broadcast_if_small(place), near["venue_id"] == F.col("vid")).drop("vid")
    near_rows = once.join(broadcast_if_small(at, 200_000), "venue_name")
    # a bare date covers the venue's local day
    day_start = F.unix_timestamp(F.to_utc_timestamp(F.to_timestamp("day"), F.col("zone")))
    near_rows = near_rows.withColumns(
        {"lo": F.when(F.col("instant").isNotNull(), F.col("instant") - APART_S).otherwise(day_start), "hi": F.when(F.col("instant").isNotNull(), F.col("instant") + APART_S).otherwise(day_start + NEAR_LOCAL_S - 1)}
    ).filter("lo is not null")
    e = existing.filter("id is not null and venue_id is not null and starts_at is not null").select(F.col("id").alias("existing_id"), F.col("venue_id").alias("evenue"), F.col("title").alias("etitle"), F.unix_timestamp("starts_at").alias("einstant"))
    etitled = _titled(e, "etitle")
    e = written(e.join(etitled, "etitle"), "shows")
    # the real pairs and those of chance in one join: chance is the same listing some weeks on
    days = F.explode(F.array(*map(F.lit, (0, *CHANCE_DAYS)))).alias("days")
    shifted = near_rows.select("*", days)
    shifted = shifted.withColumns({c: F.col(c) + F.col("days") * 86400 for c in ("lo", "hi", "instant")})
    scored = written(_scored(shifted, e), "scored")
    confidence = calibration(scored, len(CHANCE_DAYS))
    bins = F.least(F.floor(F.col("score") * BINS), F.lit(BINS - 1)).cast("int")
    out = scored.filter("days = 0").withColumn("confidence", F.element_at(F.array(*map(F.lit, confidence)), bins + 1)).filter(F.col("confidence") >= ACCEPT)
    first = F.min_by(F.struct("existing_id", "score", "confidence"), F.struct(-F.col("score"), F.coalesce("apart", F.lit(1 << 40)), "existing_id"))
    best = written(out.groupBy("sig").agg(first.alias("m")).select("sig", "m.*"), "best").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    # one listing may stand in a third of all rows
    back = rows.select("_ord", "sig", F.pmod(F.hash("_ord"), F.lit(SALTS)).alias("salt"))
    return back.join(best, ["sig", "salt"]).select("_ord", "existing_id", "score", "confidence")


def _scored(rows: DataFrame, e: DataFrame) -> DataFrame:
    """Scored pairs of listings and shows at one venue whose start lies within lo and hi."""
    slots = rows.withColumn("slot", F.explode(F.sequence(F.floor(F.col("lo") / SLOT_S), F.floor(F.col("hi") / SLOT_S))))
    keyed = e.withColumn("eslot", F.floor(F.col("einstant") / SLOT_S))
    p = slots.join(keyed, (F.col("venue_id") == F.col("evenue")) & (F.col("slot") == F.col("eslot"))).filter("einstant between lo and hi")
    p = p.withColumn("apart", F.abs(F.col("einstant") - F.col("instant")))
    street = F.when(_street("address").isNull() | _street("vaddress").isNull(), 0.5).when(_street("address") == _street("vaddress"), 1.0).otherwise(0.0)
    fields = {
        "title": F.greatest(_dice("title_bits", "etitle_bits"), HEAD * _dice("title_head", "etitle_head")),
        "venue": F.col("venue_dice"),
        "address": street,
        "start": F.coalesce(1 - F.col("apart") / (2 * APART_S), F.lit(0.5)),
    }
    total = sum((F.lit(w) * fields[k] for k, w in FIELD_WEIGHTS.items()), F.lit(0.0))
    return p.select("sig", "days", "existing_id", total.alias("score"), "apart")


def calibration(scored: DataFrame, times: int) -> list[float]:
    """Confidence of each score bin: what chance (pairs with other ``days`` than 0) does not explain, made monotone."""
    bins = F.least(F.floor(F.col("score") * BINS), F.lit(BINS - 1)).cast("int").alias("b")
    counts = scored.groupBy((F.col("days") == 0).alias("real"), bins).count().collect()
    got, by_chance = ({r.b: r["count"] for r in counts if r.real == real} for real in (True, False))
    out: list[float] = []
    for b in range(BINS):
        n = got.get(b, 0)
        # neighbours lend weight to thin bins
        around = sum(got.get(x, 0) for x in (b - 1, b, b + 1))
        expected = sum(by_chance.get(x, 0) for x in (b - 1, b, b + 1)) / times
        share = 0.0 if not around else max(0.0, 1 - (expected + 0.3) / (around + 0.3))
        out.append(share if n or around else 0.0)
    for b in range(1, BINS):
        out[b] = max(out[b], out[b - 1])
    return [float(round(x, 4)) for x in out]
