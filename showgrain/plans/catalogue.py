"""More of the relational core: tiered matching, collapse of waiting rows, roll-ups, calendars, run logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from showgrain.functions import columns as C
from showgrain.functions import times as X
from showgrain.functions.links import IMAGE_POINTS, image_points
from showgrain.operators import collapse, generate
from showgrain.operators import relational as R
from showgrain.plans.reference import _SCORE, _TK, AS_OF, AS_OF_S, NORM, L, as_of, listings
from showgrain.session import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


_WORDS = "list_filter(string_split({0}, ' '), lambda w: length(w) > 1)"


@query(f"""WITH t AS (SELECT DISTINCT {NORM.format('extracted_band_name')} AS target FROM enriched_partner_event WHERE extracted_band_name IS NOT NULL),
tt AS (SELECT target, {_WORDS.format('target')} AS tt FROM t WHERE target <> ''), a AS (SELECT id, {NORM.format('name')} AS name FROM artist), aa AS (SELECT id, name, {_WORDS.format('name')} AS nt FROM a WHERE length(name) >= 3 AND NOT regexp_matches(name, '\\d\\s*[ap]m\\b')),
p AS (SELECT target, id, len(list_filter(tt, lambda w: list_contains(nt, w))) / nullif(len(tt), 0) AS share, CASE WHEN target = name THEN 100
 WHEN least(length(target), length(name)) >= 5 AND (contains(' ' || target || ' ', ' ' || name || ' ') OR contains(' ' || name || ' ', ' ' || target || ' ')) THEN 85
 WHEN share >= 1 AND len(tt) >= 2 THEN 90 WHEN share >= 0.8 AND len(tt) >= 2 THEN 70 ELSE 0 END AS tier FROM tt, aa)
SELECT target, id AS artist_id, tier FROM p WHERE tier >= 70 QUALIFY row_number() OVER (PARTITION BY target ORDER BY tier DESC, id) = 1""")
def tiered_artists(spark: SparkSession, root: str) -> DataFrame:
    t = table(spark, root, "enriched_partner_event").filter("extracted_band_name is not null").select(C.normalize_title("extracted_band_name").alias("target")).distinct()
    a = table(spark, root, "artist").select(F.col("id").alias("artist_id"), C.normalize_title("name").alias("name"))
    best = R.top_k(collapse.tiers(t, a, "target", "artist_id", "name"), ["target"], 1, F.desc("tier"), F.col("artist_id"))
    return best.select("target", "artist_id", "tier")


def _waiting(spark, root) -> DataFrame:
    df = listings(spark, root).filter("venue_id is not null")
    rows = df.select(
        F.col("_ord").alias("ord"), F.col("venue_id").alias("venue"), C.normalize_title("title").alias("form"), F.col("s").alias("start"), C.ticket_key("ticket_url").alias("ticket"), C.no_value("fingerprint").alias("fingerprint"),
        C.preference("confidence", "ticket_url", "image_url", "description", "start").alias("score"),
    )
    return collapse.waiting(rows)


_WAITING = f"""{L}, r AS (SELECT _ord AS ord, venue_id AS venue, coalesce({NORM.format('title')}, '') AS form, s, {_TK} AS ticket, CASE WHEN trim(fingerprint) <> '' THEN fingerprint END AS fp, {_SCORE} AS score FROM listings WHERE venue_id IS NOT NULL),
o AS (SELECT *, row_number() OVER (PARTITION BY venue ORDER BY ord) AS n FROM r),
w AS (SELECT venue, n, ord, score, ord AS slot, [{{'opener': ord, 'form': form, 's': s, 'ticket': ticket, 'fp': fp, 'score': score}}] AS held FROM o WHERE n = 1
 UNION ALL SELECT venue, n, ord, score, CASE WHEN pos IS NULL THEN ord ELSE held[pos].opener END,
  CASE WHEN pos IS NULL THEN list_append(held, {{'opener': ord, 'form': form, 's': s, 'ticket': ticket, 'fp': fp, 'score': score}})
   WHEN score > held[pos].score THEN list_concat(list_append(held[: pos - 1], {{'opener': held[pos].opener, 'form': form, 's': s, 'ticket': ticket, 'fp': fp, 'score': score}}), held[pos + 1 :]) ELSE held END
  FROM (SELECT o.*, w.held, nullif(list_position(list_transform(w.held, lambda x: coalesce(x.fp = o.fp, false) OR x.form = o.form AND (coalesce(x.ticket = o.ticket, false) OR coalesce(abs(x.s - o.s) <= 64800 OR x.s // 86400 = o.s // 86400, false))), true), 0) AS pos
   FROM w JOIN o ON o.venue = w.venue AND o.n = w.n + 1)),
f AS (SELECT ord, venue, slot, row_number() OVER (PARTITION BY slot ORDER BY score DESC, ord) = 1 AS kept FROM w)"""


@query(f"WITH RECURSIVE {_WAITING} SELECT ord, slot, kept FROM f")
def waiting_collapsed(spark, root):
    """Waiting rows collapsed in order: equal fingerprints whatever their title, equal ticket and title whatever their start."""
    return _waiting(spark, root)


@query(f"WITH RECURSIVE {_WAITING} SELECT count(*) FILTER (kept) AS kept, count(*) FILTER (NOT kept) AS rejected FROM f")
def waiting_counts(spark, root):
    return _waiting(spark, root).agg(F.count_if("kept").alias("kept"), F.count_if(~F.col("kept")).alias("rejected"))


@query(f"""WITH {L}, v AS (SELECT source_id, venue_name, title, s FROM listings) SELECT source_id, count(*) AS n, count(DISTINCT venue_name) AS venues, count(*) FILTER (s >= {AS_OF_S}) AS upcoming,
 round(avg(length(title)), 4) AS mean_title FROM v GROUP BY source_id""")
def readiness(spark, root):
    up = F.count_if(F.col("start") >= as_of())
    return listings(spark, root).groupBy("source_id").agg(F.count("*").alias("n"), F.count_distinct("venue_name").alias("venues"), up.alias("upcoming"), F.round(F.avg(F.length("title")), 4).alias("mean_title"))


@query("""SELECT 'venue' AS target_type, v.id AS target_id, round(avg(p.confidence), 6) AS rating, count(p.confidence) AS n FROM venue v JOIN partner_event p ON p.venue_id = v.id GROUP BY v.id
UNION ALL SELECT 'source', s.id, round(avg(p.confidence), 6), count(p.confidence) FROM venue_event_sources s JOIN partner_event p ON p.source_id = s.id WHERE s.venue_id IS NULL GROUP BY s.id""")
def rating_rollup(spark, root):
    """Scores of two kinds of targets by a (type, id) key: one union of typed keys, one aggregate."""
    p = table(spark, root, "partner_event").select("venue_id", "source_id", "confidence")
    facts = p.select(F.explode(F.array(F.struct(F.lit("venue").alias("target_type"), F.col("venue_id").alias("target_id")), F.struct(F.lit("source").alias("target_type"), F.col("source_id").alias("target_id")))).alias("t"), "confidence").select("t.*", "confidence")
    feeds = table(spark, root, "venue_event_sources").filter("venue_id is null")
    targets = table(spark, root, "venue").select(F.lit("venue").alias("target_type"), F.col("id").alias("target_id")).union(feeds.select(F.lit("source"), "id"))
    agg = facts.filter("target_id is not null").groupBy("target_type", "target_id").agg(F.round(F.avg("confidence"), 6).alias("rating"), F.count("confidence").alias("n"))
    return agg.join(targets, ["target_type", "target_id"], "left_semi")


@query("""WITH r AS (SELECT source_id, batch_no, min(epoch(fetched_at)::BIGINT) AS started, count(*) AS n FROM partner_event GROUP BY ALL)
SELECT source_id, batch_no, started, n FROM r QUALIFY row_number() OVER (PARTITION BY source_id ORDER BY batch_no DESC) <= 2""")
def latest_runs(spark, root):
    runs = table(spark, root, "partner_event").groupBy("source_id", "batch_no").agg(F.min(F.unix_timestamp("fetched_at")).alias("started"), F.count("*").alias("n"))
    return R.top_k(runs, ["source_id"], 2, F.desc("batch_no")).drop("rank")


@query("""SELECT id, strftime(unnest(generate_series(date_trunc('month', make_timestamp(epoch_us(created_at))), make_timestamp(epoch_us(last_scrape_at)), INTERVAL 1 MONTH)), '%Y-%m-%d') AS month FROM venue_event_sources WHERE last_scrape_at IS NOT NULL AND created_at <= last_scrape_at""")
def month_pages(spark, root):
    """First days of the months between a source's start and its last visit."""
    s = table(spark, root, "venue_event_sources").filter("last_scrape_at is not null and created_at <= last_scrape_at")
    return s.select("id", F.explode(X.month_starts("created_at", "last_scrape_at")).alias("m")).select("id", F.date_format("m", "yyyy-MM-dd").alias("month"))


@query(f"""WITH r AS (SELECT id, list_filter([1, 2, 3, 4, 5], lambda d: contains(lower(coalesce(price_text, '')), d::VARCHAR)) AS days FROM extracted_event),
d AS (SELECT unnest(generate_series(DATE '2026-10-15', DATE '2026-10-21', INTERVAL 1 DAY))::DATE AS day) SELECT id, strftime(day, '%Y-%m-%d') AS on_date FROM r, d WHERE len(days) = 0 OR list_contains(days, dayofweek(day))""")
def weekday_rules(spark, root):
    """Dates of rules with weekdays (none: every day); here the digits of a price stand in for weekdays."""
    days = F.filter(F.array(*[F.lit(d).cast("smallint") for d in range(1, 6)]), lambda d: F.contains(F.lower(F.coalesce("price_text", F.lit(""))), d.cast("string")))
    rules = table(spark, root, "extracted_event").select("id", days.alias("days_of_week"), F.lit(None).cast("date").alias("valid_from"), F.lit(None).cast("date").alias("valid_to"))
    out = generate.on_weekdays(rules, F.lit(AS_OF[:10]), F.lit("2026-10-21"))
    return out.select("id", F.date_format("date", "yyyy-MM-dd").alias("on_date"))


_POINTS = " + ".join(f"CASE WHEN regexp_matches(lower(image_url), '{p}') THEN {n} ELSE 0 END" for p, n in IMAGE_POINTS)


@query(f"""SELECT venue_id, image_url FROM (SELECT DISTINCT venue_id, image_url, {_POINTS} AS points FROM partner_event WHERE trim(image_url) <> '' AND venue_id IS NOT NULL) QUALIFY row_number() OVER (PARTITION BY venue_id ORDER BY points DESC, image_url) = 1""")
def best_image(spark, root):
    """The image of each venue that scores highest, combined before the shuffle."""
    p = table(spark, root, "partner_event").filter("trim(image_url) <> '' and venue_id is not null")
    return p.groupBy("venue_id").agg(F.min_by("image_url", F.struct(-image_points("image_url"), "image_url")).alias("image_url"))



@query("""SELECT p.id, v.address, coalesce(nullif(trim(p.image_url), ''), nullif(trim(v.website_url), '')) AS media FROM prekindle_event p LEFT JOIN venue v ON p.venue_id = v.id""")
def media_enriched(spark, root):
    p = R.embed(table(spark, root, "prekindle_event"), table(spark, root, "venue"), "venue_id", "id", {"address": "address", "site": "website_url"})
    return p.select("id", "address", F.coalesce(C.no_value(F.trim("image_url")), C.no_value(F.trim("site"))).alias("media"))


@query("""WITH w AS (SELECT event_type, unnest([floor(epoch(ts))::BIGINT // 3600 * 3600 - 3600, floor(epoch(ts))::BIGINT // 3600 * 3600]) AS window_start, value FROM events)
SELECT event_type, window_start, count(*) AS n FROM w GROUP BY ALL""")
def sliding_windows(spark, root):
    e = table(spark, root, "events").withColumn("t", F.col("ts").cast("timestamp"))
    w = e.groupBy("event_type", F.window("t", "2 hours", "1 hour")).agg(F.count("*").alias("n"))
    return w.select("event_type", F.unix_timestamp("window.start").alias("window_start"), "n")


@query("""SELECT user_id, event_id, ts_s - prev AS gap FROM (SELECT user_id, event_id, floor(epoch(ts))::BIGINT AS ts_s, floor(epoch(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)))::BIGINT AS prev FROM events WHERE event_type = 'purchase')""")
def gaps_between(spark, root):
    e = table(spark, root, "events").filter("event_type = 'purchase'").withColumn("s", F.unix_timestamp(F.col("ts").cast("timestamp")))
    prev = F.lag("s").over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    return e.select("user_id", "event_id", (F.col("s") - prev).alias("gap"))


@query("""SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_disc, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY ALL""")
def pricing_summary(spark, root):
    li = table(spark, root, "lineitem").filter(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp_ntz"))
    return li.groupBy("l_returnflag", "l_linestatus").agg(F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("sum_disc"), F.count("*").alias("n"))


@query("""SELECT n_name, c_mktsegment, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL""")
def segment_totals(spark, root):
    c = R.embed(table(spark, root, "customer"), table(spark, root, "nation"), "c_nationkey", "n_nationkey", {"n_name": "n_name"}, "inner")
    j = table(spark, root, "orders").join(c, F.col("o_custkey") == F.col("c_custkey"))
    return j.groupBy("n_name", "c_mktsegment").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
