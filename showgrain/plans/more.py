"""Links, dates, sinks, functions for SQL, sources and streams, each beside the SQL it is checked with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from showgrain.functions import columns as C
from showgrain.functions import links as K
from showgrain.functions import times as X
from showgrain.operators import fuzzy, search, sinks, surface
from showgrain.operators import relational as R
from showgrain.plans.reference import _SIDES, AS_OF_S, NORM, SERIES, L, as_of, listings
from showgrain.session import broadcast_if_small, new_folder, table, written
from showgrain.sources import landed
from showgrain.streaming import stateful

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


_HOST = "nullif(regexp_extract(lower(trim({0})), '^[a-z]+://(?:www\\.)?([^/?#:]+)', 1), '')"

#: Hosts that sell tickets for others, in the tables.
VENDORS = ["weekend-planner.example", "the-bluestem-brewery.example", "metro-gig-guide.example"]


# --- links and small texts -----------------------------------------------------------
@query(
    "SELECT _ord, coalesce(" + " OR ".join(f"h = '{v}' OR ends_with(h, '.{v}')" for v in VENDORS) + f", false) AS vendor FROM (SELECT _ord, {_HOST.format('ticket_url')} AS h FROM partner_event)"
)
def vendor_links(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "partner_event").select("_ord", K.at_host("ticket_url", VENDORS).alias("vendor"))


@query("""SELECT _ord, CASE WHEN u <> '' AND u <> '#' AND NOT starts_with(lower(u), 'javascript:') THEN u END AS link, nullif(regexp_extract(ticket_url, '/events?/([A-Za-z0-9]+)(?:[/?#]|$)', 1, 'i'), '') AS vendor_id FROM (SELECT _ord, ticket_url, trim(ticket_url) AS u FROM partner_event)""")
def usable_links(spark, root):
    return table(spark, root, "partner_event").select("_ord", K.usable_link("ticket_url").alias("link"), K.vendor_id("ticket_url").alias("vendor_id"))


@query("SELECT _ord, " + " + ".join(f"CASE WHEN regexp_matches(lower(image_url), '{p}') THEN {n} ELSE 0 END" for p, n in K.IMAGE_POINTS) + " AS points FROM partner_event WHERE trim(image_url) <> ''")
def image_points(spark, root):
    return table(spark, root, "partner_event").filter("trim(image_url) <> ''").select("_ord", K.image_points("image_url").alias("points"))


@query("SELECT _ord, trim(regexp_replace(regexp_replace(regexp_replace(" + NORM.format("extracted_band_name") + ", '\\s+trio$', ''), '\\s+band$', ''), '\\s+and friends$', '')) AS form FROM enriched_partner_event WHERE extracted_band_name IS NOT NULL")
def band_forms(spark, root):
    return table(spark, root, "enriched_partner_event").filter("extracted_band_name is not null").select("_ord", K.band_form("extracted_band_name").alias("form"))


_SERIES_NAMES = ", ".join(f"'{p}'" for _, p in SERIES)


@query(f"""SELECT _ord, n IN ({_SERIES_NAMES}) OR trim(regexp_replace(n, '^(?:live music|free concert|special event)\\s*:\\s*', '')) IN ({_SERIES_NAMES}) AS is_series
FROM (SELECT _ord, trim(regexp_replace(lower(title), '\\s+', ' ', 'g')) AS n FROM partner_event WHERE title IS NOT NULL)""")
def series_names(spark, root):
    return table(spark, root, "partner_event").filter("title is not null").select("_ord", K.series_name("title", [p for _, p in SERIES]).alias("is_series"))


@query("""SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(regexp_replace(x, '[ \\t\\r]+', ' ', 'g'))), lambda x: NOT regexp_matches(x, '^[#\\[!]') AND len(string_split(x, ' ')) >= 15)[1] AS snippet FROM documents WHERE text IS NOT NULL""")
def snippets(spark, root):
    return table(spark, root, "documents").filter("text is not null").select("doc_id", K.first_snippet("text").alias("snippet"))


# --- dates ---------------------------------------------------------------------------
_RULES = {
    "two_months": "CASE WHEN m < 10 - 2 THEN 2027 ELSE 2026 END",
    "month": "CASE WHEN m < 10 - 1 THEN 2027 ELSE 2026 END",
    "late_days": "CASE WHEN m < 10 - 1 THEN 2027 ELSE 2026 END",
    "winter": "CASE WHEN m <= 3 THEN 2027 ELSE 2026 END",
    "days": "year(CASE WHEN make_date(2026, m, d) >= DATE '2026-10-15' - 30 THEN make_date(2026, m, d) ELSE make_date(2027, m, d) END)",
}


@query("SELECT id, " + ", ".join(f"{s} AS {r}" for r, s in _RULES.items()) + " FROM (SELECT id, month(starts_at)::INT AS m, least(day(starts_at), 28)::INT AS d FROM existing_event WHERE starts_at IS NOT NULL)")
def year_rules(spark, root):
    e = table(spark, root, "existing_event").filter("starts_at is not null").select("id", F.month("starts_at").alias("m"), F.least(F.dayofmonth("starts_at"), F.lit(28)).alias("d"))
    return e.select("id", *[X.rolled_year("m", "d", as_of(), r).alias(r) for r in _RULES])


@query("""WITH b AS (SELECT id, list_filter([show_date], lambda x: x IS NOT NULL) AS d, list_filter([doors_time, show_time], lambda x: x IS NOT NULL) AS t FROM prekindle_event)
SELECT id, d[1] AS date, t[1] AS time FROM b WHERE len(d) > 0 AND len(t) > 0""")
def paired_times(spark, root):
    p = table(spark, root, "prekindle_event").select("id", F.explode(X.paired(F.array("show_date"), F.array("doors_time", "show_time"))).alias("x"))
    return p.select("id", "x.date", "x.time")


@query("SELECT id, strftime(starts_at, '%Y-%m-%d') AS first, strftime(CASE WHEN day(starts_at) <= 26 THEN starts_at + INTERVAL 2 DAY ELSE starts_at END, '%Y-%m-%d') AS last FROM existing_event WHERE starts_at IS NOT NULL")
def day_ranges(spark, root):
    """Ranges written as pages write them, read back."""
    e = table(spark, root, "existing_event").filter("starts_at is not null")
    day = F.dayofmonth("starts_at")
    text = F.concat(F.date_format("starts_at", "MMMM d"), F.when(day <= 26, F.concat(F.lit("–"), (day + 2).cast("string"))).otherwise(""), F.date_format("starts_at", ", yyyy"))
    r = X.day_range(F.concat(F.lit("On view: "), text, F.lit(" at the barn")))
    return e.select("id", F.date_format(r["first"], "yyyy-MM-dd").alias("first"), F.date_format(r["last"], "yyyy-MM-dd").alias("last"))


@query("SELECT id, epoch(date_trunc('minute', starts_at))::BIGINT AS s FROM existing_event WHERE starts_at IS NOT NULL")
def url_starts(spark, root):
    e = table(spark, root, "existing_event").filter("starts_at is not null")
    clock = F.lower(F.date_format("starts_at", "'-at-'h-mm-a"))
    by_day = F.when(F.crc32("id") % 2 == 0, F.date_format("starts_at", "'/'yyyy-MM-dd'/show'")).otherwise(F.date_format("starts_at", "'/show-'MMddyy'/x'"))
    return e.select("id", F.unix_timestamp(X.url_start(F.concat(F.lit("https://t.example"), by_day, clock))).alias("s"))


@query("SELECT id, strftime(timezone('America/Chicago', starts_at::TIMESTAMPTZ), '%A, %B %-d, %-I:%M %p') AS said FROM existing_event WHERE starts_at IS NOT NULL")
def local_days(spark, root):
    return table(spark, root, "existing_event").filter("starts_at is not null").select("id", X.local_day("starts_at", F.lit("America/Chicago")).alias("said"))


@query("SELECT id, CASE platform_type WHEN 'tec' THEN greatest(scrape_days_ahead, 180) WHEN 'mec' THEN greatest(scrape_days_ahead, 120) WHEN 'spotapps' THEN least(scrape_days_ahead, 60) ELSE scrape_days_ahead END::INT AS days FROM venue_event_sources")
def days_ahead(spark, root):
    """A source's horizon, widened or narrowed by its platform."""
    d = F.col("scrape_days_ahead").cast("int")
    by = F.when(F.col("platform_type") == "tec", F.greatest(d, F.lit(180))).when(F.col("platform_type") == "mec", F.greatest(d, F.lit(120))).when(F.col("platform_type") == "spotapps", F.least(d, F.lit(60))).otherwise(d)
    return table(spark, root, "venue_event_sources").select("id", by.alias("days"))


# --- joins ---------------------------------------------------------------------------
_SLUG = "rtrim(left(trim(regexp_replace(lower({0}), '[^a-z0-9]+', '-', 'g'), '-'), 80), '-')"


@query(f"""WITH {L}, {_SIDES}, a AS (SELECT _ord AS ord, venue_id AS venue, {_SLUG.format('title')} AS slug, s FROM listings), b AS (SELECT id, venue_id AS venue, {_SLUG.format('title')} AS slug, epoch(starts_at)::BIGINT AS s FROM existing_event),
t AS (SELECT ord, k.id, 0 AS r FROM n JOIN k USING (venue, sid) UNION ALL SELECT ord, k.id, 1 FROM n JOIN k USING (venue, fp) UNION ALL SELECT a.ord, b.id, 2 FROM a JOIN b ON a.venue = b.venue AND a.slug = b.slug AND a.slug <> '' AND abs(a.s - b.s) < 60)
SELECT ord, id AS target_id, r AS step FROM t QUALIFY row_number() OVER (PARTITION BY ord ORDER BY r, id) = 1""")
def located_targets(spark, root):
    """The accepted row that an approved listing is to update: by identifier, fingerprint, or slug within a minute."""
    new = listings(spark, root).select(F.col("_ord").alias("ord"), F.col("venue_id").alias("venue"), F.nullif(F.trim("source_event_id"), F.lit("")).alias("sid"), F.nullif(F.trim("fingerprint"), F.lit("")).alias("fp"), C.slugify("title").alias("slug"), "s")
    new = written(new, "approved")
    old = table(spark, root, "existing_event").select("id", F.col("venue_id").alias("venue"), F.nullif(F.trim("source_event_id"), F.lit("")).alias("sid"), F.nullif(F.trim("fingerprint"), F.lit("")).alias("fp"), C.slugify("title").alias("slug"), F.unix_timestamp("starts_at").alias("s2"))
    hits = []
    for step, key in enumerate(("sid", "fp")):
        first = old.filter(F.col(key).isNotNull()).groupBy("venue", key).agg(F.min("id").alias("id"))
        hits.append(new.join(first, ["venue", key]).select("ord", "id", F.lit(step).alias("step")))
    # a start within a minute lies in the same or a neighbouring minute
    minute = F.floor(F.col("s") / 60)
    asked = new.filter("slug <> ''").select("ord", "venue", "slug", "s", F.explode(F.array(minute - 1, minute, minute + 1)).alias("minute"))
    by_slug = old.select("id", "venue", "slug", "s2", F.floor(F.col("s2") / 60).alias("minute"))
    hits.append(asked.join(by_slug, ["venue", "slug", "minute"]).filter("abs(s - s2) < 60").select("ord", "id", F.lit(2).alias("step")))
    best = hits[0].unionByName(hits[1]).unionByName(hits[2]).groupBy("ord").agg(F.min(F.struct("step", "id")).alias("b"))
    return best.select("ord", F.col("b.id").alias("target_id"), "b.step")


@query(f"""WITH v AS (SELECT id, venue_id, {NORM.format('title')} AS form FROM existing_event WHERE title IS NOT NULL), home AS (SELECT min(id) AS home FROM venue),
s(series_id, pattern) AS (VALUES {", ".join(f"({i}, '{p}')" for i, p in SERIES)}), h AS (SELECT v.id, series_id, length(pattern) + CASE WHEN starts_with(form, pattern) THEN 20 ELSE 0 END + CASE WHEN series_id % 2 = 0 AND venue_id = home THEN 100 ELSE 0 END AS score
 FROM v JOIN s ON contains(form, pattern), home WHERE series_id % 2 = 1 OR venue_id = home)
SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY id ORDER BY score DESC, series_id) = 1""")
def series_by_venue(spark, root):
    """Series of one venue are met there only and count more; the others anywhere."""
    home = table(spark, root, "venue").agg(F.min("id").alias("home"))
    patterns = spark.createDataFrame(SERIES, "series_id int, pattern string").crossJoin(F.broadcast(home)).withColumn("at", F.when(F.col("series_id") % 2 == 0, F.col("home"))).drop("home")
    e = table(spark, root, "existing_event").filter("title is not null").select("id", "venue_id", C.normalize_title("title").alias("form"))
    hits = R.contains_pattern(e, patterns, "form").join(F.broadcast(patterns.select("series_id", "at")), "series_id")
    hits = hits.filter("at is null or at = venue_id").withColumn("score", F.col("score") + F.when(F.col("at").isNotNull(), 100).otherwise(0))
    return R.top_k(hits, ["id"], 1, F.desc("score"), F.col("series_id")).select("id", "series_id", "score")


@query(f"""WITH n AS (SELECT DISTINCT venue_name AS name, {NORM.format('venue_name')} AS form, {_HOST.format('source_url')} AS host FROM partner_event WHERE trim(venue_name) <> ''),
v AS (SELECT id, {NORM.format('name')} AS form, {_HOST.format('website_url')} AS host FROM venue)
SELECT name, n.host, v.id AS venue_id, CASE WHEN n.form = v.form THEN 3 WHEN n.form <> '' AND v.form <> '' AND (contains(n.form, v.form) OR contains(v.form, n.form)) THEN 2 ELSE 1 END AS arm
FROM n JOIN v ON n.form = v.form OR (n.form <> '' AND v.form <> '' AND (contains(n.form, v.form) OR contains(v.form, n.form))) OR n.host = v.host""")
def venues_met(spark, root):
    """Venues met by an equal name, one name within the other, or the host of their page."""
    n = table(spark, root, "partner_event").filter("trim(venue_name) <> ''").select(F.col("venue_name").alias("name"), C.normalize_title("venue_name").alias("form"), C.url_host("source_url").alias("host")).distinct()
    n = written(n, "venue-names")
    v = table(spark, root, "venue").select(F.col("id").alias("venue_id"), C.normalize_title("name").alias("pattern"), C.url_host("website_url").alias("vhost"))
    forms = n.select("form").distinct()
    inside = R.contains_pattern(forms, v.select(F.col("venue_id").alias("series_id"), "pattern"), "form").select("form", F.col("series_id").alias("venue_id"), "pattern")
    turned = R.contains_pattern(v.select("venue_id", F.col("pattern").alias("longer")), forms.select(F.monotonically_increasing_id().alias("series_id"), F.col("form").alias("pattern")), "longer")
    turned = turned.select(F.col("pattern").alias("form"), "venue_id", F.col("longer").alias("pattern"))
    named = inside.unionByName(turned).distinct().select("form", "venue_id", F.when(F.col("form") == F.col("pattern"), 3).otherwise(2).alias("arm"))
    by_name = n.join(named, "form").select("name", "host", "venue_id", "arm")
    empty = n.filter("form = ''").join(v.filter("pattern = ''"), F.col("form") == F.col("pattern")).select("name", "host", "venue_id", F.lit(3).alias("arm"))
    by_host = n.join(v, n["host"] == v["vhost"]).select("name", "host", "venue_id", F.lit(1).alias("arm"))
    return by_name.unionByName(empty).unionByName(by_host).groupBy("name", "host", "venue_id").agg(F.max("arm").alias("arm"))


_ASCII = "trim(regexp_replace(lower({0}), '[^a-z0-9 ]', '', 'g'))"


@query(f"""WITH t AS (SELECT DISTINCT {_ASCII.format('headliner')} AS l FROM prekindle_event WHERE headliner IS NOT NULL), c AS (SELECT DISTINCT id, {_ASCII.format('n')} AS r FROM (SELECT id, name AS n FROM artist UNION ALL SELECT id, unnest(aliases) FROM artist)),
p AS (SELECT l, id, max(CASE WHEN l = r THEN 1.0::DOUBLE ELSE 1 - levenshtein(l, r)::DOUBLE / greatest(length(l), length(r)) END) AS score FROM t, c WHERE l <> '' AND r <> '' AND abs(length(l) - length(r)) <= 0.2 * greatest(length(l), length(r)) + 1e-9 GROUP BY ALL),
b AS (SELECT *, row_number() OVER (PARTITION BY l ORDER BY score DESC, id) AS n FROM p WHERE score >= 0.8 - 1e-12)
SELECT e.id, 'headliner' AS role, 1 AS billing_order, b.id AS artist_id, round(score, 6) AS score FROM prekindle_event e JOIN b ON {_ASCII.format('e.headliner')} = b.l AND n = 1""")
def lineup_artists(spark, root):
    """Slots of a line-up matched to the catalogue by the same score as titles, without reading a title."""
    form = lambda c: F.trim(F.regexp_replace(F.lower(c), r"[^a-z0-9 ]", ""))
    slots = table(spark, root, "prekindle_event").filter("headliner is not null").select("id", F.lit("headliner").alias("role"), F.lit(1).alias("billing_order"), form("headliner").alias("l"))
    a = table(spark, root, "artist")
    names = a.select("id", "name").union(a.select("id", F.explode("aliases"))).select(F.col("id").alias("artist_id"), form("name").alias("r")).distinct()
    pairs = fuzzy.similar_pairs(slots, names.select("r"), 0.80)
    best = fuzzy.best_two(pairs.join(broadcast_if_small(names), "r"), "l", "artist_id").select("l", "artist_id", F.round("score", 6).alias("score"))
    return slots.join(best, "l").select("id", "role", "billing_order", "artist_id", "score")


@query(f"""WITH v AS (SELECT id, name, {_HOST.format('website_url')} AS site FROM venue) SELECT id, coalesce(site, id) AS identity FROM v QUALIFY row_number() OVER (PARTITION BY coalesce(site, id) ORDER BY id) = 1""")
def venue_identities(spark, root):
    """One venue for each identity over sites: that of its group, its own where it has none."""
    v = table(spark, root, "venue").withColumn("identity", F.coalesce(C.url_host("website_url"), "id"))
    return R.first_wins(v, ["identity"], "id").select("id", "identity")


@query("""SELECT a.id, b.id AS sibling FROM venue a JOIN venue b ON a.city = b.city AND split_part(a.name, ' ', 2) = split_part(b.name, ' ', 2) AND a.id <> b.id AND split_part(a.name, ' ', 2) <> ''""")
def group_siblings(spark, root):
    """Venues of one group: a self-join on a nullable key."""
    v = table(spark, root, "venue").select("id", "city", F.nullif(F.split_part("name", F.lit(" "), F.lit(2)), F.lit("")).alias("grp"))
    other = v.withColumnRenamed("id", "sibling")
    return v.join(other, ["city", "grp"]).filter("id <> sibling").select("id", "sibling")


@query("SELECT id, len(l) AS n, array_to_string(l, ',') AS genres FROM (SELECT a.id, list(g ORDER BY g) AS l FROM (SELECT id, unnest(genres) AS g FROM artist) a GROUP BY a.id)")
def listed_categories(spark, root):
    """Entities joined over a bridge to their categories, as a list."""
    bridge = table(spark, root, "artist").select("id", F.explode("genres").alias("g"))
    dim = bridge.select(F.col("g").alias("name")).distinct()
    out = bridge.join(broadcast_if_small(dim), bridge["g"] == dim["name"]).groupBy("id").agg(F.array_sort(F.collect_list("name")).alias("l"))
    return out.select("id", F.size("l").cast("bigint").alias("n"), F.array_join("l", ",").alias("genres"))


_DEFAULTS = [("tec", "music"), ("seatengine", "comedy"), ("spotapps", "food"), ("prekindle", "music")]


@query(f"SELECT v.id, coalesce(c, 'general') AS category FROM venue_event_sources v LEFT JOIN (VALUES {', '.join(f'{d}' for d in _DEFAULTS)}) d(p, c) ON v.platform_type = d.p")
def default_categories(spark, root):
    """A source's category by its platform, and one for the rest: a left join on a small dimension."""
    dim = spark.createDataFrame(_DEFAULTS, "p string, c string")
    return R.embed(table(spark, root, "venue_event_sources"), dim, "platform_type", "p", {"c": "c"}).select("id", F.coalesce("c", F.lit("general")).alias("category"))


_HITS = "len(list_filter(string_split(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g'), ' '), lambda w: w IN ('fiddle', 'waltzes', 'patio')))"


@query(f"""WITH w AS (SELECT doc_id AS id, row_number() OVER (ORDER BY {_HITS} DESC, doc_id) AS rank FROM documents WHERE {_HITS} > 0 QUALIFY rank <= 100),
q AS (SELECT embedding AS q FROM embeddings WHERE vec_id = 0), s AS (SELECT vec_id AS id, round(list_cosine_similarity(list_transform(embedding, lambda x: x::DOUBLE), list_transform(q, lambda x: x::DOUBLE)), 4) AS c FROM embeddings, q),
v AS (SELECT id, row_number() OVER (ORDER BY c DESC, id) AS rank FROM s QUALIFY rank <= 100), f AS (SELECT id, round(sum(1 / (60 + rank)), 8) AS score FROM (FROM w UNION ALL FROM v) GROUP BY id)
SELECT id, score, row_number() OVER (ORDER BY score DESC, id) AS rank FROM f QUALIFY rank <= 50""")
def hybrid_search(spark, root):
    """Keyword and vector hits of one question as one list: the best 50 of the best 100 of each."""
    words = F.split(F.regexp_replace(F.lower("text"), "[^a-z0-9]+", " "), " ")
    hits = table(spark, root, "documents").select(F.col("doc_id").alias("id"), F.size(F.filter(words, lambda w: w.isin("fiddle", "waltzes", "patio"))).alias("hits")).filter("hits > 0")
    top = hits.orderBy(F.desc("hits"), "id").limit(100)
    by_word = top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("hits"), "id")))
    e = table(spark, root, "embeddings")
    by_vector = search.cosine_top_k(e, e.filter("vec_id = 0"), 100).select(F.col("vec_id").alias("id"), "rank")
    return search.fused([by_word, by_vector], 50)


# --- aggregates, order, sets ------------------------------------------------------------
@query("""SELECT source_id, bool_or(confidence < 0.3) AS doubtful, max(confidence) AS surest, string_agg(DISTINCT source_partner, ',' ORDER BY source_partner) AS notes FROM partner_event GROUP BY source_id""")
def merged_verdicts(spark, root):
    """Verdicts on one thing folded: any, most, and all that was noted."""
    agg = table(spark, root, "partner_event").groupBy("source_id").agg(F.bool_or(F.col("confidence") < 0.3).alias("doubtful"), F.max("confidence").alias("surest"), F.array_sort(F.collect_set("source_partner")).alias("x"))
    return agg.select("source_id", "doubtful", "surest", F.when(F.size("x") > 0, F.array_join("x", ",")).alias("notes"))


@query(f"""WITH {L}, c AS (SELECT _ord, source_id, s, row_number() OVER (PARTITION BY source_id ORDER BY _ord) AS n FROM listings) SELECT source_id, _ord, s, row_number() OVER (PARTITION BY source_id ORDER BY s NULLS LAST, _ord) AS place FROM c WHERE n <= 40""")
def capped_then_sorted(spark, root):
    """The first 40 rows of a source as they came, then in order of start: not the 40 earliest."""
    first = R.top_k(listings(spark, root), ["source_id"], 40, F.col("_ord")).drop("rank")
    return first.select("source_id", "_ord", "s", F.row_number().over(Window.partitionBy("source_id").orderBy(F.asc_nulls_last("s"), "_ord")).alias("place"))


@query("SELECT venue_id, id FROM venue_event_sources WHERE is_enabled AND venue_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY venue_id ORDER BY created_at NULLS LAST, id) = 1")
def oldest_enabled(spark, root):
    s = table(spark, root, "venue_event_sources").filter("is_enabled and venue_id is not null")
    return R.top_k(s, ["venue_id"], 1, F.asc_nulls_last("created_at"), F.col("id")).select("venue_id", "id")


@query(f"""SELECT id, 'upcoming' AS part FROM existing_event WHERE epoch(starts_at) >= {AS_OF_S} UNION ALL SELECT id, 'past' FROM existing_event WHERE epoch(starts_at) < {AS_OF_S} AND epoch(starts_at) >= {AS_OF_S} - 30 * 86400""")
def upcoming_and_past(spark, root):
    e = table(spark, root, "existing_event")
    past = R.within_grace(e.filter(F.col("starts_at") < as_of()), as_of(), 30 * 24)
    return e.filter(F.col("starts_at") >= as_of()).select("id", F.lit("upcoming").alias("part")).unionByName(past.select("id", F.lit("past").alias("part")))


@query("""SELECT kept, count(*) AS n FROM (SELECT _ord, row_number() OVER (PARTITION BY source_id, source_event_id ORDER BY _ord) = 1 OR source_event_id IS NULL AS kept FROM partner_event) GROUP BY kept""")
def survivors_and_dropped(spark, root):
    """Rows parted in two by one pass, counted."""
    n = F.row_number().over(Window.partitionBy("source_id", "source_event_id").orderBy("_ord"))
    return table(spark, root, "partner_event").withColumn("kept", (n == 1) | F.col("source_event_id").isNull()).groupBy("kept").agg(F.count("*").alias("n"))


@query("SELECT _ord, extracted_band_name FROM enriched_partner_event WHERE artist_match_status IS DISTINCT FROM 'matched'")
def pending_queue(spark, root):
    return table(spark, root, "enriched_partner_event").filter(~F.col("artist_match_status").eqNullSafe(F.lit("matched"))).select("_ord", "extracted_band_name")


# --- sinks ------------------------------------------------------------------------------
@query("""SELECT venue_id, source_event_id, _ord, 'pending' AS review_status FROM partner_event p WHERE venue_id IS NOT NULL AND source_event_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM existing_event e WHERE e.venue_id = p.venue_id AND e.source_event_id = p.source_event_id)
QUALIFY row_number() OVER (PARTITION BY venue_id, source_event_id ORDER BY _ord) = 1""")
def staged_rows(spark, root):
    """Rows appended as pending to a folder and read back: none that stands already, none twice."""
    rows = table(spark, root, "partner_event").filter("venue_id is not null and source_event_id is not null").select("venue_id", "source_event_id", "_ord")
    held = table(spark, root, "existing_event").filter("venue_id is not null and source_event_id is not null")
    return written(sinks.staged(held, rows, ["venue_id", "source_event_id"], "_ord"), "staged")


@query("""WITH h AS (SELECT id, venue_id, CASE WHEN kind = 'ingested' THEN 'pending' ELSE 'approved' END AS review_status FROM existing_event), i AS (SELECT 'new-' || min(_ord) AS id, venue_id FROM partner_event WHERE venue_id IS NOT NULL AND batch_no = 3 GROUP BY venue_id)
SELECT id, venue_id, CASE WHEN review_status = 'pending' AND venue_id IN (SELECT venue_id FROM i) THEN 'rejected' ELSE review_status END AS review_status FROM h UNION ALL SELECT id, venue_id, 'pending' FROM i""")
def pending_replaced(spark, root):
    h = table(spark, root, "existing_event").select("id", "venue_id", F.when(F.col("kind") == "ingested", "pending").otherwise("approved").alias("review_status"))
    i = table(spark, root, "partner_event").filter("venue_id is not null and batch_no = 3").groupBy("venue_id").agg(F.concat(F.lit("new-"), F.min("_ord").cast("string")).alias("id"))
    return sinks.replaced_pending(h, i.select("id", "venue_id"), "venue_id").select("id", "venue_id", "review_status")


_HELD = "SELECT venue_id, source_event_id, min(title) AS title, CASE min(kind) WHEN 'event' THEN 'approved' ELSE CASE WHEN length(min(id)) % 2 = 0 AND min(id) < '8' THEN 'pending' ELSE 'rejected' END END AS review_status FROM existing_event WHERE venue_id IS NOT NULL AND source_event_id IS NOT NULL GROUP BY ALL"


@query(f"""WITH h AS ({_HELD}), i AS (SELECT venue_id, source_event_id, min(title) AS title FROM partner_event WHERE venue_id IS NOT NULL AND source_event_id IS NOT NULL GROUP BY ALL)
SELECT coalesce(h.venue_id, i.venue_id) AS venue_id, coalesce(h.source_event_id, i.source_event_id) AS source_event_id,
 CASE WHEN h.venue_id IS NULL THEN 'insert' WHEN i.venue_id IS NULL THEN 'keep' WHEN review_status = 'pending' THEN 'refresh' WHEN review_status = 'rejected' THEN 'revive' ELSE 'skip' END AS done,
 CASE WHEN done IN ('insert', 'refresh', 'revive') THEN i.title ELSE h.title END AS title, CASE WHEN done IN ('insert', 'refresh', 'revive') THEN 'pending' ELSE review_status END AS review_status
FROM h FULL OUTER JOIN i ON h.venue_id = i.venue_id AND h.source_event_id = i.source_event_id""")
def upserted_by_status(spark, root):
    e = table(spark, root, "existing_event").filter("venue_id is not null and source_event_id is not null")
    held = e.groupBy("venue_id", "source_event_id").agg(F.min("title").alias("title"), F.min("kind").alias("kind"), F.min("id").alias("id"))
    status = F.when(F.col("kind") == "event", "approved").when((F.length("id") % 2 == 0) & (F.col("id") < "8"), "pending").otherwise("rejected")
    p = table(spark, root, "partner_event").filter("venue_id is not null and source_event_id is not null")
    sides = sinks.upsert_sides(held.select("venue_id", "source_event_id", "title", status.alias("review_status")), p.groupBy("venue_id", "source_event_id").agg(F.min("title").alias("title")))
    return sinks.upserted_by_status(*sides, ["venue_id", "source_event_id"], ["title"])


@query("SELECT slug, min(id) AS id FROM (SELECT slug, id FROM venue WHERE slug IS NOT NULL UNION ALL SELECT DISTINCT rtrim(left(trim(regexp_replace(lower(venue_name), '[^a-z0-9]+', '-', 'g'), '-'), 80), '-'), 'new' FROM partner_event WHERE trim(venue_name) <> '') GROUP BY slug")
def dimension_ensured(spark, root):
    v = table(spark, root, "venue").filter("slug is not null").select("slug", "id")
    new = table(spark, root, "partner_event").filter("trim(venue_name) <> ''").select(C.slugify("venue_name").alias("slug"), F.lit("new").alias("id")).distinct()
    return sinks.ensured(v, new, "slug", "id")


@query("""SELECT _ord, CASE WHEN _ord IN (SELECT _ord FROM enriched_partner_event WHERE artist_match_status = 'matched') THEN 'rejected' ELSE 'pending' END AS review_status FROM partner_event""")
def marked_by_ids(spark, root):
    """A status set for a list of ids of any length in one pass."""
    ids = table(spark, root, "enriched_partner_event").filter("artist_match_status = 'matched'").select("_ord")
    return sinks.marked(table(spark, root, "partner_event").select("_ord", F.lit("pending").alias("review_status")), ids, "_ord", "review_status", F.lit("rejected"))


@query(f"""WITH n AS (SELECT headliner AS name, min(id) AS id FROM prekindle_event WHERE headliner IS NOT NULL GROUP BY 1), f AS (SELECT *, {NORM.format('name')} AS form FROM n)
SELECT name, form FROM f WHERE form <> '' AND form NOT IN (SELECT {NORM.format('name')} FROM artist) AND form NOT IN (SELECT {NORM.format('a')} FROM (SELECT unnest(aliases) AS a FROM artist)) QUALIFY row_number() OVER (PARTITION BY form ORDER BY id, name) = 1 ORDER BY id, form LIMIT 25""")
def seeded_artists(spark, root):
    """Names for the catalogue, of names and aliases that it lacks; a run adds 25 at most."""
    n = table(spark, root, "prekindle_event").filter("headliner is not null").groupBy(F.col("headliner").alias("name")).agg(F.min("id").alias("id"))
    a = table(spark, root, "artist")
    known = [a.select(C.normalize_title("name").alias("form")), a.select(F.explode("aliases").alias("x")).select(C.normalize_title("x").alias("form"))]
    return sinks.seeded(n, known, "name", C.normalize_title("name"), "id", 25).select("name", "form")


@query("SELECT id, name, city FROM venue")
def json_rows(spark, root):
    """Written as JSON and read back."""
    path = new_folder(spark, "json")
    sinks.write_json(table(spark, root, "venue").select("id", "name", "city"), path)
    return spark.read.schema("id string, name string, city string").json(path)


# --- functions for SQL, sources, streams ---------------------------------------------------
@query("SELECT doc_id, length(regexp_replace(text, '\\s', '', 'g')) AS n FROM documents WHERE trim(text) <> ''")
def chunk_function(spark, root):
    """Table functions in SQL: chunks of all documents lose no character but blanks."""
    surface.register(spark)
    table(spark, root, "documents").filter("trim(text) <> ''").createOrReplaceTempView("sg_documents")
    return spark.sql("SELECT doc_id, sum(length(regexp_replace(chunk, '\\\\s', ''))) AS n FROM sg_documents, LATERAL chunk_text(text, 2000) GROUP BY doc_id")


@query("SELECT _ord, title, source_id FROM partner_event WHERE source_partner = 'tec' AND batch_no IN (1, 2, 3) AND _ord > 10")
def pushed_scan(spark, root):
    """Equality and membership go to the file reader, the rest stays with Spark."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(landed.Listings)
    schema = "_ord long, title string, source_id string, source_partner string, batch_no int"
    return spark.read.format("listings").schema(schema).option("path", f"{root}/partner_event.parquet").load().filter("source_partner = 'tec' and batch_no in (1, 2, 3) and _ord > 10").select("_ord", "title", "source_id")


@query(f"SELECT coalesce(venue_id, '') AS venue, coalesce({NORM.format('title')}, '') AS form, min(_ord) AS first_ord, count(*) AS n, max(confidence) AS best FROM partner_event GROUP BY ALL")
def stateful_shows(spark, root):
    """The merge as a stream over all listings until none is left."""
    path, marks = new_folder(spark, "shows"), new_folder(spark, "stream")
    source = table(spark, root, "partner_event")
    landing = new_folder(spark, "arrivals")
    source.select("_ord", "venue_id", "title", "confidence").write.parquet(landing)
    stream = spark.readStream.schema("_ord long, venue_id string, title string, confidence double").parquet(landing)
    shows = stateful.merged_shows(stream.select(F.col("venue_id").alias("venue"), C.normalize_title("title").alias("form"), F.col("_ord").alias("ord"), "confidence"))
    # a batch that is handed over again is written over
    q = shows.writeStream.outputMode("update").foreachBatch(lambda b, n: b.withColumn("batch", F.lit(n)).write.mode("overwrite").parquet(f"{path}/arrived={n}")).option("checkpointLocation", marks).trigger(availableNow=True).start()
    q.awaitTermination()
    latest = spark.read.parquet(path).groupBy("venue", "form").agg(F.max_by(F.struct("first_ord", "n", "best"), "batch").alias("x"))
    return latest.select("venue", "form", "x.*")


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
