"""The relational core on the test tables, each query beside the SQL it is checked with."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from showgrain.functions import columns as C
from showgrain.functions import times as X
from showgrain.operators import dedup, fuzzy, generate, merge, timestamps
from showgrain.operators import relational as R
from showgrain.plans.startsql import STARTS
from showgrain.session import broadcast_if_small, table, written

AS_OF = "2026-10-15 00:00:00"

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def as_of() -> Column:
    return F.lit(AS_OF).cast("timestamp")


def listings(spark: SparkSession, root: str) -> DataFrame:
    """All partner_event rows with an id, with ``start`` (timestamp) and ``s`` (seconds), however the start is written; null where none can be told."""
    df = table(spark, root, "partner_event").filter("_ord is not null")
    told = timestamps.starts(df, table(spark, root, "venue_event_sources")).groupBy("_ord").agg(F.min("instant").alias("s"))
    return df.join(told, "_ord", "left").withColumn("start", F.timestamp_seconds("s"))


#: ``listings`` in SQL, as CTE bodies.
L = STARTS.strip() + ",\nlistings AS (SELECT p.*, told.s FROM partner_event p LEFT JOIN told USING (_ord))"
NORM = "trim(regexp_replace(regexp_replace(lower({0}), '[^a-z0-9 ]', '', 'g'), ' +', ' ', 'g'))"
AS_OF_S = f"epoch(TIMESTAMP '{AS_OF}')::BIGINT"


# --- filters and projections --------------------------------------------------------
@query(f"""WITH {L} SELECT e._ord, e.s AS start_s FROM listings e JOIN venue_event_sources v ON e.source_id = v.id
WHERE trim(e.title) <> '' AND e.s <= {AS_OF_S} + v.scrape_days_ahead * 86400
  AND (e.s >= {AS_OF_S} - 86400 OR coalesce(epoch(e.ends_at) > {AS_OF_S}, false))""")
def window_valid(spark, root):
    df = R.embed(listings(spark, root), table(spark, root, "venue_event_sources"), "source_id", "id", {"days": "scrape_days_ahead"}, "inner")
    return R.valid_events(df, as_of(), F.col("days"), "start").select("_ord", F.col("s").alias("start_s"))


@query(f"WITH {L} SELECT _ord, s AS start_s FROM listings WHERE s >= {AS_OF_S} - 6 * 3600")
def window_grace(spark, root):
    return R.within_grace(listings(spark, root), as_of(), 6, "start").select("_ord", F.col("s").alias("start_s"))


@query("""SELECT _ord, trim(regexp_replace(title, '[ \\t\\n\\r]+', ' ', 'g')) AS title, coalesce(nullif(trim(raw_date_text), ''), starts_at) AS raw_date_text,
  coalesce(confidence, 1.0) AS confidence, nullif(trim(ticket_url), '') AS ticket_url FROM partner_event WHERE title IS NOT NULL""")
def normalised_projection(spark, root):
    return table(spark, root, "partner_event").filter("title is not null").select(
        "_ord",
        F.trim(F.regexp_replace("title", "[ \\t\\n\\r]+", " ")).alias("title"),
        F.coalesce(F.nullif(F.trim("raw_date_text"), F.lit("")), "starts_at").alias("raw_date_text"),
        F.coalesce("confidence", F.lit(1.0)).alias("confidence"),
        F.nullif(F.trim("ticket_url"), F.lit("")).alias("ticket_url"),
    )


@query("SELECT _ord, title FROM partner_event WHERE title IS NOT NULL AND NOT regexp_matches(lower(title), '^(private event|closed|tba|tbd|test)|cancel+ed')")
def noise_titles(spark, root):
    return table(spark, root, "partner_event").filter("title is not null").filter(~F.lower("title").rlike(r"^(private event|closed|tba|tbd|test)|cancel+ed")).select("_ord", "title")


@query("""SELECT id, platform_type, CASE WHEN platform_type IN ('tec', 'seatengine', 'prekindle') THEN 'api' WHEN feed_url IS NOT NULL AND feed_url LIKE '%.ics' THEN 'ics'
  WHEN calendar_url ILIKE '%calendar%' THEN 'page' ELSE 'unknown' END AS reader FROM venue_event_sources WHERE is_enabled""")
def source_reader(spark, root):
    reader = F.when(F.col("platform_type").isin("tec", "seatengine", "prekindle"), "api").when(F.col("feed_url").like("%.ics"), "ics").when(F.col("calendar_url").ilike("%calendar%"), "page").otherwise("unknown")
    return table(spark, root, "venue_event_sources").filter("is_enabled").select("id", "platform_type", reader.alias("reader"))


# --- scalar functions ---------------------------------------------------------------
@query(f"SELECT _ord, {NORM.format('title')} AS form FROM partner_event WHERE title IS NOT NULL")
def normalize_title(spark, root):
    return table(spark, root, "partner_event").filter("title is not null").select("_ord", C.normalize_title("title").alias("form"))


_TK = """CASE WHEN trim(ticket_url) <> '' THEN concat_ws('?', regexp_replace(split_part({u}, '?', 1), '/+$', ''),
  nullif(list_aggregate(list_sort(list_filter(string_split(CASE WHEN contains({u}, '?') THEN regexp_replace({u}, '^[^?]*\\?', '') ELSE '' END, '&'),
  lambda p: regexp_matches(p, '^(itemnumber|item_number|eventid|event_id|event|id|performanceid)='))), 'string_agg', '&'), '')) END""".replace(
    "{u}", "regexp_replace(regexp_replace(lower(trim(ticket_url)), '^[a-z]+://(www\\.)?', ''), '#.*$', '')"
)


@query(f"SELECT _ord, {_TK} AS ticket FROM partner_event")
def ticket_key(spark, root):
    return table(spark, root, "partner_event").select("_ord", C.ticket_key("ticket_url").alias("ticket"))


@query(f"""WITH {L} SELECT _ord, concat_ws('|', {NORM.format('title')}, {NORM.format('venue_name')}, strftime(make_timestamp(s * 1000000), '%Y-%m-%dT%H:%M'), {_TK}) AS fp FROM listings WHERE title IS NOT NULL""")
def fingerprint(spark, root):
    return listings(spark, root).filter("title is not null").select("_ord", C.fingerprint("title", "venue_name", "start", "ticket_url").alias("fp"))


@query("""SELECT doc_id, rtrim(left(trim(regexp_replace(lower(translate(text, 'áàâäãåāçčéèêëēíìîïīñóòôöõøōúùûüūýÿšžÁÀÂÄÃÅĀÇČÉÈÊËĒÍÌÎÏĪÑÓÒÔÖÕØŌÚÙÛÜŪÝŠŽ',
 'aaaaaaacceeeeeiiiiinooooooouuuuuyyszAAAAAAACCEEEEEIIIIINOOOOOOOUUUUUYSZ')), '[^a-z0-9]+', '-', 'g'), '-'), 80), '-') AS slug FROM documents WHERE text IS NOT NULL""")
def slugify(spark, root):
    return table(spark, root, "documents").filter("text is not null").select("doc_id", C.slugify("text", 80).alias("slug"))


@query("""SELECT _ord, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(description, '<(script|style)\\b.*?</(script|style)\\s*>', ' ', 'gis'), '<!--.*?-->', ' ', 'gs'), '<[a-zA-Z/!][^>]*>', ' ', 'g'), '[ \\t\\n\\r]+', ' ', 'g')) AS plain
FROM partner_event WHERE description IS NOT NULL""")
def strip_html(spark, root):
    df = table(spark, root, "partner_event").filter("description is not null")
    return df.select("_ord", C.strip_html("description").alias("plain"))


@query("""SELECT doc_id, CASE WHEN t = '' THEN 0 ELSE len(string_split(t, ' ')) END AS n_words, CASE WHEN t = '' THEN true ELSE len(string_split(t, ' ')) < 50 END AS thin
FROM (SELECT doc_id, trim(regexp_replace(text, '[ \\t\\n\\r\\f\\v]+', ' ', 'g')) AS t FROM documents WHERE text IS NOT NULL)""")
def word_count(spark, root):
    n = C.word_count("text")
    return table(spark, root, "documents").filter("text is not null").select("doc_id", n.alias("n_words"), (n < 50).alias("thin"))


@query("""SELECT _ord, nullif(regexp_extract(lower(trim(source_url)), '^[a-z]+://(?:www\\.)?([^/?#:]+)', 1), '') AS host,
  nullif(regexp_extract(youtube_embed, '(?:embed/|watch\\?v=|youtu\\.be/|/v/)([A-Za-z0-9_-]{3,})', 1), '') AS video FROM partner_event""")
def link_parts(spark, root):
    return table(spark, root, "partner_event").select("_ord", C.url_host("source_url").alias("host"), C.video_id("youtube_embed").alias("video"))


@query(f"""WITH {L} SELECT _ord, round(coalesce(confidence, 0) * 10 + CASE WHEN trim(ticket_url) <> '' THEN 5 ELSE 0 END + CASE WHEN trim(image_url) <> '' THEN 2 ELSE 0 END
 + CASE WHEN trim(description) <> '' THEN 1 ELSE 0 END + CASE WHEN (s % 86400) // 3600 <> 0 THEN 3 ELSE 0 END, 6) AS preference FROM listings""")
def preference_score(spark, root):
    return listings(spark, root).select("_ord", F.round(C.preference("confidence", "ticket_url", "image_url", "description", "start"), 6).alias("preference"))


@query("""SELECT id, list_reduce(list_prepend(0::BIGINT, list_transform(list_filter(string_split(slug, ''), lambda x: x <> ''), lambda x: ascii(x)::BIGINT)), lambda h, x: (h * 31 + x) % 4294967296) AS h,
 sha256(slug) AS digest FROM venue WHERE slug IS NOT NULL""")
def hash_pick(spark, root):
    return table(spark, root, "venue").filter("slug is not null").select("id", C.poly_hash("slug").alias("h"), F.sha2("slug", 256).alias("digest"))


# --- dates --------------------------------------------------------------------------
@query("""SELECT id, CASE WHEN regexp_matches(lower(show_time), '(\\d{1,2})(:(\\d{2}))?\\s*[ap]') THEN
 (regexp_extract(lower(show_time), '(\\d{1,2})(:(\\d{2}))?\\s*([ap])', 1)::INT % 12) * 60 + coalesce(try_cast(nullif(regexp_extract(lower(show_time), '(\\d{1,2})(:(\\d{2}))?\\s*([ap])', 3), '') AS INT), 0)
 + CASE WHEN regexp_extract(lower(show_time), '(\\d{1,2})(:(\\d{2}))?\\s*([ap])', 4) = 'p' THEN 720 ELSE 0 END END AS minutes FROM prekindle_event""")
def clock_parse(spark, root):
    return table(spark, root, "prekindle_event").select("id", X.parse_clock("show_time").alias("minutes"))


@query("""SELECT id, epoch(timezone('America/Chicago', make_timestamp(epoch_us(accepted_at))))::BIGINT AS utc_s FROM existing_event WHERE accepted_at IS NOT NULL""")
def wall_to_utc(spark, root):
    return table(spark, root, "existing_event").filter("accepted_at is not null").select("id", F.unix_timestamp(X.wall_to_utc("accepted_at", F.lit("America/Chicago"))).alias("utc_s"))


@query("""WITH d AS (SELECT id, split_part(show_date, '/', 1)::INT AS m, split_part(show_date, '/', 2)::INT AS d FROM prekindle_event WHERE regexp_matches(show_date, '^\\d+/\\d+/\\d+$'))
SELECT id, strftime(CASE WHEN try_cast(printf('2026-%02d-%02d', m, d) AS DATE) >= DATE '2026-10-15' - 30 THEN try_cast(printf('2026-%02d-%02d', m, d) AS DATE)
 ELSE try_cast(printf('2027-%02d-%02d', m, d) AS DATE) END, '%Y-%m-%d') AS on_date FROM d""")
def year_inference(spark, root):
    df = table(spark, root, "prekindle_event").filter(F.col("show_date").rlike(r"^\d+/\d+/\d+$"))
    m, d = F.split_part("show_date", F.lit("/"), F.lit(1)), F.split_part("show_date", F.lit("/"), F.lit(2))
    return df.select("id", F.date_format(X.infer_year(m, d, as_of(), 30), "yyyy-MM-dd").alias("on_date"))


@query("""SELECT _ord, CASE WHEN regexp_matches(starts_at, '^\\d{13}$') THEN starts_at::BIGINT // 1000 WHEN regexp_matches(starts_at, '^\\d{10}$') THEN starts_at::BIGINT END AS s
FROM partner_event WHERE regexp_matches(starts_at, '^(\\d{13}|\\d{10})$')""")
def epoch_starts(spark, root):
    return table(spark, root, "partner_event").filter(F.col("starts_at").rlike(r"^(\d{13}|\d{10})$")).select("_ord", F.unix_timestamp(X.epoch_or_iso("starts_at")).alias("s"))


@query("""SELECT _ord, epoch(CASE WHEN length(starts_at) = 8 THEN strptime(starts_at, '%Y%m%d') ELSE strptime(substr(starts_at, 1, 15), '%Y%m%dT%H%M%S') END)::BIGINT AS s
FROM partner_event WHERE regexp_matches(starts_at, '^\\d{8}(T\\d{6}Z?)?$')""")
def ics_dates(spark, root):
    return table(spark, root, "partner_event").filter(F.col("starts_at").rlike(r"^\d{8}(T\d{6}Z?)?$")).select("_ord", F.unix_timestamp(X.ics_instant("starts_at")).alias("s"))


# --- joins --------------------------------------------------------------------------
@query("""WITH enabled AS (SELECT s.id, s.venue_id, v.name FROM venue_event_sources s JOIN venue v ON s.venue_id = v.id WHERE s.is_enabled AND v.status = 'published'),
legacy AS (SELECT NULL AS id, id AS venue_id, name FROM venue WHERE website_url IS NOT NULL)
SELECT * FROM enabled UNION ALL SELECT * FROM legacy WHERE NOT EXISTS (SELECT 1 FROM enabled)""")
def enabled_sources(spark, root):
    venues = table(spark, root, "venue")
    found = R.embed(table(spark, root, "venue_event_sources").filter("is_enabled"), venues.filter("status = 'published'"), "venue_id", "id", {"name": "name"}, "inner").select("id", "venue_id", "name")
    legacy = venues.filter("website_url is not null").select(F.lit(None).cast("string").alias("id"), F.col("id").alias("venue_id"), "name")
    return R.with_fallback(found, legacy)


@query("""SELECT p._ord, p.source_event_id FROM partner_event p WHERE p.source_event_id IS NOT NULL AND p.venue_id IS NOT NULL
 AND NOT EXISTS (SELECT 1 FROM existing_event e WHERE e.venue_id = p.venue_id AND e.source_event_id = p.source_event_id)""")
def known_ids_out(spark, root):
    df = table(spark, root, "partner_event").filter("source_event_id is not null and venue_id is not null")
    return R.without_known(df, table(spark, root, "existing_event"), ["venue_id", "source_event_id"]).select("_ord", "source_event_id")


def _keys(df: DataFrame, ident: str) -> DataFrame:
    """What rows are recognised by; rows without a title have no title form."""
    more = [F.col("kind")] if "kind" in df.columns else [F.col("confidence")]
    return df.select(
        ident, F.col("venue_id").alias("venue"), F.nullif(F.trim("source_event_id"), F.lit("")).alias("sid"), C.normalize_title("title").alias("form"), F.unix_timestamp("start").alias("start"),
        C.ticket_key("ticket_url").alias("ticket"), F.nullif(F.trim("fingerprint"), F.lit("")).alias("fingerprint"), *more,
    )


def _sides(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    new = _keys(listings(spark, root), "_ord").withColumnRenamed("_ord", "ord")
    return new, _keys(table(spark, root, "existing_event").withColumn("start", F.col("starts_at")), "id")


_SIDES = f"""n AS (SELECT _ord AS ord, venue_id AS venue, nullif(trim(source_event_id), '') AS sid, {NORM.format('title')} AS form, s, {_TK} AS ticket, nullif(trim(fingerprint), '') AS fp, confidence FROM listings),
k AS (SELECT id, kind, venue_id AS venue, nullif(trim(source_event_id), '') AS sid, {NORM.format('title')} AS form, epoch(starts_at)::BIGINT AS s, {_TK} AS ticket, nullif(trim(fingerprint), '') AS fp FROM existing_event),
h AS (SELECT ord, k.kind, k.id, 0 AS r, 'source_id' AS by_ FROM n JOIN k USING (venue, sid)
 UNION ALL SELECT ord, k.kind, k.id, 1, 'exact' FROM n JOIN k ON n.venue = k.venue AND (n.fp = k.fp OR n.form = k.form AND (abs(n.s - k.s) <= 64800 OR n.s // 86400 = k.s // 86400))),
stable AS (SELECT ord, id AS known_id, by_ AS matched_by FROM h QUALIFY row_number() OVER (PARTITION BY ord ORDER BY r, kind, id) = 1)"""


@query(f"WITH {L}, {_SIDES} SELECT * FROM stable")
def stable_cascade(spark, root):
    return dedup.cascade(*_sides(spark, root))


@query(f"""WITH {L}, {_SIDES}, p AS (SELECT ord, k.kind, k.id, coalesce(n.ticket, '') = coalesce(k.ticket, '') OR n.ticket IS NULL OR k.ticket IS NULL AS fits,
  CASE WHEN coalesce(n.form, '') = coalesce(k.form, '') THEN 1.0::DOUBLE WHEN coalesce(n.form, '') = '' OR coalesce(k.form, '') = '' THEN 0.0::DOUBLE ELSE 1 - levenshtein(n.form, k.form)::DOUBLE / greatest(length(n.form), length(k.form)) END AS score
  FROM n JOIN k ON n.venue = k.venue AND (abs(n.s - k.s) <= 64800 OR n.s // 86400 = k.s // 86400)),
b AS (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY ord ORDER BY score DESC, kind, id) = 1),
d AS (SELECT n.ord, b.id, b.score, CASE WHEN score >= 0.85 AND fits THEN 'matched_existing' WHEN coalesce(score, -1) >= 0.55 OR coalesce(confidence, 0) < 0.55 THEN 'needs_review' ELSE 'new' END AS status FROM n LEFT JOIN b USING (ord) WHERE ord NOT IN (SELECT ord FROM stable))
SELECT ord, CASE WHEN status <> 'new' THEN id END AS known_id, round(score, 6) AS score, status FROM d""")
def fuzzy_decision(spark, root):
    """What is to be done with rows that no stable key matched."""
    new, known = (written(d, "keys") for d in _sides(spark, root))
    rest = new.join(dedup.cascade(new, known).select("ord"), "ord", "left_anti")
    return dedup.fuzzy_decision(rest, known, C.similarity).withColumn("score", F.round("score", 6))


_ASCII = "trim(regexp_replace(lower({0}), '[^a-z0-9 ]', '', 'g'))"


@query(f"""WITH t AS (SELECT DISTINCT {_ASCII.format('extracted_band_name')} AS l FROM enriched_partner_event WHERE extracted_band_name IS NOT NULL),
c AS (SELECT DISTINCT id, {_ASCII.format('n')} AS r FROM (SELECT id, name AS n FROM artist UNION ALL SELECT id, unnest(aliases) FROM artist)),
p AS (SELECT l, id, max(CASE WHEN l = r THEN 1.0::DOUBLE ELSE 1 - levenshtein(l, r)::DOUBLE / greatest(length(l), length(r)) END) AS score FROM t, c WHERE l <> '' AND r <> '' AND abs(length(l) - length(r)) <= 0.2 * greatest(length(l), length(r)) + 1e-9 GROUP BY ALL),
b AS (SELECT *, row_number() OVER (PARTITION BY l ORDER BY score DESC, id) AS n FROM p WHERE score >= 0.8 - 1e-12),
w AS (SELECT l AS target, max(CASE WHEN n = 1 THEN id END) AS artist_id, max(CASE WHEN n = 1 THEN score END) AS score, coalesce(max(CASE WHEN n = 2 THEN score END), 0) AS second FROM b WHERE n <= 2 GROUP BY l)
SELECT target, artist_id, round(score, 6) AS score, round(second, 6) AS second, CASE WHEN score < 0.8 THEN 'unmatched' WHEN second >= 0.8 AND score - second < 0.05 THEN 'ambiguous' WHEN score < 0.95 THEN 'ambiguous' ELSE 'matched' END AS status FROM w""")
def fuzzy_artists(spark, root):
    form = lambda c: F.trim(F.regexp_replace(F.lower(c), r"[^a-z0-9 ]", ""))
    targets = table(spark, root, "enriched_partner_event").filter("extracted_band_name is not null").select(form("extracted_band_name").alias("l")).distinct()
    a = table(spark, root, "artist")
    names = a.select("id", "name").union(a.select("id", F.explode("aliases"))).select("id", form("name").alias("r")).distinct()
    pairs = fuzzy.similar_pairs(targets, names.select("r"), 0.80)
    hits = pairs.join(broadcast_if_small(names), "r").withColumnsRenamed({"l": "target", "id": "artist_id"})
    out = fuzzy.decided(fuzzy.best_two(hits, "target", "artist_id"))
    return out.select("target", "artist_id", F.round("score", 6).alias("score"), F.round("second", 6).alias("second"), "status")


SERIES = [(1, "open mic night"), (2, "pub trivia"), (3, "poetry slam"), (4, "bluegrass brunch"), (5, "comedy showcase"), (6, "karaoke social"), (7, "songwriter round"), (8, "happy hour sessions"), (9, "swing dance class"), (10, "swing dance")]
_SERIES_SQL = ", ".join(f"({i}, '{p}')" for i, p in SERIES)


@query(f"""WITH s(series_id, pattern) AS (VALUES {_SERIES_SQL}), t AS (SELECT _ord, {NORM.format('title')} AS form FROM partner_event WHERE title IS NOT NULL)
SELECT _ord, series_id, length(pattern) + CASE WHEN starts_with(form, pattern) THEN 20 ELSE 0 END AS score FROM t JOIN s ON contains(form, pattern)
QUALIFY row_number() OVER (PARTITION BY _ord ORDER BY length(pattern) + CASE WHEN starts_with(form, pattern) THEN 20 ELSE 0 END DESC, series_id) = 1""")
def series_contains(spark, root):
    patterns = spark.createDataFrame(SERIES, "series_id int, pattern string")
    t = table(spark, root, "partner_event").filter("title is not null").select("_ord", C.normalize_title("title").alias("form"))
    hits = R.contains_pattern(t, patterns, "form")
    return R.top_k(hits, ["_ord"], 1, F.desc("score"), F.col("series_id")).select("_ord", "series_id", "score")


@query(f"""WITH {L}, n AS (SELECT _ord, venue_id, s, {NORM.format('title')} AS form FROM listings WHERE venue_id IS NOT NULL AND title IS NOT NULL),
k AS (SELECT id, venue_id, epoch(starts_at)::BIGINT AS s2, {NORM.format('title')} AS form2 FROM existing_event WHERE venue_id IS NOT NULL AND title IS NOT NULL),
p AS (SELECT _ord, id, CASE WHEN form = form2 THEN 1.0::DOUBLE WHEN form = '' OR form2 = '' THEN 0.0::DOUBLE ELSE 1 - levenshtein(form, form2)::DOUBLE / greatest(length(form), length(form2)) END AS score
 FROM n JOIN k USING (venue_id) WHERE abs(s - s2) <= 64800 OR s // 86400 = s2 // 86400)
SELECT _ord, id AS existing_id, round(score, 6) AS score, CASE WHEN score >= 0.85 THEN 'matched' WHEN score >= 0.55 THEN 'needs_review' ELSE 'new' END AS status FROM p
QUALIFY row_number() OVER (PARTITION BY _ord ORDER BY score DESC, id) = 1""")
def interval_same_show(spark, root):
    n = listings(spark, root).filter("venue_id is not null and title is not null").select("_ord", "venue_id", "s", C.normalize_title("title").alias("form"))
    k = table(spark, root, "existing_event").filter("venue_id is not null and title is not null").select("id", F.col("venue_id").alias("v2"), F.unix_timestamp("starts_at").alias("s2"), C.normalize_title("title").alias("form2"))
    # both windows reach into the neighbouring UTC days at most: an equi-join on venue and day
    days = n.withColumn("day", F.explode(F.array(*[F.floor(F.col("s") / 86400) + d for d in (-1, 0, 1)])))
    j = days.join(k.withColumn("d2", F.floor(F.col("s2") / 86400)), (F.col("venue_id") == F.col("v2")) & (F.col("day") == F.col("d2")))
    j = j.filter((F.abs(F.col("s") - F.col("s2")) <= 64800) | (F.floor(F.col("s") / 86400) == F.floor(F.col("s2") / 86400)))
    j = j.withColumn("score", C.similarity("form", "form2"))
    best = R.top_k(j, ["_ord"], 1, F.desc("score"), F.col("id"))
    status = F.when(F.col("score") >= 0.85, "matched").when(F.col("score") >= 0.55, "needs_review").otherwise("new")
    return best.select("_ord", F.col("id").alias("existing_id"), F.round("score", 6).alias("score"), status.alias("status"))


_WORDS = "list_distinct(list_filter(string_split(" + NORM + ", ' '), lambda w: length(w) > 2))"


@query(f"""WITH n AS (SELECT DISTINCT venue_name, unnest({_WORDS.format('venue_name')}) AS w FROM partner_event WHERE trim(venue_name) <> ''),
v AS (SELECT id, unnest({_WORDS.format('name')}) AS w FROM venue), h AS (SELECT venue_name, id AS venue_id, count(*) AS n_shared FROM n JOIN v USING (w) GROUP BY ALL HAVING count(*) >= 2)
SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY venue_name ORDER BY n_shared DESC, venue_id) = 1""")
def token_overlap(spark, root):
    venues = table(spark, root, "venue").select(F.col("id").alias("venue_id"), F.col("name").alias("dim_name"))
    return R.token_overlap(table(spark, root, "partner_event"), venues, "venue_name", "venue_id", "dim_name")


@query(f"""WITH {L}, k AS (SELECT *, {NORM.format('title')} || '|' || coalesce((s // 60)::VARCHAR, '') AS key FROM listings WHERE title IS NOT NULL AND venue_id IS NOT NULL),
a AS (SELECT * FROM k WHERE batch_no % 2 = 1 QUALIFY row_number() OVER (PARTITION BY venue_id, key ORDER BY _ord) = 1), b AS (SELECT * FROM k WHERE coalesce(batch_no, 0) % 2 = 0 QUALIFY row_number() OVER (PARTITION BY venue_id, key ORDER BY _ord) = 1)
SELECT coalesce(a.venue_id, b.venue_id) AS venue_id, coalesce(a.key, b.key) AS key, coalesce(a.ticket_url, b.ticket_url) AS ticket_url, coalesce(a.price_text, b.price_text) AS price_text FROM a FULL OUTER JOIN b ON a.venue_id = b.venue_id AND a.key = b.key""")
def outer_merge(spark, root):
    k = listings(spark, root).filter("title is not null and venue_id is not null")
    k = k.withColumn("key", F.concat_ws("|", C.normalize_title("title"), F.coalesce(F.floor(F.col("s") / 60).cast("string"), F.lit(""))))
    # every other batch on one side, so that each row stands on one
    side = lambda odd: R.first_wins(k.filter(F.coalesce("batch_no", F.lit(0)) % 2 == odd), ["venue_id", "key"], "_ord").select("venue_id", "key", "ticket_url", "price_text")
    return R.merged(side(1), side(0), ["venue_id", "key"], ["ticket_url", "price_text"])


@query("""SELECT v.id, v.name FROM venue v WHERE NOT EXISTS (SELECT 1 FROM existing_event e WHERE e.venue_id = v.id AND e.kind = 'event') AND NOT EXISTS (SELECT 1 FROM prekindle_event p WHERE p.venue_id = v.id)""")
def venues_without_shows(spark, root):
    v = table(spark, root, "venue").withColumnRenamed("id", "venue_id")
    events = table(spark, root, "existing_event").filter("kind = 'event'")
    return R.without_known(R.without_known(v, events, ["venue_id"]), table(spark, root, "prekindle_event"), ["venue_id"]).select(F.col("venue_id").alias("id"), "name")


@query("""SELECT a.id FROM venue_event_sources a WHERE EXISTS (SELECT 1 FROM venue_event_sources b JOIN existing_event e ON e.venue_id = b.venue_id
 WHERE regexp_replace(lower(a.calendar_url), '/+$', '') = regexp_replace(lower(b.calendar_url), '/+$', '') AND a.id <> b.id)""")
def sibling_with_shows(spark, root):
    s = table(spark, root, "venue_event_sources").select("id", "venue_id", F.regexp_replace(F.lower("calendar_url"), "/+$", "").alias("url"))
    b = s.join(table(spark, root, "existing_event").select("venue_id").distinct(), "venue_id", "left_semi").select(F.col("id").alias("bid"), F.col("url").alias("burl"))
    return s.join(b, (F.col("url") == F.col("burl")) & (F.col("id") != F.col("bid")), "left_semi").select("id")


@query("""SELECT e._ord, a.name AS artist_name, a.youtube_id FROM enriched_partner_event e LEFT JOIN artist a ON e.matched_artist_id = a.id""")
def hydrated_artists(spark, root):
    return R.embed(table(spark, root, "enriched_partner_event"), table(spark, root, "artist"), "matched_artist_id", "id", {"artist_name": "name", "youtube_id": "youtube_id"}).select("_ord", "artist_name", "youtube_id")


# --- aggregates ---------------------------------------------------------------------
@query("SELECT venue_id, count(*) AS n, count(DISTINCT source_event_id) AS n_ids, min(_ord) AS first_ord, max(_ord) AS last_ord FROM partner_event GROUP BY venue_id")
def count_by_venue(spark, root):
    return table(spark, root, "partner_event").groupBy("venue_id").agg(F.count("*").alias("n"), F.count_distinct("source_event_id").alias("n_ids"), F.min("_ord").alias("first_ord"), F.max("_ord").alias("last_ord"))


@query(f"WITH {L} SELECT source_id, source_event_id, min(s // 86400) AS first_day, max(s // 86400) AS last_day, count(DISTINCT s // 86400) AS n_days FROM listings WHERE source_event_id IS NOT NULL GROUP BY ALL")
def id_day_range(spark, root):
    day = F.floor(F.col("s") / 86400)
    return listings(spark, root).filter("source_event_id is not null").groupBy("source_id", "source_event_id").agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"), F.count_distinct(day).alias("n_days"))


@query("""SELECT venue_id, max(CASE WHEN n = 1 THEN _ord END) AS best_ord, max(CASE WHEN n = 1 THEN confidence END) AS best, max(CASE WHEN n = 2 THEN confidence END) AS second
FROM (SELECT *, row_number() OVER (PARTITION BY venue_id ORDER BY confidence DESC, _ord) AS n FROM partner_event WHERE venue_id IS NOT NULL AND confidence IS NOT NULL) WHERE n <= 2 GROUP BY venue_id""")
def best_and_second(spark, root):
    two = R.top_k(table(spark, root, "partner_event").filter("venue_id is not null and confidence is not null"), ["venue_id"], 2, F.desc("confidence"), F.col("_ord"))
    at = lambda k, c: F.max(F.when(F.col("rank") == k, F.col(c)))
    return two.groupBy("venue_id").agg(at(1, "_ord").alias("best_ord"), at(1, "confidence").alias("best"), at(2, "confidence").alias("second"))


@query("SELECT source_id, max(epoch(fetched_at)::BIGINT) AS last_fetch, bool_or(coalesce(trim(image_url), '') <> '') AS has_images, bool_or(coalesce(trim(ticket_url), '') <> '') AS has_tickets FROM partner_event GROUP BY source_id")
def source_flags(spark, root):
    has = lambda c: F.bool_or(F.coalesce(F.trim(c), F.lit("")) != "")
    return table(spark, root, "partner_event").groupBy("source_id").agg(F.max(F.unix_timestamp("fetched_at")).alias("last_fetch"), has("image_url").alias("has_images"), has("ticket_url").alias("has_tickets"))


@query("""SELECT source_id, source_event_id, arg_min(price_text, _ord) FILTER (trim(price_text) <> '') AS price_text, arg_min(image_url, _ord) FILTER (trim(image_url) <> '') AS image_url
FROM partner_event WHERE source_event_id IS NOT NULL GROUP BY ALL""")
def first_non_null(spark, root):
    df = table(spark, root, "partner_event").filter("source_event_id is not null")
    return R.first_values(df, ["source_id", "source_event_id"], "_ord", ["price_text", "image_url"])


@query("SELECT batch_no, count(*) AS found, count(*) FILTER (source_event_id IS NOT NULL) AS with_id, count(*) FILTER (confidence < 0.55) AS unsure, count(DISTINCT venue_id) AS venues FROM partner_event GROUP BY batch_no")
def run_counters(spark, root):
    return table(spark, root, "partner_event").groupBy("batch_no").agg(F.count("*").alias("found"), F.count_if(F.col("source_event_id").isNotNull()).alias("with_id"), F.count_if(F.col("confidence") < 0.55).alias("unsure"), F.count_distinct("venue_id").alias("venues"))


@query("""SELECT source_id, count(*) AS n, string_agg(title, ' / ' ORDER BY _ord) FILTER (k <= 5) AS sample FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY _ord) AS k FROM partner_event) GROUP BY source_id""")
def source_report(spark, root):
    df = table(spark, root, "partner_event")
    k = F.row_number().over(Window.partitionBy("source_id").orderBy("_ord"))
    top = F.when(F.col("k") <= 5, F.struct("_ord", "title"))
    agg = df.withColumn("k", k).groupBy("source_id").agg(F.count("*").alias("n"), F.array_sort(F.collect_list(top)).alias("t"))
    return agg.select("source_id", "n", F.array_join(F.transform("t", lambda x: x["title"]), " / ").alias("sample"))


@query("SELECT city, string_agg(slug || '=' || id, ',' ORDER BY slug, id) AS ids FROM venue WHERE slug IS NOT NULL GROUP BY city")
def slug_map(spark, root):
    return table(spark, root, "venue").filter("slug is not null").groupBy("city").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("slug", "id"))), lambda x: F.concat_ws("=", x["slug"], x["id"])), ",").alias("ids"))


@query(f"WITH {L} SELECT venue_id, string_agg(d::VARCHAR, ',' ORDER BY d) AS days FROM (SELECT DISTINCT venue_id, s // 86400 AS d FROM listings WHERE venue_id IS NOT NULL AND s IS NOT NULL) GROUP BY venue_id")
def dates_present(spark, root):
    d = listings(spark, root).filter("venue_id is not null and s is not null").groupBy("venue_id").agg(F.array_sort(F.collect_set(F.floor(F.col("s") / 86400))).alias("d"))
    return d.select("venue_id", F.array_join(F.transform("d", lambda x: x.cast("string")), ",").alias("days"))


# --- windows and order --------------------------------------------------------------
@query(f"""WITH {L}, g AS (SELECT _ord, s, lead(s) OVER (PARTITION BY venue_id, s // 86400 ORDER BY s, _ord) - s AS gap FROM listings WHERE venue_id IS NOT NULL AND s IS NOT NULL)
SELECT _ord, s + CASE WHEN gap IS NULL OR gap <= 0 THEN 7200 ELSE least(gap, 7200) END AS ends_s FROM g""")
def end_inference(spark, root):
    df = listings(spark, root).filter("venue_id is not null and s is not null").withColumn("day", F.floor(F.col("s") / 86400))
    return R.inferred_ends(df, ["venue_id", "day"], "s").select("_ord", "ends_s")


@query("SELECT _ord, source_id, source_event_id FROM partner_event WHERE source_event_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY source_id, source_event_id ORDER BY _ord) = 1")
def first_wins(spark, root):
    return R.first_wins(table(spark, root, "partner_event").filter("source_event_id is not null"), ["source_id", "source_event_id"], "_ord").select("_ord", "source_id", "source_event_id")


@query("SELECT _ord, source_id, source_event_id FROM partner_event WHERE source_event_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY source_id, source_event_id ORDER BY _ord DESC) = 1")
def last_wins(spark, root):
    return R.last_wins(table(spark, root, "partner_event").filter("source_event_id is not null"), ["source_id", "source_event_id"], "_ord").select("_ord", "source_id", "source_event_id")


@query(f"WITH {L} SELECT venue_id, _ord, s, row_number() OVER (PARTITION BY venue_id ORDER BY s, _ord) AS rank FROM listings WHERE venue_id IS NOT NULL AND s >= {AS_OF_S} QUALIFY rank <= 3")
def nearest_upcoming(spark, root):
    df = listings(spark, root).filter((F.col("venue_id").isNotNull()) & (F.col("start") >= as_of()))
    return R.top_k(df, ["venue_id"], 3, F.col("s"), F.col("_ord")).select("venue_id", "_ord", "s", "rank")


@query("SELECT _ord, venue_id, count(*) FILTER (confidence < 0.5) OVER (PARTITION BY venue_id ORDER BY _ord ROWS UNBOUNDED PRECEDING) AS segment FROM partner_event WHERE venue_id IS NOT NULL")
def contiguous_segments(spark, root):
    df = table(spark, root, "partner_event").filter("venue_id is not null")
    return R.contiguous(df, ["venue_id"], "_ord", F.col("confidence") < 0.5).select("_ord", "venue_id", "segment")


_SCORE = """coalesce(confidence, 0) * 10 + CASE WHEN trim(ticket_url) <> '' THEN 5 ELSE 0 END + CASE WHEN trim(image_url) <> '' THEN 2 ELSE 0 END
 + CASE WHEN trim(description) <> '' THEN 1 ELSE 0 END + CASE WHEN (s % 86400) // 3600 <> 0 THEN 3 ELSE 0 END"""


@query(f"""WITH RECURSIVE {L}, r AS (SELECT _ord AS ord, venue_id AS venue, coalesce({NORM.format('title')}, '') AS form, s, {_TK} AS ticket, {_SCORE} AS score FROM listings WHERE venue_id IS NOT NULL),
o AS (SELECT *, coalesce((s // 86400)::VARCHAR, '') || '|' || coalesce(ticket, '') AS key, row_number() OVER (PARTITION BY venue, form ORDER BY ord) AS n FROM r),
w AS (SELECT venue, form, n, ord, score, ord AS cluster, [{{'opener': ord, 'key': key, 's': s, 'ticket': ticket, 'score': score}}] AS held FROM o WHERE n = 1
 UNION ALL SELECT venue, form, n, ord, score, CASE WHEN pos IS NULL THEN ord ELSE held[pos].opener END,
  CASE WHEN pos IS NULL THEN list_append(held, {{'opener': ord, 'key': key, 's': s, 'ticket': ticket, 'score': score}})
   WHEN score > held[pos].score THEN list_concat(list_append(held[: pos - 1], {{'opener': held[pos].opener, 'key': held[pos].key, 's': s, 'ticket': ticket, 'score': score}}), held[pos + 1 :]) ELSE held END
  FROM (SELECT o.*, w.held, coalesce(nullif(list_position(list_transform(w.held, lambda x: coalesce((x.ticket IS NULL OR o.ticket IS NULL OR x.ticket = o.ticket) AND (abs(x.s - o.s) <= 64800 OR x.s // 86400 = o.s // 86400), false)), true), 0),
   nullif(list_position(list_transform(w.held, lambda x: x.key = o.key), true), 0)) AS pos FROM w JOIN o ON o.venue = w.venue AND o.form = w.form AND o.n = w.n + 1))
SELECT ord, cluster, row_number() OVER (PARTITION BY cluster ORDER BY score DESC, ord) = 1 AS kept FROM w""")
def batch_clusters(spark, root):
    """Order-dependent clusters of rows that list one show."""
    df = listings(spark, root).filter("venue_id is not null")
    rows = df.select(F.col("_ord").alias("ord"), F.col("venue_id").alias("venue"), C.normalize_title("title").alias("form"), F.col("s").alias("start"), C.ticket_key("ticket_url").alias("ticket"), C.preference("confidence", "ticket_url", "image_url", "description", "start").alias("score"))
    return dedup.cluster(rows)


# --- sets, sinks, quality -----------------------------------------------------------
@query("SELECT 'event' AS kind, id, title FROM existing_event WHERE kind = 'event' UNION ALL SELECT 'prekindle', id::VARCHAR, title FROM prekindle_event")
def tagged_union(spark, root):
    a = table(spark, root, "existing_event").filter("kind = 'event'").select(F.lit("event").alias("kind"), "id", "title")
    return a.unionByName(table(spark, root, "prekindle_event").select(F.lit("prekindle").alias("kind"), F.col("id").cast("string").alias("id"), "title"))


@query("SELECT title FROM prekindle_event WHERE title IS NOT NULL EXCEPT SELECT name FROM artist")
def titles_except_artists(spark, root):
    return table(spark, root, "prekindle_event").filter("title is not null").select("title").subtract(table(spark, root, "artist").select(F.col("name").alias("title")))


@query("SELECT lower(trim(website_url)) AS url FROM venue WHERE website_url IS NOT NULL UNION SELECT lower(trim(calendar_url)) FROM venue_event_sources WHERE calendar_url IS NOT NULL")
def distinct_urls(spark, root):
    u = lambda t, c: table(spark, root, t).filter(F.col(c).isNotNull()).select(F.lower(F.trim(c)).alias("url"))
    return u("venue", "website_url").union(u("venue_event_sources", "calendar_url")).distinct()


@query("""WITH a AS (SELECT id, title, show_date, 0 AS p, venue_id FROM prekindle_event WHERE promo_id IS NOT NULL), b AS (SELECT id, title, show_date, 1 AS p, venue_id FROM prekindle_event WHERE promo_id IS NULL)
SELECT id, venue_id, title FROM (SELECT * FROM a UNION ALL SELECT * FROM b) QUALIFY p = min(p) OVER (PARTITION BY venue_id)""")
def fallback_by_venue(spark, root):
    p = table(spark, root, "prekindle_event").select("id", "venue_id", "title", "promo_id")
    a, b = p.filter("promo_id is not null").drop("promo_id"), p.filter("promo_id is null").drop("promo_id")
    return R.with_fallback(a, b, "venue_id")


@query("""WITH s AS (SELECT id, name, rtrim(left(trim(regexp_replace(lower(name), '[^a-z0-9]+', '-', 'g'), '-'), 12), '-') AS base FROM venue)
SELECT id, CASE WHEN n = 1 THEN base ELSE base || '-' || n END AS slug FROM (SELECT *, row_number() OVER (PARTITION BY base ORDER BY id) AS n FROM s)""")
def slug_allocation(spark, root):
    df = table(spark, root, "venue").select("id", C.slugify("name", 12).alias("base"))
    return merge.numbered_slugs(df, "base", "id").select("id", "slug")


@query("""WITH i AS (SELECT source_event_id AS id, venue_id, title, _ord FROM partner_event WHERE source_event_id IS NOT NULL AND venue_id IS NOT NULL), c AS (SELECT source_event_id AS id, venue_id, title, 0::BIGINT AS _ord FROM existing_event WHERE source_event_id IS NOT NULL),
u AS (SELECT *, 0 AS p FROM c UNION ALL SELECT *, 1 FROM i) SELECT venue_id, id, title, _ord FROM u QUALIFY row_number() OVER (PARTITION BY venue_id, id ORDER BY p DESC, _ord DESC, title) = 1""")
def keyed_upsert(spark, root):
    i = table(spark, root, "partner_event").filter("source_event_id is not null and venue_id is not null").select("venue_id", F.col("source_event_id").alias("id"), "title", "_ord")
    c = table(spark, root, "existing_event").filter("source_event_id is not null").select("venue_id", F.col("source_event_id").alias("id"), "title", F.lit(0).cast("bigint").alias("_ord"))
    return merge.upserted(c, i, ["venue_id", "id"], "_ord").select("venue_id", "id", "title", "_ord")


@query("SELECT venue_id, source_event_id, count(*) AS n FROM existing_event WHERE venue_id IS NOT NULL AND source_event_id IS NOT NULL GROUP BY ALL HAVING count(*) > 1")
def repeated_keys(spark, root):
    return merge.repeated_keys(table(spark, root, "existing_event"), ["venue_id", "source_event_id"])


# --- generators, hierarchy, search, event windows -------------------------------------
@query("""WITH s(slot, weekday) AS (VALUES ('early', 6), ('late', 7), ('brunch', 1)), d AS (SELECT unnest(generate_series(DATE '2026-10-15', DATE '2026-10-15' + 59, INTERVAL 1 DAY))::DATE AS date)
SELECT slot, strftime(date, '%Y-%m-%d') AS on_date FROM s JOIN d ON dayofweek(date) + 1 = weekday""")
def weekly_slots(spark, root):
    slots = spark.createDataFrame([("early", 6), ("late", 7), ("brunch", 1)], "slot string, weekday int")
    return generate.weekly(slots, as_of(), 60).select("slot", F.date_format("date", "yyyy-MM-dd").alias("on_date"))


@query("""SELECT n_nationkey, n_name || ' < ' || r_name AS path FROM nation JOIN region ON n_regionkey = r_regionkey UNION ALL SELECT -1 - r_regionkey, r_name FROM region""")
def hierarchy_paths(spark, root):
    """Paths of a two-level tree by a recursive query over parent links."""
    table(spark, root, "region").selectExpr("-1 - r_regionkey AS id", "cast(null AS int) AS parent", "r_name AS name").unionByName(
        table(spark, root, "nation").selectExpr("n_nationkey AS id", "-1 - n_regionkey AS parent", "n_name AS name")
    ).createOrReplaceTempView("sg_tree")
    return spark.sql("""WITH RECURSIVE walk(id, path) AS (SELECT id, name FROM sg_tree WHERE parent IS NULL UNION ALL SELECT t.id, concat(t.name, ' < ', w.path) FROM sg_tree t JOIN walk w ON t.parent = w.id)
        SELECT id AS n_nationkey, path FROM walk""")


@query("""SELECT doc_id, len(list_filter(string_split(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g'), ' '), lambda w: w IN ('fiddle', 'waltzes', 'patio'))) AS hits FROM documents
WHERE len(list_filter(string_split(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g'), ' '), lambda w: w IN ('fiddle', 'waltzes', 'patio'))) > 0""")
def keyword_search(spark, root):
    words = F.split(F.regexp_replace(F.lower("text"), "[^a-z0-9]+", " "), " ")
    hits = F.size(F.filter(words, lambda w: w.isin("fiddle", "waltzes", "patio")))
    return table(spark, root, "documents").filter("text is not null").select("doc_id", hits.cast("bigint").alias("hits")).filter("hits > 0")


@query("""SELECT event_type, floor(epoch(ts))::BIGINT // 21600 * 21600 AS window_start, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL""")
def tumbling_windows(spark, root):
    e = table(spark, root, "events").withColumn("t", F.col("ts").cast("timestamp"))
    w = e.groupBy("event_type", F.window("t", "6 hours")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return w.select("event_type", F.unix_timestamp("window.start").alias("window_start"), "n", "total")


@query("""WITH g AS (SELECT user_id, epoch(ts) AS s, CASE WHEN epoch(ts) - lag(epoch(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) < 7200 THEN 0 ELSE 1 END AS fresh FROM events),
r AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY s ROWS UNBOUNDED PRECEDING) AS k FROM g) SELECT user_id, floor(min(s))::BIGINT AS session_start, count(*) AS n FROM r GROUP BY user_id, k""")
def sessions(spark, root):
    e = table(spark, root, "events").withColumn("t", F.col("ts").cast("timestamp"))
    w = e.groupBy("user_id", F.session_window("t", "2 hours")).agg(F.count("*").alias("n"))
    return w.select("user_id", F.unix_timestamp("session_window.start").alias("session_start"), "n")


@query("SELECT event_id, json_extract_string(props, '$.ref') AS ref, CASE WHEN json_valid(props) THEN true ELSE false END AS valid FROM events")
def json_fields(spark, root):
    return table(spark, root, "events").select("event_id", F.get_json_object("props", "$.ref").alias("ref"), F.coalesce(F.try_parse_json("props").isNotNull(), F.lit(False)).alias("valid"))


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
