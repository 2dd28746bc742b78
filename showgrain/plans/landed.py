"""Parsers checked by round trips: rows written as a platform would serve them, read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from showgrain.functions import times as X
from showgrain.operators import grammar, search
from showgrain.session import table
from showgrain.sources import detect, html, ics, jsonld, restjson

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


_CLEAN = "trim(regexp_replace({0}, '[ \\t\\n\\r]+', ' ', 'g'))"


@query("SELECT id AS source_event_id, trim(title) AS title, epoch(starts_at)::BIGINT AS start_s FROM existing_event WHERE trim(title) <> ''")
def ics_events(spark: SparkSession, root: str) -> DataFrame:
    e = table(spark, root, "existing_event").filter("trim(title) <> ''")
    escaped = F.regexp_replace(F.regexp_replace("title", r"\\", r"\\\\"), r"([,;])", r"\\$1")
    line = lambda name, v: F.regexp_replace(F.concat(F.lit(name + ":"), v), r"(.{60})(?=.)", "$1\r\n ")
    body = F.concat_ws("\r\n", F.lit("BEGIN:VCALENDAR\r\nBEGIN:VEVENT"), line("UID", F.col("id")), line("SUMMARY", escaped), line("DTSTART", F.date_format("starts_at", "yyyyMMdd'T'HHmmss'Z'")), F.lit("END:VEVENT\r\nEND:VCALENDAR"))
    out = ics.parse(e.select(F.col("id").alias("url"), body.alias("body")))
    return out.select("source_event_id", "title", F.unix_timestamp(X.ics_instant("starts_text")).alias("start_s"))


@query("SELECT id::VARCHAR AS source_event_id, trim(title) AS title, show_date AS starts_text, nullif(trim(price), '') AS price_text, nullif(trim(image_url), '') AS image_url FROM prekindle_event WHERE trim(title) <> '' AND trim(show_date) <> ''")
def jsonld_events(spark, root):
    e = table(spark, root, "prekindle_event").filter("trim(title) <> '' and trim(show_date) <> ''")
    item = F.to_json(
        F.struct(F.lit("MusicEvent").alias("@type"), F.col("id").cast("string").alias("identifier"), F.trim("title").alias("name"), F.col("show_date").alias("startDate"), F.array(F.struct(F.col("image_url").alias("url"))).alias("image"), F.struct(F.col("price")).alias("offers"))
    )
    # a malformed block and an object of another type stand beside it
    page = F.concat(F.lit('<html><script type="application/ld+json">{bad</script><script type="application/ld+json">{"@graph":[{"@type":"Place","name":"x"},'), item, F.lit("]}</script></html>"))
    return jsonld.parse(e.select(F.col("id").cast("string").alias("url"), page.alias("body"))).select("source_event_id", "title", "starts_text", "price_text", "image_url")


@query("SELECT id::VARCHAR AS source_event_id, trim(title) AS title, show_date AS starts_text, nullif(trim(price), '') AS price_text FROM prekindle_event WHERE trim(title) <> '' AND trim(show_date) <> ''")
def rest_events(spark, root):
    e = table(spark, root, "prekindle_event").filter("trim(title) <> '' and trim(show_date) <> ''")
    body = F.concat(F.lit("callback("), F.to_json(F.struct(F.array(F.struct("id", F.trim("title").alias("title"), F.col("show_date").alias("date"), "price")).alias("events"))), F.lit(");"))
    return restjson.parse(e.select(F.col("id").cast("string").alias("url"), body.alias("body")), "widget").select("source_event_id", "title", "starts_text", "price_text")


@query(f"SELECT id::VARCHAR AS source_event_id, {_CLEAN.format('title')} AS title, show_date AS starts_text, 'https://cards.example/e/' || id AS ticket_url FROM prekindle_event WHERE trim(title) <> '' AND trim(show_date) <> ''")
def card_events(spark, root):
    e = table(spark, root, "prekindle_event").filter("trim(title) <> '' and trim(show_date) <> ''")
    esc = F.replace(F.replace(F.replace("title", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    i = F.col("id").cast("string")
    card = F.concat(F.lit('<nav>x</nav><article data-id="'), i, F.lit('"><h3><em>'), esc, F.lit('</em></h3><time datetime="'), F.col("show_date"), F.lit('">x</time><a href="/e/'), i, F.lit('">more</a></article><article><h3>Menu</h3><time datetime="1/1/2027"></time></article>'))
    return html.parse_cards(e.select(F.lit("https://cards.example/list").alias("url"), card.alias("body"))).select("source_event_id", "title", "starts_text", "ticket_url")


@query("SELECT venue_id AS source_event_id_of, count(*) AS n_days FROM (SELECT DISTINCT venue_id, epoch(starts_at)::BIGINT // 86400 FROM existing_event WHERE venue_id IS NOT NULL) GROUP BY 1")
def grid_days(spark, root):
    e = table(spark, root, "existing_event").filter("venue_id is not null")
    cell = F.concat(F.lit('<td class="d" data-date="'), F.date_format("starts_at", "yyyy-MM-dd"), F.lit('"><a href="/event/'), F.col("venue_id"), F.lit('">x</a></td>'))
    out = html.month_grid(e.select(F.lit("https://grid.example").alias("url"), cell.alias("body")), ident=r"/event/([0-9a-f-]+)")
    return out.select(F.col("source_event_id").alias("source_event_id_of"), "n_days")


@query("SELECT doc_id::VARCHAR AS url, length(regexp_replace(text, '[ \\t\\n\\r]+', '', 'g')) AS n FROM documents WHERE trim(text) <> ''")
def chunk_lengths(spark, root):
    """Chunks of every document lose no character but blanks, whatever their number."""
    d = table(spark, root, "documents").filter("trim(text) <> ''").select(F.col("doc_id").cast("string").alias("url"), F.col("text").alias("body"))
    c = html.chunks(d, 2000)
    return c.groupBy("url").agg(F.sum(F.length(F.regexp_replace("chunk", "[ \\t\\n\\r]+", ""))).alias("n"))


@query("SELECT id, CASE WHEN regexp_matches(lower(concat_ws(chr(10), calendar_url, feed_url)), '\\.ics($|\\?|\n)') THEN 'ical' WHEN contains(lower(concat_ws(chr(10), calendar_url, feed_url)), 'calendar.google.com') THEN 'google_calendar' ELSE 'custom_html' END AS platform FROM venue_event_sources")
def platform_detect(spark, root):
    return table(spark, root, "venue_event_sources").select("id", detect.platform("calendar_url", "feed_url").alias("platform"))


@query()
def title_bills(spark, root):
    """Distinct titles with the acts they announce, their roles and order."""
    return grammar.lineups(table(spark, root, "partner_event"))


@query()
def title_band_names(spark, root):
    return grammar.band_names(table(spark, root, "partner_event"))


@query("""WITH q AS (SELECT vec_id AS query_id, embedding AS q FROM embeddings WHERE vec_id % 20 = 0), s AS (SELECT query_id, vec_id, round(list_cosine_similarity(list_transform(embedding, lambda x: x::DOUBLE), list_transform(q, lambda x: x::DOUBLE)), 4) AS score FROM q, embeddings)
SELECT query_id, vec_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s QUALIFY rank <= 10""")
def vector_search(spark, root):
    e = table(spark, root, "embeddings")
    return search.cosine_top_k(e, e.filter("vec_id % 20 = 0"), 10)


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
