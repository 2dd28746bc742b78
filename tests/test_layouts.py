"""Pages as the platforms write them, copied down by hand, and what must be read off them."""

import pytest
from pyspark.sql import functions as F

from showgrain.operators import relational
from showgrain.sources import crawl, detect, layouts, restjson

AGENDA = """<div id="cal"><div class="ai1ec-event ai1ec-event-id-7"><a href="/event/quiet-otter/?instance_id=77">
<span class="ai1ec-event-title">Quiet &amp; Otter</span></a><div class="ai1ec-event-time">Oct 3 @ 8:00 pm</div>
<a data-ticket-url="https://t.example/q" href="#">Tickets</a></div><div class="ai1ec-event x"><span class="ai1ec-event-title">No time</span></div></div>"""
NOTES = """<div class="em-cal-body"><div class="event_notes"><a href="https://v.example/shows/?event_id=12"><img src="/i.jpg" alt="Fallback"></a>
<h3 class="event_name">Copper Lantern</h3><span class="event_date">October 9, 2026 7:30 PM</span><p>First <b>text</b>.</p><b>$12.50 – $15</b></div>
<div class="event_notes"><img src="/j.jpg" alt="Silver Kestrel"><span class="event_date">October 10, 2026 9 pm</span></div></div>"""
PINBOARD = """<div class="pinboardAgendaContainer"><div class="event-calendar-card" data-event-id="5" data-event-start-date="2026-10-03" data-event-start-time="22:00" data-event-end-date="2026-10-03" data-event-end-time="01:00">
<h2>Late <i>Jam</i></h2><div class="event-info-text">Bring a drum</div></div></div>"""
HOLDERS = """<section class="events-holder"><var class="atc_title">x</var></section><div class="row events-holder"><h2>Brunch</h2><var class="atc_date_start">2026-10-04 11:00:00</var>
<var class="atc_timezone">America/Chicago</var><var class="atc_title">Jazz Brunch</var><var class="atc_date_end">2026-10-04 14:00:00</var></div>"""
OCCURRENCES = """<div class="event-detail" data-event-id="1" data-occurrence-id="91"><h3 class="event-title"><a href="https://z.example/event/91">Trio Night</a></h3>
<p class="event-datetime">Friday, October 2, 2026 9:30 PM</p></div><div class="event-detail" data-event-id="2"><p class="event-datetime">Friday</p></div>"""
DAYS = """<ul><li class="ace-cal-list-day" id="Date_2026-10-03"><article class="ace-cal-list-event-content"><h4 class="ace-cal-list-event-name"><a href="/p/1">Act One</a></h4><p class="ace-cal-list-event-time">2:00 PM</p>
<a href="https://s.example/smartseat?itemNumber=441">Buy</a></article><article class="ace-cal-list-event-content"><h4 class="ace-cal-list-event-name">Act Two</h4><p class="ace-cal-list-event-time">7:30 PM</p></article></li>
<li class="ace-cal-list-day" id="Date_2026-10-04"><article class="ace-cal-list-event-content"><h4 class="ace-cal-list-event-name">Act One</h4><p class="ace-cal-list-event-time">2:00 PM</p></article></li></ul>"""
ITEMS = """<ul class="user-items-list"><li class="list-item"><h2 class="list-item-content__title">Ballroom Dance</h2><div class="list-item-content__description">October 12, 2026</div></li>
<li class="list-item"><h2 class="list-item-content__title">Matinee Revue</h2><div class="list-item-content__description">October 13, 2026</div></li></ul>"""
CARDS = """<div class="upcoming-shows"><div class="card events"><div class="media-left"></div><h4 class="media-heading">Big Tour</h4><span class="date">October 20, 2026 // 8:00 PM</span></div>
<div class="card events"><h4 class="media-heading">Other Tour</h4><span class="date">October 21, 2026</span></div></div>"""
COLUMNS = """<div class="event-column d-flex "><a class="event-tag">Race</a><h3><a href="/r">Night Race</a></h3><div class="event-date">September 4-6, 2026</div><i style="background-image: url('/n.jpg')"></i></div>
<div class="event-column d-flex"><a class="event-tag">Concert</a><h3><a href="/c">Loud Band</a></h3><div class="event-date">September 8, 2026</div></div>"""
LISTED = """<div class="eventColl-item"><h3 class="eventColl-eventInfo--title">Barn Supper</h3><p class="eventColl-date">Saturday, October 24</p><p class="eventColl-time">6 pm</p></div>"""
ROOMS = """<ol><li class="event-row"><a href="/shows/31"><h3>Late Laughs</h3></a><p class="event-day">Friday, October 16</p><p class="event-time">10:00 PM</p><p class="event-room">The Little Room</p></li></ol>"""

WANT = {
    ("agenda", AGENDA): [("77", "Quiet & Otter", "Oct 3 @ 8:00 pm", "https://t.example/q")],
    ("events_manager", NOTES): [("12", "Copper Lantern", "October 9, 2026 7:30 PM", "https://v.example/shows/?event_id=12"), (None, "Silver Kestrel", "October 10, 2026 9 pm", None)],
    ("pinboard", PINBOARD): [("5", "Late Jam", "2026-10-03 22:00", None)],
    ("holders", HOLDERS): [(None, "Jazz Brunch", "2026-10-04 11:00:00 America/Chicago", None)],
    ("occurrences", OCCURRENCES): [("91", "Trio Night", "Friday, October 2, 2026 9:30 PM", "https://z.example/event/91")],
    ("day_list", DAYS): [("441", "Act One", "2026-10-03 2:00 PM", "https://s.example/smartseat?itemNumber=441"), (None, "Act Two", "2026-10-03 7:30 PM", None), (None, "Act One", "2026-10-04 2:00 PM", None)],
    ("user_items", ITEMS): [(None, "Ballroom Dance", "October 12, 2026 20:00", None), (None, "Matinee Revue", "October 13, 2026 14:00", None)],
    ("media_cards", CARDS): [(None, "Big Tour", "October 20, 2026 // 8:00 PM", None), (None, "Other Tour", "October 21, 2026 19:00", None)],
    ("columns", COLUMNS): [(None, "Night Race", "September 4-6, 2026", "https://v.example/r")],
    ("list_items", LISTED): [(None, "Barn Supper", "Saturday, October 24 6 pm", None)],
    ("rooms", ROOMS): [("31", "Late Laughs", "Friday, October 16 10:00 PM", "https://v.example/shows/31")],
}


def _pages(spark, *bodies):
    return spark.createDataFrame([(f"https://v.example/list{i or ''}", b) for i, b in enumerate(bodies)], "url string, body string")


@pytest.mark.parametrize("name,page", WANT, ids=[n for n, _ in WANT])
def test_layouts(spark, name, page):
    rows = layouts.parse(_pages(spark, page, "", "<p>nothing</p>"), name).orderBy("_pos").collect()
    assert [(r.source_event_id, r.title, r.starts_text, r.ticket_url) for r in rows] == WANT[name, page]


def test_layout_details(spark):
    pin = layouts.parse(_pages(spark, PINBOARD), "pinboard").first()
    assert (pin.ends_text, pin.description) == ("2026-10-03 01:00", "Bring a drum")
    notes = layouts.parse(_pages(spark, NOTES), "events_manager").orderBy("_pos").first()
    assert (notes.price_text, notes.image_url, notes.description) == ("$12.50 – $15", "/i.jpg", "First text .")
    assert layouts.parse(_pages(spark, ROOMS), "rooms").first().venue_name == "The Little Room"
    assert layouts.parse(_pages(spark, COLUMNS), "columns").first().image_url == "/n.jpg"
    assert layouts.parse(_pages(spark, AGENDA).limit(0), "agenda").count() == 0


def test_other_forms(spark):
    post = 'x({"a":[{"id":4,"title":"Otter &amp; Co","sortkey":"20261003200000","permalink":"https://d.example/4"},{"id":5,"title":"No time"}]})'
    got = layouts.discovery(_pages(spark, post)).collect()
    assert [(r.source_event_id, r.title, r.starts_text, r.ticket_url) for r in got] == [("4", "Otter & Co", "2026-10-03 20:00", "https://d.example/4")]
    feed = '<rss><item><title><![CDATA[Jam & Roll]]></title><link>https://f.example/1</link><ev:startdate>2026-10-03T20:00:00-05:00</ev:startdate></item><item><title>Post</title></item></rss>'
    assert [(r.title, r.starts_text) for r in layouts.feed_items(_pages(spark, feed)).collect()] == [("Jam & Roll", "2026-10-03T20:00:00-05:00")]
    site = "<urlset><url><loc>https://f.example/a</loc><lastmod>2026-01-01</lastmod></url><url><loc>https://f.example/b</loc><lastmod>2026-02-01</lastmod></url><url><loc>https://f.example/c</loc></url></urlset>"
    assert [r.page[-1] for r in layouts.sitemap(_pages(spark, site), 2).collect()] == ["b", "a"]


def test_richest_page(spark):
    pages = _pages(spark, ITEMS, ITEMS.replace("</ul>", '<li class="list-item"><h2 class="list-item-content__title">Third</h2><div class="list-item-content__description">October 14, 2026</div></li></ul>'))
    rows = layouts.parse(pages, "user_items")
    kept = layouts.richest(pages, rows, F.regexp_extract("url", r"^([a-z]+://[^/]+)", 1)).collect()
    assert {r.url for r in kept} == {"https://v.example/list1"} and len(kept) == 3


def test_detected_platforms(spark):
    pages = [
        ("ical", "https://v.example/cal.ics", ""), ("google_calendar", "https://v.example", "<iframe src='https://calendar.google.com/x'>"), ("event_discovery", "https://v.example", "get_events_for_calendar"),
        ("seatengine", "https://v.example", "<div id='se-calendar'>"), ("ace_calendar", "https://v.example", DAYS), ("squarespace_events", "https://v.example/events", "<script src='//static.sqspcdn.com'></script><article class='eventlist-event'>"),
        ("squarespace_user_items", "https://v.example", ITEMS), ("zoogle", "https://v.example", OCCURRENCES), ("columns", "https://v.example", COLUMNS), ("media_cards", "https://v.example", CARDS), ("livenation", "https://v.example", "livenationcdn"),
        ("webflow", "https://v.example", "<img src='https://cdn.website-files.com/x'><a href='/events/a'>"), ("spacecrafted", "https://v.example", LISTED), ("spotapps", "https://v.example", PINBOARD), ("events_manager", "https://v.example", NOTES),
        ("mec", "https://v.example/all-events/", ""), ("prekindle", "https://v.example", "<div class='pk-cal-widget'>"), ("tec", "https://v.example", "<div class='tribe-events'> wp-content"), ("eventon", "https://v.example", "evcal_list"),
        ("mec", "https://v.example", "<div class='mec-events'>"), ("wordpress", "https://v.example", "/wp-content/x"), ("custom_html", "https://v.example", "<p>"), ("eventbrite", "https://v.example", "eventbrite-widget"), ("bandsintown", "https://v.example", "bandsintown-widget"),
    ]
    got = spark.createDataFrame(pages, "want string, url string, body string").select("want", detect.platform("url", "body").alias("got")).collect()
    assert [r.got for r in got] == [r.want for r in got]


def test_crawl(spark):
    page = '<a href="/event/one">1</a><a href="/event/two?x=1">2</a><a href="/event/one">again</a><a href="/about">x</a><a class="nav" href="/month/2026-11/"><i class="chevron-right"></i></a>'
    assert [r.link for r in crawl.event_links(_pages(spark, page)).orderBy("_pos").collect()] == ["https://v.example/event/one", "https://v.example/event/two?x=1"]
    links = _pages(spark, page, '<link rel="next" href="/p2">', "<p>").orderBy("url").select(crawl.next_link("body").alias("n")).collect()
    assert [r.n for r in links] == ["/month/2026-11/", "/p2", None]
    rows = spark.createDataFrame([("s", p, i) for p, n in ((1, 3), (2, 3), (3, 1), (4, 3)) for i in range(n)] + [("t", 1, 0), ("t", 1, 1), ("t", 1, 2)], "site string, page int, i int")
    assert {(r.site, r.page) for r in crawl.until_short(rows, ["site"], "page", 3).collect()} == {("s", 1), ("s", 2), ("s", 3), ("t", 1)}
    seen = spark.createDataFrame([("s", 1, "a"), ("s", 2, "a"), ("s", 2, "b"), ("s", 3, "b"), ("s", 4, "c")], "site string, page int, slug string")
    assert {r.page for r in crawl.while_new(seen, ["site"], "page", "slug").collect()} == {1, 2}
    held = _pages(spark, '<div data-config="eyJsaW1pdCI6IDIwfQ=="></div>', '<div data-config="AAAA"></div>', "<p>").orderBy("url").select(crawl.embedded_settings("body").alias("c")).collect()
    assert [r.c for r in held] == ['{"limit": 20}', None, None]
    media = '<article><a href="/show/7"></a><img src="https://m.example/logo.png"><img src="https://m.example/uploads/a.jpg"></article><li><a href="/show/8"><img src="/b.jpg"></a></li><li><img src="/c.jpg"></li>'
    assert {tuple(r) for r in crawl.media_map(_pages(spark, media)).collect()} == {("7", "https://m.example/uploads/a.jpg"), ("8", "/b.jpg")}


def test_two_lists_of_one_answer(spark):
    body = '{"upcoming":[{"id":"a","title":"Next","startDate":1790000000000}],"past":[{"id":"b","title":"Last","startDate":1780000000000},{"id":"c","title":""}]}'
    assert [(r.source_event_id, r.starts_text) for r in restjson.parse(_pages(spark, body, "no json"), "site_json").orderBy("_pos").collect()] == [("a", "1790000000000"), ("b", "1780000000000")]


def test_boxes(spark):
    d = spark.createDataFrame([(1, 30.2, -97.7), (2, 10.0, 179.5), (3, None, None), (4, 10.0, -179.5)], "id int, lat double, lng double")
    assert {r.id for r in relational.in_box(d, 30, -98, 31, -97).collect()} == {1}
    assert {r.id for r in relational.in_box(d, 0, 179, 20, -179).collect()} == {2, 4}
