from datetime import datetime

from showgrain.sources import detect, html, ics, jsonld, read_pages, restjson
from showgrain.streaming import ingest


def pages(spark, *bodies):
    return spark.createDataFrame([(f"https://p.example/{i}", b) for i, b in enumerate(bodies)], "url string, body string")


def test_ics(spark):
    body = "BEGIN:VCALENDAR\r\nBEGIN:VEVENT\r\nUID:1\r\nSUMMARY:Rock\\, roll\r\n  and more\r\nDTSTART;TZID=America/Denver:20260901T200000\r\nEND:VEVENT\r\nBEGIN:VEVENT\r\nUID:2\r\nDTSTART:20260901\r\nEND:VEVENT\r\nEND:VCALENDAR"
    got = ics.parse(pages(spark, body, "nothing", None)).collect()
    assert [(r.source_event_id, r.title, r.starts_text) for r in got] == [("1", "Rock, roll and more", "TZID=America/Denver:20260901T200000")]


def test_jsonld(spark):
    body = '<script type="application/ld+json">[{"@type":["Thing","MusicEvent"],"name":"A","startDate":"2026-09-01","image":["i.jpg"],"offers":[{"url":"t"}]},{"@type":"Person","name":"x","startDate":"y"}]</script><script type="application/ld+json">{oops</script>'
    got = jsonld.parse(pages(spark, body, "", None)).collect()
    assert [(r.title, r.image_url, r.ticket_url) for r in got] == [("A", "i.jpg", "t")]


def test_rest_and_extras(spark):
    got = restjson.parse(pages(spark, '{"events":[{"id":7,"title":"A","start_date":"d","image":{"url":"u"}},{"id":8}]}', "not json", None), "calendar").collect()
    assert [(r.source_event_id, r.title, r.image_url) for r in got] == [("7", "A", "u")]
    df = spark.createDataFrame([('[{"key_name":"a","key_value":"1"},{"key_name":"a","key_value":"2"}]',)], "x string")
    assert df.select(restjson.extras("x").alias("m")).first().m == {"a": "2"}


def test_text_layouts(spark):
    got = html.day_blocks(pages(spark, "intro\nFri, Oct 9\nAnn Lee 8pm\n\nBob Ray 9pm\nSat, Oct 10\nCy Poe", None)).collect()
    assert [(r.day_text, r.line) for r in got] == [("Fri, Oct 9", "Ann Lee 8pm"), ("Fri, Oct 9", "Bob Ray 9pm"), ("Sat, Oct 10", "Cy Poe")]
    c = html.chunks(pages(spark, "aaaa\n\nbbbb\n\ncccc"), 10).collect()
    assert [r.chunk for r in c] == ["aaaa\n\nbbbb", "cccc"]
    assert [r.chunk for r in html.chunks(pages(spark, "x" * 50), 10).collect()] == ["x" * 50]
    df = pages(spark, '<a href="webcal://c.example/f.ics">', "plain")
    assert [r.f for r in df.select(detect.feed_link("body").alias("f")).collect()] == ["https://c.example/f.ics", None]


def test_read_pages(spark, tmp_path):
    (tmp_path / "a.html").write_text("one\ntwo")
    assert [r.body for r in read_pages(spark, str(tmp_path)).collect()] == ["one\ntwo"]


def test_streams(spark, tmp_path):
    rows = [(1, datetime(2026, 1, 1, 1), "a", 1.0), (1, datetime(2026, 1, 1, 1), "a", 1.0), (2, datetime(2026, 1, 1, 7), "a", 2.0)]
    spark.createDataFrame(rows, "id int, ts timestamp, event_type string, value double").write.parquet(str(tmp_path / "in"))
    stream = lambda: spark.readStream.schema("id int, ts timestamp, event_type string, value double").parquet(str(tmp_path / "in"))
    seen = []
    ingest.merged_batches(ingest.new_rows(stream(), ["id"], "ts"), lambda b, number: seen.extend((number, r.id) for r in b.collect()), str(tmp_path / "c1")).awaitTermination()
    assert sorted(seen) == [(0, 1), (0, 2)]
    q = ingest.windowed_counts(stream()).writeStream.format("memory").queryName("sg_windows").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert {(r.window_start.hour, r.n) for r in spark.sql("select * from sg_windows").collect()} == {(0, 2), (6, 1)}
