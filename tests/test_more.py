"""Links, dates, sinks and functions on small inputs, with results stated by hand."""

from datetime import datetime

from pyspark.sql import functions as F

from showgrain.functions import links as K
from showgrain.functions import times as X
from showgrain.operators import grammar, sinks, surface


def _one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return df.select(column.alias("x")).first().x


def test_links(spark):
    assert _one(spark, K.at_host("u", ["tix.example"]), u="https://www.box.tix.example/e/1") is True
    assert _one(spark, K.at_host("u", ["tix.example"]), u="https://nottix.example/e/1") is False
    assert [_one(spark, K.usable_link("u"), u=u) for u in (" https://a.example ", "#", "JavaScript:void(0)", "")] == ["https://a.example", None, None, None]
    assert _one(spark, K.plain_title("t"), t="[ Ann &amp; Bob ]") == "Ann & Bob"
    assert [_one(spark, K.band_form("t"), t=t) for t in ("Ann Lee Trio", "The Band", "Ann and Friends", "Trio")] == ["ann lee", "the", "ann", "trio"]
    assert _one(spark, K.series_name("t", ["open mic"]), t="Live  Music: Open Mic") is True
    assert _one(spark, K.image_points("u"), u="https://a.example/uploads/logo.svg") == 30 - 80 - 50
    assert _one(spark, K.first_snippet("t", 3), t="# A head line\n[a b c d](x)\nshort\n one  two three four") == "one two three four"
    assert [_one(spark, K.vendor_id("u"), u=u) for u in ("https://t.example/event/A1b2?x", "https://t.example/events/77", "https://t.example/e/1")] == ["A1b2", "77", None]
    assert _one(spark, K.unwrapped("u"), u="https://p.example/_img?url=https%3A%2F%2Fa.example%2Fx.jpg&w=64") == "https://a.example/x.jpg"
    assert _one(spark, K.json_before_noise("t"), t='{"a":[1,2]} // {end') == '{"a":[1,2]}'
    assert _one(spark, K.json_before_noise("t"), t="no json") is None
    m = spark.sql("select map('q', map('a', '1', 'b', null), 'r', map('c', '2')) as m").select(K.flat_form("m").alias("x")).first().x
    assert m == {"q[a]": "1", "r[c]": "2"}


def test_dates(spark):
    at = lambda m, d, day, rule: spark.createDataFrame([(m, d, day)], "m int, d int, a string").select(X.rolled_year("m", "d", F.to_date("a"), rule).alias("y")).first().y
    assert [at(1, 5, "2026-10-15", r) for r in ("two_months", "month", "late_days", "winter", "days")] == [2027] * 5
    assert at(8, 5, "2026-10-15", "two_months") == 2026 and at(8, 5, "2026-10-15", "month") == 2027
    assert at(11, 2, "2026-11-20", "late_days") == 2027 and at(12, 30, "2027-01-03", "late_days") == 2026
    assert at(5, 5, "2026-10-15", "winter") == 2026 and at(10, 1, "2026-10-15", "days") == 2026
    pair = lambda d, t: [tuple(x) for x in spark.createDataFrame([(d, t)], "d array<string>, t array<string>").select(X.paired("d", "t").alias("x")).first().x]
    assert pair(["a", "b"], ["1", "2"]) == [("a", "1"), ("b", "2")]
    assert pair(["a"], ["1", "2"]) == [("a", "1")]
    assert pair(["a", "b", "c", "c"], ["1", "2"]) == [("a", "1"), ("b", "1"), ("c", "1")]
    assert pair(["a"], []) == [] and pair(None, ["1"]) == []
    days = lambda t: tuple(str(x) for x in _one(spark, X.day_range("t"), t=t))
    assert days("September 4-6, 2026") == ("2026-09-04", "2026-09-06")
    assert days("Sep. 29 – October 2, 2026") == ("2026-09-29", "2026-10-02")
    assert days("May 7, 2027") == ("2027-05-07", "2027-05-07")
    assert _one(spark, X.day_range("t"), t="soon") is None
    urls = {"https://v.example/2026-10-05/ann-at-8-30-pm": datetime(2026, 10, 5, 20, 30), "https://v.example/ann-100526/": datetime(2026, 10, 5), "https://v.example/old-100571": datetime(1971, 10, 5), "https://v.example/ann": None}
    assert {u: _one(spark, X.url_start("u"), u=u) for u in urls} == urls
    assert _one(spark, X.local_day(F.to_timestamp("t"), F.lit("America/Chicago")), t="2026-10-06 01:30:00") == "Monday, October 5, 8:30 PM"


def test_sinks(spark):
    held = spark.createDataFrame([("a", "t1", "pending"), ("b", "t2", "rejected"), ("c", "t3", "approved"), ("d", "t4", "pending")], "k string, title string, review_status string")
    come = spark.createDataFrame([("a", "n1"), ("b", "n2"), ("c", "n3"), ("e", "n5")], "k string, title string")
    out = {tuple(r) for r in sinks.upserted_by_status(*sinks.upsert_sides(held, come), ["k"], ["title"]).collect()}
    assert out == {("a", "n1", "pending", "refresh"), ("b", "n2", "pending", "revive"), ("c", "t3", "approved", "skip"), ("d", "t4", "pending", "keep"), ("e", "n5", "pending", "insert")}
    assert {r.review_status for r in sinks.marked(held, come, "k", "review_status", F.lit("x")).collect() if r.k != "d"} == {"x"}
    assert {r.k for r in sinks.ensured(held.select("k", "title"), come, "k", "title").collect()} == {"a", "b", "c", "d", "e"}
    rows = spark.createDataFrame([("a", 1), ("e", 2), ("e", 3)], "k string, o int")
    assert {(r.k, r.o) for r in sinks.staged(held, rows, ["k"], "o").collect()} == {("e", 2)}


def test_model_hook_and_table_functions(spark):
    surface.register(spark)
    got = [tuple(r) for r in spark.sql("select name, role, billing_order from explode_lineup('Ann Lee w/ Bob Ray') order by 3").collect()]
    assert got == [("Ann Lee", "headliner", 1), ("Bob Ray", "support", 2)]
    assert [r.chunk for r in spark.sql("select chunk from chunk_text('aa\\n\\nbb\\n\\ncccccccc', 6) order by pos").collect()] == ["aa\n\nbb", "cccccccc"]
    assert spark.sql("select band_name('SOLD OUT: Ann Lee') as b").first().b == "Ann Lee"
    pages = spark.createDataFrame([("u1", "x y"), ("u2", "")], "url string, body string")
    model = lambda bodies: [[{"title": w} for w in b.split()] for b in bodies]
    assert {tuple(r) for r in surface.asked(pages, model, "title string, price string").collect()} == {("x", None, "u1"), ("y", None, "u1")}


def test_band_names_by_hand():
    want = {
        "SOLD OUT – Ann Lee feat. Bob Ray w/ The Point.": "Ann Lee",
        "Copper Lantern Album Release Show": "Copper Lantern",
        "Quiet Otter - The Long Road Tour w/ Mossy Kestrel & Friends": "Quiet Otter",
        "Quiet Otter: World Tour 2026": "Quiet Otter",
        "Old Master Tribute: Bob Ray Caravan ft. Cy Poe, Dot Elm & More": "Bob Ray Caravan",
        "Ann Lee, Bob Ray, Cy Poe & More": "Ann Lee",
        "Quiet Otter (Ann Lee, Bob": "Quiet Otter",
        "Quiet Otter & Friends": "Quiet Otter",
        "[ QUIET OTTER ]": "QUIET OTTER",
        "An Evening with Ann Lee": "Ann Lee",
        "Blue Monday w/ Ann Lee & Bob Ray": "Ann Lee",
        "": "",
    }
    assert {t: grammar.band_name(t, None, frozenset(["blue monday"])) for t in want} == want
    assert grammar.band_name("Ann Lee - The Copper Barn", "Copper Barn") == "Ann Lee"
    assert grammar.band_name("Ann Lee at Copper Barn", "Copper Barn") == "Ann Lee"
