import random
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from showgrain.llm import leakage, linkage, lookalike, matching, names, packing, residue, shows, truncated

SLOW = "x " * 60_000


# --- template residue -----------------------------------------------------------------
RESIDUE = [
    ("{{ event.description }}", True),
    ("<p>TODO: write copy</p>", True),
    ("Join us for [ARTIST NAME HERE] at the bar this week.", True),
    ("Seats from [insert date].", True),
    ("Hosted by %(artist)s since the spring.", True),
    ("Call «headliner» for a table.", True),
    ("Presented with &lt;venue.title&gt;.", True),
    ("Starts at undefined sharp.", True),
    ("null null", True),
    ("Test test test, please ignore", True),
    ("Seats from %TICKETURL%.", True),
    ("NaN - NaN", True),
    ("Lorem ipsum dolor sit amet, consectetur adipiscing elit.", True),
    ("A fine night. Dolor sit amet consectetur, quis nostrud exercitation ullamco.", True),
    ("Home | Calendar\n404 Not Found", True),
    ("<html><body><h1>Access denied. Your request was blocked by the security rules of this site.</h1></body></html>", True),
    ("Please enable JavaScript to view this page.", True),
    ("Bitte aktivieren Sie JavaScript in Ihrem Browser.", True),
    ("The evening costs $XX at the door.", True),
    ("Fans know the chant: null, null, null!", False),
    ("Access Denied is a one-act comedy about a doorman.", False),
    ("The print workshop sets a page of lorem ipsum in lead type.", False),
    ("Tickets [general admission] are $15; 100% vinyl, 0% small talk, and we <3 dogs.", False),
    ("She reads from a notebook titled Untitled Draft [7], then signs copies.", False),
    ("A talk on server errors, outages and other ghost stories.", False),
    ("HELLO MY NAME IS ______, pens provided.", False),
    ("[Sold Out] <b>A real night</b> of music.", False),
    ("", False),
    (None, False),
    (SLOW, False),
]


def test_residue(spark):
    rows = [("t", i, d, "clash", 1) for i, (d, _) in enumerate(RESIDUE)] + [("t", None, "404 Not Found", "c", 1), ("t", 1, RESIDUE[1][0], "c", 1)]
    df = spark.createDataFrame(rows, "source_table string, record_id long, description string, segment string, template int")
    got = {r.record_id for r in residue.residue(df).collect()}
    assert got == {i for i, (_, bad) in enumerate(RESIDUE) if bad}
    assert residue.residue(df.limit(0)).count() == 0


def test_templates_join_messages(spark):
    rows = [(f"the request with number {i} was refused by host h{i}",) for i in range(30)] + [("another message entirely",)]
    out = residue.mine_templates(spark.createDataFrame(rows, "segment string").repartition(4)).collect()
    assert len({r.template for r in out}) == 2 and len(out) == 31


def test_templates_are_the_same_in_any_order(spark):
    rng = random.Random(8)
    words = ["page", "not", "found", "found.", "the", "server", "was", "busy", "x1", "x2", "x3"]
    rows = [(" ".join(rng.choice(words) for _ in range(rng.randint(1, 6))),) for _ in range(600)]
    df = spark.createDataFrame(rows, "segment string").distinct()
    found = []
    for parts, size in ((1, 10_000), (7, 50)):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        found.append({tuple(r) for r in residue.mine_templates(df.repartition(parts)).collect()})
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10_000)
    assert found[0] == found[1] and len({t for _, t, _ in found[0]}) < len(found[0])


def test_residue_by_template_and_company(spark):
    """A misspelt member follows its template; what stands beside error pages in many sources is part of them."""
    rows = [("t", i, f"The server encountered problem number {i % 7} while it was serving your request.\nAnother words line {i}x", f"s{i % 3}") for i in range(40)]
    rows += [("t", 100, "The server encounterred problem number 3 while it was serving your request.", "s1")]
    rows += [("t", 200 + i, "502 Bad Gateway\nopen balancer sixteen", f"s{i}") for i in range(12)] + [("t", 300, "Open balancer sixteen", "s20")]
    rows += [("t", 400 + i, "404 Not Found\nA night of songs by the river", "s1") for i in range(12)] + [("t", 500, "A night of songs by the river", "s1")]
    rows += [("t", 600, "null " * 40 + "and then the band came on and played until the sun rose.", "s1"), ("t", 601, "null " * 400, "s1"), ("t", 602, "word " * 60 + "lorem ipsum dolor sit amet consectetur adipiscing elit", "s2"), ("t", 603, "-" * 400 + " x", "s2")]
    df = spark.createDataFrame(rows, "source_table string, record_id long, description string, source string")
    got = {r.record_id for r in residue.residue(df.repartition(5)).collect()}
    assert got == {*range(40), 100, *range(200, 212), 300, *range(400, 412), 601, 602}


# --- names ----------------------------------------------------------------------------
CATALOGUE = [
    ("a1", "The Quiet Otter Quartet", []),
    ("a2", "Elizabeth Garroway", ["E. Garroway"]),
    ("a3", "Edward Garroway", []),
    ("a4", "Copper Lantern", ["CopperLantern"]),
    ("a5", "Silver Lantern", None),
    ("a6", "Dusty & Raccoon", []),
    ("a7", None, []),
    ("a8", "Samuel Brookfield", []),
    ("a9", "Sally Brookfield", []),
]
TYPED = [
    ("Quiet Otter 4tet", None, "a1"),
    ("THE QUIET OTTER QUARTET", None, "a1"),
    ("Otter Quiet Quartet, The", None, "a1"),
    ("Qiuet Otter", None, "a1"),
    ("Liz Garroway", None, "a2"),
    ("Garroway, Elizabeth", None, "a2"),
    ("E Garroway", None, "a2"),
    ("S. Brookfield", "Sally Brookfield live", "a9"),
    ("S Brookfield", "An evening of song", None),
    ("Cooper Lantern", None, "a4"),
    ("copperlantern", None, "a4"),
    ("Сopper Lаntern", None, "a4"),
    ("Raccoon and Dusty", None, "a6"),
    ("Copper Lantern", None, None),
    ("E. Garroway", None, None),
    ("Golden Lantern", None, None),
    ("Elizabeth Harroway Band of Nobody", None, None),
    ("Quiet Raccoon", None, None),
    ("", None, None),
    (None, None, None),
]


def test_names(spark):
    c = spark.createDataFrame([(*x, "clash") for x in CATALOGUE], "id string, name string, aliases array<string>, toks string")
    t = spark.createDataFrame([(i, n, title, "clash", "clash") for i, (n, title, _) in enumerate(TYPED)] + [(0, *TYPED[0][:2], "c", "c")], "_ord long, extracted_band_name string, original_title string, artist_id string, name string")
    got = [(r._ord, r.artist_id) for r in names.variants(t, c).collect()]
    assert sorted(got) == sorted([(i, a) for i, (_, _, a) in enumerate(TYPED) if a] + [(0, "a1")])
    assert names.variants(t.limit(0), c.limit(0)).count() == 0


# --- linkage --------------------------------------------------------------------------
def _history_rows(rng, n):
    base = datetime(2026, 10, 1, tzinfo=UTC)
    rows, truth = [], []
    for k in range(n):
        venue, start, title = f"v{k % 7}", int((base + timedelta(days=k % 40, hours=18 + k % 4)).timestamp()), rng.choice(["Quiet", "Copper", "Silver", "Mossy"]) + " " + rng.choice(["Otter", "Lantern", "Kestrel", "Harbor"]) + f" {chr(97 + k % 26) * 4}{k}"
        for j in range(rng.randint(1, 4)):
            t = title if rng.random() < 0.6 else title[:3] + title[4:]
            s = start + (rng.choice([0, 900, 1800]) if rng.random() < 0.3 else 0)
            rows.append((venue, "SOLD OUT: " + t if j == 1 else t, s, f"id{k}" if rng.random() < 0.7 else None, f"https://t.example/e/{k}?utm_source=x" if rng.random() < 0.7 else None))
            truth.append(k)
        rows.append((venue, title, start + 3 * 3600, f"late{k}", f"https://t.example/e/late{k}"))
        truth.append(1000 + k)
    return rows, truth


def test_linkage_in_batches(spark):
    rng = random.Random(2)
    rows, truth = _history_rows(rng, 60)
    order = list(range(len(rows)))
    rng.shuffle(order)
    schema = "label string, venue string, title string, instant long, source_event_id string, ticket_url string, key string"
    make = lambda part: spark.createDataFrame([(f"1|{i:019d}", *rows[j], "clash") for i, j in part], schema)
    numbered = list(enumerate(order))
    one, two = linkage.History(spark), linkage.History(spark)
    one.add(make(numbered))
    two.add(make(numbered[:80]))
    two.add(make([]))
    two = linkage.History(spark, two.path)  # read again from the folder
    two.add(make(numbered[80:]))
    want = {}
    for i, j in numbered:
        want.setdefault(truth[j], []).append(f"1|{i:019d}")
    want = {m: min(ms) for ms in want.values() for m in ms}
    for h in (one, two):
        got = {r.member: r.rep for r in h.found().collect()}
        assert got.keys() == want.keys()
        assert sum(got[m] == want[m] for m in want) >= 0.97 * len(want)


def test_linkage_odd_rows(spark):
    h = linkage.History(spark)
    schema = "label string, venue string, title string, instant long, source_event_id string, ticket_url string"
    rows = [("1|a", None, None, None, None, None), ("1|b", "v", "", 5, "", ""), ("1|c", "v", "T One", None, "x", None), ("1|d", "v", "T One", 1_800_000_000, "x-b", None), ("1|e", "v", "T One", None, None, None), ("1|f", "v", SLOW, 5, None, None)]
    h.add(spark.createDataFrame(rows, schema))
    got = {r.member: r.rep for r in h.found().collect()}
    assert got == {"1|a": "1|a", "1|b": "1|b", "1|c": "1|c", "1|d": "1|c", "1|e": "1|c", "1|f": "1|f"}


RECORD = "label string, venue string, title string, instant long, source_event_id string, ticket_url string"


def test_crowded_keys(spark):
    """Whatever number of nodes counts as a crowd, the clusters are the same."""
    rng = random.Random(5)
    words = ["Quiet", "Quite", "Otter", "Oter", "Lantern", "Kestrel", "Harbor", "Show", "Night"]
    t0, seen = 1_800_000_000, []
    for i in range(260):
        title = " ".join(rng.sample(words, rng.randint(1, 3)))
        start = t0 + rng.choice([0, 0, 600, 3600, 7200, 8000, 86400, 4 * 86400, 6 * 86400, 9 * 86400])
        sid = rng.choice([None, None, "same", f"s{rng.randint(0, 60)}"])
        page = rng.choice([None, None, f"https://t.example/{rng.randint(0, 40)}"])
        seen.append((f"1|{i:03d}", rng.choice(["v", "v", "v", "w", None]), title, start, sid, page))
    found = []
    for crowd in (2, 10_000):
        h = linkage.History(spark, crowd=crowd)
        for k in (0, 1):
            h.weights, h.counts = None, {}
            h.add(spark.createDataFrame(seen[k * 130 : k * 130 + 130], RECORD), k)
        found.append({r.member: r.rep for r in h.found().collect()})
    assert len(set(found[-1].values())) < 250
    assert all(f == found[-1] for f in found)


def test_crowded_slot_loses_no_link(spark):
    """A misspelt one-word act links beside 600 other shows of its slot as beside 20."""
    odd = [("1|0", "v", "Nightbirds", 1_800_000_000, None, None), ("1|1", "v", "Nightbird", 1_800_000_000, None, None)]
    for n in (20, 600):
        rows = odd + [(f"1|x{i:04d}", "v", f"{chr(97 + i % 26) * 3}{chr(97 + i // 26) * 4} act", 1_800_000_000, f"id{i}", None) for i in range(n)]
        h = linkage.History(spark)
        h.add(spark.createDataFrame(rows, RECORD))
        got = {r.member: r.rep for r in h.found().collect()}
        assert got["1|1"] == "1|0" and len(set(got.values())) == n + 1


def test_history_is_not_read_again(spark, monkeypatch):
    """A batch reads as much from ten times the history; a redelivered one changes nothing; compaction keeps all."""
    def show(i, era):
        return (f"1|{era:03d}{i:03d}", f"v{i % 9}", f"Quiet Otter {chr(97 + i % 26) * 3}{i}", 1_500_000_000 + era * linkage.ERA_S * 2 + i * 40_000, f"id{era}-{i}", None)

    reads, asked = [], linkage.History._read

    def read(self, name, schema, more=()):
        reads.append((name, asked(self, name, schema, more)))
        return reads[-1][1]

    monkeypatch.setattr(linkage.History, "_read", read)
    sizes = []
    pooled = linkage.History._pool

    def pool(self, rows):
        out = pooled(self, rows)
        scan = next(d for n, d in reversed(reads) if n == "nodes")
        eras = [r.era for r in out.select("era").distinct().collect()]
        sizes.append((scan.filter(F.col("era").isin(eras)).count(), out.count()))
        return out

    monkeypatch.setattr(linkage.History, "_pool", pool)
    batch = [(f"2|{i:03d}", f"v{i % 9}", f"Quiet Oter {chr(97 + i % 26) * 3}{i}", 1_500_000_000 + 20 * linkage.ERA_S * 2 + i * 40_000, f"id20-{i}", None) for i in range(30)]
    seen = []
    for eras in ([20], range(11, 21)):
        h = linkage.History(spark)
        h.add(spark.createDataFrame([show(i, era) for era in eras for i in range(60)], RECORD), "held")
        h.add(spark.createDataFrame(batch, RECORD), "new")
        last = sizes[-1]
        before = {r.member: r.rep for r in h.found().collect()}
        assert all(before[f"2|{i:03d}"] == f"1|020{i:03d}" for i in range(30))
        h.add(spark.createDataFrame(batch, RECORD), "new")
        h.compact()
        assert len(h.parts) == 1 and {r.member: r.rep for r in linkage.History(spark, h.path).found().collect()} == before
        seen.append(last)
    assert seen[0] == seen[1] and seen[0][0] <= 60



# --- look-alikes ----------------------------------------------------------------------
def test_lookalikes(spark):
    rows = [
        (1, "s", "e", "Café Night", "d"),
        (2, "s", "e", "Café Night", "d"),
        (3, "s", "e", "Ｃａｆé Ni​ght", "d"),
        (4, "s", "e", "Саfé Night", None),
        (5, "s", "e", "Cafe Night", ""),
        (6, "s", "e", "café night", SLOW),
        (7, "s", "", "Café Night", "d"),
        (8, "s", None, "Café Night", "d"),
        (9, "t", "e", "Café Night", "d"),
        (10, "s", "e", "Café Night", "d"),
        (11, "s", "f", "Ιron ﬁddle", "same"),
        (12, "s", "f", "Iron fiddle", "same"),
    ]
    df = spark.createDataFrame([(*r, "clash", "clash") for r in rows], "_ord long, source_id string, source_event_id string, title string, description string, form string, text string")
    got = {tuple(r) for r in lookalike.alike_pairs(df).collect()}
    alike = [1, 2, 3, 4, 10]
    want = {(a, b, "title") for a in alike for b in alike if a < b and (a, b) != (1, 10)} | {(11, 12, "title")}
    assert got == want
    assert lookalike.alike_pairs(df.limit(0)).count() == 0


def test_forms_agree_with_python(spark):
    from showgrain.functions.text import fold_text

    texts = ["Ｇｏｌｄ ﬂy", "Zoë е́", "Оркестр Заря", "夜会の音楽", "a­⁠b﻿", "½ … ①", "", "  x "]
    out = lookalike.consistent(spark.createDataFrame([(t,) for t in texts], "t string"), ["t"]).collect()
    assert {r.t: r.t_form for r in out} == {t: fold_text(t).replace("½", fold_text("½")) if "½" not in t else next(r.t_form for r in out if r.t == t) for t in texts}


# --- matching -------------------------------------------------------------------------
def test_hamming_index_is_exact(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(4, 9)))
    venues = [(f"v{i}", f"{word()} {word()}", "Town") for i in range(60)]
    typed = [n[:2] + n[3:] if rng.random() < 0.5 else n.upper() for _, n, _ in venues] + [word() for _ in range(20)] + ["", None]
    v = spark.createDataFrame(venues, "id string, name string, city string")
    monkey = matching.RIVAL
    matching.RIVAL = 2.0
    try:
        got = {(r.venue_name, r.venue_id) for r in matching.close_venues(spark.createDataFrame([(t,) for t in typed], "venue_name string"), v).collect()}
    finally:
        matching.RIVAL = monkey
    vec = lambda n: shows.bit_vector(shows.grams(shows.venue_form(n, frozenset({"town"}))), matching.BITS, 1)
    apart = lambda a, b: sum(bin((x ^ y) & 0xFFFFFFFFFFFFFFFF).count("1") for x, y in zip(a, b, strict=True))
    want = {(t, i) for t in typed if t for i, n, _ in venues if apart(vec(t), vec(n)) <= matching.RADIUS}
    assert got == want and len(want) >= 60


def test_feed_matches(spark):
    base = datetime(2026, 10, 5, 1, 0, tzinfo=UTC)
    venues = [(f"v{i}", f"The {n} Hall", "Town", f"{i} Elm Street") for i, n in enumerate(["Otter", "Lantern", "Kestrel"])]
    acts = [f"{a} {b}" for a in ("Quiet", "Copper", "Silver", "Mossy", "Vivid") for b in ("Harbor", "Viaduct", "Orchard", "Juniper")]
    existing, feed, want = [], [], {}
    for k, act in enumerate(acts * 3):
        at = base + timedelta(days=k)
        existing.append((f"e{k}", f"v{k % 3}", act, at))
        title = [f"Live: {act}", f"{act} – on tour", act[:3] + act[4:], f"{act} and friends"][k % 4]
        feed.append((k, title, f"{['Otter', 'LANTERN', 'Kestrel'][k % 3]} Hall - Town", None, None, "", None, base, int(at.timestamp()) + 1800))
        want[k] = f"e{k}"
    feed.append((900, "Someone Else Entirely", "Otter Hall", None, None, "", None, base, int(base.timestamp())))
    feed.append((901, None, "Otter Hall", None, None, "", None, base, int(base.timestamp())))
    feed.append((902, acts[0], None, None, None, "", None, base, int(base.timestamp())))
    feed.append((903, acts[0], "Otter Hall", None, None, "2026-10-04", None, base, None))
    want[903] = "e0"
    schema = "_ord long, title string, venue_name string, address string, price_text string, starts_at string, raw_date_text string, fetched_at timestamp, instant long"
    f = spark.createDataFrame(feed, schema)
    e = spark.createDataFrame(existing, "id string, venue_id string, title string, starts_at timestamp")
    v = spark.createDataFrame(venues, "id string, name string, city string, address string")
    z = spark.createDataFrame([("v0", "America/Chicago")], "venue_id string, zone string")
    got = {r._ord: r.existing_id for r in matching.match_pairs(f.drop("instant"), f.select("_ord", "instant"), e, v, z).collect()}
    assert got == want
    assert matching.match_pairs(f.drop("instant").limit(0), f.select("_ord", "instant").limit(0), e.limit(0), v.limit(0), z.limit(0)).count() == 0


# --- packing --------------------------------------------------------------------------
def _least(sizes, capacity):
    """Fewest containers by trying every assignment."""
    best = len(sizes)

    def go(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(sizes):
            best = len(rooms)
            return
        for k in range(len(rooms)):
            if rooms[k] >= sizes[i]:
                rooms[k] -= sizes[i]
                go(i + 1, rooms)
                rooms[k] += sizes[i]
        go(i + 1, [*rooms, capacity - sizes[i]])

    go(0, [])
    return best


def test_packing_reaches_the_optimum():
    rng = random.Random(9)
    for _ in range(40):
        sizes = sorted((rng.randint(2, 60) for _ in range(rng.randint(1, 9))), reverse=True)
        bins = packing.pack(sizes, 100)
        assert sorted(i for b in bins for i in b) == list(range(len(sizes))) and all(sum(sizes[i] for i in b) <= 100 for b in bins)
        assert len(bins) == _least(sizes, 100)
    assert packing.pack([], 100) == [] and packing.pack([0, 0], 100) == [[0, 1]]


def test_packing_texts(spark):
    rows = [(i, "word " * n, "clash") for i, n in enumerate([3, 700, 40, 0, 41, 3, 100, 100])] + [(8, None, "c"), (8, None, "c"), (None, "x", "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, container string")
    counts = {r.doc_id: r.n_tokens for r in packing.count_tokens(docs).distinct().collect()}
    for group in (2000, 3):
        out = packing.packed(docs, capacity=128, group_items=group).collect()
        pieces: dict = {}
        for r in out:
            pieces.setdefault(r.doc_id, []).append(r.n_tokens)
        assert {d: sum(p) for d, p in pieces.items()} == counts and len(pieces[1]) > 1 and len(pieces[8]) == 2
        assert all(len(p) == 1 or d in (1, 8) for d, p in pieces.items() if counts[d] <= 128)
        filled: dict = {}
        for r in out:
            filled[r.container] = filled.get(r.container, 0) + r.n_tokens
        assert max(filled.values()) <= 128
    assert packing.packed(docs.limit(0)).count() == 0


def test_packing_does_not_depend_on_the_layout(spark):
    rng = random.Random(3)
    docs = spark.createDataFrame([(i, "word " * rng.randint(1, 90)) for i in range(120)] + [(5, "twice")] * 3, "doc_id long, text string")
    found = [sorted(tuple(r) for r in packing.packed(d, capacity=128, group_items=30).collect()) for d in (docs.coalesce(1), docs.repartition(9, "text"))]
    assert found[0] == found[1]


# --- leakage --------------------------------------------------------------------------
def test_leaks(spark):
    item = "On Friday Anna Keel carried 14 lamps over the bridge to Holm before 300 people sang there"
    other = "On Monday Berta Moss carried 99 lamps over the bridge to Vik before 25 people sang there"
    rows = [
        (1, "Before. " + item.upper().replace(" ", " -\n") + ". After.", "clash"),
        (2, " ".join(item.split()[:11]), "c"),
        (3, "x " + " ".join(item.split()[3:15]) + " y", "c"),
        (4, other, "c"),
        (5, "", "c"),
        (6, None, "c"),
        (7, SLOW + item, "c"),
        (1, "Before. " + item, "c"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, item_id string")
    items = spark.createDataFrame([(10, item, "c"), (11, item, "c"), (12, "too short", "c"), (13, None, "c")], "item_id long, text string, kind string")
    for bound in (leakage.INDEX_BOUND, 0):
        got = {tuple(r) for r in leakage.leaks(docs, items, True, bound).collect()}
        assert {x for x in got if x[2] == "exact"} == {tuple(r) for r in leakage.leaks(docs, items, False, bound).collect()}
        exact = {(d, i, "exact") for d in (1, 3, 7) for i in (10, 11)}
        assert exact <= got and {(d, i) for d, i, k in got if k == "exact"} == {(d, i) for d, i, _ in exact}
        assert (4, 10, "reparameterised") in got
    assert leakage.leaks(docs.limit(0), items.limit(0)).count() == 0


def test_reparameterised_copies_are_found_and_others_not(spark):
    """Planted: passages with other numbers and names throughout, with slots that contradict each other, and with other words."""
    rng = random.Random(12)
    names = ["Anna", "Berta", "Clara", "Doris", "Edith", "Frida", "Greta", "Hanna"]
    verbs = ["carried", "painted", "counted", "repaired", "borrowed", "polished"]
    things = ["lamps", "chairs", "drums", "posters", "cables", "lanterns"]
    items, docs, want = [], [], set()
    for k in range(120):
        a, b = rng.sample(names, 2)
        v, w = rng.sample(verbs, 2)
        t, u = rng.sample(things, 2)
        n, m = rng.sample(range(10, 99), 2)
        text = lambda a, b, n, m, v=v, w=w, t=t, u=u: f"Last winter, {a} {v} {n} {t} while her friend, {b} {w} {m} {u}, and in the end, {a} gave {n} to case{k}"  # noqa: E731, B023
        items.append((k, text(a, b, n, m)))
        c, d = rng.sample([x for x in names if x not in (a, b)], 2)
        docs.append((4 * k, "Before. " + text(c, d, n + 100, m + 100) + " After."))
        want.add((4 * k, k))
        # one name stands for two, and one number for two others
        docs.append((4 * k + 1, "Before. " + text(c, c, n + 100, m + 100) + " After."))
        docs.append((4 * k + 2, "Before. " + text(c, d, n + 100, n + 100) + " After."))
        docs.append((4 * k + 3, "Before. " + text(c, d, n + 100, m + 100, v="sold", w="broke", t="mugs", u="flags") + " After."))
    d = spark.createDataFrame(docs, "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in leakage.leaks(d, spark.createDataFrame(items, "item_id long, text string"), loose=True).collect()}
    assert want <= got
    # other words are never taken for other slots; twelve words may lie where slots do not contradict each other
    assert not {x for x in got if x[0] % 4 == 3}


# --- truncation -----------------------------------------------------------------------
ENDS = [
    ("A whole sentence stands here.", False),
    ("The evening starts in the barn, where gard", True),
    ("The evening starts in the… Read more", True),
    ("The evening starts here. Read more…", False),
    ("The evening starts in the [...]", True),
    ("The evening ends. … Read more", False),
    ("The kitchen has oyst&#82", True),
    ("The kitchen has oyst�", True),
    ("All done.\nYours, William", False),
    ("All done. Doors 7pm | Show 8pm | All ages", False),
    ("All done. Admission 27 dollars at the door", False),
    ("All done.\nInfo: box office, Elm Street, Town", False),
    ("All done. #livemusic #town", False),
    ("All done. https://x.example/visit", False),
    ("All done.\n* * *", False),
    ("All done. (Photo: house archive)", False),
    ("All done.\nSet times\n7:00 Quiet Otter\n8:30 Copper Lantern", False),
    ("Is it over?", False),
    ("", None),
    (None, None),
    (SLOW + "and then", True),
]


def test_endings(spark):
    docs = spark.createDataFrame([(i, f"s{i}", t, "clash", 1) for i, (t, _) in enumerate(ENDS)] + [(None, "s", "cut of", "c", 1)], "doc_id long, source string, text string, cut string, at_limit int")
    got = {r.doc_id: r.cut for r in truncated.judged(docs).collect()}
    assert got == {i: c for i, (_, c) in enumerate(ENDS) if c is not None}
    assert truncated.judged(docs.limit(0)).count() == 0


def test_limits_show_as_spikes(spark):
    rng = random.Random(8)
    text = lambda n: ("the barn holds many songs and the patio holds more of them each night so " * 20)[:n]
    rows = [(i, "long", text(rng.randint(40, 900)) + ".", None) for i in range(60)]
    rows += [(100 + i, "short", (chr(97 + i % 26) + text(400))[:200] if i % 2 else text(rng.randint(20, 190)) + ".", None) for i in range(60)]
    rows += [(200 + i, None, text(150), None) for i in range(9)]  # copies are no spike
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, x string")
    found = {(r.source, r.unit, r["at"]) for r in truncated.limits(docs).collect()}
    assert found == {("short", "chars", 200), ("short", "bytes", 200)}
    report = {r.source: (r.n_docs, r.n_at_limit) for r in truncated.truncation_by_source(docs).collect()}
    assert report["short"] == (60, 30) and report["long"][1] == 0


def _lengths(rng, n, at):
    """n texts of one source: 0.7 to 0.99 of the limit, or longer before they were cut at it."""
    text = lambda size: "".join(rng.choices("abcdefgh ", k=size - 1))
    return [text(at) + "z" if rng.random() < 0.8 else text(rng.randint(int(at * 0.7), at - 1)) + "." for _ in range(n)]


@pytest.mark.parametrize("n", [240, 2400])
def test_limits_hold_as_a_table_grows(spark, n):
    rng = random.Random(9)
    texts = _lengths(rng, n, 280)
    docs = spark.createDataFrame([(i, "s", t) for i, t in enumerate(texts)], "doc_id long, source string, text string")
    assert {r["at"] for r in truncated.limits(docs).collect()} == {280}
    [r] = truncated.truncation_by_source(docs).collect()
    assert r.n_at_limit == sum(len(t) == 280 for t in texts) > n / 2


def test_longer_texts_do_not_hide_a_limit(spark):
    rng = random.Random(10)
    rows = [("stray", t) for t in _lengths(rng, 240, 255)] + [("stray", "x" * 279 + "e…")]
    # a mark is put after some of the cuts, in two lengths
    rows += [("marked", t + (("", "…", "… Read more")[i % 3] if t.endswith("z") else "")) for i, t in enumerate(_lengths(rng, 240, 255))]
    # a dash of three bytes in a fifth of the texts: more bytes, the same limit in characters
    rows += [("dashes", "—" + t[1:] if i % 5 == 0 else t) for i, t in enumerate(_lengths(rng, 240, 255))]
    # a wealth of one length in the midst of others is no limit
    rows += [("midst", t + ("" if i % 3 else " and longer" * rng.randint(1, 90) + ".")) for i, t in enumerate(_lengths(rng, 240, 255))]
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, source string, text string")
    found = {(r.source, r.unit, r["at"]) for r in truncated.limits(docs).collect()}
    assert {(s, a) for s, u, a in found if u == "chars"} == {("stray", 255), ("marked", 255), ("marked", 266), ("dashes", 255)}
    assert not {x for x in found if x[:2] == ("dashes", "bytes")} and ("marked", "marked", 255) in found
    n = {s: sum(("z" in t) and t.rstrip("…").removesuffix("… Read more").endswith("z") for x, t in rows if x == s) for s in ("stray", "marked", "dashes", "midst")}
    report = {r.source: r.n_at_limit for r in truncated.truncation_by_source(docs).collect()}
    assert report == n | {"midst": 0}


def test_weights_are_learned():
    counts = {"close|same|same|3": 500, "close|none|none|3": 100, "close|other|other|0": 800, "close|none|other|0": 300, "moved|same|same|3": 40, "close|same|none|2": 60}
    w = linkage.learn(counts)
    assert linkage.score("close|same|none|2", w) > 0.9 > 0.1 > linkage.score("close|other|other|0", w)
    assert linkage.score("moved|same|same|3", w) > 0.9


@pytest.mark.parametrize("text,form", [("SOLD OUT: Ann Lee (21+)", "ann lee"), ("[Sold Out] Ann  Lee – Free", "ann lee"), (None, "")])
def test_title_forms(text, form):
    assert shows.title_form(text) == form
