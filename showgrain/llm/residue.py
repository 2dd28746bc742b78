"""Template residue and error-page text in description fields.

1. Descriptions are brought to their consistent form and cut into segments (lines,
   sentences, mark-up blocks), once for each distinct description.
2. A fixed-depth prefix tree groups distinct segments into message templates: token count,
   then the first ``DEPTH`` tokens lead to a leaf; within it a token stays in the template
   where at least ``CONSTANT`` of the leaf's segments have it at that place, else it becomes
   ``<*>``.  The tree is a count of tokens by leaf and place, so it is the same in whatever order and
   tasks the segments come, and a hot leaf is combined before it is shuffled.
3. Templates are classified once, by what their segments are and where they stand: a template
   is residue if its own constant text is, if nearly all its records hold residue spellings of
   it (a misspelt member follows the others), or if it stands in many sources and nearly
   nowhere but beside other residue (the rest of an error page).  The verdict is joined back to
   segments and records; a segment that is residue as it stands is so in any template.
4. Ordinary records are searched for unresolved slots ({{name}}, [INSERT DATE], %s ...)
   and printed missing values, whatever template they belong to.

Defined results: rows without an id take no part; null, empty or blank descriptions are no cases; repeated rows are judged
each; very long texts and segments are judged whole; an empty table gives none; a missing ``source`` counts as one source.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from showgrain.functions.frames import frame
from showgrain.functions.text import mixed_script_fold
from showgrain.session import broadcast_if_small, spread, written

DEPTH = 2  # leading tokens that lead to a leaf
CONSTANT = 0.1  # share of a leaf's segments, two at least, that have a token the template keeps
KEPT = 0.6  # share of kept tokens of a template that is judged by its members
AGREED = 0.9  # share of a template's records that must be residue by themselves
LEAST_SOURCES = 5  # sources in which a companion of residue must stand

# --- fixed values -----------------------------------------------------------------
#: Names of fields as templates write them.
FIELD_WORDS = "artist band headliner opener opening act host venue event title name price cost ticket tickets url link date time day start starts end door doors city address description copy text image genre place placeholder location datum nombre fecha preis".split()
#: Verbs and pronouns that open an instruction in brackets.
ASKING_WORDS = "insert enter add your type fill replace put choose select paste ihr ihre inserte introduzca escriba nombre su tu hier aqui".split()
#: Words that close such an instruction.
CLOSING_WORDS = "here einsetzen eintragen eingeben aqui tbd tbc".split()
#: Names of mark-up tags, which are no slots.
TAG_NAMES = "a abbr article aside b blockquote body br button center code dd details div dl dt em figure figcaption font footer form h1 h2 h3 h4 h5 h6 head header hr html i iframe img input label li link main meta nav noscript ol option p path picture pre script section select small source span strike strong style sub summary sup svg table tbody td template textarea tfoot th thead title tr u ul video".split()
#: Whole segments (lower case, numbers as 9) that failed pages, script notices and blocks print.
PAGE_MESSAGES = [
    r"(error |http )?(400|401|403|404|405|408|410|429|500|501|502|503|504|9)[:.]? (bad request|unauthori[sz]ed|forbidden|(page )?not found|method not allowed|request time-?out|gone|too many requests|internal server error|bad gateway|service (temporarily )?unavailable|gateway time-?out)",
    r"error 9( |:).*", r"\(?error code:? 9\)?", r"http error 9.*",
    r"internal server error", r"bad gateway", r"gateway time-?out", r"service (temporarily )?unavailable", r"(page|file) not found",
    r"the (page|url|file) you (requested|are looking for|were looking for).*(not|n't|moved|removed|no longer).*", r"this page (isn't|is not|could not|can't|no longer).*",
    r"(sorry, )?(we can't|we couldn't|we could not|we cannot) find (that|the|this) page.*",
    r"the (requested )?(url|resource).* (was )?not found.*",
    r"seite (wurde )?nicht gefunden.*", r"die (angeforderte )?seite (wurde|konnte) nicht.*", r"p[aá]gina no encontrada", r"no se (ha )?(encontrado|encontró) la p[aá]gina.*", r"es posible que el enlace haya caducado", r"la p[aá]gina que busca.*no.*",
    r"access (to .* )?(is |was |has been )?denied", r"acceso denegado", r"zugriff verweigert", r"forbidden",
    r"you (don't|do not) have (permission|access).*", r"your (request|access|ip).* (was|has been|is) blocked.*", r"incident( id)?:? #?9", r"request( id)?:? #?9", r"(ray|reference|ref) id:? .*",
    r"the server (encountered|is temporarily|was unable|could not).*", r"please try again (later|in 9 (minutes|seconds|hours)|in a (moment|few minutes))",
    r"too many requests", r"slow down", r"rate limit exceeded.*",
    r"error establishing a database connection", r"database error.*", r"warning: [a-z]+ (variable|array key|index|property|offset).*", r"(fatal error|parse error|notice|deprecated): .* on line 9", r".* on line 9",
    r"traceback \(most recent call last\).*", r"(uncaught )?(type|reference|key|value|syntax|attribute|index)error: .*", r"exception in thread .*", r"uncaught .*exception.*", r"(java|system|org)\.[a-z.]+exception.*",
    r"checking your browser.*", r"(please )?(verify|confirm|prove) (that )?you are (a )?human.*", r"(please )?complete the (security check|captcha).*", r"are you a robot\?", r"performing security verification.*", r"just a moment",
    r"(you need to|please|you must|bitte|es necesario) (enable|activate|turn on|aktivieren sie|activar) (javascript|cookies|scripts).*", r"(javascript|cookies|scripts?) (is|are|must be|has been|ist|est[aá]) .*(disabled|required|enabled|deaktiviert|deshabilitado|erforderlich|necesario|turned off).*", r"turn it on and reload.*", r"(this (site|page|app|website)|loading).* (requires?|needs) (javascript|cookies|scripts).*", r"(if nothing happens, )?your browser (does not|doesn't) support.*", r"loading", r"loading\.\.\. if nothing happens.*", r"wird geladen", r"cargando",
    r"we use a browser feature.*", r"update (it|your browser) to continue", r"your browser is (out of date|not supported|outdated).*", r"(please )?upgrade your browser.*",
    r"(this |our |the )?(site|page|website|server|system) is (currently |temporarily )?(down|under|unavailable|offline).*", r"we('| wi)ll be (right )?back (shortly|soon)", r"(scheduled|site) maintenance( in progress)?", r"(wegen )?wartungsarbeiten.*", r"sitio en mantenimiento.*", r"under construction",
    r"your session (has )?(expired|timed out)", r"(please )?(log|sign) in (again|to continue|to view.*)", r"session (expired|timed out)",
    r"something went wrong( on our end)?", r"oops!?( something went wrong.*)?", r"an (unexpected |unknown )?error (has )?occurred.*", r"ha ocurrido un error.*", r"ein (unerwarteter )?fehler ist aufgetreten.*",
]
#: Whole segments that are filler, sample copy or editing instructions.
FILLER = [
    r"lorem ipsum.*", r"dolor sit amet.*", r".*consectetur adipisc?ing elit.*", r".*(sed do eiusmod tempor|ut labore et dolore|quis nostrud exercitation|ullamco laboris|duis aute irure|excepteur sint occaecat|sunt in culpa).*",
    r"this is (a|an|some) (sample|example|dummy|placeholder|test) (event|text|page|description|post|copy|content).*", r"edit or delete (it|this).*", r"(sample|dummy|placeholder|example|test) (text|copy|description|content|event)",
    r"texto de (ejemplo|prueba|relleno).*", r"(beispiel|platzhalter|muster|blind)text.*", r"hier steht (ihr|dein|der) text.*", r"(su|tu) texto aqu[ií].*", r"escriba aqu[ií].*",
    r"(your|event|add) (text|description|copy|content|title)( goes)? here", r"(text|description|copy|content|title|details) (goes|go) here", r"click (here )?to (edit|add).*", r"double-?click to edit.*",
    r"\[?(insert|enter|add|type|write|put|paste) (your |an? |the |event |short |some )*(short |event )*(text|description|copy|content|details|blurb|bio)( of your event)?( here)?\b.*", r"todo( ?:|\b).*", r"fixme\b.*", r"tbd ?: ?.*(copy|text|description).*", r"(copy|text|description|details) (to come|tk|tbd|tba|pending)", r"(write|replace|update) (the )?(copy|text|description)( here| before .*)?", r"reemplace este .*", r"ersetzen sie diesen.*", r"(x{3,} ?)?placeholder( ?x{3,})?", r"x{4,}( x{3,})*", r"asdf.*", r"test( test)+(?:[,.:;!-]* .*)?", r"test(?: (?:event|entry|post|listing|record|page))?[,.:;!-]* (?:please |do )?(?:ignore|not publish|delete).*", r"(?:please|bitte) (?:ignore|ignorieren|ignorar)(?: this .*)?", r"(?:do not publish|not for publication|draft only|nicht veröffentlichen|no publicar)\b.*", r"blah( blah)+",
]
#: Printed missing values; a text of nothing else is one.
MISSING_WORDS = "null none undefined nan nil n/a na #error! #n/a #ref! #value! #name? #null! [object_object] object_object missing void empty (null) <null>".split()
# ----------------------------------------------------------------------------------

_PAGE = re.compile(r"(?:" + "|".join(f"(?:{p})" for p in PAGE_MESSAGES) + r")[.!…]*$")
_FILLER = re.compile(r"(?:" + "|".join(f"(?:{p})" for p in FILLER) + r")[.!…]*$")
_MISSING = frozenset(MISSING_WORDS)
_MARKUP = re.compile(r"</?(?:" + "|".join(TAG_NAMES) + r")\b[^<>]*/?>", re.I)
_CUT = re.compile(r"(?<=[.!?])\s+|[\n\r]+")
_NUMBER = re.compile(r"\d+")

_NAME = r"[A-Za-z_][A-Za-z0-9_]*(?:\.[A-Za-z_][A-Za-z0-9_]*)*(?:\s*\|\s*\w+)?"
_SLOTS = re.compile(
    rf"\{{\{{.{{1,60}}?\}}\}}|\{{%.{{1,60}}?%\}}|<%.{{1,60}}?%>|[$#]\{{.{{1,60}}?\}}|\{{(?:{_NAME}|\d+)\}}|%\(\w+\)[sdif]|(?<![\w%])%[sd](?!\w)"
    rf"|%%\w+%%|@@\w+@@|\*\|[\w:.]+\|\*|(?<!\w)__[A-Za-z]\w*?__(?!\w)|\[\[{_NAME}\]\]|<<\s*\w+\s*>>"
    r"|\$XX+\b|\bXX:XX\b|\bYYYY-MM-DD\b|\bMM/DD/YYYY\b|\bDD/MM/YYYY\b|\bTK(?: TK)+\b|\[object Object\]",
    re.I,
)
_SPACED_PERCENT = re.compile(r"(?<![\w%])%([A-Za-z][A-Za-z_]+)%(?![\w%])")
_NAMED = re.compile(rf"(?:<|&lt;|«)\s*/?({_NAME})\s*(?:>|&gt;|»)", re.I)
_BRACKET = re.compile(r"[\[(]([^\[\]()]{2,60})[\])]")
#: Printed missing values inside a sentence: the telling spellings, and null where a value was due.
_PRINTED = re.compile(r"(?<!\w)NaN(?!\w)|(?<!an )(?<!remains )(?<!\w)(?:undefined|UNDEFINED|Undefined)(?!\w)")
_PRINTED_AFTER = re.compile(r"\b(?:at|from|by|of|for|with|call|see|doors|in|until|behind|called|us) (?:null|nan)\b(?! ?,)", re.I)


def _field_like(name: str) -> bool:
    parts = [p for p in re.split(r"[\W_]+|(?<=[a-z])(?=[A-Z])", name) if p]
    return "_" in name or "." in name or name.lower() in _FIELD_SET or any(p.lower() in _FIELD_SET for p in parts)


#: Field words, and two of them written as one.
_FIELD_SET = frozenset(FIELD_WORDS) | frozenset(a + b for a in FIELD_WORDS for b in FIELD_WORDS)
_TAG_SET = frozenset(TAG_NAMES) - {"title", "link", "source", "time", "address"}


def has_slot(text: str) -> bool:
    """True where a text (in consistent form) holds an unresolved slot or a printed missing value."""
    if _SLOTS.search(text):
        return True
    if any(_field_like(m[1]) for m in _SPACED_PERCENT.finditer(text)):
        return True
    for m in _NAMED.finditer(text):
        name = m[1]
        if m[0][1:2] == "/" or name.lower() in _TAG_SET:
            continue
        if _field_like(name) or not m[0].startswith("«") and "|" in name:
            return True
    for m in _BRACKET.finditer(text):
        inner = m[1].strip()
        words = re.findall(r"[^\W\d_]+", inner.lower())
        if not words:
            continue
        square = m[0][0] == "["
        asks = words[0] in ASKING_WORDS and len(words) > 1 or words[-1] in CLOSING_WORDS and len(words) > 1
        if square and (asks or len(words) <= 4 and ("_" in inner or all(w in _FIELD_SET for w in words)) and (inner.isupper() or "_" in inner or text.isupper() or text.islower())):
            return True
        if not square and re.search(r"\b(fill in|tbc|tbd|insert|to be filled|bitte einsetzen|rellenar)\b", inner, re.I) and len(words) <= 8:
            return True
        if square and re.search(r"\b(nombre|fecha|precio|lugar) (del?|de la)\b", inner, re.I):
            return True
    return bool(_PRINTED.search(text) or _PRINTED_AFTER.search(text))


def segments(form: str) -> list[str]:
    """A text in consistent form cut at mark-up, line ends and sentence ends."""
    t = _MARKUP.sub("\n", form.replace("…", "..."))
    return [s.strip() for s in _CUT.split(t) if s.strip()]


def _plain(segment: str) -> str:
    """A segment in lower case with numbers as 9 and single blanks."""
    return " ".join(_NUMBER.sub("9", segment.lower()).split())


def all_missing(plain: str) -> bool:
    """True for a text of printed missing values only, however many."""
    told = False
    for word in re.split(r"[\s,;|]+", plain.replace("object object", "object_object").rstrip(".")):
        parts = [word] if word in _MISSING else re.split(r"[-/]+", word)
        for x in parts:
            if x in _MISSING or x and not x.strip("?"):
                told = True
            elif x:
                return False
    return told


def verdict(plain: str) -> str:
    """What a segment or the constant text of a template is: 'page', 'filler', 'missing' or 'copy'."""
    t = plain.strip(" \"'“”*·-–—|>").strip()
    if not t:
        return "copy"
    if all_missing(t):
        return "missing"
    if _PAGE.match(t):
        return "page"
    if _FILLER.match(t):
        return "filler"
    return "copy"


def _judge(column: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(bad=[verdict(t) != "copy" for t in b[column]])

    return run


def _split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        d, n, s, direct = [], [], [], []
        for digest, rows, text in zip(b.digest, b.n, b.description, strict=True):
            form = mixed_script_fold(text)
            parts = [_plain(x) for x in segments(form)]
            if parts:
                d.append(digest), n.append(rows), s.append(list(dict.fromkeys(parts)))
                direct.append(has_slot(form) or all_missing(" ".join(parts).strip(" \"'“”*·-–—|>")))
        yield frame({"digest": d, "n": n, "segments": s, "direct": direct})


def mine_templates(segments_: DataFrame) -> DataFrame:
    """Distinct ``segment`` values (other columns stay) with their ``template`` and the share of its tokens that was ``kept``."""
    # signs around a token do not tell templates apart
    tokens = F.transform(F.split("segment", " "), lambda t: F.regexp_replace(t, r"^\p{P}+(?=.)|(?<=.)\p{P}+$", ""))
    cut = segments_.withColumn("tokens", tokens).withColumn("leaf", F.concat_ws("|", F.size("tokens").cast("string"), *[F.coalesce(F.get("tokens", F.lit(i)), F.lit("")) for i in range(DEPTH)]))
    cut = written(cut, "segments")
    # a leaf of one segment keeps it as it is; the first tokens are the leaf's own
    sizes = cut.groupBy("leaf").agg(F.count("*").alias("size")).filter("size > 1")
    long = cut.select("leaf", F.posexplode("tokens").alias("place", "token")).filter(F.col("place") >= DEPTH)
    held = long.groupBy("leaf", "place", "token").agg(F.count("*").alias("n")).filter("n > 1")
    # of a leaf at most 1 / CONSTANT tokens a place are kept
    keep = held.join(sizes, "leaf").filter(F.col("n") >= CONSTANT * F.col("size")).groupBy("leaf").agg(F.collect_set(F.concat_ws(" ", F.col("place").cast("string"), "token")).alias("keep"))
    stays = lambda t, i: (i < DEPTH) | F.array_contains("keep", F.concat_ws(" ", i.cast("string"), t))
    masked = F.transform("tokens", lambda t, i: F.when(stays(t, i), t).otherwise("<*>"))
    out = cut.join(keep, "leaf", "left").withColumn("masked", masked)
    known = F.col("keep").isNotNull()
    return out.select(
        *segments_.columns,
        F.when(known, F.array_join("masked", " ")).otherwise(F.col("segment")).alias("template"),
        F.when(known, F.size(F.filter("masked", lambda t: t != "<*>")) / F.size("masked")).otherwise(1.0).alias("kept"),
    )


def classified(parts: DataFrame, direct: DataFrame, places: DataFrame) -> DataFrame:
    """``digest`` of all texts that hold residue.

    parts: ``digest``, ``n`` (its records), ``segment``; direct: ``digest`` of texts with a slot; places:
    ``digest``, ``source``.
    """
    distinct = parts.groupBy("segment").agg(F.sum("n").alias("n"))
    judged = spread(distinct).mapInPandas(_judge("segment"), "segment string, n long, bad boolean")
    mined = written(mine_templates(judged), "templates")
    # the constant text of a template without wildcards is that of its segments
    text = mined.filter("kept < 1").select("template").distinct().mapInPandas(_judge("template"), "template string, bad boolean").filter("bad").select("template")
    members = mined.groupBy("template").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("bad"), F.col("n")).otherwise(0)).alias("n_bad"), F.min("kept").alias("kept"))
    by_members = members.filter((F.col("kept") >= KEPT) & (F.col("n_bad") > 0) & (F.col("n_bad") >= AGREED * F.col("n"))).select("template")
    first = broadcast_if_small(written(text.unionByName(by_members).distinct(), "bad-templates"))
    bad = written(mined.join(first, "template", "left_semi").select("segment").unionByName(mined.filter("bad").select("segment")).distinct(), "bad-segments")
    bad_texts = written(parts.join(broadcast_if_small(bad), "segment", "left_semi").select("digest").unionByName(direct).distinct(), "bad-texts")
    # companions: what stands beside residue is counted in those texts only, and set against all records of the template
    beside = parts.join(broadcast_if_small(bad_texts), "digest", "left_semi").groupBy("segment").agg(F.sum("n").alias("n_beside"))
    often = mined.join(beside, "segment", "left").groupBy("template").agg(F.sum("n").alias("n"), F.sum("n_beside").alias("n_beside"))
    often = often.filter((F.col("n") >= LEAST_SOURCES) & (F.col("n_beside") >= AGREED * F.col("n"))).join(first, "template", "left_anti")
    company = written(mined.join(often, "template").select("segment", "template"), "company")
    stand = written(parts.join(broadcast_if_small(company), "segment").select("template", "digest").distinct(), "stand")
    wide = places.join(broadcast_if_small(stand), "digest").select("template", "source").distinct().groupBy("template").count().filter(F.col("count") >= LEAST_SOURCES)
    return bad_texts.unionByName(stand.join(wide, "template", "left_semi").select("digest")).distinct()


def residue(rows: DataFrame) -> DataFrame:
    """Records of ``rows`` (``source_table``, ``record_id``, ``description`` and, if known, ``source``) that hold residue."""
    source = F.coalesce("source", F.lit("")) if "source" in rows.columns else F.lit("")
    held = rows.select("source_table", "record_id", "description", source.alias("source")).filter("record_id is not null and coalesce(trim(description), '') <> ''")
    held = held.withColumn("digest", F.md5("description"))
    # descriptions repeat from batch to batch: each is folded and cut once
    once = held.groupBy("digest").agg(F.first("description").alias("description"), F.count("*").alias("n"))
    cut = written(once.mapInPandas(_split, "digest string, n long, segments array<string>, direct boolean"), "cut")
    parts = cut.select("digest", "n", F.explode("segments").alias("segment"))
    found = written(classified(parts, cut.filter("direct").select("digest"), held.select("digest", "source")), "found")
    return held.select("source_table", "record_id", "digest").join(broadcast_if_small(found), "digest", "left_semi").select("source_table", "record_id").distinct()
