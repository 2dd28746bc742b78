"""Scalar functions of the event relation as Spark columns: all JVM-side, none in Python."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------------
#: Named HTML entities and what they stand for; the ampersand goes last.
ENTITIES = [("&nbsp;", " "), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&#039;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&ndash;", "–"), ("&mdash;", "—"), ("&hellip;", "…"), ("&rsquo;", "'"), ("&lsquo;", "'"), ("&rdquo;", '"'), ("&ldquo;", '"'), ("&amp;", "&")]
#: Curly quotes and their straight forms.
CURLY, STRAIGHT = "‘’‚‛“”„‟", "''''\"\"\"\""
#: Query parameters of a ticket link that identify the event.
TICKET_PARAMETERS = "itemnumber|item_number|eventid|event_id|event|id|performanceid"
#: Latin letters with marks, and the plain ones.
MARKED = "áàâäãåāçčéèêëēíìîïīñóòôöõøōúùûüūýÿšžÁÀÂÄÃÅĀÇČÉÈÊËĒÍÌÎÏĪÑÓÒÔÖÕØŌÚÙÛÜŪÝŠŽ"
PLAIN = "aaaaaaacceeeeeiiiiinooooooouuuuuyyszAAAAAAACCEEEEEIIIIINOOOOOOOUUUUUYSZ"
# ----------------------------------------------------------------------------------


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def no_value(c: Column | str) -> Column:
    """Null for null, empty and blank strings."""
    c = _col(c)
    return F.when(F.trim(c) != "", c)


def collapse(c: Column | str) -> Column:
    return F.trim(F.regexp_replace(_col(c), r"\s+", " "))


def decode_entities(c: Column | str) -> Column:
    """Named and numeric entities decoded (two passes), quotes straight, blanks collapsed."""
    c = _col(c)
    for _ in range(2):
        for name, plain in ENTITIES:
            c = F.replace(c, F.lit(name), F.lit(plain))
        # numeric entities: cut at '&#', decode the number that opens each later piece
        parts = F.split(c, "&#")
        number = lambda p: F.regexp_extract(p, r"^([0-9]{1,6});", 1).try_cast("bigint")
        letter = lambda p: F.decode(F.unhex(F.lpad(F.hex(number(p)), 8, "0")), "UTF-32")
        piece = lambda p: F.when(
            number(p).between(1, 0xD7FF) | number(p).between(0xE000, 999_999), F.concat(letter(p), F.regexp_replace(p, r"^[0-9]{1,6};", ""))
        ).otherwise(F.concat(F.lit("&#"), p))
        c = F.when(F.contains(c, F.lit("&#")), F.concat(F.element_at(parts, 1), F.array_join(F.transform(F.slice(parts, 2, 1 << 20), piece), ""))).otherwise(c)
    return collapse(F.translate(c, CURLY, STRAIGHT))


def plain_letters(c: Column | str) -> Column:
    return F.translate(_col(c), MARKED, PLAIN)


def normalize_title(c: Column | str) -> Column:
    """Lower case, letters, digits and single blanks only."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(_col(c)), r"[^a-z0-9 ]", ""), r" +", " "))


def series_form(c: Column | str) -> Column:
    """Marks and apostrophes dropped, other signs as blanks."""
    s = F.regexp_replace(F.lower(plain_letters(c)), r"['’]", "")
    return F.trim(F.regexp_replace(s, r"[^a-z0-9]+", " "))


def ticket_key(c: Column | str) -> Column:
    """Host without www, path and identifying parameters in order; null for no link."""
    c = F.lower(F.trim(_col(c)))
    bare = F.regexp_replace(F.regexp_replace(c, r"^[a-z]+://(www\.)?", ""), r"#.*$", "")
    path = F.regexp_replace(F.substring_index(bare, "?", 1), r"/+$", "")
    query = F.when(F.contains(bare, F.lit("?")), F.regexp_replace(bare, r"^[^?]*\?", "")).otherwise("")
    kept = F.array_join(F.array_sort(F.filter(F.split(query, "&"), lambda p: p.rlike(rf"^({TICKET_PARAMETERS})="))), "&")
    return F.when(c != "", F.concat_ws("?", path, F.when(kept != "", kept)))


def start_minute(start: Column | str) -> Column:
    return F.date_format(_col(start), "yyyy-MM-dd'T'HH:mm")


def fingerprint(title: Column | str, venue: Column | str, start: Column | str, ticket: Column | str) -> Column:
    """title|venue|UTC minute, and the ticket key where there is one."""
    return F.concat_ws("|", normalize_title(title), normalize_title(venue), start_minute(start), ticket_key(ticket))


def similarity(a: Column | str, b: Column | str) -> Column:
    """1 - edit distance / longer length; 1 for equal strings (two empty ones too), 0 where one is empty."""
    a, b = _col(a), _col(b)
    longer = F.greatest(F.length(a), F.length(b))
    return F.when(a == b, 1.0).when((a == "") | (b == ""), 0.0).otherwise(1 - F.levenshtein(a, b) / longer)


def preference(confidence, ticket, image, description, start) -> Column:
    """How much a listing tells, for choosing among duplicates."""
    has = lambda c: F.when(no_value(c).isNotNull(), 1).otherwise(0)
    return (
        F.coalesce(_col(confidence), F.lit(0.0)) * 10 + 5 * has(ticket) + 2 * has(image) + has(description) + F.when(F.hour(_col(start)) != 0, 3).otherwise(0)
    )


def strip_html(c: Column | str, lines: bool = False) -> Column:
    """Text of mark-up: scripts and styles out first, then comments and tags; block ends as lines if wanted."""
    c = F.regexp_replace(_col(c), r"(?is)<(script|style)\b.*?</(script|style)\s*>", " ")
    c = F.regexp_replace(c, r"(?s)<!--.*?-->", " ")
    if lines:
        c = F.regexp_replace(c, r"(?i)<br\s*/?>|</(p|div|li|h[1-6]|tr)\s*>", "\n")
    c = F.regexp_replace(c, r"<[a-zA-Z/!][^>]*>", " ")
    if lines:
        c = F.regexp_replace(F.regexp_replace(c, r"[ \t]+", " "), r" ?\n[ \n]*", "\n")
        return F.trim(c)
    return collapse(c)


def slugify(c: Column | str, longest: int = 80) -> Column:
    s = F.regexp_replace(F.lower(plain_letters(c)), r"[^a-z0-9]+", "-")
    return F.regexp_replace(F.left(F.regexp_replace(s, r"^-+|-+$", ""), F.lit(longest)), r"-+$", "")


def truncate_words(c: Column | str, longest: int) -> Column:
    """Cut at the last blank that fits, with an ellipsis."""
    c = collapse(c)
    cut = F.left(c, F.lit(longest - 1))
    at_blank = F.regexp_extract(cut, r"^(.*\S)\s+\S*$", 1)
    return F.when(F.length(c) <= longest, c).otherwise(F.concat(F.when(at_blank != "", at_blank).otherwise(cut), F.lit("…")))


def word_count(c: Column | str) -> Column:
    c = collapse(c)
    return F.when(c == "", 0).otherwise(F.size(F.split(c, " ")))


def first_sentence(c: Column | str) -> Column:
    c = collapse(c)
    s = F.regexp_extract(c, r"^(.*?[.!?])( |$)", 1)
    return F.when(s != "", s).otherwise(c)


def poly_hash(c: Column | str) -> Column:
    """31-polynomial hash of the characters, modulo 2^32."""
    codes = F.filter(F.split(_col(c), ""), lambda x: x != "")
    return F.aggregate(codes, F.lit(0).cast("bigint"), lambda h, x: F.pmod(h * 31 + F.ascii(x), F.lit(1 << 32)))


def canonical_digest(**fields: Column | str) -> Column:
    """sha256 of a key-sorted JSON object, for content versions."""
    return F.sha2(F.to_json(F.struct(*[_col(fields[k]).alias(k) for k in sorted(fields)]), {"ignoreNullFields": "false"}), 256)


def url_host(c: Column | str) -> Column:
    return no_value(F.regexp_extract(F.lower(F.trim(_col(c))), r"^[a-z]+://(?:www\.)?([^/?#:]+)", 1))


def video_id(c: Column | str) -> Column:
    """The id of a video link: embed, watch or short form."""
    return no_value(F.regexp_extract(_col(c), r"(?:embed/|watch\?v=|youtu\.be/|/v/)([A-Za-z0-9_-]{3,})", 1))


def first_event_link(markdown: Column | str) -> Column:
    """The first link of a Markdown text that leads to tickets."""
    links = F.regexp_extract_all(_col(markdown), F.lit(r"\]\((https?://[^)\s]+)\)"), 1)
    return F.get(F.filter(links, lambda u: u.rlike(r"(?i)ticket|/buy|/event|tix")), 0)
