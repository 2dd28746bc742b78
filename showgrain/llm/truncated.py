"""Text cut off by field limits or mid-transfer.

Per source and column two histograms are built, of lengths in characters and in bytes,
over distinct texts (copies would fake a spike), and one of the lengths before a "read
more" marker.  A source has a limit at a length where nearly nothing is longer and whose
count is far above what the density just below would give (a Poisson tail under
``CHANCE``, at any density, so that a table may grow).  Single longer texts hide no limit
and a source may have several.  Texts at a limit without terminal punctuation are cut.  Elsewhere a
text is cut where it ends in a broken character or entity, or where what stands before
a "read more" marker, or the end, is neither a finished sentence nor one of the finished
lines that need no full stop (sign-off, address, list, tag, price line ...).

Everything stays in JVM expressions; histograms are aggregated before any shuffle, so a
source with a third of all rows is as cheap as its number of distinct lengths.

Defined results: null, empty and blank texts are never cut; repeated rows are judged
each; every length is tested by itself, so ties in the histogram do not matter; a null source is a source of its own; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from showgrain.session import broadcast_if_small, written

CHANCE = 1e-4  # a spike is less likely than this under the density below it
NEAR = 0.25  # share of a length over which that density is taken
STRAYS = 0.25  # texts longer than a limit, for each text at it; one is always let pass
LEAST_AT_LIMIT = 2
MARKER_WINDOW = 80  # characters at the end in which a marker or a broken character stands

# --- fixed values -----------------------------------------------------------------
#: Links that are put behind a cut.
MORE_WORDS = "continue reading|keep reading|read more|see more|view more|show more|learn more|more|mehr lesen|weiterlesen|mehr|leer más|seguir leyendo|ver más|más"
#: Of those, the ones that stand alone behind a sentence.
LINK_WORDS = "continue reading|keep reading|read more|see more|view more|show more|learn more|mehr lesen|weiterlesen|leer más|seguir leyendo|ver más"
#: Labels of finished lines.
LABELS = r"line-?up|info|tickets?|tickets and directions|directions|seats left|doors|show|admission|set times|photo|image|credits?|contact|address|where|when|parking|tags?|ages?|price|phone|email|web(?:site)?|source|hosts?|with|support|cast|besetzung|einlass|beginn|karten|eintritt|adresse|ort|entradas|puertas|lugar|precio|dirección"
#: Openings of sign-offs and credits.
SIGN_OFFS = "yours|yours truly|best|best wishes|cheers|love|sincerely|warmly|kind regards|regards|thanks|xoxo|saludos|un abrazo|abrazos|atentamente|herzlich|grüße|viele grüße|liebe grüße|bis bald"
CREDITS = "presented by|sponsored by|photo by|photos by|supported by|brought to you by|text by|words by|präsentiert von|presentado por"
# ----------------------------------------------------------------------------------

BLANKS = " \n\r\t\xa0"
MARKER = (
    r"(?i)(?:(?<=[.!?…])\s*(?:" + LINK_WORDS + r")\s*(?:…|\.{3,})?|\s*(?:…|\.{3,})(?:\s*(?:" + MORE_WORDS + r")\s*[»>→]*)?|\s*[\[(]\s*(?:…|\.{3,}|(?:…|\.{3,})?\s*(?:" + MORE_WORDS + r")\s*(?:…|\.{3,})?)\s*[\])])+\s*\z"
)
BROKEN = r"(?:�+|&(?:#x?[0-9a-fA-F]{0,6}|[a-zA-Z]{0,8})|</?[a-zA-Z][^<>]*|</?)\z"
TERMINAL = r"[.!?。！？؟][\"'”’»)\]*_]*\z"
CLOSED = r"[\"”’»)\]*_~=]\z|\*\s\*\z"
#: Finished lines that close a text without a full stop, tested on what follows the last sentence.
FINISHED = "|".join(
    [
        r"^(?i:" + SIGN_OFFS + r")\s*[,!]\s*\S",
        r"^(?i:" + CREDITS + r")\s+\S",
        r"^[—–•*·-]\s*\S",
        r"(?:^|\s)[#@][\p{L}\p{N}_]+\z",
        r"(?:https?://|www\.)\S+\z|\S+@\S+\.\w+\z",
        r"^\d{1,2}(?:[:.h]\d{2})?\s*(?i:[ap]\.?m\.?|uhr|h)?\s+\S",
        r"\s\|\s",
        r"^(?i:" + LABELS + r")\s*:",
        r"(?i)^(?:admission|entry|tickets?|eintritt|entrada)\s.*\d.*\z|\d+ (?:dollars|euros?|pesos|taler) at the door\z",
        r"(?i)^rated \d+ of \d+|\d+ (?:of|out of|/) \d+(?: by \S+)?\z",
        r"(?i)^(?:©|copyright|tel\.?|phone)\b",
        r"^\d+ [\p{Lu}][\p{L} ]+ (?:Street|Avenue|Road|Lane|Ave|St|Rd)\b.*\z",
    ]
)
#: Of those, the ones that a cut inside cannot leave behind: accepted even at a limit.
WHOLE = r"\d+ (?:dollars|euros?|pesos|taler) at the door\z|^(?i:rated) \d+ of \d+ by \w+\z|\*\s\*\s\*\z"


def _before_marker(docs: DataFrame) -> DataFrame:
    """Texts that are not blank, with the length before a marker in characters and bytes."""
    d = docs.filter("trim(text) <> ''").withColumn("_body", F.rtrim("text", F.lit(BLANKS)))
    # a marker is far shorter than its window, so nothing of it can lie before it
    window = F.right("_body", F.lit(MARKER_WINDOW))
    d = d.withColumn("_window", window).withColumn("_window_kept", F.regexp_replace(window, MARKER, ""))
    shorter = lambda size: size("_body") - size("_window") + size("_window_kept")
    d = d.withColumn("_kept", shorter(F.length)).withColumn("_kept_bytes", shorter(F.octet_length))
    return d.withColumn("_marked", F.col("_kept") < F.length("_body")).drop("_window", "_window_kept")


def _parts(docs: DataFrame) -> DataFrame:
    """Each text with its lengths, what stands before a marker, and the piece after its last sentence."""
    d = _before_marker(docs).withColumn("_rest", F.rtrim(F.expr("left(_body, _kept)"), F.lit(BLANKS)))
    line = F.substring_index("_rest", "\n", -1)
    return (
        d.withColumn("_last", F.trim(F.regexp_replace(line, r"^.*[.!?][\"'”’»)\]]*\s+(?=\S)", "")))
        .withColumn("n_chars_", F.length("text"))
        .withColumn("n_bytes_", F.octet_length("text"))
        .withColumn("_end", F.right("_body", F.lit(MARKER_WINDOW)))
        .withColumn("_rest_end", F.right("_rest", F.lit(MARKER_WINDOW)))
    )


def _log_tail(n: Column, rate: Column) -> Column:
    """Upper bound of the logarithm of P(at least n) of a Poisson variable, for any rate below n."""
    # n! from below by Stirling; the later terms are under a geometric series
    log_factorial = (n + 0.5) * F.log(n) - n + 0.5 * math.log(2 * math.pi) + 1 / (12 * n + 1)
    return n * F.log(rate) - rate - log_factorial - F.log(1 - rate / (n + 1))


def limits(docs: DataFrame) -> DataFrame:
    """``source``, ``unit`` ('chars', 'bytes' or, before a marker, 'marked') and ``at`` of the length limits that sources show."""
    once = (
        _before_marker(docs)
        .select("source", F.length("text").alias("c"), F.octet_length("text").alias("b"), F.col("_kept").alias("k"), F.col("_kept_bytes").alias("kb"), F.col("_marked").alias("m"), F.xxhash64("text").alias("h"))
        .distinct()
        .groupBy("source", "c", "b", "k", "kb", "m")
        .count()
    )
    # a text is longer than all shorter lengths, but than the one before its marker by the marker only
    point = lambda unit, size, at, over, but: F.struct(F.lit(unit).alias("unit"), F.col(size).alias("len"), F.lit(at).alias("at"), F.lit(over).alias("over"), F.lit(but).alias("but"))
    plain = [point("chars", "c", 1, 1, 0), point("bytes", "b", 1, 1, 0)]
    marked = [point("chars", "k", 0, 0, 1), point("bytes", "kb", 0, 0, 1), point("marked", "k", 1, 1, 0)]
    points = F.when(F.col("m"), F.array(*plain, *marked)).otherwise(F.array(*plain, point("marked", "k", 0, 1, 0)))
    total = lambda name, of: F.sum(F.col("count") * F.col(f"x.{of}")).alias(name)
    hist = once.select("source", "count", F.explode(points).alias("x")).groupBy("source", "x.unit", "x.len").agg(total("n", "at"), total("over", "over"), total("but", "but"))
    longer = Window.partitionBy("source", "unit").orderBy(F.desc("len")).rowsBetween(Window.unboundedPreceding, -1)
    hist = written(hist.withColumn("n_over", F.coalesce(F.sum("over").over(longer), F.lit(0)) - F.col("but")), "lengths")
    tops = hist.filter((F.col("n") >= LEAST_AT_LIMIT) & (F.col("n_over") <= F.greatest(F.lit(1), F.col("n") * STRAYS)))
    tops = tops.select(F.col("source").alias("_s"), F.col("unit").alias("_u"), F.col("len").alias("at"), F.col("n").alias("n_at"), "n_over")
    below = (F.col("len") < F.col("at")) & (F.col("len") >= F.col("at") * (1 - NEAR))
    stats = (
        tops.join(hist.select("source", "unit", "len", "n"), F.col("_s").eqNullSafe(F.col("source")) & (F.col("_u") == F.col("unit")))
        .groupBy(F.col("_s").alias("source"), F.col("_u").alias("unit"), "at", "n_at", "n_over")
        .agg(F.sum(F.when(below, F.col("n")).otherwise(0)).alias("n_near"))
    )
    rate = (F.col("n_near") + 0.5) / F.greatest(F.col("at") * NEAR, F.lit(1.0))
    # the chance allowed falls with the square of the rank, so all lengths of a source together stay under twice CHANCE
    allowed = math.log(CHANCE) - 2 * F.log(F.col("n_over") + 1)
    spikes = stats.filter((rate < F.col("n_at")) & (_log_tail(F.col("n_at"), rate) < allowed))
    # most texts at a limit in characters have equally many bytes: no limit of its own
    chars = F.max(F.when(F.col("unit") == "chars", F.col("n_at"))).over(Window.partitionBy("source"))
    return spikes.withColumn("_chars", chars).filter((F.col("unit") != "bytes") | F.col("_chars").isNull() | (F.col("n_at") >= F.col("_chars"))).select("source", "unit", "at")


def judged(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``source``, ``at_limit``, ``cut`` and ``sign`` (what told) of every document that has a text.

    sign: 'broken' (a broken character or entity), 'marked' (a marker behind), 'limit' (a length
    limit) or 'ending' (none of these, only an unfinished sentence).
    """
    of = lambda unit: F.collect_set(F.when(F.col("unit") == unit, F.col("at")))
    found = written(limits(docs), "limits").groupBy("source").agg(of("chars").alias("_at_c"), of("bytes").alias("_at_b"), of("marked").alias("_at_m"))
    found = broadcast_if_small(found.withColumnRenamed("source", "_s"))
    d = _parts(docs.filter("doc_id is not null").select("doc_id", "source", "text"))
    d = d.join(found, d["source"].eqNullSafe(found["_s"]), "left")
    held = lambda size, at: F.coalesce(F.array_contains(at, F.col(size)), F.lit(False))
    in_bytes = F.coalesce(F.exists("_at_b", lambda b: F.col("n_bytes_").between(b - 3, b)), F.lit(False))
    at_limit = held("n_chars_", F.col("_at_c")) | in_bytes | (F.col("_marked") & held("_kept", F.concat("_at_c", "_at_m")))
    whole_sentence = F.col("_rest_end").rlike(TERMINAL) | F.col("_rest_end").rlike(CLOSED)
    broken = F.col("_end").rlike(BROKEN)
    open_end = ~whole_sentence & (F.col("_rest") != "")
    cut = (
        F.when(broken, True)
        .when(F.col("_marked"), open_end)
        .when(at_limit, open_end & ~F.col("_last").rlike(WHOLE))
        .otherwise(open_end & ~F.col("_last").rlike(FINISHED))
    )
    sign = F.when(broken, "broken").when(F.col("_marked"), "marked").when(at_limit, "limit").otherwise("ending")
    return d.select("doc_id", "source", at_limit.alias("at_limit"), cut.alias("cut"), sign.alias("sign"))


def truncated(docs: DataFrame) -> DataFrame:
    """``doc_id`` of the documents that were cut."""
    return judged(docs).filter("cut").select("doc_id")


def truncation_by_source(docs: DataFrame) -> DataFrame:
    """For each source its documents with text, those cut, those of them at a length limit, those told by each other sign alone, and the share."""
    by = lambda sign: F.count_if(F.col("cut") & ~F.col("at_limit") & (F.col("sign") == sign))
    return (
        judged(docs).groupBy("source")
        .agg(
            F.count("*").alias("n_docs"), F.count_if("cut").alias("n_cut"), F.count_if(F.col("cut") & F.col("at_limit")).alias("n_at_limit"),
            by("marked").alias("n_marked"), by("broken").alias("n_broken"), by("ending").alias("n_by_ending"),
        )
        .withColumn("share_cut", F.round(F.col("n_cut") / F.col("n_docs"), 6))
    )
