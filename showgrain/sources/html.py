"""HTML and text layouts: event cards, month grids, day-headed text, Markdown chunks."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from showgrain.functions.columns import decode_entities, no_value, strip_html
from showgrain.sources import event_row

_PARAGRAPHS = re.compile(r"\n\s*\n")


@dataclass(frozen=True)
class Cards:
    """Where a listing's cards begin and what their fields look like (regular expressions, group 1)."""

    card: str = r"(?is)<article\b.*?</article>"
    title: str = r"(?is)<h[1-4][^>]*>(.*?)</h[1-4]>"
    starts: str = r"(?is)<time[^>]*datetime=\"([^\"]+)\""
    ends: str = r"(?is)<time[^>]*data-end=\"([^\"]+)\""
    ident: str = r"(?is)data-(?:event-)?id=\"([^\"]+)\""
    link: str = r"(?is)<a[^>]*href=\"([^\"#][^\"]*)\""
    image: str = r"(?is)<img[^>]*src=\"([^\"]+)\""
    price: str = r"(?is)class=\"[^\"]*price[^\"]*\"[^>]*>([^<]+)<"
    junk: str = r"(?i)^(menu|home|private event|closed|tba)$"


def _absolute(link: Column, page: Column) -> Column:
    root = F.regexp_extract(page, r"^([a-z]+://[^/]+)", 1)
    return F.when(link.rlike(r"^[a-z]+://"), link).when(link.startswith("/"), F.concat(root, link)).when(link != "", F.concat(root, F.lit("/"), link))


def parse_cards(pages: DataFrame, layout: Cards | None = None) -> DataFrame:
    """One row per card with a title that is no navigation and a start."""
    c = layout or Cards()
    cards = pages.select("url", F.posexplode(F.regexp_extract_all("body", F.lit(c.card), 0)).alias("_pos", "card"))
    get = lambda p: no_value(F.regexp_extract("card", p, 1))
    out = cards.select(
        *event_row(
            url=F.col("url"), _pos=F.col("_pos"), source_event_id=get(c.ident), title=no_value(decode_entities(strip_html(get(c.title)))), starts_text=get(c.starts), ends_text=get(c.ends), ticket_url=_absolute(get(c.link), F.col("url")),
            image_url=get(c.image), price_text=no_value(F.trim(get(c.price))), description=no_value(decode_entities(strip_html(F.regexp_extract("card", r"(?is)<p[^>]*>(.*?)</p>", 1)))),
        )
    )
    return out.filter("title is not null and starts_text is not null").filter(~F.col("title").rlike(c.junk))


def month_grid(pages: DataFrame, cell: str = r"(?is)<td[^>]*data-date=\"(\d{4}-\d{2}-\d{2})\"[^>]*>(.*?)</td>", ident: str = r"/events?/(\d+)") -> DataFrame:
    """``source_event_id`` with its first and last day over all cells of all pages."""
    cells = pages.select("url", F.explode(F.regexp_extract_all("body", F.lit(cell), 0)).alias("c"))
    days = cells.select(F.regexp_extract("c", cell, 1).alias("day"), F.explode(F.array_distinct(F.regexp_extract_all("c", F.lit(ident), 1))).alias("source_event_id"))
    return days.groupBy("source_event_id").agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.count_distinct("day").alias("n_days"))


def day_blocks(pages: DataFrame, header: str = r"^(?:Mon|Tue|Wed|Thu|Fri|Sat|Sun)[a-z]*,? .*\d{1,2}") -> DataFrame:
    """Lines of a text under their day header: ``url``, ``day_text``, ``_pos``, ``line``."""
    # cut ahead of each header, so a long page costs no more than its length
    at = header.removeprefix("^")
    blocks = pages.select("url", F.posexplode(F.split("body", rf"(?m)(?=^{at})")).alias("_block", "b"))
    lines = F.transform(F.split("b", r"\r?\n"), lambda x: F.trim(x))
    blocks = blocks.withColumn("ls", lines).filter(F.get("ls", F.lit(0)).rlike(header))
    rest = F.filter(F.slice("ls", 2, 1 << 30), lambda x: x != "")
    out = blocks.select("url", "_block", F.get("ls", F.lit(0)).alias("day_text"), F.posexplode(rest).alias("_line", "line"))
    place = F.row_number().over(Window.partitionBy("url").orderBy("_block", "_line")) - 1
    return out.select("url", place.cast("int").alias("_pos"), "day_text", "line")


def packed_paragraphs(text: str | None, longest: int) -> Iterator[str]:
    """Chunks of whole paragraphs, of at most ``longest`` characters but for a paragraph that alone is longer."""
    held, size = [], 0
    for p in _PARAGRAPHS.split(text or ""):
        if not p.strip():
            continue
        if held and size + len(p) > longest:
            yield "\n\n".join(held)
            held, size = [], 0
        held.append(p)
        size += len(p) + 2
    if held:
        yield "\n\n".join(held)


def chunks(pages: DataFrame, longest: int = 8000) -> DataFrame:
    """Text packed paragraph by paragraph into chunks of at most ``longest`` characters.

    A paragraph longer than that is a chunk of its own, whole.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = [(u, i, c) for u, t in zip(b.url, b.body, strict=True) for i, c in enumerate(packed_paragraphs(t, longest))]
            yield pd.DataFrame(out, columns=["url", "_pos", "chunk"])

    return pages.select("url", "body").mapInPandas(run, "url string, _pos int, chunk string")
