"""Functions and table functions for SQL, and a model's answers as rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from showgrain.operators.grammar import band_name, bill
from showgrain.sources.html import packed_paragraphs


@F.udtf(returnType="billing_order int, name string, role string")
class ExplodeLineup:
    """The acts of a title with their roles, in order of billing."""

    def eval(self, title: str):
        for name, role, order in bill(title) if title else ():
            yield order, name, role


@F.udtf(returnType="pos int, chunk string")
class ChunkText:
    """A text packed paragraph by paragraph into chunks of ``longest`` characters; longer paragraphs stay whole."""

    def eval(self, text: str, longest: int):
        yield from enumerate(packed_paragraphs(text, longest))


@F.pandas_udf(T.StringType())
def band_name_of(title: pd.Series) -> pd.Series:
    """The act a title is about."""
    return title.map(lambda t: band_name(t) if isinstance(t, str) else None)


def register(spark: SparkSession) -> None:
    """Make them known to SQL: explode_lineup(title), chunk_text(text, longest), band_name(title)."""
    spark.udtf.register("explode_lineup", ExplodeLineup)
    spark.udtf.register("chunk_text", ChunkText)
    spark.udf.register("band_name", band_name_of)


def asked(pages: DataFrame, model: Callable[[list[str]], list[list[dict]]], schema: str) -> DataFrame:
    """Rows that a model reads off pages (``url``, ``body``).

    ``model`` takes the bodies of a batch and answers with a list of records for each; it is called
    once an Arrow batch, on the executors.  A page without answer gives no row.
    """
    names = [f.name for f in T._parse_datatype_string(f"{schema}, url string").fields]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [{**r, "url": u} for u, answer in zip(b.url, model(b.body.tolist()), strict=True) for r in answer]
            yield pd.DataFrame([[r.get(n) for n in names] for r in rows], columns=names)

    return pages.select("url", "body").mapInPandas(run, f"{schema}, url string")
