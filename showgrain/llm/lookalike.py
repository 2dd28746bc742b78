"""Visually identical text with different characters: one consistent form.

DuckDB runs inside the Arrow partitions: each batch is registered as a table and one
SQL expression turns a column into its consistent form with ``nfc_normalize``,
``translate`` and ``regexp_replace``.  Spark then compares plain strings.

Pairs: forms are grouped with their source and listing; only groups that hold two or
more spellings go on, and only pairs of different spellings are built.  A text whose
characters are all plain ASCII needs no DuckDB call to keep its form, but takes the
same path, so there is a single definition.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from showgrain.functions.text import BLANKS, LOOK_ALIKES, compatibility_forms, invisible_class
from showgrain.session import written

SALTS = 4


def form_expression(column: str) -> str:
    """SQL for the consistent form of ``column``: widths, blanks, invisible marks, scripts, accents."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    single = {c: p for c, p in compatibility_forms().items() if len(p) == 1} | {c: " " for c in BLANKS} | LOOK_ALIKES
    several = {c: p for c, p in compatibility_forms().items() if len(p) > 1}
    seen = f"regexp_replace(nfc_normalize({column}), '[{invisible_class()}]', '', 'g')"
    e = seen
    for c, p in several.items():
        e = f"replace({e}, {quote(c)}, {quote(p)})"
    # characters that stand for several are rare: the chain runs on texts that hold one
    any_of = "".join(rf"\x{{{ord(c):X}}}" for c in several)
    e = f"CASE WHEN regexp_matches({seen}, '[{any_of}]') THEN {e} ELSE {seen} END"
    e = f"translate({e}, {quote(''.join(single))}, {quote(''.join(single.values()))})"
    # a look-alike with a combining mark has its composed form only now
    return f"trim(nfc_normalize({e}))"


def _convert(columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        con = duckdb.connect(config={"threads": 1, "memory_limit": "512MB"})
        for b in batches:
            if not b.num_rows:
                continue
            con.register("batch", pa.Table.from_batches([b]))
            forms = ", ".join(f"{form_expression(c)} AS {c}_form" for c in columns)
            out = con.sql(f"SELECT *, {forms} FROM batch").to_arrow_table()
            con.unregister("batch")
            yield from out.to_batches()

    return run


def consistent(df: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` with ``<column>_form`` for each named string column; null stays null, '' stays ''."""
    schema = T.StructType([*df.schema.fields, *[T.StructField(f"{c}_form", T.StringType()) for c in columns]])
    return df.mapInArrow(_convert(columns), schema)


def alike_pairs(rows: DataFrame, fields: tuple[str, ...] = ("title", "description")) -> DataFrame:
    """Pairs of rows of one listing whose field differs as a string yet looks the same.

    rows: ``_ord``, ``source_id``, ``source_event_id`` and the fields.  Null or empty
    identifiers and null texts take no part.  Repeated rows with one spelling make no
    pair with each other.
    """
    listed = rows.filter("_ord is not null and source_id is not null and coalesce(trim(source_event_id), '') <> ''")
    long = listed.select(
        "_ord",
        "source_id",
        "source_event_id",
        F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).alias("text")) for f in fields])).alias("_f"),
    ).select("_ord", "source_id", "source_event_id", "_f.*")
    long = written(long.filter("text is not null").withColumn("text_id", F.md5("text")), "long")
    key = ["source_id", "source_event_id", "field_name"]
    several = long.groupBy(*key).agg(F.min("text_id").alias("lo"), F.max("text_id").alias("hi")).filter("lo <> hi").select(*key)
    spelled = long.join(several, key, "left_semi").groupBy(*key, "text_id").agg(F.first("text").alias("text"))
    formed = written(consistent(spelled, ["text"]).select(*key, F.md5("text_form").alias("form"), "text_id"), "forms")
    a, b = formed.alias("a"), formed.alias("b")
    same = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in [*key, "form"]]
    spellings = a.join(b, [*same, F.col("a.text_id") < F.col("b.text_id")]).select(*[F.col(f"a.{k}").alias(k) for k in key], F.col("a.text_id").alias("one"), F.col("b.text_id").alias("two"))
    # a listing may hold a third of all rows: its rows are spread over salts
    rows = long.select(*key, "text_id", "_ord", F.pmod(F.hash("_ord"), F.lit(SALTS)).alias("salt"))
    salted = lambda d: d.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    left = salted(spellings).join(rows.withColumnsRenamed({"text_id": "one", "_ord": "x"}), [*key, "one", "salt"]).drop("salt")
    both = salted(left).join(rows.withColumnsRenamed({"text_id": "two", "_ord": "y"}), [*key, "two", "salt"])
    return both.select(F.least("x", "y").alias("ord_lo"), F.greatest("x", "y").alias("ord_hi"), "field_name")
