"""Mixed timestamp formats and zones: one dictionary of distinct strings, parsed once.

Rows repeat their date strings far more often than they bring new ones, so the
expensive parser never sees rows.  The steps:

1. each row offers up to two (text, zone, reference day) keys; zone is kept only for
   texts that lack one, the day only for texts without a year, so equal meanings
   share one key;
2. keys are made distinct (partial aggregation ahead of the shuffle, so a string that
   fills a third of all rows costs one row a task) and, in incremental runs, those
   already in the dictionary fall out by anti join;
3. the rest is parsed by ``functions.timeparse`` in Arrow batches and appended;
4. instants are joined back to the rows.  The dictionary side is repeated over
   ``SALTS`` salts and the row side salted, so a hot string is spread; rows without
   any parseable text never enter the join.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import date

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from showgrain.functions.timeparse import DEFAULT_ZONE, parse_instant, resolve_zone
from showgrain.session import broadcast_if_small, new_folder

#: A start already in the one accepted form.
CANONICAL = r"^\d{4}-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01])T([01]\d|2[0-3]):[0-5]\d:[0-5]\d(\.\d{3})?Z\z"
#: Texts that carry an absolute instant, whatever the zone of their source.
_ABSOLUTE = r"^\s*(\d{10}|\d{13}|TZID=.*|\d{8}T\d{4,6}Z)\s*$|(Z|UTC|GMT|[+-]\d{2}:?\d{2}|T\d{2}:\d{2}[+-]\d{2}|\b[ECMP][SD]?T)\s*$"
_YEAR = r"\d{4}|\d{1,2}/\d{1,2}/\d{2}"
SALTS = 8

KEY = ["text", "zone", "ref_day"]
DICTIONARY = T.StructType([T.StructField(k, T.StringType()) for k in KEY] + [T.StructField("instant", T.LongType())])


@F.pandas_udf(T.StringType())
def zone_name(typed: pd.Series) -> pd.Series:
    """IANA name of a zone typed by hand; the default zone for no value or an unknown one."""
    return typed.map(lambda z: resolve_zone(z if isinstance(z, str) else None) or DEFAULT_ZONE)


def date_key(text: F.Column | str, zone: F.Column | str, seen_at: F.Column | str) -> F.Column:
    """The dictionary key of a text; null where it holds no digit, so cannot tell a time."""
    text, zone, seen_at = (F.col(c) if isinstance(c, str) else c for c in (text, zone, seen_at))
    return F.when(
        text.rlike(r"\d"),
        F.struct(
            text.alias("text"),
            F.when(~text.rlike(_ABSOLUTE), F.coalesce(zone, F.lit(DEFAULT_ZONE))).otherwise("").alias("zone"),
            F.when(~text.rlike(_YEAR), F.coalesce(F.date_format(seen_at, "yyyy-MM-dd"), F.lit(""))).otherwise("").alias("ref_day"),
        ),
    )


def _parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        b = b.copy()
        b["instant"] = pd.array(
            [parse_instant(t, z or None, date.fromisoformat(d) if d else None) for t, z, d in zip(b.text, b.zone, b.ref_day, strict=True)],
            dtype="Int64",
        )
        yield b


class TimestampDictionary:
    """Distinct date strings with their instants, kept as Parquet and only ever added to."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.path = spark, path or new_folder(spark, "dates")

    def _exists(self) -> bool:
        jvm, sc = self.spark._jvm, self.spark.sparkContext
        p = jvm.org.apache.hadoop.fs.Path(self.path)
        return p.getFileSystem(sc._jsc.hadoopConfiguration()).exists(p)

    def read(self) -> DataFrame:
        if not self._exists():
            return self.spark.createDataFrame([], DICTIONARY)
        return self.spark.read.schema(DICTIONARY).parquet(self.path)

    def add(self, keys: DataFrame) -> TimestampDictionary:
        """Parse the keys that are new (column ``key`` as from ``date_key``) and append them."""
        fresh = keys.filter("key is not null").select("key.*").distinct()
        if self._exists():
            fresh = fresh.join(self.read(), KEY, "left_anti")
        fresh.mapInPandas(_parse, DICTIONARY).write.mode("append").parquet(self.path)
        return self

    def attach(self, rows: DataFrame, key: str, as_name: str, salt: F.Column) -> DataFrame:
        """``rows`` with the instant (seconds) of ``key``; null keys keep out of the shuffle."""
        salted = (
            self.read()
            .select(F.struct(*KEY).alias("_key"), F.col("instant").alias(as_name))
            .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        )
        with_key = rows.filter(F.col(key).isNotNull()).withColumn("_salt", F.pmod(F.hash(salt), F.lit(SALTS)))
        joined = with_key.join(salted, (with_key[key] == salted["_key"]) & (with_key["_salt"] == salted["_salt"]), "left")
        joined = joined.select(*[with_key[c] for c in rows.columns], salted[as_name])
        return joined.unionByName(rows.filter(F.col(key).isNull()).withColumn(as_name, F.lit(None).cast("long")))


def zoned(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """``rows`` with ``_zone``: that of their ``source_id``, the default for unknown sources."""
    zones = sources.filter("id is not null").groupBy("id").agg(F.min("timezone").alias("_typed"))
    zones = broadcast_if_small(zones.select(F.col("id").alias("_sid"), zone_name("_typed").alias("_zone")))
    out = rows.join(zones, rows["source_id"] == zones["_sid"], "left").drop("_sid")
    return out.withColumn("_zone", F.coalesce("_zone", F.lit(DEFAULT_ZONE)))


def starts(
    rows: DataFrame, sources: DataFrame, dictionary: TimestampDictionary | None = None
) -> DataFrame:
    """Every row with its start: ``_ord``, ``instant`` (seconds), ``canonical`` (already in form).

    Usable ``starts_at`` decides, otherwise ``raw_date_text``.  Null or empty texts, texts
    without a date or without a clock time and undecided dates give a null instant;
    repeated rows give repeated results; an empty table gives an empty one.
    """
    dictionary = dictionary or TimestampDictionary(rows.sparkSession)
    held = rows.filter("_ord is not null").select("_ord", "source_id", "starts_at", "raw_date_text", "fetched_at")
    base = zoned(held, sources)
    is_canonical = F.coalesce(F.col("starts_at").rlike(CANONICAL), F.lit(False))
    direct = F.try_to_timestamp(F.substring("starts_at", 1, 19), F.lit("yyyy-MM-dd'T'HH:mm:ss"))
    keyed = base.select(
        "_ord",
        is_canonical.alias("canonical"),
        F.when(is_canonical, F.unix_timestamp(direct)).alias("_direct"),
        F.when(~is_canonical, date_key("starts_at", "_zone", "fetched_at")).alias("_first"),
        F.when(~is_canonical, date_key("raw_date_text", "_zone", "fetched_at")).alias("_second"),
    )
    keyed = keyed.withColumn("_second", F.when(~F.coalesce(F.col("_first.text") == F.col("_second.text"), F.lit(False)), F.col("_second")))
    dictionary.add(keyed.select(F.explode(F.array("_first", "_second")).alias("key")))
    salt = F.col("_ord")
    out = dictionary.attach(keyed, "_first", "_a", salt)
    # the second text is looked up only where the first told nothing
    out = out.withColumn("_second", F.when(F.col("_a").isNull(), F.col("_second")))
    out = dictionary.attach(out, "_second", "_b", salt)
    return out.select("_ord", F.coalesce("_direct", "_a", "_b").alias("instant"), "canonical")


def normalised_starts(rows: DataFrame, sources: DataFrame, dictionary: TimestampDictionary | None = None) -> DataFrame:
    """``_ord`` and ``starts_at_utc`` of the rows whose start was not in form but can be told."""
    found = starts(rows, sources, dictionary).filter(~F.col("canonical") & F.col("instant").isNotNull())
    return found.select("_ord", F.date_format(F.timestamp_seconds("instant"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("starts_at_utc"))
