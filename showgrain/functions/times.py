"""Date and time functions as Spark columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from showgrain.functions.columns import _col

# --- fixed values -----------------------------------------------------------------
MONTHS = {"jan": 1, "feb": 2, "mar": 3, "apr": 4, "may": 5, "jun": 6, "jul": 7, "aug": 8, "sep": 9, "oct": 10, "nov": 11, "dec": 12}
# ----------------------------------------------------------------------------------


def wall_to_utc(wall: Column | str, zone: Column | str, one_pass: bool = False) -> Column:
    """UTC instant of a wall time.  one_pass: take the offset that holds at the wall time read as UTC,
    which is off by the gap for some hours on the days clocks change."""
    wall, zone = _col(wall).cast("timestamp"), _col(zone)
    if not one_pass:
        return F.to_utc_timestamp(wall, zone)
    offset = F.unix_timestamp(F.from_utc_timestamp(wall, zone)) - F.unix_timestamp(wall)
    return F.timestamp_seconds(F.unix_timestamp(wall) - offset)


def parse_clock(c: Column | str) -> Column:
    """Minutes after midnight of a 12- or 24-hour clock text; null where there is none."""
    c = F.lower(_col(c))
    h = F.regexp_extract(c, r"(\d{1,2})(?::(\d{2}))?\s*([ap])\.?m?\b", 1)
    mi = F.regexp_extract(c, r"(\d{1,2})(?::(\d{2}))?\s*([ap])\.?m?\b", 2)
    ap = F.regexp_extract(c, r"(\d{1,2})(?::(\d{2}))?\s*([ap])\.?m?\b", 3)
    num = lambda x: F.coalesce(F.expr("null").cast("int") if x is None else x.try_cast("int"), F.lit(0))
    twelve = F.pmod(num(h), F.lit(12)) * 60 + num(mi) + F.when(ap == "p", 720).otherwise(0)
    h24 = F.regexp_extract(c, r"\b([01]?\d|2[0-3])[:h](\d{2})\b", 1)
    m24 = F.regexp_extract(c, r"\b([01]?\d|2[0-3])[:h](\d{2})\b", 2)
    return F.when((h != "") & num(h).between(1, 12), twelve).when(h24 != "", num(h24) * 60 + num(m24))


def month_number(c: Column | str) -> Column:
    """1 to 12 of a month name or its short form."""
    key = F.lower(F.left(F.trim(_col(c)), F.lit(3)))
    out = F.lit(None).cast("int")
    for name, n in MONTHS.items():
        out = F.when(key == name, n).otherwise(out)
    return out


def infer_year(month: Column | str, day: Column | str, as_of: Column | str, back_days: int = 30) -> Column:
    """The date of a month and day without a year: the first that is not over ``back_days`` past."""
    month, day, as_of = _col(month).cast("int"), _col(day).cast("int"), F.to_date(_col(as_of))
    at = lambda y: F.try_to_date(F.format_string("%04d-%02d-%02d", y, month, day), "yyyy-MM-dd")
    this, following = at(F.year(as_of)), at(F.year(as_of) + 1)
    return F.when(this >= F.date_sub(as_of, back_days), this).otherwise(F.coalesce(following, this))


def nearest_year(month: Column | str, day: Column | str, as_of: Column | str) -> Column:
    """The date of a month and day without a year that lies nearest to ``as_of``."""
    month, day, as_of = _col(month).cast("int"), _col(day).cast("int"), F.to_date(_col(as_of))
    years = [F.try_to_date(F.format_string("%04d-%02d-%02d", F.year(as_of) + k, month, day), "yyyy-MM-dd") for k in (-1, 0, 1)]
    near = F.array_sort(F.array_compact(F.array(*[F.when(y.isNotNull(), F.struct(F.abs(F.date_diff(y, as_of)).alias("d"), y.alias("y"))) for y in years])))
    return F.get(near, 0)["y"]


def roll_overnight(start: Column | str, end: Column | str, equal_rolls: bool = True) -> Column:
    """An end not after its start belongs to the next day."""
    start, end = _col(start), _col(end)
    rolls = end <= start if equal_rolls else end < start
    return F.when(rolls, end + F.expr("interval 1 day")).otherwise(end)


def epoch_or_iso(c: Column | str) -> Column:
    """Instant of an epoch in seconds or milliseconds, or of an ISO text."""
    c = F.trim(_col(c))
    return (
        F.when(c.rlike(r"^\d{13}$"), F.timestamp_millis(c.try_cast("bigint")))
        .when(c.rlike(r"^\d{10}$"), F.timestamp_seconds(c.try_cast("bigint")))
        .otherwise(F.try_to_timestamp(F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}[T ]"), c)))
    )


def ics_instant(value: Column | str) -> Column:
    """A calendar file's date: DATE is midnight, a floating time counts as UTC, as does Z."""
    digits = F.regexp_replace(_col(value), r"[^0-9]", "")
    return F.when(F.length(digits) == 8, F.try_to_timestamp(digits, F.lit("yyyyMMdd"))).when(F.length(digits) == 14, F.try_to_timestamp(digits, F.lit("yyyyMMddHHmmss")))


def same_show(a: Column | str, b: Column | str, hours: int = 18) -> Column:
    """Same UTC day, or at most ``hours`` apart."""
    a, b = _col(a), _col(b)
    near = F.abs(F.unix_timestamp(a) - F.unix_timestamp(b)) <= hours * 3600
    return F.coalesce((F.to_date(a) == F.to_date(b)) | near, F.lit(False))


def month_starts(first: Column | str, last: Column | str) -> Column:
    """First days of the months that a range touches."""
    return F.sequence(F.trunc(_col(first), "month"), F.trunc(_col(last), "month"), F.expr("interval 1 month"))


def rolled_year(month: Column | str, day: Column | str, as_of: Column | str, rule: str) -> Column:
    """Year of a month and day without one, by a named rule of a kind of listing.

    'two_months': months over two behind belong to the next year.  'month': months over one
    behind do.  'late_days': so do, from November on, days over one behind in this month; and in
    January and February the last two months belong to the year before.  'winter': only January
    to March, seen from October on, belong to the next year.  'days': the first such date
    that is not over 30 days past.
    """
    month, day, as_of = _col(month).cast("int"), _col(day).cast("int"), F.to_date(_col(as_of))
    year, now, today = F.year(as_of), F.month(as_of), F.dayofmonth(as_of)
    if rule == "two_months":
        return F.when(month < now - 2, year + 1).otherwise(year)
    if rule == "month":
        return F.when(month < now - 1, year + 1).otherwise(year)
    if rule == "late_days":
        behind = (month < now - 1) | ((month == now) & (day + 1 < today) & (now >= 11))
        return F.when((now <= 2) & (month >= 11), year - 1).when(behind, year + 1).otherwise(year)
    if rule == "winter":
        return F.when((now >= 10) & (month <= 3) & (month < now - 1), year + 1).otherwise(year)
    if rule == "days":
        return F.year(infer_year(month, day, as_of))
    raise ValueError(rule)


def paired(dates: Column | str, times: Column | str) -> Column:
    """Array of (date, time): as many distinct times as dates go together in order, else all dates take the first time."""
    d, t = F.array_distinct(F.array_compact(_col(dates))), F.array_distinct(F.array_compact(_col(times)))
    one = lambda x, i: F.struct(x.alias("date"), F.when(F.size(d) == F.size(t), F.get(t, i)).otherwise(F.get(t, 0)).alias("time"))
    return F.when((F.size(d) > 0) & (F.size(t) > 0), F.transform(d, one)).otherwise(F.array().cast("array<struct<date:string,time:string>>"))


def day_range(text: Column | str) -> Column:
    """First and last day of 'Month d-d, yyyy', 'Month d - Month d, yyyy' or a single 'Month d, yyyy'."""
    text = _col(text)
    pattern = r"([A-Za-z]{3,9})\.?\s+(\d{1,2})(?:\s*[-–]\s*(?:([A-Za-z]{3,9})\.?\s+)?(\d{1,2}))?,?\s+(\d{4})"
    part = lambda i: F.regexp_extract(text, pattern, i)
    at = lambda m, d: F.try_to_date(F.format_string("%s-%02d-%02d", part(5), month_number(m), d.try_cast("int")), "yyyy-MM-dd")
    first = at(part(1), part(2))
    last = F.when(part(4) != "", at(F.when(part(3) != "", part(3)).otherwise(part(1)), part(4))).otherwise(first)
    return F.when(part(5) != "", F.struct(first.alias("first"), last.alias("last")))


def url_start(url: Column | str) -> Column:
    """Wall time in a link: /yyyy-mm-dd or /yyyy/mm/dd or -mmddyy (from 70 on of the last century), and -at-h-mm-am or -pm."""
    url = F.lower(_col(url))
    long = r"[/-](\d{4})[-/](\d{2})[-/](\d{2})(?:[/-]|$)"
    short = r"[/-](\d{2})(\d{2})(\d{2})(?:[/-]|$)"
    part = lambda p, i: F.regexp_extract(url, p, i)
    century = F.when(part(short, 3).try_cast("int") >= 70, "19").otherwise("20")
    day = F.when(part(long, 1) != "", F.concat_ws("-", part(long, 1), part(long, 2), part(long, 3))).when(part(short, 1) != "", F.concat(century, part(short, 3), F.lit("-"), part(short, 1), F.lit("-"), part(short, 2)))
    clock = r"-at-(\d{1,2})(?:-(\d{2}))?-?([ap])m"
    minutes = F.when(part(clock, 1) != "", F.pmod(part(clock, 1).try_cast("int"), F.lit(12)) * 60 + F.coalesce(part(clock, 2).try_cast("int"), F.lit(0)) + F.when(part(clock, 3) == "p", 720).otherwise(0)).otherwise(0)
    return F.timestamp_seconds(F.unix_timestamp(F.try_to_timestamp(day, F.lit("yyyy-MM-dd"))) + minutes * 60)


def local_day(instant: Column | str, zone: Column | str, form: str = "EEEE, MMMM d, h:mm a") -> Column:
    """An instant written for readers at a place."""
    return F.date_format(F.from_utc_timestamp(_col(instant), _col(zone)), form)
