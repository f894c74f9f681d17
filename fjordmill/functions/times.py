"""Epochs, wall times and localised dates as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

APPLE_EPOCH = 978307200  # seconds from 1970 to 2001
DANISH_MONTHS = {"maj": "May", "okt": "Oct"}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ntz(c: Column) -> Column:
    """The UTC wall time of a timestamp, without zone."""
    return F.convert_timezone(F.lit("UTC"), F.lit("UTC"), c.cast("timestamp_ntz"))


def _micros(us: Column) -> Column:
    """Microseconds since 1970 as a wall time in UTC, whatever the session's zone; null out of range."""
    ok = (us > F.lit(-62135596800000000)) & (us < F.lit(253402300800000000))
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    days, rest = F.floor(us / 86_400_000_000), F.pmod(us, F.lit(86_400_000_000))
    return F.when(ok, start + F.make_dt_interval(days.cast("int"), F.lit(0), F.lit(0), (rest / F.lit(1_000_000)).cast("decimal(18,6)")))


def apple_seconds(c: Column | str, shift_hours: int = 0) -> Column:
    """Seconds since 2001 as a wall time, shifted by whole hours; null for null and 0."""
    x = F.nullif(_col(c), F.lit(0.0))
    return _micros(F.round((x + APPLE_EPOCH + 3600 * shift_hours) * 1_000_000).cast("long"))


def unix_millis(c: Column | str) -> Column:
    """Milliseconds since 1970, also as text with a decimal comma, as a UTC wall time; null for null, 0 and other text."""
    x = F.nullif(F.replace(_col(c).cast("string"), F.lit(","), F.lit(".")).try_cast("double"), F.lit(0.0))
    return _micros(F.round(x * 1000).cast("long"))


def unix_micros(c: Column | str, shift_hours: int = 0) -> Column:
    x = F.nullif(_col(c).cast("double"), F.lit(0.0))
    return _micros((x + 3_600_000_000.0 * shift_hours).cast("long"))


def unix_seconds(c: Column | str) -> Column:
    return _micros(F.round(_col(c).cast("double") * 1_000_000).cast("long"))


def social_timestamp(c: Column | str) -> Column:
    """Text: Unix seconds from 2000 on, or an ISO date and time with its offset cut off; years 2000 to 2030, else null."""
    s = _col(c).cast("string")
    number = s.try_cast("double")
    text = F.split_part(s, F.lit("+"), F.lit(1))
    parsed = F.coalesce(F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ss")), F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss"))).cast("timestamp_ntz")
    out = F.when(number.isNotNull(), F.when(number >= 946684800, unix_seconds(number))).otherwise(parsed)
    return F.when(F.year(out).between(2000, 2030), out)


def extractor_timestamp(c: Column | str) -> Column:
    """A number over 1e12 as milliseconds, any other as seconds since 2001; null out of range."""
    x = _col(c).cast("double")
    return F.when(x > 1e12, F.when(x < 2.534e14, unix_millis(x))).otherwise(F.when(F.abs(x) < 2.5e11, apple_seconds(x)))


def seconds_or_millis(c: Column | str) -> Column:
    """1e9 to 1e10 as seconds, over 1e12 as milliseconds, else null."""
    x = _col(c).cast("double")
    return F.when((x >= 1e9) & (x <= 1e10), unix_seconds(x)).when(x > 1e12, F.when(x < 2.534e14, unix_millis(x)))


def to_zone(c: Column | str, zone: str, source: str = "UTC") -> Column:
    """A wall time of one zone as that of another, daylight saving included."""
    return F.convert_timezone(F.lit(source), F.lit(zone), _col(c))


def localised_date(c: Column | str) -> Column:
    """English and Danish dates with a 12-hour or 24-hour time; a text with only a year from 2000 on is its first day."""
    t = F.initcap(F.lower(_col(c)))
    for danish, english in DANISH_MONTHS.items():
        t = F.regexp_replace(t, rf"\b{danish.capitalize()}\b\.?", english)
    t = F.regexp_replace(t, r"\b(Am|Pm)\b", "$1")
    upper = F.regexp_replace(F.regexp_replace(t, r"\bAm\b", "AM"), r"\bPm\b", "PM")
    formats = ["MMM d, yyyy h:mm:ss a", "MMMM d, yyyy h:mm:ss a", "MMM. d, yyyy h:mm:ss a", "d. MMM yyyy HH:mm:ss", "yyyy-MM-dd", "dd/MM/yyyy", "MM/dd/yyyy"]
    year = F.nullif(F.regexp_extract(t, r"20\d{2}", 0), F.lit(""))
    parsed = [F.try_to_timestamp(upper, F.lit(f)) for f in formats] + [F.try_to_timestamp(year, F.lit("yyyy"))]
    return F.coalesce(*parsed).cast("timestamp_ntz")


def iso_text(c: Column | str) -> Column:
    """An ISO text with a blank for T and without Z."""
    return F.replace(F.replace(_col(c), F.lit("T"), F.lit(" ")), F.lit("Z"), F.lit(""))


def timestamp_problem(c: Column | str) -> Column:
    """What is wrong with a numeric timestamp text: missing, parse_error, too_small, pre_2000 or ok."""
    s = _col(c).cast("string")
    x = s.try_cast("double")
    return F.when(s.isNull() | (s == ""), "missing").when(x.isNull(), "parse_error").when(x < 1e8, "too_small").when(x < 946684800, "pre_2000").otherwise("ok")
