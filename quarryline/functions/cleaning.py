"""Column expressions for ids, hashes and times; all of them stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What counts as whitespace round ids, hashes and texts.
WHITESPACE = " \t\r\n"

_ISO = (
    r"^(\d{4})(?:-(\d{2})-(\d{2})[Tt ](\d{2}):(\d{2})(?::(\d{2})(?:[.,](\d+))?)?([Zz]|[+-]\d{2}(?::?\d{2})?)?"
    r"|(\d{2})(\d{2})[Tt](\d{2})(\d{2})(?:(\d{2})(?:[.,](\d+))?)?([Zz]|[+-]\d{2}(?:\d{2})?)?)$"
)


def strip(col: Column | str) -> Column:
    """The text without surrounding space, tab, CR and LF; null stays null."""
    return F.btrim(F.col(col) if isinstance(col, str) else col, F.lit(WHITESPACE))


def id_or_null(col: Column | str) -> Column:
    """The stripped id, or null where it is null or blank."""
    return F.nullif(strip(col), F.lit(""))


def epoch_micros(col: Column | str) -> Column:
    """Microseconds since 1970 of an ISO 8601 date and time, basic or extended; null for anything else.

    No offset means UTC. Impossible dates (30 February) and times (25:00) give null. More than six digits of a
    second are cut off. The session's time zone plays no part. The commonest spellings are told by a few characters and cast; of the others, one
    match tells whether it is a time at all, and only what can't be cast is taken apart (inside a lambda, so that it stays out of the generated method,
    which would else be too long to be compiled).
    """
    text = strip(col)
    at = lambda i: F.substring(text, i, 1)
    n = F.length(text)
    ends = (n == 19) | ((n == 20) & (at(20) == "Z")) | ((n == 25) & at(20).isin("+", "-") & (at(23) == ":"))
    common = ends & (at(5) == "-") & (at(8) == "-") & at(11).isin("T", " ") & (at(14) == ":") & (at(17) == ":")
    cast = lambda t: F.unix_micros(t.try_cast("timestamp"))
    tail = F.substring(text, 11, 40)
    zoned = F.contains(tail, F.lit("Z")) | F.contains(tail, F.lit("+")) | F.contains(tail, F.lit("-"))
    utc = F.concat(text, F.lit("Z"))
    return F.coalesce(F.when(common, cast(F.when(n == 19, utc).otherwise(text))), F.when(text.rlike(_ISO), F.coalesce(cast(F.when(zoned, text).otherwise(utc)), F.transform(F.array(text), _by_parts)[0])))


def _by_parts(text: Column) -> Column:
    """The same for any spelling, from the groups of _ISO."""
    part = lambda i, j: F.concat(F.regexp_extract(text, _ISO, i), F.regexp_extract(text, _ISO, j))
    num = lambda i, j: F.nullif(part(i, j), F.lit("")).cast("int")
    zone = F.regexp_replace(part(8, 15), ":", "")
    offset = F.when(zone.rlike(r"^[+-]"), F.when(F.substring(zone, 1, 1) == "-", -1).otherwise(1) * (F.substring(zone, 2, 2).cast("int") * 60 + F.coalesce(F.nullif(F.substring(zone, 4, 2), F.lit("")).cast("int"), F.lit(0)))).otherwise(0)
    second = F.coalesce(num(6, 13), F.lit(0)).cast("decimal(16,6)")
    whole = F.try_make_timestamp(F.regexp_extract(text, _ISO, 1).try_cast("int"), num(2, 9), num(3, 10), num(4, 11), num(5, 12), second, F.lit("UTC"))
    micros = F.rpad(F.substring(part(7, 14), 1, 6), 6, "0").try_cast("long")
    return F.unix_micros(whole) + F.coalesce(micros, F.lit(0)) - offset.cast("long") * 60_000_000


def utc_text(micros: Column | str) -> Column:
    """Microseconds since 1970 as ``YYYY-MM-DDTHH:MM:SSZ``, whatever the session's time zone."""
    m = F.col(micros) if isinstance(micros, str) else micros
    seconds = F.floor(m / 1_000_000).cast("long")
    day = F.floor(seconds / 86_400).cast("int")
    rest = seconds - day.cast("long") * 86_400
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    return F.concat(F.date_add(F.lit("1970-01-01").cast("date"), day).cast("string"), F.lit("T"), two(F.floor(rest / 3600)), F.lit(":"), two(F.floor(rest / 60) % 60), F.lit(":"), two(rest % 60), F.lit("Z"))


def content_digest(col: Column | str) -> Column:
    """A content hash in one spelling: lower case, stripped, without a leading ``sha256:``; null where unknown."""
    return id_or_null(F.regexp_replace(F.lower(strip(col)), "^sha256:", ""))


def month_of(timestamp: Column | str) -> Column:
    """``YYYY-MM`` of a timestamp without zone."""
    return F.substring((F.col(timestamp) if isinstance(timestamp, str) else timestamp).cast("timestamp_ntz").cast("string"), 1, 7)
