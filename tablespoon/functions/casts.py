"""Lenient casts: a bad value becomes zero (numbers) or null (times), never an error.

The functions take a column name, or any SQL text, and the type it has; text is
the default because landed numbers are read as text. They are written in SQL, as
one text is one round trip to the JVM where a tree of column calls is dozens.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOCAL_ZONE = "Asia/Ho_Chi_Minh"

# A failed try_cast costs an exception per row, so text is matched before it is
# cast and bad values never get that far. Java also reads "1d" and "0x1p3" as
# numbers; neither is one in the data. The first two patterns only match numbers
# that fit; the third also matches those that may be too large.
_WHOLE = r"^\s*[+-]?\d{1,18}\s*$"
_NUMBER = r"^\s*[+-]?(?:\d{1,200}\.?\d*|\.\d+)(?:[eE][+-]?\d{1,2})?\s*$"
_LARGE = r"^\s*[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?\s*$"
_INFINITY = r"^\s*[+-]?(?i:inf|infinity)\s*$"

# ISO 8601, extended form. One match decides for nearly all rows.
_TIME = r"\d{1,2}(?::\d{1,2}(?::\d{1,2}(?:\.\d+)?)?)?"
_ZONE = r"\s*(?:Z|[+-]\d{1,2}(?::?\d{2})?)"
_ISO = rf"^\s*\d{{4}}(?:-\d{{1,2}}(?:-\d{{1,2}}(?:[T ]{_TIME}(?:{_ZONE}\s*)?)?)?)?$"
# The same without blanks around it, of years that are within range as a whole: such text needs no more looking at.
_YEAR = r"(?:1(?:67[89]|6[89]\d|[7-9]\d\d)|2(?:[01]\d\d|2[0-5]\d|26[01]))"
_PLAIN = rf"\A{_YEAR}(?:-\d{{1,2}}(?:-\d{{1,2}}(?:[T ]{_TIME}(?:{_ZONE})?)?)?)?\z"

_BLANK = r"' \t\n\r\u000B\u000C'"

# Range of a 64-bit nanosecond clock, whole days.
_FIRST_DAY, _AFTER_LAST_DAY = "1677-09-22", "2262-04-12"


def to_float(column: str, source: T.DataType = T.StringType()) -> Column:
    """Double; null, NaN and unreadable text become 0.0."""
    number = f"try_cast({column} AS DOUBLE)"
    if isinstance(source, T.StringType):
        number = (
            f"CASE WHEN rlike({column}, r'{_NUMBER}') THEN {number}"
            f" WHEN rlike({column}, r'{_LARGE}') AND abs({number}) < double('inf') THEN {number}"
            f" WHEN rlike({column}, r'{_INFINITY}') THEN {number} END"
        )
    return F.expr(f"coalesce(nanvl({number}, 0D), 0D)")


def to_int(column: str, source: T.DataType = T.StringType()) -> Column:
    """Long, truncated toward zero; null, unreadable and out-of-range become 0."""
    # doubles from 2**63 on would be cast to the largest long
    fits = "CASE WHEN abs({0}) < 9223372036854775808D THEN try_cast({0} AS BIGINT) END".format
    whole = fits(f"CAST({column} AS DOUBLE)")
    if isinstance(source, T.StringType):  # whole numbers are exact beyond 2**53
        whole = (
            f"CASE WHEN rlike({column}, r'{_WHOLE}') THEN CAST({column} AS BIGINT)"
            f" WHEN rlike({column}, r'{_LARGE}') THEN {fits(f'try_cast({column} AS DOUBLE)')} END"
        )
    elif not isinstance(source, (T.DoubleType, T.FloatType, T.DecimalType)):
        whole = f"CAST({column} AS BIGINT)"
    return F.expr(f"coalesce({whole}, 0L)")


def to_string(column: str) -> Column:
    """Text; null stays null."""
    return F.expr(f"CAST({column} AS STRING)")


def _extended(text: str) -> str:
    """Rewrites the rarer ISO spellings (20240120, 2024/01/20, T2000) into the extended form."""
    rules = [
        (r"^(\d{4})(\d{2})(\d{2})(?=[T ]|$)", "$1-$2-$3"),
        (r"^(\d{4})([/. ])(\d{1,2})\2(\d{1,2})(?=[T ]|$)", "$1-$3-$4"),
        (r"([T ]\d{2})(\d{2})(\d{2})(?=[^:\d]|$)", "$1:$2:$3"),
        (r"([T ]\d{2})(\d{2})(?=[^:\d]|$)", "$1:$2"),
    ]
    result = f"ltrim({text})"
    for pattern, replacement in rules:
        result = f"regexp_replace({result}, r'{pattern}', '{replacement}')"
    return result


def _let(name: str, value: str, body: str) -> str:
    """SQL that has a value under a name, so that it is written and computed once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _readable(text: str) -> str:
    """ISO text within range, else null. One match decides for plain text; the rarer spellings are looked at step
    by step, each step under a name, as it would else be done again wherever its result is used."""
    rare = _let("other", _extended(text), f"CASE WHEN rlike(other, r'{_ISO}') THEN btrim(other, {_BLANK}) END")
    iso = f"CASE WHEN rlike({text}, r'{_ISO}') THEN btrim({text}, {_BLANK}) ELSE {rare} END"
    within = _let("iso", iso, f"CASE WHEN iso >= '{_FIRST_DAY}' AND iso < '{_AFTER_LAST_DAY}' THEN iso END")
    return f"CASE WHEN rlike({text}, r'{_PLAIN}') THEN {text} WHEN {text} IS NOT NULL THEN {within} END"


def _session_is_utc() -> bool:
    return SparkSession.active().conf.get("spark.sql.session.timeZone") in ("UTC", "Etc/UTC", "Z")


def _instant(column: str, source: T.DataType) -> str:
    """A timestamp; only for sessions that run in UTC."""
    text = isinstance(source, T.StringType)
    return f"try_cast({_readable(column)} AS TIMESTAMP)" if text else f"CAST({column} AS TIMESTAMP)"


def _utc(column: str, source: T.DataType) -> str:
    """UTC wall clock time, whatever zone the session runs in."""
    wall_clock = "timestampadd(MICROSECOND, unix_micros({}), TIMESTAMP_NTZ '1970-01-01 00:00:00')".format
    if isinstance(source, T.TimestampType):
        return wall_clock(column)
    if not isinstance(source, T.StringType):
        return f"CAST({column} AS TIMESTAMP_NTZ)"
    iso = _readable(column)
    past_date = f"substring({iso}, 9, 64)"  # past the dashes of the date
    zoned = f"endswith({iso}, 'Z') OR contains({past_date}, '+') OR contains({past_date}, '-')"
    instant = wall_clock(f"try_cast({iso} AS TIMESTAMP)")
    return f"CASE WHEN {zoned} THEN {instant} ELSE try_cast({iso} AS TIMESTAMP_NTZ) END"


def utc_ts(column: str, source: T.DataType = T.StringType()) -> Column:
    """UTC wall clock time (``timestamp_ntz``). Time without a zone counts as UTC;
    unreadable or out-of-range becomes null."""
    if _session_is_utc():
        return F.expr(f"CAST({_instant(column, source)} AS TIMESTAMP_NTZ)")
    return F.expr(_utc(column, source))


def to_local_ts(column: str, source: T.DataType = T.StringType(), zone: str = LOCAL_ZONE) -> Column:
    """Local wall clock time without a zone (``timestamp_ntz``)."""
    if _session_is_utc():
        return F.expr(f"CAST(from_utc_timestamp({_instant(column, source)}, '{zone}') AS TIMESTAMP_NTZ)")
    return F.expr(f"convert_timezone('UTC', '{zone}', {_utc(column, source)})")
