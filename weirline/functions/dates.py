"""Dates and times in text, epoch numbers and intervals. Sessions run in UTC."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

STANDARD = "yyyy-MM-dd HH:mm:ss.SSS"


def spark_pattern(pattern: str) -> str:
    """A pattern as users of lenient date formats write it, for Spark's parser: week years meant as years become years, and
    two-digit fields that stand alone also take one digit."""
    pattern = pattern.replace("YYYY", "yyyy")
    return re.sub(r"(?<![A-Za-z])(MM|dd|HH|hh|mm|ss)(?![A-Za-z])", lambda m: m[1][0], pattern)


def parsed(c: Column | str, pattern: str) -> Column:
    """The timestamp in trimmed text; null where it doesn't fit the pattern."""
    return F.try_to_timestamp(F.trim(c), F.lit(spark_pattern(pattern)))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hour_epoch(c) -> Column:
    """HH of epoch seconds."""
    return F.date_format(F.timestamp_seconds(_col(c).cast("long")), "HH")


def day_epoch(c) -> Column:
    """yyyy-MM-dd of epoch seconds."""
    return F.date_format(F.timestamp_seconds(_col(c).cast("long")), "yyyy-MM-dd")


def hour(c, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """HH of a time in text; the text 'error' where it doesn't parse."""
    return F.coalesce(F.date_format(parsed(_col(c), pattern), "HH"), F.lit("error"))


def day(c, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """yyyy-MM-dd of a time in text; the text 'error' where it doesn't parse."""
    return F.coalesce(F.date_format(parsed(_col(c), pattern), "yyyy-MM-dd"), F.lit("error"))


def dt_standardize(c, pattern: str) -> Column:
    """The time in the standard form; blank, null or unparsable gives an empty text."""
    return F.coalesce(F.date_format(parsed(_col(c), pattern), STANDARD), F.lit(""))


def dt_english_format(c, pattern: str, to: str = STANDARD) -> Column:
    """As dt_standardize, for patterns with English month and half-day names."""
    return F.coalesce(F.date_format(parsed(_col(c), pattern), to), F.lit(""))


def epoch_ms_to_string(c, pattern: str = "yyyy-MM-dd HH:mm:ss", zone: str = "GMT") -> Column:
    """Epoch milliseconds in text, formatted in a zone; blank stays blank, anything else unparsable is null."""
    text = F.trim(_col(c).cast("string"))
    ms = text.try_cast("long")
    return F.when(text == "", "").otherwise(
        F.date_format(F.from_utc_timestamp(F.timestamp_millis(ms), zone), pattern.replace("YYYY", "yyyy"))
    )


def now_string(pattern: str = STANDARD) -> Column:
    return F.date_format(F.current_timestamp(), pattern)


def change_date_to_current(c) -> Column:
    """Epoch seconds with today's date and the same time of day."""
    return F.unix_timestamp(F.current_date().cast("timestamp")) + F.pmod(_col(c).cast("long"), F.lit(86400))


def date_subtract(end, start, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Whole seconds from start to end; null if either doesn't parse."""
    ms = F.unix_millis(parsed(_col(end), pattern)) - F.unix_millis(parsed(_col(start), pattern))
    return F.when(ms >= 0, F.floor(ms / 1000)).otherwise(F.ceil(ms / 1000)).cast("long")


def bucket_starts(start, end, seconds: int) -> Column:
    """Starts of the fixed buckets that [start, end] (timestamps) touches; one that begins at the end counts. An interval that
    ends before it starts touches none."""
    s, e = _col(start).cast("timestamp"), _col(end).cast("timestamp")
    first = F.timestamp_seconds(F.floor(F.unix_seconds(s) / seconds) * seconds)
    step = F.make_interval(secs=F.lit(seconds).cast("decimal(18,6)"))
    return F.when(s <= e, F.sequence(first, e, step))


def split_time_range(start, end, seconds: int, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """The buckets an interval in text touches, each as 'start,end' with the end a millisecond before the next."""
    starts = bucket_starts(parsed(_col(start), pattern), parsed(_col(end), pattern), seconds)
    last = F.make_interval(secs=F.lit(seconds - 0.001).cast("decimal(18,6)"))
    return F.transform(
        starts, lambda s: F.concat_ws(",", F.date_format(s, STANDARD), F.date_format(s + last, STANDARD))
    )


def week_day_yesterday() -> Column:
    """Lower-case weekday name of yesterday."""
    return F.lower(F.date_format(F.date_sub(F.current_date(), 1), "EEEE"))
