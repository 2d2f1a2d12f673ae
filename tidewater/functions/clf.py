"""Common Log Format parsing with built-in regex expressions (no Python per row)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's parser: the access-log pattern
# (nine groups, anchored at the start only) and the timestamp layout
# '%d/%b/%Y:%H:%M:%S %z' written in Spark's datetime pattern language.
CLF_PATTERN = r'^(\S+) (\S+) (\S+) \[([\w:/]+\s[+\-]\d{4})\] "(\S+) (\S+)\s*(\S*)\s*" (\d{3}) (\S+)'
CLF_TIME_FORMAT = "dd/MMM/yyyy:HH:mm:ss Z"

CLF_FIELDS = ["ipAddress", "clientIdentd", "userId", "dateTime", "timestamp", "date",
              "method", "endpoint", "protocol", "responseCode", "contentSize"]


# Separator for the one-pass split; lines that contain it take the per-group path.
_SEP = "\u0001"
_JOINED = _SEP.join(f"${i}" for i in range(1, 10))


def clf_group(value: Column, i: int) -> Column:
    return F.regexp_extract(value, CLF_PATTERN, i)


def clf_matches(value: Column) -> Column:
    return value.rlike(CLF_PATTERN)


def clf_groups(value: Column) -> Column:
    """The nine groups as ``array<string>``, null when the line does not match.

    One regex pass per line: the match is rewritten to the groups joined by a
    control character and split again. A line that already contains that character
    (never a real log line) is parsed group by group instead.
    """
    fast = F.split(F.regexp_replace(value, CLF_PATTERN + r"[\s\S]*", _JOINED), _SEP)
    slow = F.when(clf_matches(value), F.array(*[clf_group(value, i) for i in range(1, 10)]))
    return F.when(value.contains(_SEP), slow).otherwise(F.when(F.size(fast) == 9, fast))


def content_size(text: Column) -> Column:
    """``-`` → 0, otherwise an int; anything else is null (the row is then rejected)."""
    return F.when(text == "-", F.lit(0)).otherwise(text.try_cast("int"))


def clf_instant(date_time: Column) -> Column:
    """Instant of ``dd/MMM/yyyy:HH:mm:ss ±hhmm``; null if it does not parse."""
    return F.try_to_timestamp(date_time, F.lit(CLF_TIME_FORMAT))


def clf_local_date(date_time: Column) -> Column:
    """Calendar date in the line's own offset, taken from the text (not from the instant,
    which the session zone would shift)."""
    return F.try_to_date(F.substring(date_time, 1, 11), "dd/MMM/yyyy")


def clf_columns(groups: Column) -> list[Column]:
    """The eleven typed columns from the nine groups (see ``clf_groups``)."""
    g = lambda i: groups.getItem(i - 1)
    dt = g(4)
    return [
        g(1).alias("ipAddress"),
        g(2).alias("clientIdentd"),
        g(3).alias("userId"),
        dt.alias("dateTime"),
        clf_instant(dt).cast("double").alias("timestamp"),
        F.date_format(clf_local_date(dt), "yyyy-MM-dd").alias("date"),
        g(5).alias("method"),
        g(6).alias("endpoint"),
        g(7).alias("protocol"),
        g(8).cast("int").alias("responseCode"),
        content_size(g(9)).alias("contentSize"),
    ]


def weekday_of(date_time: Column) -> Column:
    """Day of week of the line's local date, Monday = 0."""
    return F.weekday(clf_local_date(date_time))
