"""Zone-free time conversions.

Spark's ``to_date``, ``date_format`` on instants and string parsing follow the
session time zone.  The data is UTC, so every conversion here goes through integer
epoch arithmetic and UTC wall clock (``timestamp_ntz``) and gives the same answer
in any session zone.  All functions are built-ins, so they stay inside codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def representable_ms(ms: Column | str) -> Column:
    """The value itself, or NULL where an instant cannot hold it: instants are 64-bit
    microseconds, and one hostile number must not stop a job with an overflow."""
    ms = _col(ms)
    limit = (2**63 - 1) // 1000
    return F.when(ms.between(F.lit(-limit), F.lit(limit)), ms)


def ms_to_event_time(ms: Column | str) -> Column:
    """Batch event time: epoch ms -> instant with the milliseconds dropped (NULL where
    the instant cannot be represented, see :func:`representable_ms`).

    Equal to ``to_timestamp(from_unixtime(ms / 1000))``: seconds are truncated
    toward zero (-1 ms -> 1970-01-01 00:00:00) and NULL stays NULL.  Integer only:
    ``%`` keeps the sign of the dividend, so ``ms - ms % 1000`` truncates to zero.
    """
    ms = representable_ms(ms)
    return F.timestamp_millis(ms - ms % F.lit(1000))


def ms_to_instant(ms: Column | str) -> Column:
    """Epoch ms -> instant at full millisecond precision; NULL where it cannot be
    represented (see :func:`representable_ms`)."""
    return F.timestamp_millis(representable_ms(ms))


def instant_to_utc(ts: Column | str) -> Column:
    """Instant -> UTC wall clock as ``timestamp_ntz`` (zone-free)."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(_col(ts)), _epoch_ntz())


def utc_to_instant(ntz: Column | str) -> Column:
    """UTC wall clock (``timestamp_ntz``) -> instant (zone-free)."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", _epoch_ntz(), _col(ntz)))


def utc_epoch_ms(ntz: Column | str) -> Column:
    """UTC wall clock (``timestamp_ntz``) -> epoch ms, floored like ``unix_millis``."""
    return F.unix_millis(utc_to_instant(ntz))


def utc_date(ts: Column | str) -> Column:
    """Calendar date of an instant in UTC."""
    return F.to_date(instant_to_utc(ts))


def parse_utc_text(text: Column | str) -> Column:
    """Lenient ISO-8601 parse: a naive string is read as UTC, an explicit zone
    (``Z``, ``+02:00``, ``-0700``, a zone name) is honoured, anything unreadable
    becomes NULL (never an error under ANSI mode).

    The branch is chosen by a cheap test of the string's end rather than by trying
    one parse and falling back to another: a failed timestamp cast is several times
    dearer than a successful one.
    """
    text = _col(text)
    # "-02" ends an offset only after a time of day; in "2015-06-02" it is the day
    has_zone = text.rlike("([A-Za-z]|:[0-9.]+ ?[+-][0-9]{1,2}(:?[0-9]{2})?(:[0-9]{2})?)\\s*$")
    date_only = text.rlike("^\\s*[+-]?[0-9]+(-[0-9]{1,2}){0,2}\\s*$")
    return (
        F.when(has_zone, text.try_cast("timestamp"))
        .when(date_only, utc_to_instant(text.try_cast("timestamp_ntz")))
        .otherwise(F.concat(text, F.lit("Z")).try_cast("timestamp"))
    )


def iso_utc_from_ms(ms: Column | str) -> Column:
    """Epoch ms -> naive UTC ISO text in the form Python's ``isoformat`` gives:
    ``2015-06-02T05:02:12.117000``, without fraction when the millisecond part is 0."""
    ms = _col(ms)
    wall = instant_to_utc(ms_to_instant(ms))
    return F.when(
        F.pmod(ms, F.lit(1000)) == 0, F.date_format(wall, "yyyy-MM-dd'T'HH:mm:ss")
    ).otherwise(F.date_format(wall, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))


def iso_utc_from_instant(ts: Column | str) -> Column:
    """Instant -> naive UTC ISO text (``isoformat`` style, microseconds if any)."""
    wall = instant_to_utc(ts)
    return F.when(
        F.unix_micros(_col(ts)) % F.lit(1_000_000) == 0, F.date_format(wall, "yyyy-MM-dd'T'HH:mm:ss")
    ).otherwise(F.date_format(wall, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))


def long_date_label(ts: Column | str, missing: str = "-") -> Column:
    """``Friday, 18 September 2015`` for an instant (UTC); ``missing`` for NULL."""
    return F.coalesce(F.date_format(instant_to_utc(ts), "EEEE, dd MMMM yyyy"), F.lit(missing))


def long_date_label_of_date(d: Column | str, missing: str = "-") -> Column:
    """``Friday, 18 September 2015`` for a date; ``missing`` for NULL (zone-free)."""
    return F.coalesce(F.date_format(_col(d).cast("timestamp_ntz"), "EEEE, dd MMMM yyyy"), F.lit(missing))


def lenient_timestamp(text: Column | str) -> Column:
    """Result-file timestamp text -> instant, NULL when unreadable (``errors="coerce"``)."""
    return parse_utc_text(text)


def lenient_date(text: Column | str) -> Column:
    """Result-file date text -> date, NULL when unreadable."""
    return _col(text).try_cast("date")
