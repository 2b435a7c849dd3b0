"""Time expressions. All of them stay inside generated code."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

MS_PER_DAY = 86_400_000
MS_PER_MINUTE = 60_000


def instant(epoch_ms: Column | str) -> Column:
    """Epoch milliseconds to a timestamp."""
    return F.timestamp_millis(epoch_ms)


def text_date(text: Column | str) -> Column:
    """``YYYY-MM-DD`` text to a date; other text is an error under ANSI.

    A cast reads such text several times faster than a pattern does.
    """
    return (F.col(text) if isinstance(text, str) else text).cast("date")


def midnight_ms(text: Column | str) -> Column:
    """``YYYY-MM-DD`` text to the epoch milliseconds of its UTC midnight."""
    return F.unix_date(text_date(text)).cast("bigint") * F.lit(MS_PER_DAY)


def age_minutes(at: Column | str, epoch_ms: Column | str) -> Column:
    """Whole minutes from ``epoch_ms`` to the second of ``at``, cut toward zero.

    Negative when ``epoch_ms`` is the later one.
    """
    at_ms = F.unix_seconds(at) * F.lit(1000)
    since = F.col(epoch_ms) if isinstance(epoch_ms, str) else epoch_ms
    return F.call_function("div", at_ms - since, F.lit(MS_PER_MINUTE))


def as_of_column(as_of: Column | datetime | str | None) -> Column:
    """The report time: a column, a literal, or now."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of.cast("timestamp")
    return F.lit(as_of).cast("timestamp")
