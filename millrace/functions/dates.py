"""Date and time columns. Times without a zone are taken as UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def coerce_timestamp(column: str | Column) -> Column:
    """Text to timestamp; null where the text is no valid time."""
    return F.try_to_timestamp(_col(column))


def year_month(ts: str | Column) -> Column:
    """Partition value ``YYYY-MM``."""
    return F.date_format(_col(ts), "yyyy-MM")


def is_weekend(ts: str | Column, zone: str = "America/New_York") -> Column:
    """1 when the UTC time falls on Saturday or Sunday in ``zone``, else 0."""
    local = F.convert_timezone(F.lit("UTC"), F.lit(zone), _col(ts).cast("timestamp_ntz"))
    return F.dayofweek(local).isin(1, 7).cast("int")


def round_up(ts: str | Column, minutes: int) -> Column:
    """Unix seconds of the next multiple of ``minutes``; a time on the boundary stays."""
    micros = _micros(ts)
    return _seconds(micros + F.pmod(-micros, _step(minutes)))


def round_down(ts: str | Column, minutes: int) -> Column:
    micros = _micros(ts)
    return _seconds(micros - F.pmod(micros, _step(minutes)))


def _micros(ts: str | Column) -> Column:
    return F.unix_micros(_col(ts).cast("timestamp"))


def _seconds(whole: Column) -> Column:
    return (whole / 1_000_000).cast("bigint")


def _step(minutes: int) -> Column:
    return F.lit(minutes * 60 * 1_000_000).cast("bigint")


def epoch_to_timestamp(seconds: str | Column) -> Column:
    """Text or number of Unix seconds to timestamp; null where it is no number."""
    return F.timestamp_seconds(_col(seconds).try_cast("bigint"))


def shift_days(date_text: str | Column, days: int) -> Column:
    """Move the date part of an ISO time text and keep the rest of the text."""
    text = _col(date_text)
    day = F.date_add(F.to_date(F.substring(text, 1, 10)), days)
    return F.concat(F.date_format(day, "yyyy-MM-dd"), F.substr(text, F.lit(11)))
