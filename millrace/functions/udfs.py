"""Python forms of three date functions, fed by Arrow batches.

They exist to show that the built-in forms in :mod:`millrace.functions.dates`
give the same values. Jobs use the built-in forms, which stay in the JVM.
Each is made by a call so that Spark ships the function itself and workers
need not have this package installed.
"""

from __future__ import annotations

import datetime as dt
from zoneinfo import ZoneInfo

from pyspark.sql import functions as F


def is_weekend_udf(zone: str = "America/New_York"):
    @F.udf("int", useArrow=True)
    def weekend(ts):
        if ts is None:
            return None
        aware = ts if ts.tzinfo else ts.replace(tzinfo=dt.timezone.utc)
        return int(aware.astimezone(ZoneInfo(zone)).isoweekday() > 5)

    return weekend


def year_month_udf():
    @F.udf("string", useArrow=True)
    def month(ts):
        return None if ts is None else f"{ts:%Y-%m}"

    return month


def round_up_udf(minutes: int):
    @F.udf("bigint", useArrow=True)
    def rounded(ts):
        if ts is None:
            return None
        aware = ts if ts.tzinfo else ts.replace(tzinfo=dt.timezone.utc)
        micros = (aware - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)) // dt.timedelta(microseconds=1)
        return -(-micros // (minutes * 60_000_000)) * minutes * 60

    return rounded
