"""Table functions in Python over a partitioned table argument.

Rows of a partition pass in order through one object, which holds a state of
fixed size and emits rows as it goes. They are made by a call so that Spark
ships them with their code. Partitions should be bounded by their keys: a day of
a user rather than all of a user's rows.
"""

from __future__ import annotations

from pyspark.sql.functions import udtf


def visits(gap_minutes: int):
    """``f(TABLE(key, day, ts) PARTITION BY (key, day) ORDER BY ts)``: runs of rows with gaps of ``gap_minutes`` at most.

    Gives (key, day, visit, started, ended, n_events), visits numbered from 1
    within a key and day. Rows without a time belong to no visit.
    """

    @udtf(returnType="key bigint, day date, visit int, started timestamp, ended timestamp, n_events bigint")
    class Visits:
        def __init__(self):
            self.open = None
            self.visit = 0

        def eval(self, row):
            from datetime import timedelta

            ts = row["ts"]
            if ts is None:
                return
            if self.open is not None and ts - self.open[3] <= timedelta(minutes=gap_minutes):
                self.open[3] = ts
                self.open[4] += 1
                return
            yield from self.terminate()
            self.open = [row["key"], row["day"], ts, ts, 1]

        def terminate(self):
            if self.open is not None:
                self.visit += 1
                key, day, started, ended, n = self.open
                self.open = None
                yield key, day, self.visit, started, ended, n

    return Visits
