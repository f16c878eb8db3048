"""First row per key and day on a stream."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Row
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from tideline.streaming.combine import one_per_key, ordering

_DAY_MS = 24 * 60 * 60 * 1000


class DayChange(StatefulProcessor):
    """Emits a key's first row of each day with ``is_new`` and ``gap_days``.

    State is the last two days seen, which is all a watermark below one day can ask
    for. It is kept for ever unless ``ttl_ms`` of event time is given.
    """

    def __init__(self, day, order, time, ttl_ms):
        self.day, self.order, self.time, self.ttl_ms = day, order, time, ttl_ms

    def init(self, handle):
        self.handle = handle
        self.days = handle.getValueState("days", T.StructType([
            T.StructField("last", T.StringType()),
            T.StructField("before", T.StringType()),
            T.StructField("expires", T.LongType()),
        ]))

    def handleInputRows(self, key, rows, timerValues):
        first = {}
        for row in rows:
            day = row[self.day]
            if day not in first or ordering(row, self.order) < ordering(first[day], self.order):
                first[day] = row
        last, before, expires = self.days.get() if self.days.exists() else (None, None, None)
        changed = False
        for day in sorted(first, key=lambda d: (d is not None, d)):
            if last is not None and day in (last, before):
                continue
            is_new, gap = last is None, None
            if last is None or day is None or day > last:
                if last is not None and day is not None:
                    gap = (date.fromisoformat(day) - date.fromisoformat(last)).days
                last, before = day, last
            else:
                before = day if before is None or day > before else before
            changed = True
            yield Row(**first[day].asDict(), is_new=is_new, gap_days=gap)
        if changed:
            if self.ttl_ms:
                if expires is not None:
                    self.handle.deleteTimer(expires)
                newest = max(row[self.time] for row in first.values())
                expires = int(newest.timestamp() * 1000) + self.ttl_ms
                self.handle.registerTimer(expires)
            self.days.update((last, before, expires))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if self.days.exists() and self.days.get()[2] == expiredTimerInfo.getExpiryTimeInMs():
            self.days.clear()
        return iter([])

    def close(self):
        pass


def first_per_day_stream(df, keys, day, order, time, ttl_days=None):
    thin = one_per_key(df, (*keys, day), order)
    out = T.StructType([*df.schema.fields, T.StructField("is_new", T.BooleanType()),
                        T.StructField("gap_days", T.LongType())])
    processor = DayChange(day, list(order), time, ttl_days * _DAY_MS if ttl_days else None)
    return thin.groupBy(*keys).transformWithState(
        processor, out, "append", "EventTime", eventTimeColumnName=time)
