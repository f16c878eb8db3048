"""Latest row per key, held for a while before it is emitted."""

from __future__ import annotations

from pyspark.sql import Row
from pyspark.sql.streaming import StatefulProcessor

from tideline.streaming.combine import one_per_key, ordering


class LatestHeld(StatefulProcessor):
    """The first row starts a timer; later rows that are not older replace it."""

    def __init__(self, schema, order, hold_ms):
        self.schema, self.order, self.hold_ms = schema, order, hold_ms

    def init(self, handle):
        self.handle = handle
        self.held = handle.getValueState("held", self.schema)

    def _order(self, row):
        names = self.schema.names
        return ordering({c: row[names.index(c)] for c in self.order}, self.order)

    def handleInputRows(self, key, rows, timerValues):
        best = max(rows, key=self._order)
        if not self.held.exists():
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.hold_ms)
            self.held.update(tuple(best))
        elif self._order(best) >= self._order(self.held.get()):
            self.held.update(tuple(best))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if self.held.exists():
            row = Row(*self.schema.names)(*self.held.get())
            self.held.clear()
            yield row

    def close(self):
        pass


def latest_held_stream(df, keys, order, hold_ms):
    thin = one_per_key(df, keys, order, latest=True)
    return thin.groupBy(*keys).transformWithState(
        LatestHeld(df.schema, list(order), hold_ms), df.schema, "append", "ProcessingTime")
