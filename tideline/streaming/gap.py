"""First row per key, again only after a silence of that key.

Rows travel to the state and back as Arrow data, many of a bucket of keys in one value,
so that neither a row nor a key costs a step of Python or a call to the state store.
"""

from __future__ import annotations

from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from tideline.streaming.combine import thinned

# Keys share state by their hash. A task deals out this many rows at once.
BUCKETS = 1024
TOGETHER = 100_000
_PACKED = "_bucket bigint, rows binary"


def _bytes(table):
    import pyarrow as pa

    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _table(data):
    import pyarrow as pa

    return pa.ipc.open_stream(data).read_all()


class FirstAfterSilence(StatefulProcessor):
    """Lets a key's row pass when its state is gone; each row renews the state's life.

    The state of a bucket is its keys that are not silent yet, each with the time when
    its silence is over. It goes when the whole bucket has been silent.
    """

    def __init__(self, keys, order, ttl_ms):
        self.keys, self.order, self.ttl_ms = keys, order, ttl_ms

    def init(self, handle):
        self.live = handle.getValueState("live", "keys binary", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues):
        import pyarrow as pa
        import pyarrow.compute as pc

        now = timerValues.getCurrentProcessingTimeInMs()
        least = thinned(pa.concat_tables(_table(row["rows"]) for row in rows), self.keys, self.order)
        seen = self._entries(least.select(self.keys), now + self.ttl_ms, range(least.num_rows))
        if self.live.exists():
            live = _table(self.live.get()[0])
            live = live.filter(pc.greater(live["_until"], now))
            seen = pa.concat_tables([seen, self._entries(live.select(self.keys), live["_until"], [-1] * live.num_rows)])
        # A key that is live has a least position of -1.
        met = seen.group_by(self.keys).aggregate([("_position", "min"), ("_until", "max")])
        until = met.select(self.keys).append_column("_until", met["_until_max"])
        self.live.update((_bytes(until),))
        position = met["_position_min"]
        passing = least.take(position.filter(pc.greater_equal(position, 0)))
        if passing.num_rows:
            yield Row(_bucket=key[0], rows=_bytes(passing))

    @staticmethod
    def _entries(keys, until, positions):
        import pyarrow as pa

        if isinstance(until, int):
            until = pa.array([until] * keys.num_rows, pa.int64())
        return keys.append_column("_until", until).append_column("_position", pa.array(positions, pa.int64()))

    def close(self):
        pass


def _packing(keys, order):
    """Rows of a task, one per key of every ``TOGETHER`` of them, as one value per bucket."""
    def task(batches):
        import pyarrow as pa

        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= TOGETHER:
                yield from packed(pa.Table.from_batches(held))
                held, size = [], 0
        if size:
            yield from packed(pa.Table.from_batches(held))

    def packed(table):
        import numpy as np
        import pyarrow as pa

        rows = thinned(table, keys, order).sort_by("_bucket").combine_chunks()
        bucket = rows["_bucket"].to_numpy()
        begin = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        end = np.append(begin[1:], len(bucket))
        rows = rows.drop_columns("_bucket")
        values = [_bytes(rows.slice(b, e - b)) for b, e in zip(begin, end)]
        yield pa.RecordBatch.from_arrays([pa.array(bucket[begin]), pa.array(values, pa.binary())], names=["_bucket", "rows"])

    return task


def _unpacked(batches):
    for batch in batches:
        for data in batch.column(1).to_pylist():
            yield from _table(data).to_batches()


def first_after_silence_stream(df, keys, order, ttl_ms):
    keys, order = list(keys), list(order)
    dealt = df.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)))
    packed = dealt.mapInArrow(_packing(keys, order), _PACKED)
    passed = packed.groupBy("_bucket").transformWithState(
        FirstAfterSilence(keys, order, ttl_ms), _PACKED, "append", "ProcessingTime")
    return passed.mapInArrow(_unpacked, df.schema)
