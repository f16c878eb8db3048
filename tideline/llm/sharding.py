"""Uniform sharding with exact shard sizes by a hypergeometric communication matrix."""

from __future__ import annotations

from collections import OrderedDict

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from tideline.llm.common import checkpointed, quoted, without

ADDED = ("shard", "slot")


def shard_sizes(rows, shards):
    """Shard sizes at most one apart; the first ``rows % shards`` hold one more."""
    return [rows // shards + (s < rows % shards) for s in range(shards)]


# numpy draws from populations below this only.
NUMPY_LIMIT = 1_000_000_000


def _marginals(draw, room, count):
    """One row of the matrix, shard after shard, from a population of any size."""
    sent, left = np.zeros(len(room), dtype=np.int64), int(room.sum())
    for shard, good in enumerate(room.tolist()):
        left -= good
        sent[shard] = hypergeometric(draw, good, left, count)
        count -= int(sent[shard])
    return sent


def hypergeometric(draw, good, bad, count):
    """How many of ``count`` draws without replacement are good, by inversion around the mode.

    Chances follow from the ratio of neighbours. Fifteen deviations to either side hold all
    but a share far below what double precision can tell.
    """
    low, high = max(0, count - bad), min(good, count)
    if low == high:
        return low
    whole = good + bad
    mode = min(high, max(low, (good + 1) * (count + 1) // (whole + 2)))
    spread = int(15 * (count * (good / whole) * (bad / whole)) ** 0.5) + 50
    k = np.arange(max(low, mode - spread), min(high, mode + spread) + 1, dtype=np.int64)
    at = k[:-1].astype(float)
    steps = np.log(good - at) + np.log(count - at) - np.log(at + 1) - np.log(bad - count + at + 1)
    chance = np.concatenate([[0.0], np.cumsum(steps)])
    chance = np.cumsum(np.exp(chance - chance.max()))
    return int(k[np.searchsorted(chance, draw.random() * chance[-1], side="right").clip(max=len(k) - 1)])


def communication_matrix(counts, sizes, seed):
    """How many rows each input partition sends to each shard.

    The matrix has row sums ``counts`` and column sums ``sizes`` and is drawn as a uniform
    permutation of all rows would fill it: each partition in turn draws, without
    replacement, from the room that is left in the shards.
    """
    draw = np.random.default_rng(seed)
    room = np.asarray(sizes, dtype=np.int64)
    for count in counts:
        sent = (draw.multivariate_hypergeometric(room, count, method="marginals") if room.sum() < NUMPY_LIMIT
                else _marginals(draw, room, count))
        room = room - sent
        yield sent


def shard(docs, shards=24, seed=17, rows_per_block=1 << 16):
    """Shuffle all rows uniformly into ``shards`` shards whose sizes are at most one apart.

    Adds ``shard`` (0 to ``shards`` - 1) and ``slot`` (gapless from 0 in each shard).

    1. Rows get their place (input partition, position) and are checkpointed, so the counts
       and the draws below hold even when executors are lost.
    2. The driver draws the communication matrix from the rows per partition: ``shards``
       numbers for each partition, no rows.
    3. Each partition permutes its positions and deals them to the shards by its matrix row.
    4. Rows of a shard are exchanged by blocks of about ``rows_per_block`` rows along a
       second random key and take their slots in its order, which permutes the shard.

    Partitions and blocks bound what a task holds, whatever the size of a shard. Equal and
    repeated rows are placed one by one. Nulls need no care: no column is looked at. An
    empty table gives no rows. Columns of ``docs`` named like an added column are replaced.
    The placement follows the seed and the input's partitions.
    """
    spark = docs.sparkSession
    base = without(docs, *ADDED)
    number = F.monotonically_increasing_id()
    rows = checkpointed(base.select("*", F.shiftright(number, 33).cast("int").alias("__part"),
                                    number.bitwiseAND((1 << 33) - 1).alias("__pos")))
    counts = sorted((r["__part"], r["count"]) for r in rows.groupBy("__part").count().toLocalIterator())
    sizes = shard_sizes(sum(n for _, n in counts), shards)
    matrix = communication_matrix([n for _, n in counts], sizes, seed)
    deal = spark.createDataFrame(
        [(part, n, sent.cumsum().tolist()) for (part, n), sent in zip(counts, matrix)],
        "__in int, __rows long, __ends array<long>")

    place = _permuted(seed)("__part", "__pos", "__rows")
    dealt = (rows.join(deal, F.col("__part") == F.col("__in"))
             .withColumn("__place", place)
             .withColumn("shard", sum((F.col("__place") >= F.col("__ends")[s]).cast("int")
                                      for s in range(shards - 1)) if shards > 1 else F.lit(0))
             .withColumn("__key", F.xxhash64(F.lit(seed), "__part", "__pos")))
    bits = max(0, (max(sizes, default=0) // rows_per_block).bit_length())
    block = F.shiftrightunsigned("__key", 64 - bits) if bits else F.lit(0).cast("long")
    dealt = dealt.withColumn("__block", block)

    # Blocks per shard are few, so their running sum is a small window.
    filled = dealt.groupBy("shard", "__block").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("shard").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    first = filled.select(F.col("shard").alias("__shard"), F.col("__block").alias("__of"),
                          F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__first"))
    within = Window.partitionBy("shard", "__block").orderBy(
        F.shiftleft("__key", bits), "__part", "__pos")
    return (dealt.join(first, (F.col("shard") == F.col("__shard")) & (F.col("__block") == F.col("__of")))
            .withColumn("slot", (F.col("__first") + F.row_number().over(within) - 1).cast("long"))
            .select(*quoted(base.columns), *ADDED))


def _permuted(seed):
    """A pandas UDF: position -> its place after the partition's own permutation."""
    orders = OrderedDict()

    def order(part, rows):
        if part not in orders:
            if len(orders) > 1:
                orders.popitem(last=False)
            orders[part] = np.random.default_rng([seed, part]).permutation(rows)
        return orders[part]

    @F.pandas_udf("long")
    def place(part: pd.Series, pos: pd.Series, rows: pd.Series) -> pd.Series:
        out = np.empty(len(part), dtype=np.int64)
        parts, at = part.to_numpy(), pos.to_numpy()
        for p in np.unique(parts):
            here = parts == p
            out[here] = order(int(p), int(rows[here].iloc[0]))[at[here]]
        return pd.Series(out)

    return place
