"""Approximate nearest neighbours by multiprobe p-stable hashing."""

from __future__ import annotations

from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from tideline.llm.common import checkpointed

SCHEMA = "__query long, __at long, __other long, __id long, __score double"
# Queries that a task compares at once.
TOGETHER = 128


class Tables:
    """Hash tables over a block of points, probed in the order of estimated success.

    A hash is ``floor((a . v + b) / width)`` with Gaussian ``a``; a bucket is ``hashes`` of
    them. The chance that a near point lies one cell up or down falls with the squared
    distance to that cell's edge, so perturbations are visited by the sum of these.
    Perturbations change up to ``changes`` hashes.
    """

    def __init__(self, dims, tables, hashes, width, probes, seed, changes=2):
        draw = np.random.default_rng(seed)
        self.width = width
        self.lines = draw.normal(size=(tables, dims, hashes))
        self.shift = draw.uniform(0, width, (tables, hashes))
        self.code = draw.integers(1, 1 << 62, hashes) | 1
        moves = [dict(zip(which, signs)) for n in range(changes + 1) for which in combinations(range(hashes), n)
                 for signs in product((-1, 1), repeat=n)]
        self.moves = np.array([[m.get(h, 0) for h in range(hashes)] for m in moves])
        self.probes = min(probes, len(moves))

    def cells(self, points, table):
        at = (points @ self.lines[table] + self.shift[table]) / self.width
        cell = np.floor(at)
        return cell.astype(np.int64), at - cell

    def build(self, points):
        """Per table the bucket codes in use, and the bucket of each point."""
        self.buckets = [np.unique(self.cells(points, t)[0] @ self.code, return_inverse=True)
                        for t in range(len(self.lines))]

    def candidates(self, queries, count):
        """Which of the ``count`` points each query meets in any table."""
        met = np.zeros((len(queries), count), dtype=bool)
        for t, (codes, bucket) in enumerate(self.buckets):
            cell, rest = self.cells(queries, t)
            cost = (1 - rest) ** 2 @ (self.moves == 1).T + rest ** 2 @ (self.moves == -1).T
            best = np.argpartition(cost, self.probes - 1, axis=1)[:, :self.probes]
            probes = (cell @ self.code)[:, None] + (self.moves @ self.code)[best]
            at = np.minimum(np.searchsorted(codes, probes), len(codes) - 1)
            seen = np.zeros((len(queries), len(codes)), dtype=bool)
            row, column = np.nonzero(codes[at] == probes)
            seen[row, at[row, column]] = True
            met |= seen[:, bucket]
        return met


def usable(vector):
    """Whether a vector takes part: not null, no null or non-finite component, not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def nearest(points, is_query, vector="embedding", id="vec_id", top=20, tables=8, hashes=10, width=3.0,
            probes=50, seed=3):
    """The ``top`` points with the largest inner product for every query point.

    ``is_query`` is a condition on ``points``; candidates are all other rows. Returns
    ``query_id, rank, vec_id, score``, nearest first, ties to the smaller id.

    The largest inner product is a nearest neighbour once every point gets one more
    component that lifts it to the largest length of all, and every query is scaled to
    that length. Points are dealt to blocks, as many as the square root of their number
    over 256. A task holds a block's hash tables; queries visit every block, find
    candidates in its tables, and candidates are ranked by the exact inner product in
    double precision. Blocks give their ``top`` per query, which are merged. A block in
    which a query meets fewer than ``top`` points is searched in full.

    A bucket of very many equal points spreads over all blocks. Null vectors, zero
    vectors, vectors with null or non-finite components and vectors of another length
    than most have (ties: the longer) take no part, nor do rows without id. Repeated rows are points of their own.
    An empty table gives no rows.
    """
    v = F.col(f"`{vector}`").cast("array<double>")
    rows = checkpointed(points.select(
        F.col(f"`{id}`").cast("long").alias("__id"), v.alias("__v"), F.coalesce(is_query, F.lit(False)).alias("__q"),
        F.monotonically_increasing_id().alias("__at")).filter(usable(F.col("__v")) & F.col("__id").isNotNull()))
    square = F.aggregate("__v", F.lit(0.0), lambda s, x: s + x * x)
    found = (rows.groupBy(F.size("__v").alias("d")).agg(F.count(F.lit(1)).alias("n"), F.max(F.sqrt(square)).alias("l"))
             .orderBy(F.desc("n"), F.desc("d")).first())
    dims, count, length = found or (1, 0, 1.0)
    blocks = max(1, round((count / 256) ** 0.5))
    rows = rows.filter(F.size("__v") == dims)
    members = rows.withColumns({"__block": F.pmod(F.xxhash64("__at"), F.lit(blocks)).cast("long"), "__q": F.lit(False)})
    queries = rows.filter("__q").withColumn("__block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    # False sorts first: a block's points arrive before its queries.
    dealt = (members.unionByName(queries).repartition(blocks, "__block").sortWithinPartitions("__block", "__q", "__id")
             .select("__block", "__q", "__id", "__at", "__v"))
    settings = dims + 1, tables, hashes, width, probes, seed

    found = dealt.mapInArrow(_search(settings, dims, length, top), SCHEMA)
    order = Window.partitionBy("__query", "__at").orderBy(F.desc("__score"), "__id", "__other")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
            .select(F.col("__query").alias("query_id"), "rank", F.col("__id").alias("vec_id"), F.col("__score").alias("score")))


def _search(settings, dims, length, top):
    def task(batches):
        index, block, members, searched = Tables(*settings), None, [], None
        for batch in batches:
            blocks, is_query, ids, at = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            vectors = batch.column(4).flatten().to_numpy().reshape(-1, dims)
            for b in np.unique(blocks):
                here = blocks == b
                if b != block:
                    block, members, searched = b, [], None
                new = here & ~is_query
                if new.any():
                    members.append((ids[new], at[new], vectors[new]))
                asked = np.flatnonzero(here & is_query)
                if asked.size and members:
                    # All points of the block have come.
                    searched = _Block(index, length, *map(np.concatenate, zip(*members)))
                    members = []
                for i in range(0, len(asked) if searched else 0, TOGETHER):
                    some = asked[i:i + TOGETHER]
                    yield searched.search(ids[some], at[some], vectors[some], top)

    return task


class _Block:
    """The points of one block with their hash tables."""

    def __init__(self, index, length, ids, at, vectors):
        self.index, self.ids, self.at, self.vectors = index, ids, at, vectors
        scaled = self.vectors / length
        lift = np.sqrt(np.maximum(0.0, 1.0 - (scaled * scaled).sum(axis=1)))
        index.build(np.column_stack([scaled, lift]))

    def search(self, ids, at, queries, top):
        unit = queries / np.sqrt((queries * queries).sum(axis=1, keepdims=True))
        met = self.index.candidates(np.column_stack([unit, np.zeros(len(unit))]), len(self.ids))
        met[met.sum(axis=1) <= top] = True
        met &= at[:, None] != self.at[None, :]
        rough = np.where(met, queries @ self.vectors.T, -np.inf)
        out = []
        for q, scores in enumerate(rough):
            count = min(top, int(met[q].sum()))
            if not count:
                continue
            # Rounding of the matrix product must not decide: rank by sums row by row.
            edge = np.partition(scores, len(scores) - count)[len(scores) - count]
            near = np.flatnonzero(met[q] & (scores >= edge - 1e-9 * (1.0 + abs(edge))))
            exact = (self.vectors[near] * queries[q]).sum(axis=1)
            near, exact = (x[np.lexsort((self.at[near], self.ids[near], -exact))[:count]] for x in (near, exact))
            out.append((np.full(count, ids[q]), np.full(count, at[q]), self.at[near], self.ids[near], exact))
        columns = [np.concatenate(c) for c in zip(*out)] if out else [np.empty(0, np.int64)] * 4 + [np.empty(0)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["__query", "__at", "__other", "__id", "__score"])
