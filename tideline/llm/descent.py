"""Near-duplicate embeddings by NN-descent over a neighbour graph."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from tideline.llm.ann import usable
from tideline.llm.common import checkpointed, quoted, written
from tideline.llm.components import components

PAIRS = "src long, dst long, sim double"
# Points that a task compares at once, at the start and around one point.
WINDOW, AROUND = 256, 256


def near_duplicates(rows, vector="embedding", id="vec_id", threshold=0.9, neighbours=12, orders=3, centres=8,
                    settled=0.002, recall=0.98, queries=256, seed=12):
    """Link vectors whose cosine is ``threshold`` or more; one row per vector.

    Equal vectors are one point of the graph, which counts them. Lists of the ``neighbours``
    nearest points start from ``orders`` random orderings, in which windows of points are
    compared. Each round joins the neighbours of every point with each other, where one
    of the two is new to a list, until less than a share ``settled`` of the lists' places
    changes. A list whose last neighbour still reaches the threshold is saturated: it
    grows without end, each round by the links of ``centres`` of its neighbours, until
    rounds find next to nothing. Recall is audited with ``queries`` points chosen by hash
    and as many of those with links, against all points; below ``recall`` another graph
    is started from other orderings and its links are added, as long as it finds any.

    Returns ``vec_id`` (named as ``id``), ``n_links``, ``component_id`` (smallest id
    reachable) and ``kept``. Vectors that are null, empty, zero or hold null or non-finite
    components have no links. Vectors of different lengths are not comparable and link
    only within a length. Repeated rows are vectors of their own; rows without id keep a
    null component of their own but count as links. An empty table gives no rows.
    """
    v = F.col(quoted([vector])[0]).cast("array<double>")
    own = F.col(quoted([id])[0]).cast("long")
    # Lengths of vectors may be extreme; a direction is what counts.
    largest = F.aggregate("v", F.lit(0.0), lambda m, x: F.greatest(m, F.abs(x)))
    table = written(rows.select(own.alias("id"), F.when(usable(v), F.transform(v, lambda x: x + F.lit(0.0))).alias("v")), "vectors")
    classes = (table.filter("v is not null").groupBy("v").agg(F.count(F.lit(1)).alias("copies"), F.min("id").alias("first")))
    classes = written(classes.withColumn("p", F.monotonically_increasing_id())
                      .withColumn("u", F.transform("v", lambda x: x / largest))
                      .withColumn("u", F.transform("u", lambda x: x / F.sqrt(F.aggregate("u", F.lit(0.0), lambda s, y: s + y * y)))),
                      "classes")
    lengths = [r[0] for r in classes.select(F.size("u").alias("d")).distinct().collect()]
    found = None
    for d in sorted(lengths):
        points = classes.filter(F.size("u") == d).select("p", "u")
        links = _links(points, threshold, neighbours, orders, centres, settled, recall, queries, seed)
        found = links if found is None else found.union(links)
    if found is None:
        return table.select(F.col("id").alias(id), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"),
                            F.lit(True).alias("kept"))
    found = written(found, "links")
    weights = classes.select(F.col("p").alias("dst"), "copies")
    near = found.join(weights, "dst").groupBy(F.col("src").alias("p")).agg(F.sum("copies").alias("near"))
    label = written(components(found.select(F.col("src").alias("a"), F.col("dst").alias("b"))), "labels")
    label = label.select(F.col("node").alias("p"), "label")
    members = classes.select("p", "v", "copies", "first").join(near, "p", "left").join(label, "p", "left")
    members = members.withColumn("label", F.coalesce("label", "p"))
    smallest = members.groupBy("label").agg(F.min("first").alias("component_id"))
    members = written(members.join(smallest, "label").select(
        "v", (F.col("copies") - 1 + F.coalesce("near", F.lit(0))).cast("long").alias("n_links"), "component_id"), "members")
    return table.join(members, "v", "left").select(
        F.col("id").alias(id), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
        F.coalesce(F.col("id") == F.coalesce("component_id", "id"), F.lit(True)).alias("kept"))


def _links(points, threshold, neighbours, orders, centres, settled, recall, queries, seed):
    """All links found, in both directions: ``src, dst``."""
    points = checkpointed(points)
    count = points.count()
    links, before = None, -1
    while True:
        graph = _descended(points, count, neighbours, orders, settled, seed)
        new = graph.filter(F.col("sim") >= threshold).select("src", "dst")
        new = new.union(new.select("dst", "src"))
        links = written((new if links is None else links.union(new)).distinct(), "links")
        links, total = _enlarged(points, links, threshold, neighbours, centres, settled, seed)
        if total <= before or _recall(points, links, threshold, queries, seed) >= recall:
            return links
        before, seed = total, seed + 1000


def _dims(points):
    return points.select(F.max(F.size("u"))).first()[0] or 1


def _descended(points, count, neighbours, orders, settled, seed):
    """The neighbour graph ``src, dst, sim`` after rounds of local joins."""
    dims, parts = _dims(points), int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # A partition of an ordering holds several windows.
    pieces = max(1, min(parts, count // (4 * WINDOW)))
    starts = None
    for k in range(orders):
        start = points.mapInArrow(_coded(dims, count, seed + k), "code long, p long, u array<double>").repartitionByRange(
            pieces, "code", "p").sortWithinPartitions("code", "p").mapInArrow(_windows(neighbours), PAIRS)
        starts = start if starts is None else starts.union(start)
    graph = written(_nearest(starts.withColumn("fresh", F.lit(True)), neighbours), "graph")
    rounds = 0
    while True:
        rounds += 1
        both = graph.select("src", "dst", "fresh").union(graph.select("dst", "src", "fresh"))
        both = both.groupBy(F.col("src").alias("c"), F.col("dst").alias("p")).agg(F.max("fresh").alias("fresh"))
        # Around a point with very many others, a random part of them meets in each round.
        crowd = written(both.groupBy("c").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > AROUND), "crowds")
        tile = F.pmod(F.xxhash64("p", "c", F.lit(seed + rounds)), F.ceil(F.col("size") / AROUND))
        both = (both.join(crowd, "c", "left")
                .select("c", F.coalesce(tile, F.lit(0)).cast("long").alias("tile"), "p", "fresh"))
        least = graph.groupBy(F.col("src").alias("p")).agg(F.count(F.lit(1)).alias("k"), F.min("sim").alias("least"))
        known = points.join(least, "p", "left").select(
            "p", "u", F.when(F.col("k") >= neighbours, F.col("least")).otherwise(F.lit(-2.0)).alias("least"))
        around = both.join(known, "p").select("c", "tile", "p", "fresh", "least", "u")
        found = (around.repartition(parts, "c", "tile").sortWithinPartitions("c", "tile", "p")
                 .mapInArrow(_around(), PAIRS))
        old = graph.withColumn("fresh", F.lit(False))
        # What a list already holds keeps its place as old.
        merged = old.union(found.withColumn("fresh", F.lit(True))).groupBy("src", "dst").agg(
            F.max("sim").alias("sim"), F.min("fresh").alias("fresh"))
        graph = written(_nearest(merged, neighbours, distinct=True), "graph")
        changed = graph.filter("fresh").count()
        if changed <= settled * count * neighbours:
            return graph


def _nearest(pairs, neighbours, distinct=False):
    if not distinct:
        pairs = pairs.groupBy("src", "dst").agg(F.max("sim").alias("sim"), F.min("fresh").alias("fresh"))
    order = Window.partitionBy("src").orderBy(F.desc("sim"), "dst")
    return pairs.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= neighbours).drop("nth")


def _enlarged(points, links, threshold, neighbours, centres, settled, seed):
    """Grow saturated lists by the links of their neighbours until next to nothing is new."""
    total, rounds = links.count(), 0
    parts = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    while True:
        rounds += 1
        sizes = links.groupBy("src").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") >= neighbours)
        full = written(links.join(written(sizes, "saturated"), "src"), "full")
        order = Window.partitionBy("src").orderBy(F.xxhash64("src", "dst", F.lit(seed + rounds)))
        some = full.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= centres)
        some = some.select(F.col("src").alias("a"), F.col("dst").alias("c"))
        asked = some.join(links.select(F.col("src").alias("c"), F.col("dst").alias("b")), "c")
        asked = asked.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        asked = asked.join(links.select(F.col("src").alias("a"), F.col("dst").alias("b")), ["a", "b"], "left_anti")
        # All that one point is compared with comes together, in tiles.
        asked = asked.select("a", F.pmod(F.xxhash64("b"), F.lit(16)).alias("tile"), "b")
        pairs = asked.join(points.select(F.col("p").alias("b"), F.col("u").alias("w")), "b").join(
            points.select(F.col("p").alias("a"), "u"), "a").select("a", "b", "u", "w")
        new = written(pairs.mapInArrow(_compared(threshold), "src long, dst long"), "found")
        more = new.count()
        if more:
            links = written(links.union(new).union(new.select("dst", "src")), "links")
        total += 2 * more
        if 2 * more <= settled * total:
            return links, total


def _recall(points, links, threshold, queries, seed):
    """The share of a sample's links that were found, against a scan of all points."""
    def chosen(frame):
        return frame.orderBy(F.xxhash64("p", F.lit(seed)), "p").limit(queries)

    asked = chosen(points.select("p")).union(chosen(links.select(F.col("src").alias("p")).distinct())).distinct()
    asked = points.join(F.broadcast(asked), "p").collect()
    if not asked:
        return 1.0
    ids, vectors = np.array([r["p"] for r in asked]), np.array([r["u"] for r in asked])

    def task(batches):
        for batch in batches:
            if len(batch):
                own = batch.column(0).to_numpy()
                q, at = np.nonzero(vectors @ _matrix(batch.column(1)).T >= threshold)
                apart = ids[q] != own[at]
                yield pa.RecordBatch.from_arrays([pa.array(ids[q][apart]), pa.array(own[at][apart])], names=["src", "dst"])

    true = checkpointed(points.mapInArrow(task, "src long, dst long"))
    total = true.count()
    return true.join(links, ["src", "dst"]).count() / total if total else 1.0


def _matrix(column):
    return column.flatten().to_numpy().reshape(len(column), -1)


def _coded(dims, count, seed):
    """Codes whose first bits say on which sides of random planes a point is, the others how far along a line."""
    bits = max(1, min(24, round(math.log2(max(2, count / WINDOW)))))

    def task(batches):
        draw = np.random.default_rng(seed)
        planes, line = draw.normal(size=(dims, bits)), draw.normal(size=dims)
        for batch in batches:
            if len(batch):
                u = _matrix(batch.column(1))
                code = ((u @ planes > 0) @ (1 << np.arange(bits))).astype(np.int64)
                place = np.clip((u @ line / np.sqrt(line @ line) + 1) * (1 << 30), 0, (1 << 31) - 1).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array((code << 31) | place), batch.column(0), batch.column(1)],
                                                 names=["code", "p", "u"])
    return task


def _pairs(src, dst, sim):
    return pa.RecordBatch.from_arrays([pa.array(src, pa.int64()), pa.array(dst, pa.int64()), pa.array(sim, pa.float64())],
                                      names=["src", "dst", "sim"])


def _windows(neighbours):
    """The nearest points of each point in windows of a sorted partition; windows overlap by half."""

    def window(ids, u):
        sim = u @ u.T
        np.fill_diagonal(sim, -3)
        k = min(neighbours, len(ids) - 1)
        best = np.argpartition(-sim, k - 1, axis=1)[:, :k]
        rows = np.repeat(np.arange(len(ids)), k)
        return _pairs(ids[rows], ids[best.ravel()], sim[rows, best.ravel()])

    def task(batches):
        ids, u, done = None, None, 0
        for batch in batches:
            if not len(batch):
                continue
            more, vectors = batch.column(1).to_numpy(), _matrix(batch.column(2))
            ids, u = (more, vectors) if ids is None else (np.concatenate([ids, more]), np.concatenate([u, vectors]))
            at = 0
            while at + WINDOW <= len(ids):
                yield window(ids[at:at + WINDOW], u[at:at + WINDOW])
                at, done = at + WINDOW // 2, done + 1
            ids, u = ids[at:], u[at:]
        if ids is not None and len(ids) > 1 and (not done or len(ids) > WINDOW // 2):
            yield window(ids, u)

    return task


def _around():
    """Compare the points around each centre where one of two is fresh; keep what improves a list."""

    def compare(p, fresh, least, u):
        sim = u @ u.T
        apart = (fresh[:, None] | fresh[None, :]) & (p[:, None] != p[None, :]) & (sim > least[:, None])
        a, b = np.nonzero(apart)
        return p[a], p[b], sim[a, b]

    def task(batches):
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if rest is not None:
                table = pa.concat_tables([rest, table])
            if not len(table):
                continue
            table = table.combine_chunks()
            c, tile, p, fresh, least = (table.column(i).to_numpy() for i in range(5))
            u = _matrix(table.column(5).chunk(0))
            cuts = np.flatnonzero((c[1:] != c[:-1]) | (tile[1:] != tile[:-1])) + 1
            rest = table.slice(cuts[-1] if len(cuts) else 0)
            yield from joined([compare(p[a:b], fresh[a:b], least[a:b], u[a:b])
                               for a, b in zip(np.insert(cuts, 0, 0)[:-1], cuts)])
        if rest is not None and len(rest):
            rest = rest.combine_chunks()
            p, fresh, least = (rest.column(i).to_numpy() for i in (2, 3, 4))
            yield from joined([compare(p, fresh, least, _matrix(rest.column(5).chunk(0)))])

    def joined(found):
        if found:
            src, dst, sim = (np.concatenate(x) for x in zip(*found))
            # The same pair often comes from several centres of a batch.
            if len(src):
                order = np.lexsort((dst, src))
                src, dst, sim = src[order], dst[order], sim[order]
                new = np.ones(len(src), dtype=bool)
                new[1:] = (src[1:] != src[:-1]) | (dst[1:] != dst[:-1])
                yield _pairs(src[new], dst[new], sim[new])

    return task


def _compared(threshold):
    def task(batches):
        for batch in batches:
            if len(batch):
                near = np.einsum("ij,ij->i", _matrix(batch.column(2)), _matrix(batch.column(3))) >= threshold
                yield pa.RecordBatch.from_arrays([c.filter(pa.array(near)) for c in batch.columns[:2]], names=["src", "dst"])
    return task
