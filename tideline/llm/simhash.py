"""SimHash near-duplicates with pivot distance tables."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from tideline.llm.common import checkpointed, quoted, written
from tideline.llm.components import components

HASH_SEED = 42
# Hashes of a long text are counted in runs of this many.
CHUNK = 1 << 16


def fingerprint_of(data, shingle):
    """The fingerprint of a text in UTF-8: 64 bits as a signed number.

    A-Z fold to lower case; ``bytes.split`` cuts at space and 0x09 to 0x0D. A bit is set
    when it is set in over half of the shingles' hashes, repeats included. A text with
    fewer words than a shingle has one shingle, all its words; without words it gives 0.
    """
    words = data.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    span = min(shingle, len(words))
    starts, ends = starts[:len(words) - span + 1].tolist(), ends[span - 1:].tolist()
    hashed = xxhash.xxh64_intdigest
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(starts), CHUNK):
        hashes = np.array([hashed(line[s:e], HASH_SEED) for s, e in zip(starts[at:at + CHUNK], ends[at:at + CHUNK])],
                          dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view("<i8")[0])


def fingerprints(text, shingle=3):
    """Column of the fingerprints of a text column; null text has no words."""
    @F.arrow_udf("long")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint_of(t or b"", shingle) for t in texts.cast(pa.binary()).to_pylist()], pa.int64())

    return of(F.coalesce(text, F.lit("")))


def pivots(count, seed=7):
    """Reference fingerprints: fixed random 64-bit words."""
    return np.random.default_rng(seed).integers(0, 1 << 64, count, dtype=np.uint64)


def links(classes, max_bits=3, references=16, tile=4096):
    """Links (``a``, ``b``) that join all fingerprints of ``classes.fp`` within ``max_bits`` bits.

    ``classes`` has distinct fingerprints. Not every close pair is returned, but enough to
    connect what close pairs connect.

    Candidate buckets: of ``max_bits`` + 2 blocks of bits, a close pair has two in common,
    so each fingerprint enters a bucket for every two blocks. Within a bucket, distances
    to the reference fingerprints form a pivot table: by the triangle inequality a pair
    whose distances to any reference differ by more than ``max_bits`` is discarded; the
    survivors are verified on the fingerprints. A bucket gives stars, not pairs.

    A bucket above ``tile`` rows is cut into parts, and every two parts meet in a task of
    their own, so no bucket has to fit one task.
    """
    masks = _masks(max_bits + 2)
    keyed = classes.select("fp", F.explode(F.array(*[
        F.xxhash64(F.lit(t), F.col("fp").bitwiseAND(F.lit(m))) for t, m in enumerate(masks)])).alias("key"))
    large = (keyed.groupBy("key").count().filter(F.col("count") > tile)
             .select("key", F.ceil(F.col("count") / tile).cast("int").alias("parts")))
    parts = F.coalesce("parts", F.lit(1))
    tiles = (keyed.join(large, "key", "left").withColumn("part", F.pmod(F.xxhash64("fp"), parts).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
             .select("key", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "fp"))
    table = pivots(references)

    def task(batches):
        kept = None
        for batch in batches:
            rows = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1)
            rows = rows if kept is None else np.concatenate([kept, rows])
            # The last bucket may go on in the next batch.
            last = np.flatnonzero((rows[:, :3] != rows[-1, :3]).any(axis=1))
            end = last[-1] + 1 if last.size else 0
            kept = rows[end:]
            yield stars(rows[:end])
        if kept is not None:
            yield stars(kept)

    def stars(rows):
        new = np.ones(len(rows), dtype=bool)
        new[1:] = (rows[1:, :3] != rows[:-1, :3]).any(axis=1)
        node, root = close(np.cumsum(new), rows[:, 3].view(np.uint64), table, max_bits)
        return pa.RecordBatch.from_arrays([pa.array(node.view(np.int64)), pa.array(root.view(np.int64))], names=["a", "b"])

    return (tiles.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")
            .select("key", F.col("low").cast("long"), F.col("high").cast("long"), "fp")
            .mapInArrow(task, "a long, b long"))


def _masks(blocks):
    """For every two of ``blocks`` blocks of the 64 bits, a signed mask of their bits."""
    cuts = [round(64 * b / blocks) for b in range(blocks + 1)]
    bits = [(1 << high) - (1 << low) for low, high in zip(cuts, cuts[1:])]
    return [m - (1 << 64) if m >> 63 else m for m in (a | b for a, b in combinations(bits, 2))]


def close(bucket, fps, references, max_bits):
    """Stars over the close pairs of each bucket: nodes and their centres.

    Rows are ordered by bucket and distance to the first reference, so the partners of a
    row follow it; each round compares rows one step further apart and goes on with those
    whose next partner is still in the bucket and within reach of the first reference.
    """
    tables = np.bitwise_count(fps[:, None] ^ references[None, :]).astype(np.int16)
    order = np.lexsort((tables[:, 0], bucket))
    bucket, fps, tables = bucket[order], fps[order], tables[order]
    root = np.arange(len(fps))
    active, step = np.arange(len(fps)), 0
    while active.size:
        step += 1
        active = active[active + step < len(fps)]
        ahead = active + step
        reach = (bucket[ahead] == bucket[active]) & (tables[ahead, 0] - tables[active, 0] <= max_bits)
        active, ahead = active[reach], ahead[reach]
        here, there = active, ahead
        for t in range(1, tables.shape[1]):
            near = np.abs(tables[there, t] - tables[here, t]) <= max_bits
            here, there = here[near], there[near]
        near = np.bitwise_count(fps[here] ^ fps[there]) <= max_bits
        near &= root[here] != root[there]
        if near.any():
            root = _merged(root, here[near].tolist(), there[near].tolist())
    member = root != np.arange(len(fps))
    return fps[member], fps[root[member]]


def _merged(root, here, there):
    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in zip(here, there):
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    while True:
        up = root[root]
        if (up == root).all():
            return root
        root = up


def near_duplicates(docs, text="text", id="doc_id", shingle=3, max_bits=3, references=16):
    """Give every document its ``fingerprint`` and ``component_id``.

    Documents whose fingerprints differ in at most ``max_bits`` bits are linked; a
    component is all that links reach, and its id is the smallest identifier in it.
    Returns one row per document: ``id``, ``fingerprint`` (16 hexadecimal digits),
    ``component_id``, ``group`` (a fingerprint that names the component, also where
    identifiers repeat) and ``text_key`` (hash of the text, which tells repeated
    identifiers apart); ``docs`` joins on ``id`` and ``text_key``. Only distinct fingerprints meet, so copies cost one.

    Null and empty texts have fingerprint 0 and are linked like any other. A null
    identifier is no component id unless there is no other. An empty table gives no rows.
    """
    rows = checkpointed(docs.select(
        F.col(f"`{id}`").alias("id"), F.xxhash64(F.col(f"`{text}`")).alias("text_key"),
        fingerprints(F.col(f"`{text}`"), shingle).alias("fp")))
    classes = checkpointed(rows.groupBy("fp").agg(F.min("id").alias("first")))
    labels = components(links(classes, max_bits, references))
    labelled = checkpointed(
        classes.join(labels, classes["fp"] == labels["node"], "left")
        .select("fp", "first", F.coalesce("label", "fp").alias("label")))
    # Written, so that the join has an exchange on both sides and can split a large component.
    ids = written(labelled.groupBy("label").agg(F.min("first").alias("component_id")), "components")
    named = labelled.join(ids, "label").select(F.col("fp").alias("of"), "component_id", F.col("label").alias("group"))
    return (rows.join(named, F.col("fp") == F.col("of"))
            .select("id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "group", "text_key"))


def first_of_group(docs, text="text", id="doc_id", **options):
    """One document of each component stays: the one with the smallest identifier.

    Rows that share identifier and text are one document and stay or go together; of
    rows that share the identifier only, the one with the smallest text hash stays.
    """
    found = near_duplicates(docs, text, id, **options)
    keep = found.groupBy("group").agg(
        F.min(F.struct(F.col("id").isNull(), "id", "text_key")).alias("k"))
    keep = keep.select(F.col("k.id").alias("__id"), F.col("k.text_key").alias("__key"))
    rows = docs.withColumn("__text_key", F.xxhash64(F.col(f"`{text}`")))
    return (rows.join(keep, F.col(f"`{id}`").eqNullSafe(F.col("__id")) & (F.col("__text_key") == F.col("__key")),
                      "left_semi").select(*quoted(docs.columns)))
