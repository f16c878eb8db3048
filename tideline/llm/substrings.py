"""Removal of repeated word windows by level-wise doubling."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from tideline.llm.common import checkpointed, quoted, short_lived_shuffles, without, written

ADDED = ("n_words", "n_removed", "kept_text", "kept_sha256")
# Odd multipliers of the two window hashes.
LOW, HIGH = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F), (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


def word_hashes(words):
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def window_hashes(hashes, length, mix=LOW):
    """Hash of every window of ``length`` words, composed from the hashes of its halves."""
    if length == 1:
        return hashes
    left = length // 2 if length % 2 == 0 else length - 1
    a = window_hashes(hashes, left, mix)
    b = a if left * 2 == length else hashes
    n = max(0, len(hashes) - length + 1)
    h = a[:n] * np.uint64(mix[0]) + b[left:left + n]
    h = (h ^ h >> np.uint64(29)) * np.uint64(mix[1])
    return h ^ h >> np.uint64(32)


def anchors(hashes, base):
    """Starts of the windows of ``base`` words that are tested first, and their hashes.

    In every run of 2 x ``base`` words the window with the smallest hash is taken. The words
    alone decide, so equal runs have equal anchors; about one window in base / 2 is one.
    """
    h = window_hashes(hashes, base)
    if len(h) <= base:
        return np.empty(0, dtype=np.int64), h[:0]
    least = _slide(h, base + 1, np.minimum)
    # A window is an anchor when the largest of the minima over it is its own hash.
    edge = np.zeros(base, dtype=np.uint64)
    taken = np.flatnonzero(_slide(np.concatenate([edge, least, edge]), base + 1, np.maximum) == h)
    return taken, h[taken]


def _slide(values, width, best):
    """``best`` of every ``width`` values in a row."""
    span = 1
    while span * 2 <= width:
        values = best(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return best(values[:-rest], values[rest:]) if rest else values


def extended(hashes, base, repeated):
    """Starts of windows of 2 x ``base`` words whose own anchor is repeated.

    Other anchors inside may owe their place to words outside the window.
    """
    h = window_hashes(hashes, base)
    if len(h) <= base:
        return np.empty(0, dtype=np.int64)
    others = np.ones(len(h), dtype=bool)
    others[repeated] = False
    known = np.where(others, np.uint64(2**64 - 1), h)
    return np.flatnonzero(_slide(known, base + 1, np.minimum) == _slide(h, base + 1, np.minimum))


def doubled(length, repeated):
    """Starts of windows of 2 x ``length`` words whose halves are both repeated."""
    return np.intersect1d(repeated, repeated - length)


def covered(n_words, starts, length):
    """Whether each word lies in a window of ``length`` words at one of ``starts``."""
    edges = np.zeros(n_words + 1, dtype=np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + length, -1)
    return edges[:-1].cumsum() > 0


def repeated_windows(rows, base, length):
    """Windows of ``length`` words that repeat one that starts earlier: ``__row``, ``__start``.

    ``rows`` has ``__row``, ``__id`` and ``__text``, and equal texts once. The first level
    tests sampled windows of ``base`` words; windows that repeat at one length alone are
    extended to twice that length, up to ``length`` or until no candidate survives. The
    last level compares 95 bits of hash and the earliest start of every window.
    """
    size = base
    found = rows.select("__row", "__text").mapInArrow(_first_level(base), "__row long, __start int, __low long")
    while True:
        last = size == length
        key = ["__low", "__high"] if last else ["__low"]
        if size > base:
            found = written(found, "windows")
        groups = found.groupBy(*key).agg(
            F.count(F.lit(1)).alias("__n"), *([F.min(F.struct("__id", "__start")).alias("__first")] if last else []))
        groups = groups.filter("__n > 1").select(*[F.col(k).alias(k + "_of") for k in key], *groups.columns[len(key) + 1:])
        # Written, so that the join below has an exchange on both sides and can split a hot window.
        groups = written(groups, "repeated")
        same = [F.col(k) == F.col(k + "_of") for k in key]
        repeated = found.join(groups, same)
        if last:
            return checkpointed(repeated.filter(F.struct("__id", "__start") > F.col("__first")).select("__row", "__start"))
        starts = checkpointed(repeated.groupBy("__row").agg(F.collect_list("__start").alias("__starts")))
        if starts.isEmpty():
            return starts.select("__row", F.explode("__starts").alias("__start"))
        columns = "__row long, __start int, __low long" + (", __id long, __high int" if 2 * size == length else "")
        found = (rows.join(starts.withColumnRenamed("__row", "__of"), F.col("__row") == F.col("__of"))
                 .select("__row", "__text", "__id", "__starts").mapInArrow(_next_level(size, base, length), columns))
        size *= 2


def _first_level(base):
    def task(batches):
        for batch in batches:
            out = []
            for row, words in zip(batch.column(0).to_pylist(), _words(batch.column(1))):
                taken, hashes = anchors(word_hashes(words), base)
                out.append((np.full(len(taken), row), taken.astype(np.int32), hashes >> np.uint64(16)))
            yield _table(out, ("__row", "__start", "__low"))

    return task


def _next_level(size, base, length):
    last = 2 * size == length
    names = ("__row", "__start", "__low") + (("__id", "__high") if last else ())

    def task(batches):
        for batch in batches:
            out = []
            rows, ids = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for row, words, id, starts in zip(rows, _words(batch.column(1)), ids, batch.column(3)):
                hashes, starts = word_hashes(words), np.sort(starts.values.to_numpy())
                starts = extended(hashes, base, starts) if size == base else doubled(size, starts)
                low = window_hashes(hashes, 2 * size)[starts]
                found = (np.full(len(starts), row), starts.astype(np.int32), low)
                if last:
                    found += np.full(len(starts), id), (window_hashes(hashes, 2 * size, HIGH)[starts] >> np.uint64(33)).astype(np.int32)
                out.append(found)
            yield _table(out, names)

    return task


def _words(texts):
    return (t.split() for t in texts.cast(pa.binary()).to_pylist())


def _table(parts, names):
    columns = [np.concatenate(c) if parts else np.empty(0, dtype=np.int64) for c in zip(*parts)]
    columns = [pa.array(c.view(np.int64) if c.dtype == np.uint64 else c) for c in columns]
    return pa.RecordBatch.from_arrays(columns, names=list(names))


def remove_repeats(docs, text="text", id="doc_id", length=20, base=10):
    """Remove every word that a window of ``length`` words covers which also starts earlier.

    Earlier is a smaller identifier, or an earlier start in the same document; windows are
    judged on the input. ``length`` is ``base`` times a power of two, and ``base`` above 1.
    Adds ``n_words``, ``n_removed``, ``kept_text`` (the kept words joined by one space) and
    ``kept_sha256`` (of its UTF-8 bytes). Words are ``[^\\x20\\x09-\\x0D]+``.

    Documents are written once with a row number. Of equal texts only the one with the
    smallest identifier is searched; the windows of the others start earlier in it, so all
    their words go (if they have ``length`` words). Equal texts that share the identifier
    share the result of one. Null text has no words. A null identifier comes before
    any other. An empty table gives no rows. Columns of ``docs`` named like an added column
    are replaced.
    """
    spark = docs.sparkSession
    base_columns = without(docs, *ADDED)
    with short_lived_shuffles(spark):
        body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
        order = F.coalesce(F.col(f"`{id}`").cast("long"), F.lit(-(1 << 63)))
        rows = written(base_columns.withColumns({
            "__row": F.monotonically_increasing_id(), "__id": order, "__hash": F.md5(body.cast("binary"))}), "documents")
        firsts = written(rows.groupBy("__hash").agg(F.min(F.struct("__id", "__row")).alias("__f")), "firsts")
        # Each row, the row searched in its place, and whether all its windows start earlier.
        roles = checkpointed(rows.select("__row", "__id", "__hash").join(firsts, "__hash").select(
            "__row", F.col("__f.__row").alias("__by"), (F.col("__id") > F.col("__f.__id")).alias("__copy")))
        copies = roles.filter("__by <> __row").select(F.col("__row").alias("__other"))
        searched = (rows.select("__row", "__id", F.col(f"`{text}`").alias("__text"))
                    .withColumn("__text", F.coalesce("__text", F.lit("")))
                    .join(copies, F.col("__row") == F.col("__other"), "left_anti"))
        removed = repeated_windows(searched, base, length)
        starts = removed.groupBy(F.col("__row").alias("__by")).agg(F.collect_list("__start").alias("__starts"))
        marks = checkpointed(roles.join(starts, "__by", "left").filter("__copy or __starts is not null")
                             .select(F.col("__row").alias("__of"), "__copy", F.when(~F.col("__copy"), F.col("__starts")).alias("__starts")))

    result = _kept(length)(F.coalesce(F.col(f"`{text}`"), F.lit("")), F.coalesce("__copy", F.lit(False)), "__starts")
    return (rows.join(marks, F.col("__row") == F.col("__of"), "left").withColumn("__k", result)
            .select(*quoted(base_columns.columns), F.col("__k.n_words").alias("n_words"), F.col("__k.n_removed").alias("n_removed"),
                    F.col("__k.kept_text").alias("kept_text"), F.col("__k.kept_sha256").alias("kept_sha256")))


def _kept(length):
    @F.arrow_udf("struct<n_words: long, n_removed: long, kept_text: string, kept_sha256: string>")
    def keep(texts: pa.Array, copies: pa.Array, starts: pa.Array) -> pa.Array:
        out = []
        for words, copy, at in zip(_words(texts), copies.to_pylist(), starts):
            kept = words
            if copy:
                kept = [] if len(words) >= length else words
            elif at.is_valid and words:
                gone = covered(len(words), at.values.to_numpy(), length)
                kept = [w for w, g in zip(words, gone.tolist()) if not g]
            joined = b" ".join(kept)
            out.append((len(words), len(words) - len(kept), joined.decode(), hashlib.sha256(joined).hexdigest()))
        n_words, n_removed, kept_text, sha = zip(*out) if out else ((), (), (), ())
        return pa.StructArray.from_arrays(
            [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept_text, pa.string()), pa.array(sha, pa.string())],
            ["n_words", "n_removed", "kept_text", "kept_sha256"])

    return keep
