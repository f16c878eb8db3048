"""Removal of repeated lines by content-defined chunks."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from tideline.llm.common import checkpointed, quoted, short_lived_shuffles, without, written

ADDED = ("n_lines", "n_removed", "kept_text", "kept_sha256")


def chunks(lines, mean=4):
    """Starts and ends of the chunks of a list of lines (bytes).

    A line's hash is the first 32 bits of its MD5. The rolling hash of a line and the one
    before it, h1 * 31 + h2 modulo 2^32, ends a chunk where ``mean`` divides it. It depends
    on two lines only, so an inserted line moves no boundary further on.
    """
    hashes = np.array([int.from_bytes(hashlib.md5(line).digest()[:4], "big") for line in lines], dtype=np.int64)
    before = np.concatenate(([0], hashes[:-1]))[:len(hashes)]
    ends = np.flatnonzero((before * 31 + hashes) % (1 << 32) % mean == 0) + 1
    if len(lines) and (not ends.size or ends[-1] != len(lines)):
        ends = np.append(ends, len(lines))
    return zip(np.concatenate(([0], ends[:-1])).tolist() if ends.size else [], ends.tolist())


def lines_of(data):
    return data.split(b"\n") if data else []


def remove_repeats(docs, text="text", id="doc_id", mean=4):
    """Remove chunks of two or more lines that also occur earlier in the corpus.

    Earlier is a smaller identifier, or an earlier line of the same document. Adds
    ``n_lines``, ``n_removed`` (lines), ``kept_text`` (the kept lines joined by line feeds)
    and ``kept_sha256`` (of its UTF-8 bytes).

    Hashes of 128 bits find the chunks that may repeat; these alone are fetched and
    compared by their bytes. Chunks of one line stay. Null and empty texts have no lines.
    Rows that share the identifier are ordered by the row number they are written with. A
    null identifier comes before any other. An empty table gives no rows. Columns of
    ``docs`` named like an added column are replaced.
    """
    spark = docs.sparkSession
    base = without(docs, *ADDED)
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    with short_lived_shuffles(spark):
        rows = written(base.withColumns({"__row": F.monotonically_increasing_id(),
                                         "__id": F.coalesce(F.col(f"`{id}`").cast("long"), F.lit(-(1 << 63)))}), "documents")
        found = rows.select("__row", body).mapInArrow(_hashed(mean), "__row long, __start int, __key binary")
        # Groups are written, so that joins have an exchange on both sides and can split a hot chunk.
        repeated = written(found.groupBy("__key").count().filter("count > 1").select(F.col("__key").alias("__key_of")), "repeated")
        places = (found.join(repeated, F.col("__key") == F.col("__key_of")).groupBy("__row")
                  .agg(F.collect_list("__start").alias("__starts")).withColumnRenamed("__row", "__of"))
        # The bytes of what may repeat.
        hits = written(rows.join(places, F.col("__row") == F.col("__of"))
                       .select("__row", body, "__starts", "__id")
                       .mapInArrow(_fetched(mean), "__row long, __id long, __start int, __lines int, __key binary, __bytes binary"),
                       "chunks")
        order = F.struct("__id", "__start", "__row")
        first = written(hits.groupBy("__key", "__bytes").agg(F.min(order).alias("__first"))
                        .select(F.col("__key").alias("__key_of"), F.col("__bytes").alias("__bytes_of"), "__first"), "first")
        gone = (hits.join(first, (F.col("__key") == F.col("__key_of")) & (F.col("__bytes") == F.col("__bytes_of")))
                .filter(order > F.col("__first")).groupBy(F.col("__row").alias("__of"))
                .agg(F.collect_list(F.struct("__start", "__lines")).alias("__gone")))
        gone = checkpointed(gone)

    kept = F.arrow_udf(_kept, "struct<n_lines: long, n_removed: long, kept_text: string, kept_sha256: string>")
    return (rows.join(gone, F.col("__row") == F.col("__of"), "left")
            .withColumn("__k", kept(body, F.col("__gone.__start"), F.col("__gone.__lines")))
            .select(*quoted(base.columns), *[F.col(f"__k.{name}").alias(name) for name in ADDED]))


def _parts(batch, mean):
    for row, data in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
        lines = lines_of(data)
        yield row, [(start, end - start, b"\n".join(lines[start:end])) for start, end in chunks(lines, mean) if end - start > 1]


def _hashed(mean):
    def task(batches):
        for batch in batches:
            out = [(row, start, xxhash.xxh3_128_digest(part)) for row, parts in _parts(batch, mean) for start, _, part in parts]
            yield _batch(out, (pa.int64(), pa.int32(), pa.binary()), ("__row", "__start", "__key"))

    return task


def _fetched(mean):
    def task(batches):
        for batch in batches:
            out = []
            wanted, ids = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            for (row, parts), starts, id in zip(_parts(batch, mean), map(set, wanted), ids):
                out += [(row, id, start, n, xxhash.xxh3_128_digest(part), part) for start, n, part in parts if start in starts]
            yield _batch(out, (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()),
                         ("__row", "__id", "__start", "__lines", "__key", "__bytes"))

    return task


def _batch(rows, kinds, names):
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=list(names))


def _kept(texts: pa.Array, starts: pa.Array, counts: pa.Array) -> pa.Array:
    out = []
    for data, at, lengths in zip(texts.cast(pa.binary()).to_pylist(), starts.to_pylist(), counts.to_pylist()):
        lines = lines_of(data)
        gone = {i for start, n in zip(at or (), lengths or ()) for i in range(start, start + n)}
        kept = b"\n".join(line for i, line in enumerate(lines) if i not in gone)
        out.append((len(lines), len(gone), kept.decode(), hashlib.sha256(kept).hexdigest()))
    columns = list(zip(*out)) if out else [()] * 4
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
    return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], list(ADDED))
