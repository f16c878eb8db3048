"""Exact deduplication by a streaming query with disk-backed keyed state."""

from __future__ import annotations

from pyspark.sql import functions as F

from tideline.llm.common import checkpointed, quoted, short_lived_shuffles, without, written
from tideline.session import stream_session, work_dir

ADDED = ("keep_id", "group_size", "kept", "text_sha256")


def digests(arrivals):
    """The state of the stream: per digest the row to keep and the number of arrivals.

    ``arrivals`` is a stream of ``__digest``, ``__id`` and ``__at``. State never expires. It
    holds the digest, the largest identifier seen and the locator of that row's content,
    in RocksDB on the executors' disks, with its change log in the checkpoint folder.
    """
    return arrivals.groupBy("__digest").agg(
        F.max(F.struct("__id", "__at")).alias("__keep"), F.count(F.lit(1)).alias("__n"))


def exact_dedup(docs, text="text", id="doc_id", digest=None, state_partitions=None,
                bytes_per_batch=64 << 30):
    """Mark one row of every group of equal texts: the one with the largest identifier.

    Adds ``keep_id`` (identifier of the row that stays), ``group_size``, ``kept`` and
    ``text_sha256``. Documents are written once with a locator per row; their digests then
    arrive as a stream, ``bytes_per_batch`` of files per micro-batch, and meet the keyed
    state. On a hit the full bytes of the row are held against those of the row kept, so
    texts that share only their digest stay apart.

    Null text counts as empty. Rows with equal text and equal identifier are ordered by
    their locator, so exactly one stays. A null identifier is smaller than any other.
    An empty table gives no rows. Columns of ``docs`` named like an added column are
    replaced. ``digest`` maps a text column to another digest (for tests of collisions).
    """
    spark = docs.sparkSession
    base, home = without(docs, *ADDED), work_dir(docs.sparkSession, "exact")
    body = F.coalesce(F.col(text), F.lit(""))
    (base.select("*", F.col(id).alias("__id"), F.monotonically_increasing_id().alias("__at"),
                 F.sha2(body, 256).alias("text_sha256"))
     .withColumn("__digest", digest(body) if digest else F.unhex("text_sha256"))
     .write.parquet(f"{home}/content"))
    rows = spark.read.parquet(f"{home}/content")

    with short_lived_shuffles(spark):
        state = written(_run(spark, rows, home, state_partitions, bytes_per_batch), "groups")
        # Full bytes on hits: every row of a group against the row kept.
        hits = written(rows.select("__digest", "__id", "__at", body.alias("__body"))
                       .join(state.filter("__n > 1"), "__digest"), "hits")
        kept = hits.filter("__keep.__at = __at").select("__digest", F.col("__body").alias("__other"))
        differ = checkpointed(hits.join(kept, "__digest").filter("__body <> __other")
                              .select("__digest", "__id", "__at", "__body"))
    marked = rows.join(state, "__digest")
    size, keep = F.col("__n"), F.col("__keep")
    if not differ.isEmpty():
        # Digest collisions: these rows form groups by their bytes.
        groups = differ.groupBy("__digest", "__body").agg(
            F.max(F.struct("__id", "__at")).alias("__own_keep"), F.count(F.lit(1)).alias("__own_n"))
        moved = differ.join(groups, ["__digest", "__body"]).select("__at", "__own_keep", "__own_n")
        lost = differ.groupBy("__digest").agg(F.count(F.lit(1)).alias("__lost"))
        marked = marked.join(moved, "__at", "left").join(lost, "__digest", "left")
        size = F.coalesce("__own_n", F.col("__n") - F.coalesce("__lost", F.lit(0)))
        keep = F.coalesce("__own_keep", "__keep")
    return marked.select(*quoted(base.columns), keep["__id"].alias("keep_id"), size.alias("group_size"),
                         (keep["__at"] == F.col("__at")).alias("kept"), "text_sha256")


def _run(spark, rows, home, state_partitions, bytes_per_batch):
    """Run the stream over all content files and return the last state of every digest."""
    partitions = state_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    session = stream_session(spark, partitions)
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage", "true")
    # A store is closed and its local files go when its task has committed; what lasts is
    # its snapshot in the checkpoint folder.
    session.conf.set("spark.sql.streaming.stateStore.unloadOnCommit", "true")
    arrivals = (session.readStream.schema(rows.select("__digest", "__id", "__at").schema)
                .option("maxBytesPerTrigger", bytes_per_batch).parquet(f"{home}/content"))
    # A batch owns one folder, so a batch that is run again replaces what it wrote.
    query = (digests(arrivals).writeStream.outputMode("update")
             .option("checkpointLocation", f"{home}/state")
             .foreachBatch(lambda batch, n: batch.write.mode("overwrite")
                           .parquet(f"{home}/groups/batch={n}"))
             .trigger(availableNow=True).start())
    query.awaitTermination()
    schema = digests(rows).schema
    # Identifier and count only grow, so the largest is the latest.
    return (spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(f"{home}/groups")
            .groupBy("__digest").agg(F.max("__keep").alias("__keep"), F.max("__n").alias("__n")))


def kept_documents(docs, text="text", id="doc_id", **options):
    """The documents that stay, with the columns of ``docs``."""
    marked = exact_dedup(docs, text, id, **options)
    return marked.filter("kept").select(*quoted(docs.columns))
