"""Helpers shared by the operators of this package."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import functions as F

from tideline.session import work_dir

# Word separators of all operators here: space and the ASCII controls 0x09 to 0x0D.
WORD = r"[^\x20\x09-\x0D]+"


def checkpointed(df):
    """Cut the lineage by a checkpoint in the shared folder, which survives lost executors.

    The folder is the cluster's ``spark.checkpoint.dir``; one under the warehouse is set
    only where that is missing.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(work_dir(df.sparkSession, "checkpoints"))
    return df.checkpoint(eager=True)


def without(df, *names):
    """``df`` less the columns that an operator is about to add, in any letter case.

    Names that start with two underscores are reserved for the operators' own columns.
    """
    taken = {n.lower() for n in names}
    return df.select(*quoted(c for c in df.columns if c.lower() not in taken and not c.startswith("__")))


def quoted(names):
    """Column names as references, whatever characters they hold."""
    return ["`" + name.replace("`", "``") + "`" for name in names]


def word_count(text):
    """Number of words of a text column, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


@contextmanager
def short_lived_shuffles(spark):
    """Remove shuffle files when each query inside ends, as its result is written out."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def written(df, purpose):
    """``df`` as a table written to the shared folder and read again."""
    path = work_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
