"""A corpus pipeline out of the operators in ``tideline.llm``.

Every stage takes the documents its predecessor kept and returns documents with the same
columns; the last returns token pieces. Each result is written before the next stage
reads it, so a lost executor never reaches back over a stage.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tideline.llm import exact, langid, mixing, packing, simhash
from tideline.llm.common import quoted, written


def language(spark, docs, sf_dir):
    """Identify languages, learning from the labelled documents not held out; texts without letters go."""
    prototypes = langid.learn(docs.filter(~langid.held_out()))
    known = langid.identify(docs, prototypes).filter(F.col("lang_pred") != langid.UNKNOWN)
    return known.select(*quoted(docs.columns))


def exact_copies(spark, docs, sf_dir):
    """Of equal texts the document with the largest identifier stays."""
    return exact.kept_documents(docs)


def near_copies(spark, docs, sf_dir):
    """Of documents linked by fingerprints at most 3 bits apart, the smallest identifier stays."""
    return simhash.first_of_group(docs, shingle=3, max_bits=3)


def source_mix(spark, docs, sf_dir):
    """Documents are repeated or left out so that the sources meet their target weights."""
    return mixing.mix(docs)


def packed(spark, docs, sf_dir):
    """Pieces of at most 1024 token ids, placed in sequences."""
    return packing.pack(docs).withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("language_id", language),
    ("exact_dedup", exact_copies),
    ("simhash_near_dedup", near_copies),
    ("source_mix", source_mix),
    ("packing", packed),
]

# Profiles, fingerprints and token ids are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
