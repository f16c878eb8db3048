"""The queries of this package: thin contracts over the operators, on whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tideline.llm import ann, descent, exact, html_main, langid, line_chunks, mixing, packing, phrases, sharding, simhash, substrings, whitening


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_hypergeometric_shards(spark, sf_dir):
    text = F.coalesce("text", F.lit(""))
    rows = _table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    return sharding.shard(rows, shards=24).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op2_simhash_pivot_tables(spark, sf_dir):
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle=3, max_bits=3)
    return found.select(F.col("id").alias("doc_id"), "fingerprint", "component_id")


def op3_multiprobe_p_stable(spark, sf_dir):
    return ann.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, top=20)


def op4_target_weights(spark, sf_dir):
    mixed = mixing.plan_mix(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target",
                        (F.col("size") * F.col("copies")).cast("long").alias("taken"))


def op5_hyperdimensional_langid(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    prototypes = langid.learn(docs.filter(~langid.held_out()))
    found = langid.identify(docs.select("doc_id", "text"), prototypes)
    return found.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def op6_consensus_host_paths(spark, sf_dir):
    return html_main.main_text(_table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op7_content_defined_line_chunks(spark, sf_dir):
    cut = line_chunks.remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_lines", "n_removed", "kept_sha256")


def op8_level_wise_doubling(spark, sf_dir):
    cut = substrings.remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"), length=20)
    return cut.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op9_sum_of_squares_packing(spark, sf_dir):
    pieces = packing.pack(_table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


def op10_streaming_exact_dedup(spark, sf_dir):
    marked = exact.exact_dedup(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return marked.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op11_external_stream_collocations(spark, sf_dir):
    found = phrases.top_phrases(_table(spark, sf_dir, "documents").select("text", "lang"), top=2000, longest=5, least=100)
    return found.withColumnRenamed("group", "lang")


def op12_nn_descent_duplicates(spark, sf_dir):
    return descent.near_duplicates(_table(spark, sf_dir, "embeddings"), threshold=0.9)


def op13_contour_whitening(spark, sf_dir):
    return whitening.whiten(_table(spark, sf_dir, "embeddings"), components=32)


QUERIES = {
    "op1_hypergeometric_shards": op1_hypergeometric_shards,
    "op2_simhash_pivot_tables": op2_simhash_pivot_tables,
    "op3_multiprobe_p_stable": op3_multiprobe_p_stable,
    "op4_target_weights": op4_target_weights,
    "op5_hyperdimensional_langid": op5_hyperdimensional_langid,
    "op6_consensus_host_paths": op6_consensus_host_paths,
    "op7_content_defined_line_chunks": op7_content_defined_line_chunks,
    "op8_level_wise_doubling": op8_level_wise_doubling,
    "op9_sum_of_squares_packing": op9_sum_of_squares_packing,
    "op10_streaming_exact_dedup": op10_streaming_exact_dedup,
    "op11_external_stream_collocations": op11_external_stream_collocations,
    "op12_nn_descent_duplicates": op12_nn_descent_duplicates,
    "op13_contour_whitening": op13_contour_whitening,
}
