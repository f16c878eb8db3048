from __future__ import annotations

import hashlib
import os
from collections import Counter, defaultdict

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from oracle_check import compare, connect
from tideline.llm import langid, oracle, packing, queries
from test_exact_and_mixing import water_fill
from test_texts import WORDS, plain_fingerprint, union

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


def documents(spark):
    rows = [(i, f"the house number {i} and the river of words {i * 7} " * (1 + i % 5), "en", f"s{i % 3}") for i in range(90)]
    rows += [(200 + i, rows[i][1], "en", "s1") for i in range(5)]
    rows += [(300 + i, rows[30 + i][1] + " end", "en", None) for i in range(5)]
    rows += [(400, None, "en", "s0"), (401, "12 34 !", "en", "s0"), (402, "", None, None), (403, "und der fluss", "de", "s2")]
    return spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")


def plain_run(rows):
    """The kept documents and their copies, row by row."""
    rows = [r for r in rows if r["text"] and any(c.isalpha() for c in r["text"])]
    last = {}
    for r in rows:
        last[r["text"]] = max(last.get(r["text"], -1), r["doc_id"])
    rows = [r for r in rows if last[r["text"]] == r["doc_id"]]
    prints = [plain_fingerprint(r["text"]) for r in rows]
    roots = union(len(rows), [(a, b) for a in range(len(rows)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 3])
    first = {}
    for r, root in zip(rows, roots):
        first[root] = min(first.get(root, r["doc_id"]), r["doc_id"])
    rows = [r for r, root in zip(rows, roots) if first[root] == r["doc_id"]]
    sizes = defaultdict(int)
    for r in rows:
        sizes[r["source"]] += len(WORDS.findall(r["text"]))
    targets = water_fill(sizes, (5, 2, 1), 3)
    for r in rows:
        rate = targets[r["source"]] / sizes[r["source"]]
        draw = int(hashlib.md5(f"mix:{r['doc_id']}".encode()).hexdigest()[:13], 16) / (1 << 52)
        for copy in range(int(rate) + (draw < rate - int(rate))):
            yield r["doc_id"], copy


def test_stages_equal_the_plain_run(spark, folder):
    docs = documents(spark)
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "exact_dedup", "simhash_near_dedup", "source_mix", "packing"]
    source = docs.collect()
    docs.write.parquet(f"{folder}/documents.parquet")
    pieces = corpus_pipeline.run(spark, folder).collect()
    want = Counter(doc for doc, _ in plain_run(source))
    encode = packing.Encoder("byte_bpe_50k.json", None)
    tokens = {r["doc_id"]: len(encode(r["text"] or "")) + 1 for r in source}
    got = defaultdict(int)
    for p in pieces:
        got[p["doc_id"]] += p["length"]
    assert dict(got) == {doc: copies * tokens[doc] for doc, copies in want.items()}


def test_every_stage_takes_an_empty_table(spark):
    docs = documents(spark).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, None).collect() == []


def test_stages_keep_columns(spark):
    docs = documents(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, None).columns == docs.columns


@pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")
@pytest.mark.parametrize("name", list(oracle.SQL))
def test_query_equals_sql(spark, name):
    problem = compare(spark, connect(SF), name, queries.QUERIES[name], oracle.SQL[name], SF)
    assert problem is None, problem


def test_registration():
    names = contract.queries()
    assert set(queries.QUERIES) | {"pipeline"} <= set(names)
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)] == [1] * 10


@pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")
def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("held", langid.held_out())
    found = langid.identify(docs, langid.learn(docs.filter("not held"))).filter("held").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in found) >= 0.97 * len(found)
