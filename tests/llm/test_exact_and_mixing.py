from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tideline.llm import exact, mixing

DOCS = "doc_id long, text string, source string, kept string, Size long, `odd.name` int"


def frame(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema)


ROWS = [
    (1, "a b c", "x", "old", 5, 0), (2, "a b c", "y", None, 5, 0), (2, "a b c", "y", None, 5, 0), (3, None, None, "old", None, 1),
    (4, "", "x", "old", 1, 1), (None, "a b c", "x", "old", 5, 0), (7, "long " * 30000, "y", "old", 1, None), (8, "A b c", "x", "", 2, 2),
]


def groups(rows):
    by = defaultdict(list)
    for i, row in enumerate(rows):
        by[row[1] or ""].append((row[0] is not None, row[0] or 0, i))
    return by


def test_exact_keeps_one_row_with_the_largest_id(spark):
    got = exact.exact_dedup(frame(spark, ROWS)).collect()
    by = groups(ROWS)
    assert len(got) == len(ROWS)
    for row in got:
        members = by[row["text"] or ""]
        assert row["keep_id"] == max(members)[1]
        assert row["group_size"] == len(members)
        assert row["text_sha256"] == hashlib.sha256((row["text"] or "").encode()).hexdigest()
    kept = [(r["text"] or "", r["doc_id"]) for r in got if r["kept"]]
    assert sorted(kept) == sorted((t, max(m)[1]) for t, m in by.items())


def test_exact_splits_digest_collisions_by_bytes(spark):
    weak = lambda body: F.substring(body, 1, 1).cast("binary")
    rows = [(i, text, "x", None, 1, 1) for i, text in enumerate(["aa", "ab", "aa", "b", "ab", "ab", ""])]
    got = {(r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in exact.exact_dedup(frame(spark, rows), digest=weak).collect()}
    assert got == {(0, 2, 2, False), (2, 2, 2, True), (1, 5, 3, False), (4, 5, 3, False), (5, 5, 3, True), (3, 3, 1, True), (6, 6, 1, True)}


def test_exact_carries_state_over_micro_batches(spark):
    docs = frame(spark, ROWS * 3).repartition(6)
    got = exact.exact_dedup(docs, bytes_per_batch=1).collect()
    assert {r["group_size"] for r in got if r["text"] == "a b c"} == {12}
    assert sum(r["kept"] for r in got) == len(groups(ROWS))


def test_exact_on_an_empty_table(spark):
    assert exact.exact_dedup(frame(spark, [])).collect() == []
    assert exact.kept_documents(frame(spark, ROWS)).columns == frame(spark, ROWS).columns


def water_fill(sizes, weights, most):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in capped)
        free = sum(weight[s] for s in names if s not in capped)
        share = {s: left * weight[s] / free for s in names if s not in capped} if free else {}
        above = {s for s, x in share.items() if x > most * sizes[s]}
        if not above:
            return {s: share.get(s, most * sizes[s]) for s in names}
        capped |= above


def test_targets_equal_repeated_resharing(spark):
    sizes = {"a": 10, "b": 500, "c": 3000, "d": 40, "e": 7, "f": 100, None: 60, "é": 0, "zz": 900}
    rows = [(i, "w " * n, s, None, 0, 0) for i, (s, n) in enumerate(sizes.items())]
    got = {r["source"]: r for r in mixing.plan_mix(frame(spark, rows)).collect()}
    want = water_fill(sizes, (5, 2, 1), 3)
    for source, row in got.items():
        assert row["source_size"] == sizes[source]
        assert row["target"] == pytest.approx(want[source])
    assert sum(r["target"] for r in got.values()) == pytest.approx(sum(sizes.values()))


def test_copies_follow_rates_and_reruns_agree(spark):
    rows = [(i, "w " * (i % 7), f"s{i % 5 % 3}", None, 0, 0) for i in range(3000)]
    docs = frame(spark, rows)
    planned = mixing.plan_mix(docs).collect()
    again = {(r["doc_id"], r["copies"]) for r in mixing.plan_mix(docs.repartition(7)).collect()}
    assert {(r["doc_id"], r["copies"]) for r in planned} == again
    taken, target = defaultdict(int), {}
    for r in planned:
        assert int(r["rate"]) <= r["copies"] <= int(r["rate"]) + 1 and r["copies"] <= 3
        taken[r["source"]] += r["copies"] * r["size"]
        target[r["source"]] = r["target"]
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", r["text"]))
    for source in target:
        assert taken[source] == pytest.approx(target[source], rel=0.1)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r["copies"] for r in planned)


def test_mixing_edge_cases(spark):
    planned = mixing.plan_mix(frame(spark, ROWS))
    assert planned.count() == len(ROWS)
    assert {r["size"] for r in planned.filter("text is null or text = ''").collect()} == {0}
    assert mixing.plan_mix(frame(spark, [])).collect() == []
    none = mixing.plan_mix(frame(spark, [(1, None, None, None, None, None)])).first()
    assert (none["target"], none["copies"]) == (0.0, 0)
