from __future__ import annotations

import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tideline.llm import packing, sharding


def test_shards_are_exact_and_gapless(spark):
    rows = [(i % 50, "t", i) for i in range(1003)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, slot int").repartition(5)
    got = sharding.shard(docs, shards=24, rows_per_block=8).collect()
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert sorted(slots) == list(range(24))
    assert sorted(map(len, slots.values())) == sorted(sharding.shard_sizes(1003, 24))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in rows)


def test_few_rows_and_none(spark):
    three = spark.createDataFrame([(1,), (1,), (None,)], "doc_id long")
    assert sorted((r["shard"], r["slot"]) for r in sharding.shard(three).collect()) == [(0, 0), (1, 0), (2, 0)]
    assert sharding.shard(three.limit(0)).collect() == []
    assert sharding.shard(three, shards=1).count() == 3


def test_matrix_has_both_margins_and_the_right_law():
    sizes = sharding.shard_sizes(100, 3)
    cells = []
    for seed in range(400):
        matrix = np.array(list(sharding.communication_matrix([30, 50, 20], sizes, seed)))
        assert matrix.sum(axis=1).tolist() == [30, 50, 20] and matrix.sum(axis=0).tolist() == sizes
        cells.append(matrix[0, 0])
    # Hypergeometric: 30 draws from 100 of which 34 go to the shard.
    mean, spread = 30 * 0.34, 30 * 0.34 * 0.66 * 70 / 99
    assert abs(np.mean(cells) - mean) < 4 * (spread / 400) ** 0.5
    assert 0.7 < np.var(cells) / spread < 1.4


def test_every_place_is_equally_likely(spark):
    docs = spark.range(0, 40, 1, 4)
    places = np.zeros((40, 4))
    for seed in range(40):
        for r in sharding.shard(docs, shards=4, seed=seed).collect():
            places[r["id"], r["shard"]] += 1
    # 160 cells with 10 expected each: chi-square with about 120 degrees of freedom.
    assert ((places - 10) ** 2 / 10).sum() < 185


def pack_rows(spark, texts, **options):
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, length int")
    return packing.pack(docs.repartition(options.pop("parts", 2)), **options)


def reference_ids(texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [e.ids + [0] for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


TEXTS = [None, "", "word", "Ünï cödé ☃ \U0001f600", "end <|endoftext|> of text", "a b c " * 2000] + [
    f"text {i} " * (i * 37 % 400) for i in range(60)]


def test_round_trip_and_whole_sequences(spark):
    pieces = pack_rows(spark, TEXTS)
    rows = pieces.collect()
    want = reference_ids(TEXTS)
    parts = defaultdict(list)
    for r in rows:
        assert len(r["ids"]) == 4 * r["length"] and r["length"] > 0
        parts[r["doc_id"]].append((r["start"], np.frombuffer(r["ids"], dtype="<u4").tolist(), r["doc_tokens"]))
    for doc, ids in enumerate(want):
        got = [x for _, part, _ in sorted(parts[doc]) for x in part]
        assert got == ids and {t for _, _, t in parts[doc]} == {len(ids)}
    lengths, places = Counter(), defaultdict(list)
    for r in rows:
        lengths[r["sequence_id"]] += r["length"]
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for sequence, at in places.items():
        assert [o for o, _ in sorted(at)] == [sum(n for _, n in sorted(at)[:k]) for k in range(len(at))]
        assert lengths[sequence] <= 1024 and (lengths[sequence] == 1024 or lengths[sequence] & (lengths[sequence] - 1) == 0)
    whole = {r["sequence_id"]: r for r in packing.sequences(pieces).collect()}
    assert {s: r["length"] for s, r in whole.items()} == lengths
    assert all(zlib.crc32(r["ids"]) and len(r["ids"]) == 4 * r["length"] for r in whole.values())


def test_both_encoders_agree_on_all_code_points():
    encode = packing.Encoder("byte_bpe_50k.json", "byte_bpe_50k.tiktoken")
    points = [chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), 40000):
        texts = [f"a{c}b1{c}2 {c}{c} .{c}. {c}x\n" for c in points[at:at + 40000:7]]
        slow = encode.exact.encode_batch_fast(texts, add_special_tokens=False)
        assert [encode(t).tolist() for t in texts] == [e.ids for e in slow]


def test_packer_follows_the_sum_of_squares_rule():
    draw = np.random.default_rng(4)
    packer = packing.Packer(32, 0)
    levels = np.zeros(33, dtype=int)
    for n, length in enumerate(draw.integers(1, 32, 400).tolist()):
        def cost(level, length=length):
            after = levels.copy()
            after[level] -= level > 0
            after[level + length] += 1
            return (after[1:32] ** 2).sum()

        choices = [h for h in range(0, 33 - length) if h == 0 or levels[h]]
        low = min(map(cost, choices))
        before = levels.copy()
        list(packer.place((n, 0, length, b"\0" * 4 * length, length)))
        levels = packer.levels.copy()
        assert (levels[1:32] ** 2).sum() == low, (before, length)
    rest = list(packer.flush())
    assert packer.open == 0 and sum(p[2] for p, _, _ in rest) > 0


def test_packer_bounds_its_open_windows(spark):
    packer = packing.Packer(16, 0, most_open=10)
    placed = [x for n in range(500) for x in packer.place((n, 0, 9, b"\0" * 36, 9))]
    placed += packer.flush()
    assert packer.open == 0 and sum(p[2] for p, _, _ in placed) == 4500


def test_packing_nothing(spark):
    assert pack_rows(spark, TEXTS).limit(0).collect() == []
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(empty).collect() == []
    assert [(r["length"], r["ids"]) for r in pack_rows(spark, [None], parts=1).collect()] == [(1, bytearray(4))]


@pytest.mark.parametrize("space", [" ", "\t", "\n"])
def test_million_spaces_are_encoded(space):
    encode = packing.Encoder("byte_bpe_50k.json", "byte_bpe_50k.tiktoken")
    text = "a" + space * 1_000_100 + "b"
    assert list(encode(text)) == encode.exact.encode(text, add_special_tokens=False).ids


def test_matrix_over_billions_of_rows():
    counts = [700_000_000, 900_000_000, 5, 0, 400_000_000]
    sizes = sharding.shard_sizes(sum(counts), 7)
    matrix = np.array(list(sharding.communication_matrix(counts, sizes, 3)))
    assert matrix.sum(axis=1).tolist() == counts and matrix.sum(axis=0).tolist() == sizes


def test_hypergeometric_law():
    draw = np.random.default_rng(5)
    for good, bad, count in ((30, 50, 20), (3, 400, 100), (5, 5, 10), (0, 4, 2), (4, 0, 2), (200, 100, 250)):
        got = np.array([sharding.hypergeometric(draw, good, bad, count) for _ in range(4000)])
        want = draw.hypergeometric(good, bad, count, 4000)
        assert abs(got.mean() - want.mean()) <= 0.1 + 0.02 * want.std() and abs(got.std() - want.std()) <= 0.05 + 0.1 * want.std()
        assert got.min() >= max(0, count - bad) and got.max() <= min(good, count)
