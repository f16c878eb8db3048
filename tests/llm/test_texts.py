from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import xxhash

from tideline.llm import langid, line_chunks, simhash, substrings
from tideline.llm.components import components

SCHEMA = "doc_id long, text string, component_id string, n_removed int"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "old", 1) for i, t in rows], SCHEMA)


def union(n, pairs):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def plain_fingerprint(text):
    folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORDS.findall(folded)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def random_words(draw, n, size=4000):
    return [f"w{x}" for x in draw.integers(0, size, n)]


def test_near_duplicates_equal_brute_force(spark):
    draw = np.random.default_rng(2)
    base = random_words(draw, 400)
    rows = [(100, None), (101, ""), (7, " \t\n"), (8, "One"), (9, "one two"), (9, "other text"), (None, "One TWO"), (11, "É é")]
    for i in range(60):
        words = list(base) if i % 2 else random_words(draw, 50)
        for _ in range(i % 4):
            words[int(draw.integers(0, len(words)))] = "changed"
        rows.append((200 + i, " ".join(words)))
    rows.append((5, "x y " * 40000))
    prints = [plain_fingerprint(t) for _, t in rows]
    close = [(a, b) for a in range(len(rows)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 3]
    roots = union(len(rows), close)
    ids = {}
    for (i, _), root in zip(rows, roots):
        ids[root] = min((x for x in (i, ids.get(root)) if x is not None), default=None)
    want = Counter((i, f"{p:016x}", ids[root]) for (i, _), p, root in zip(rows, prints, roots))
    got = simhash.near_duplicates(frame(spark, rows)).select("id", "fingerprint", "component_id").collect()
    assert Counter(map(tuple, got)) == want
    kept = simhash.first_of_group(frame(spark, rows))
    assert kept.columns == frame(spark, []).columns
    assert kept.count() == len(set(roots))
    assert simhash.near_duplicates(frame(spark, [])).collect() == []


def test_large_buckets_lose_no_link(spark):
    draw = np.random.default_rng(1)
    centres = draw.integers(0, 1 << 63, 12, dtype=np.uint64)
    fps = np.unique([c ^ np.bitwise_or.reduce(np.uint64(1) << draw.integers(0, 64, k).astype(np.uint64))
                     for c in centres for k in draw.integers(1, 6, 100)])
    close = [(a, b) for a in range(len(fps)) for b in range(a) if int(fps[a] ^ fps[b]).bit_count() <= 3]
    roots = union(len(fps), close)
    want = Counter(Counter(roots).values())
    classes = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    for tile in (4096, 16):
        label = dict(map(tuple, components(simhash.links(classes, 3, 16, tile)).collect()))
        groups = Counter(label.get(int(x), int(x)) for x in fps.view(np.int64))
        assert Counter(groups.values()) == want


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(50)] + [(1000, 1000 + i) for i in range(1, 40)] + [(7, 7), (-5, 2000)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**{i: 0 for i in range(51)}, **{1000 + i: 1000 for i in range(40)}, -5: -5, 2000: -5}
    assert components(spark.createDataFrame([(3, 3)], "a long, b long")).collect() == []


def plain_windows(rows, length):
    first = {}
    order = sorted(range(len(rows)), key=lambda r: (rows[r][0] is not None, rows[r][0] or 0))
    words = [WORDS.findall(t or "") for _, t in rows]
    key = [(-1 << 63) if i is None else i for i, _ in rows]
    for r in order:
        for s in range(len(words[r]) - length + 1):
            window = tuple(words[r][s:s + length])
            first[window] = min(first.get(window, (key[r], s)), (key[r], s))
    for r in range(len(rows)):
        gone = set()
        for s in range(len(words[r]) - length + 1):
            if (key[r], s) > first[tuple(words[r][s:s + length])]:
                gone |= set(range(s, s + length))
        kept = " ".join(w for n, w in enumerate(words[r]) if n not in gone)
        yield rows[r][0], len(words[r]), len(gone), hashlib.sha256(kept.encode()).hexdigest()


def window_rows():
    draw = np.random.default_rng(3)
    passage, few = random_words(draw, 55), random_words(draw, 30, 3)
    rows = [(50, None), (51, ""), (52, "same few words"), (53, "same few words"), (54, " ".join(few)), (55, "a " * 300)]
    for i in range(40):
        words = random_words(draw, int(draw.integers(5, 120)))
        at = int(draw.integers(0, len(words)))
        cut = sorted(draw.integers(0, 56, 2).tolist())
        rows.append((i, " ".join(words[:at] + (passage[cut[0]:cut[1]] if i % 3 else passage) + words[at:])))
    rows += [(60, rows[10][1]), (3, rows[12][1]), (61, rows[10][1] + "\xa0x"), (None, rows[11][1]), (62, rows[8][1] + " " + rows[8][1])]
    return rows + [(63, "long word " + "x" * 50000 + " " + " ".join(random_words(draw, 30000)))]


def test_window_removal_equals_brute_force(spark):
    for length, base in ((20, 10), (16, 4)):
        rows = window_rows()
        got = substrings.remove_repeats(frame(spark, rows), length=length, base=base)
        assert got.count() == len(rows)
        got = Counter(map(tuple, got.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()))
        assert got == Counter(plain_windows(rows, length))


def test_repeated_rows_share_their_result(spark):
    text = " ".join(random_words(np.random.default_rng(5), 60))
    got = substrings.remove_repeats(frame(spark, [(1, text), (1, text), (2, text)])).collect()
    assert sorted((r["doc_id"], r["n_removed"]) for r in got) == [(1, 0), (1, 0), (2, 60)]
    assert substrings.remove_repeats(frame(spark, [])).collect() == []


def plain_chunks(rows):
    first, parts = {}, []
    for n, (i, text) in enumerate(rows):
        lines = text.split("\n") if text else []
        chunk, before, start = [], 0, 0
        for k, line in enumerate(lines):
            h = int(hashlib.md5(line.encode()).hexdigest()[:8], 16)
            chunk.append(line)
            if (before * 31 + h) % 2**32 % 4 == 0 or k == len(lines) - 1:
                parts.append(((-1 << 63) if i is None else i, start, n, tuple(chunk)))
                chunk, start = [], k + 1
            before = h
    gone = {n: set() for n in range(len(rows))}
    for _, start, n, chunk in sorted(parts):
        if len(chunk) > 1:
            if chunk in first:
                gone[n] |= set(range(start, start + len(chunk)))
            first.setdefault(chunk, n)
    for n, (i, text) in enumerate(rows):
        lines = text.split("\n") if text else []
        kept = "\n".join(line for k, line in enumerate(lines) if k not in gone[n])
        yield i, len(lines), len(gone[n]), hashlib.sha256(kept.encode()).hexdigest()


def test_line_chunks_equal_brute_force(spark):
    draw = np.random.default_rng(6)
    shared = [f"line {x}" for x in range(60)]
    rows = [(90, None), (91, ""), (92, "\n\n\n\n\n\n"), (93, "one line"), (94, "one line"), (None, "\n".join(shared))]
    for i in range(30):
        own = [f"own {i} {k} é" for k in range(int(draw.integers(0, 15)))]
        at = int(draw.integers(0, 40))
        rows.append((i, "\n".join(own + shared[at:at + 20] + own[:3])))
    rows += [(95, "\n".join(f"many {k % 700}" for k in range(20000)))]
    got = line_chunks.remove_repeats(frame(spark, rows)).select("doc_id", "n_lines", "n_removed", "kept_sha256").collect()
    assert Counter(map(tuple, got)) == Counter(plain_chunks(rows))
    assert line_chunks.remove_repeats(frame(spark, [])).collect() == []


def test_chunk_boundaries_resist_shifts():
    lines = [f"line {x}".encode() for x in range(400)]
    before = {tuple(lines[a:b]) for a, b in line_chunks.chunks(lines)}
    after = {tuple(x[a:b]) for x in [[b"new"] + lines] for a, b in line_chunks.chunks(x)}
    assert len(before - after) <= 2


def language_rows(spark):
    words = {"en": "the and of with that house river", "de": "und der nicht schön über häuser", "fr": "les des une été français où",
             "es": "los una señor mañana niño ciudad"}
    draw = np.random.default_rng(8)
    rows = [(i, " ".join(draw.choice(words[lang].split(), 40)), lang) for i, lang in enumerate(list(words) * 60)]
    return spark.createDataFrame(rows + [(900, None, "en"), (901, "123 ... !!", "de"), (902, "", None), (None, "the and of", None)],
                                 "doc_id long, text string, lang string")


def test_languages_of_held_out_documents(spark):
    docs = language_rows(spark).withColumns({"score": langid.held_out()})
    held = {r["doc_id"]: r["score"] for r in docs.collect()}
    assert all(h == (i is not None and zlib.crc32(str(i).encode()) % 3 == 1) for i, h in held.items())
    prototypes = langid.learn(docs.filter(~langid.held_out()), dims=512)
    assert sorted(prototypes) == ["de", "en", "es", "fr"]
    found = langid.identify(docs, prototypes, dims=512)
    assert found.columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    rows = found.collect()
    tested = [r for r in rows if r["doc_id"] is not None and r["doc_id"] < 900 and held[r["doc_id"]]]
    assert len(tested) > 50 and all(r["lang_pred"] == r["lang"] for r in tested)
    assert {r["doc_id"]: (r["lang_pred"], r["score"]) for r in rows if r["doc_id"] in (900, 901, 902)} == {
        i: ("und", 0.0) for i in (900, 901, 902)}
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_learning_from_a_bounded_sample_and_from_nothing(spark):
    docs = language_rows(spark)
    some = langid.learn(docs, dims=256, most=30)
    assert sorted(some) == ["de", "en", "es", "fr"]
    assert langid.learn(docs.limit(0), dims=256) == {}
    assert {r["lang_pred"] for r in langid.identify(docs, {}, dims=256).collect()} == {"und"}
    assert langid.identify(docs.limit(0), some, dims=256).collect() == []


def test_document_vector_is_the_sum_of_its_grams():
    profiles = langid.Profiles(64, 3, 11)
    text = "Ab c-a"
    padded = "\0ab\0c\0a\0"
    want = np.zeros(64)
    for i in range(len(padded) - 2):
        a, b, c = (profiles.letter(ord(x)).astype(int) for x in padded[i:i + 3])
        want += np.roll(a, 2) * np.roll(b, 1) * c
    assert np.array_equal(profiles.document(text), want)
