"""Phrase collocations against plain counting."""

import random
import re
from collections import Counter

from tideline.llm import phrases


def _plain(rows, least, longest):
    counts, totals = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for i in range(len(words)):
                for j in range(i + 1, min(len(words), i + longest) + 1):
                    counts.setdefault(lang, Counter())[tuple(words[i:j])] += 1
    out = set()
    for lang, f in counts.items():
        held = {part for w, a in f.items() if len(w) > 2 for part in (w[1:], w[:-1]) if f[part] == a}
        for w, a in f.items():
            if len(w) > 1 and a >= least and w not in held:
                n = totals[lang]
                score, k = min((1000 * a * n // (f[w[:k]] * f[w[k:]]), k) for k in range(1, len(w)))
                out.add((lang, " ".join(w), a, f[w[:k]], f[w[k:]], n, score))
    return out


def test_phrases_match_plain_counts(spark):
    draw = random.Random(3)
    words = ["New", "york", "of", "the", "été", "x\x01y", "city", "B\x0eb"]
    rows = [("".join(draw.choice(words) + draw.choice([" ", "  ", "\t", " ", ", ", "\n"]) for _ in range(draw.randint(0, 60))),
             draw.choice(["en", "es", None, "a\tb"])) for _ in range(200)]
    rows += [(None, "en"), ("", "en"), ("  ", None), ("the city of New york " * 3000, "en")]
    docs = spark.createDataFrame([(t, g, 1, "k") for t, g in rows], "text string, lang string, a int, key string")
    got = phrases.mine(docs, least=20).collect()
    assert len(got) == len(set(got))
    assert {tuple(r[c] for c in ("group", "phrase", "a", "l", "r", "n", "score")) for r in got} == _plain(rows, 20, 5)


def test_phrases_of_nothing(spark):
    docs = spark.createDataFrame([], "text string, lang string")
    assert phrases.top_phrases(docs).count() == 0
    docs = spark.createDataFrame([(None, None), ("", "en")], "text string, lang string")
    assert phrases.top_phrases(docs).count() == 0


def test_windows_are_made_once_and_dealt_by_ranges(spark, monkeypatch):
    """The ranges' borders come from a share of the documents, and the counts do not depend on it."""
    draw = random.Random(5)
    rows = [(" ".join(draw.choice(["the", "new", "city", "of", "x\x01y", "B\x0eb"]) for _ in range(30)),
             draw.choice(["en", "a\tb", None])) for _ in range(400)]
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(4)
    seen = []
    dealt = phrases._dealt
    monkeypatch.setattr(phrases, "_dealt", lambda *a: seen.append(dealt(*a)) or seen[-1])
    monkeypatch.setattr(phrases, "SHARE", 0.3)
    got = phrases.mine(docs, least=20).collect()
    assert {tuple(r) for r in got} == _plain(rows, 20, 5) and len(got) == len(set(got))
    plan = seen[0]._jdf.queryExecution().toString()
    assert "rangepartitioning" not in plan and "RangePartitioning" not in plan
    keys = seen[0].rdd.mapPartitions(lambda p: [[r["key"] for r in p]]).collect()
    assert sum(map(bool, keys)) > 1
    assert sum(keys, []) == sorted(k for part in keys for k in part)
