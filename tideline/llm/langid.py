"""Language identification with hyperdimensional profiles."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tideline.llm.common import quoted, without

ADDED = ("lang_pred", "score")
UNKNOWN = "und"
# Documents per language, in expectation, that the prototypes are learned from.
TRAIN_PER_LANG = 20_000
# A task keeps the vectors of at most this many n-grams (one byte per dimension each).
CACHED = 1 << 16
# Marks the gap between words among the letters.
GAP = 0
_LETTERS = []


def letters():
    """Whether each code point is a letter."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter(map(str.isalpha, map(chr, range(0x110000))), dtype=bool, count=0x110000))
    return _LETTERS[0]


class Profiles:
    """Random letter vectors and what is built from them.

    A letter has a fixed random vector of +1 and -1. An n-gram is the product of its
    letters' vectors, each rotated by its distance from the end; a document is the sum of
    its n-grams' vectors.
    """

    def __init__(self, dims, n, seed):
        self.dims, self.n, self.seed = dims, n, seed
        self.alphabet = {}
        self.forget()

    def forget(self):
        self.rows, self.table = {}, np.empty((1024, self.dims), dtype=np.int8)

    def letter(self, code):
        if code not in self.alphabet:
            if len(self.alphabet) >= CACHED:
                self.alphabet.clear()
            draw = np.random.default_rng([self.seed, code])
            self.alphabet[code] = (2 * draw.integers(0, 2, self.dims) - 1).astype(np.int8)
        return self.alphabet[code]

    def gram(self, code):
        """Vector of an n-gram given as one number, 21 bits a letter."""
        vector = np.ones(self.dims, dtype=np.int8)
        for back in range(self.n):
            vector = vector * np.roll(self.letter(code >> 21 * back & 0x1FFFFF), back)
        return vector

    def document(self, text):
        """The vector of a whole text, or None if it has no letter."""
        points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype="<u4")
        is_letter = letters()[points]
        if not is_letter.any():
            return None
        # Words in a row, one gap between them and at both ends.
        points = np.where(is_letter, points, GAP)
        points = np.concatenate(([GAP], points, [GAP]))
        points = points[(points != GAP) | np.append(True, points[:-1] != GAP)].astype(np.uint64)
        codes = points[:len(points) - self.n + 1].copy()
        for at in range(1, self.n):
            codes = codes << np.uint64(21) | points[at:len(points) - self.n + 1 + at]
        codes, counts = np.unique(codes, return_counts=True)
        vector = np.zeros(self.dims)
        # A text with very many different n-grams is summed in parts.
        for at in range(0, len(codes), CACHED // 4):
            rows = self.known(codes[at:at + CACHED // 4].tolist())
            vector += counts[at:at + CACHED // 4].astype(np.float32) @ self.table[rows].astype(np.float32)
        return vector

    def known(self, codes):
        if len(self.rows) + len(codes) > CACHED:
            self.forget()
        rows = self.rows
        for code in codes:
            if code not in rows:
                if len(rows) == len(self.table):
                    self.table = np.concatenate([self.table, np.empty_like(self.table)])
                self.table[len(rows)] = self.gram(code)
                rows[code] = len(rows)
        return [rows[code] for code in codes]


def unit(vector):
    length = np.sqrt(vector @ vector)
    return vector / length if length else vector


def learn(docs, text="text", lang="lang", id="doc_id", dims=1024, n=3, seed=11, most=TRAIN_PER_LANG):
    """Language prototypes: per language the sum of its documents' vectors, each of length one.

    Rows without text, letters or language teach nothing. A language with more than
    ``most`` documents is learned from a sample of that expected size, drawn by a hash of
    the identifier; this bound is the only one. Every task adds up its own documents, and
    ``dims`` numbers per language come to the driver.
    """
    rows = docs.select(F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("text"),
                       F.xxhash64(F.lit(seed), F.col(f"`{id}`")).alias("h")).filter("lang is not null and text is not null")
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().toLocalIterator()}
    some = {name: most / count for name, count in counts.items() if count > most}
    if some:
        share = F.create_map(*[F.lit(x) for pair in some.items() for x in pair])
        rows = rows.filter(F.shiftrightunsigned("h", 11) / F.lit(float(1 << 53)) < F.coalesce(share[F.col("lang")], F.lit(1.0)))

    def task(batches):
        profiles, sums = Profiles(dims, n, seed), {}
        for batch in batches:
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                vector = profiles.document(body.as_py())
                if vector is not None:
                    sums[name] = sums.get(name, 0) + unit(vector)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.string()), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))],
            names=["lang", "v"])

    parts = rows.select("lang", "text").mapInArrow(task, "lang string, v array<double>")
    total = (parts.select("lang", F.posexplode("v").alias("i", "x")).groupBy("lang", "i").agg(F.sum("x").alias("x"))
             .groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("i", "x"))).alias("v"))
             .select("lang", F.col("v.x").alias("v")))
    return {r["lang"]: np.array(r["v"]) for r in total.toLocalIterator()}


def identify(docs, prototypes, text="text", dims=1024, n=3, seed=11):
    """Add ``lang_pred`` and ``score`` to every document.

    The prediction is the prototype with the largest cosine with the whole text's vector,
    ties to the smaller name; the score is that cosine, 0 if negative. A null text, a text
    without letters and any text when no language was learned give ``und`` and 0. Only
    the text is looked at, so repeated rows agree. An empty table gives no rows. Columns
    of ``docs`` named like an added column are replaced.
    """
    names = sorted(prototypes)
    matrix = np.array([unit(prototypes[name]) for name in names])

    @F.arrow_udf("struct<lang: string, score: double>")
    def predict(texts: pa.Array) -> pa.Array:
        profiles = _profiles(dims, n, seed)
        langs, scores = [], []
        for body in texts:
            vector = profiles.document(body.as_py() or "") if names else None
            if vector is None:
                langs.append(UNKNOWN)
                scores.append(0.0)
            else:
                cosine = matrix @ unit(vector)
                best = int(cosine.argmax())
                langs.append(names[best])
                scores.append(float(min(1.0, max(0.0, cosine[best]))))
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["lang", "score"])

    base = without(docs, *ADDED)
    return (base.withColumn("__p", predict(F.col(f"`{text}`")))
            .select(*quoted(base.columns), F.col("__p.lang").alias("lang_pred"), F.col("__p.score").alias("score")))


_OF_WORKER = {}


def _profiles(*settings):
    """One set of profiles per Python worker, so its table outlives the Arrow batches."""
    if settings not in _OF_WORKER:
        _OF_WORKER.clear()
        _OF_WORKER[settings] = Profiles(*settings)
    return _OF_WORKER[settings]


def held_out(id="doc_id"):
    """Whether a document is held out of learning: crc32 of its identifier's text mod 3 is 1."""
    return F.coalesce(F.crc32(F.col(f"`{id}`").cast("string").cast("binary")) % 3 == 1, F.lit(False))
