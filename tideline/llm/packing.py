"""Packing token ids into sequences by the sum-of-squares rule."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F

SCHEMA = ("doc_id long, start long, length long, ids binary, doc_tokens long, "
          "sequence_id long, offset long")
# Windows of one task are numbered within this many ids.
PER_TASK = 1 << 36
# A task closes its partially filled windows when it holds this many.
MOST_OPEN = 4096


class Packer:
    """Fills windows of ``size`` tokens from pieces that arrive one by one.

    ``levels[h]`` counts the open windows filled to ``h``. A piece goes to the level that
    makes the sum of the squared counts smallest, ties to the fullest. Pieces wait in
    their window until it closes, so memory holds the open windows only.
    """

    def __init__(self, size, first_id, most_open=MOST_OPEN):
        import numpy as np

        self.size, self.next_id, self.most_open = size, first_id, most_open
        self.levels = np.zeros(size + 1, dtype=np.int64)
        self.windows = [[] for _ in range(size)]
        self.open = 0

    def close(self, window):
        """Rows of a finished window: (piece, sequence, offset)."""
        at, sequence = 0, self.next_id
        self.next_id += 1
        for piece in window:
            yield piece, sequence, at
            at += piece[2]

    def place(self, piece):
        """Put one piece (doc, start, length, ids, doc_tokens) of at most ``size`` tokens."""
        length = piece[2]
        if length == self.size:
            yield from self.close([piece])
            return
        level = self._level(length)
        window = self.windows[level].pop() if level else []
        window.append(piece)
        self.levels[level] -= level > 0
        self.open -= level > 0
        if level + length == self.size:
            yield from self.close(window)
            return
        self.levels[level + length] += 1
        self.windows[level + length].append(window)
        self.open += 1
        if self.open >= self.most_open:
            yield from self.flush()

    def _level(self, length):
        n, size = self.levels, self.size
        best, cost = 0, 2 * n[length] + 1  # a new window
        if n[size - length] and 1 - 2 * n[size - length] <= cost:  # one that is full then
            best, cost = size - length, 1 - 2 * n[size - length]
        here = n[1:size - length].nonzero()[0] + 1
        if here.size:
            costs = 2 * (n[here + length] - n[here]) + 2
            low = costs.min()
            if low < cost or low == cost and best == 0:
                best = int(here[(costs == low).nonzero()[0][-1]])
        return best

    def flush(self):
        """Close all open windows: the emptiest are cut to fill the fullest.

        The one that remains is cut into parts whose lengths are powers of two.
        """
        waiting = [w for level in self.windows for w in level]
        self.levels[:] = 0
        self.windows = [[] for _ in range(self.size)]
        self.open = 0
        rest = []
        while waiting:
            window = waiting.pop()
            room = self.size - sum(p[2] for p in window)
            while room and (rest or waiting):
                if not rest:
                    rest = waiting.pop(0)
                piece = rest.pop()
                if piece[2] > room:
                    piece, tail = cut(piece, room)
                    rest.append(tail)
                window.append(piece)
                room -= piece[2]
            if room == 0:
                yield from self.close(window)
            else:
                rest = window
        while rest:
            part, room = [], 1 << sum(p[2] for p in rest).bit_length() - 1
            while room:
                piece = rest.pop(0)
                if piece[2] > room:
                    piece, tail = cut(piece, room)
                    rest.insert(0, tail)
                part.append(piece)
                room -= piece[2]
            yield from self.close(part)


LONG_SPACE = 10_000
_LONG_SPACE = re.compile(r"\s{%d}" % LONG_SPACE)


def cut(piece, length):
    """A piece as two, the first of ``length`` tokens. Ids take four bytes each."""
    doc, start, whole, ids, tokens = piece
    return ((doc, start, length, ids[:4 * length], tokens),
            (doc, start + length, whole - length, ids[4 * length:], tokens))


class Encoder:
    """Token ids of texts as little-endian 32-bit words.

    ``tokenizers`` defines the ids. The same vocabulary read by ``tiktoken`` gives the same
    ids about four times faster (a test holds the two together over all code points), so
    it encodes every text but those that contain a special token's string and those with a
    run of ``LONG_SPACE`` white-space characters, on which ``tiktoken`` may fail.
    """

    def __init__(self, tokenizer, ranks):
        import base64

        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(public_tokenizers.path(tokenizer))
        self.special = [t.content for t in self.exact.get_added_tokens_decoder().values()]
        self.fast = None
        if ranks:
            with open(public_tokenizers.path(ranks), "rb") as lines:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN,
                                          mergeable_ranks=table, special_tokens={})

    def __call__(self, text):
        import numpy as np

        if self.fast is None or any(s in text for s in self.special) or _LONG_SPACE.search(text):
            ids = self.exact.encode(text, add_special_tokens=False).ids
        else:
            ids = self.fast.encode_ordinary(text)
        return np.asarray(ids, dtype="<u4")


def pack(docs, text="text", id="doc_id", size=1024, end_id=0, tokenizer="byte_bpe_50k.json",
         ranks="byte_bpe_50k.tiktoken"):
    """Cut all documents into pieces and place them in sequences of at most ``size`` tokens.

    Returns one row per piece: ``doc_id, start, length, ids, doc_tokens, sequence_id,
    offset``; ``ids`` are little-endian 32-bit words. A document is its token ids, then
    ``end_id``. Full lengths of ``size`` tokens are sequences of their own; what remains of
    each document is placed online by the sum-of-squares rule. Every task packs its own
    input partition, so nothing is shuffled and a lost task only repeats its own work.

    At the end of its input, and when it holds ``MOST_OPEN`` windows, a task fills the
    fullest windows from the emptiest; the last one is cut at powers of two, so no
    sequence needs padding beyond a power of two. Null text is empty and gives ``end_id``
    alone. Repeated rows are packed each. An empty table gives no rows; other columns of
    ``docs`` are not read.
    """
    def task(batches):
        encode = Encoder(tokenizer, ranks)
        packer = Packer(size, TaskContext.get().partitionId() * PER_TASK)
        placed = []
        for batch in batches:
            for doc, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                for piece in pieces(doc, body.as_py() or "", encode):
                    placed.extend(packer.place(piece))
                if len(placed) >= 2000:
                    yield rows(placed)
                    placed = []
        placed.extend(packer.flush())
        if placed:
            yield rows(placed)

    def pieces(doc, body, encode):
        data = encode(body).tobytes() + end_id.to_bytes(4, "little")
        tokens = len(data) // 4
        for start in range(0, tokens, size):
            length = min(size, tokens - start)
            yield doc, start, length, data[4 * start:4 * (start + length)], tokens

    def rows(placed):
        columns = list(zip(*[(*piece, sequence, at) for piece, sequence, at in placed]))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, kind) for c, kind in zip(columns, kinds)],
            names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    return docs.select(docs[id].cast("long"), docs[text]).mapInArrow(task, SCHEMA)


def sequences(pieces):
    """The sequences themselves: ``sequence_id``, ``length`` and all ``ids``, from packed pieces."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return (pieces.groupBy("sequence_id").agg(F.sum("length").alias("length"), ordered.alias("__parts"))
            .select("sequence_id", "length",
                    F.aggregate("__parts", F.lit(b""), lambda a, p: F.concat(a, p["ids"])).alias("ids")))
