"""Phrase collocations out of count streams in prefix and suffix order."""

from __future__ import annotations

from bisect import bisect_left, bisect_right

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Window
from pyspark.sql import functions as F

from tideline.llm.common import checkpointed, written

BREAK = "\n"
# Words that a task counts at once, and the bytes they may take.
TOGETHER, BYTES = 1_500_000, 48_000_000
ROWS = 50_000
# Range borders come from this share of the documents, so many keys a task.
SHARE, KEYS = 0.02, 64
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Keys are tab-joined. Characters up to the tab, and the line ends a group name may hold,
# are written as two others, so that the tab sorts before all that a key holds.
_ESCAPE, _SHIFT = "\x0e", 0x40
_LOW = "[\x00-\x0e]"


def mine(docs, text="text", group="lang", longest=5, least=100, unknown="und"):
    """Candidate phrases of 2 to ``longest`` words with their counts and scores, per group.

    Texts are lower-cased (A-Z) and cut into pieces at ``.,;:!?`` and line ends, pieces
    into words at spaces and tabs. A candidate occurs ``least`` times or more. Its score is
    the smallest floor(1000 a n / (l r)) over its cuts, and it is left out if a candidate
    one word longer holds it as often as it occurs. Returns ``group, phrase, a, l, r, n,
    score``.

    Layout: each word position gives one row, the window of up to ``longest`` words that
    starts there, counted within a task first. Windows are dealt by range and sorted in
    prefix order, where the windows of a phrase are neighbours; one scan gives the counts
    of all heads. Phrases that occur often enough form two streams, in prefix order and in
    suffix order. In the first a phrase follows its heads, in the second its tails, so a
    scan knows the counts of either from the few phrases it is inside of. The two results
    are merged in lockstep. Nothing is looked up by hash; ranges also cut a very common
    word's phrases, and what crosses a border is passed on as a few rows a partition.

    Null texts are empty, a null group is ``unknown``. Repeated rows count repeatedly. An
    empty table gives no rows. A window holds whole words, however long. Names of other
    columns do not matter.
    """
    counts = phrase_counts(docs, text, group, longest, least, unknown)
    forward = in_order(counts)
    backward = in_order(counts.select(_turned("key").alias("key"), "a"))
    parts = _around(forward, "heads").union(_around(backward, "tails").withColumn("key", _turned("key")))
    merged = _by_range(parts).mapInArrow(_merge, "group string, phrase string, a long, l long, r long, n long, score long")
    return merged


def top_phrases(docs, top=2000, **options):
    """The ``top`` phrases of each group by score, then count, then text, with their ``rank``."""
    order = Window.partitionBy("group").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (mine(docs, **options).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
            .select("group", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))


def phrase_counts(docs, text="text", group="lang", longest=5, least=100, unknown="und"):
    """Every phrase that occurs ``least`` times or more: ``key`` and ``a``; a group is its own first part.

    The count of a group's bare name is the number of its words.
    """
    def split(docs):
        lower = F.translate(F.coalesce(F.col(f"`{text}`"), F.lit("")), UPPER + "\t", LOWER + " ")
        return docs.select(
            F.coalesce(F.col(f"`{group}`").cast("string"), F.lit(unknown)).alias("group"),
            F.split(F.concat(F.regexp_replace(lower, r"[.,;:!?\x0A-\x0D]", f" {BREAK} "), F.lit(f" {BREAK}")), " ").alias("words"))

    sums = _dealt(docs, split, longest).mapInArrow(_heads(longest, least), "key string, a long, open boolean")
    # Written once, read by both orders. Border phrases come in several parts.
    sums = written(sums, "phrases")
    whole = sums.filter(~F.col("open")).select("key", "a")
    border = sums.filter("open").groupBy("key").agg(F.sum("a").alias("a")).filter((F.col("a") >= least) | ~F.col("key").contains("\t"))
    return written(whole.union(border), "phrase-counts")


def in_order(counts):
    """``counts`` dealt by ranges of their keys and sorted; partitions stay as they are."""
    return checkpointed(_by_range(counts))


def _by_range(rows):
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartitionByRange(parts, "key").sortWithinPartitions("key")


def _dealt(docs, split, longest):
    """The windows of all documents, dealt by ranges and sorted, as ``_by_range`` does.

    That would make all windows twice, once to find the borders. Here a share of the documents
    gives them; they decide how even the ranges are, and no more.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    some = split(docs.sample(SHARE, 7)).mapInArrow(_spaced(longest), "key string, weight long").collect()
    if not some:
        return _by_range(split(docs).mapInArrow(_windows(longest), "key string, a long"))
    some = sorted((r["key"], r["weight"]) for r in some)
    upto = np.cumsum([w for _, w in some])
    at = np.searchsorted(upto, upto[-1] * np.arange(1, parts) / parts)
    borders = sorted({some[i][0] for i in at})
    windows = split(docs).mapInArrow(_placed(longest, borders), "part int, key string, a long")
    return windows.repartitionById(parts, "part").select("key", "a").sortWithinPartitions("key")


def _spaced(longest):
    """Per task: evenly spaced keys of its windows, each with the number of rows it stands for."""
    def task(batches):
        for batch in _windows(longest)(batches):
            keys = batch.column(0)
            step = max(1, len(keys) // KEYS)
            spaced = keys.take(pa.array(range(step // 2, len(keys), step)))
            yield pa.RecordBatch.from_arrays([spaced, pa.array([step] * len(spaced), pa.int64())], names=["key", "weight"])

    return task


def _placed(longest, borders):
    """Windows with the range they are in: a key equal to a border begins the next."""
    def task(batches):
        for batch in _windows(longest)(batches):
            keys = batch.column(0)
            first, last = (bisect_right(borders, keys[i].as_py()) for i in (0, len(keys) - 1))
            part = np.full(len(keys), first, dtype=np.int32)
            reader = _Keys(keys)
            for border in borders[first:last]:
                part[bisect_left(reader, border):] += 1
            yield pa.RecordBatch.from_arrays([pa.array(part), keys, batch.column(1)], names=["part", "key", "a"])

    return task


class _Keys:
    """A sorted array of strings, for ``bisect``."""

    def __init__(self, keys):
        self.keys = keys

    def __len__(self):
        return len(self.keys)

    def __getitem__(self, i):
        return self.keys[i].as_py()


def _turned(key):
    """A key with its words in reverse order; the group stays in front."""
    parts = F.split(key, "\t")
    return F.array_join(F.concat(F.slice(parts, 1, 1), F.reverse(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))))), "\t")


def _escaped(values):
    """An array of strings with the characters replaced that must not be in keys."""
    low = pc.match_substring_regex(values, _LOW)
    if not pc.any(low).as_py():
        return values
    table = {c: _ESCAPE + chr(c + _SHIFT) for c in range(0x0f)}
    return pa.array([v.translate(table) for v in values.to_pylist()], pa.string())


def _plain(part):
    if _ESCAPE not in part:
        return part
    head, *rest = part.split(_ESCAPE)
    return head + "".join(chr(ord(r[0]) - _SHIFT) + r[1:] for r in rest)


def _windows(longest):
    """Per task: the window of up to ``longest`` words from every position, counted."""

    def task(batches):
        groups, lengths, words, held, size = [], [], [], 0, 0
        for batch in batches:
            lists = batch.column(1)
            step = max(1, len(lists) * TOGETHER // max(1, len(lists.flatten())))
            for at in range(0, len(lists), step):
                some = lists.slice(at, step)
                flat = some.flatten()
                groups.append(batch.column(0).slice(at, step))
                lengths.append(pc.list_value_length(some).to_numpy(zero_copy_only=False))
                words.append(flat)
                held += len(flat)
                size += pc.sum(pc.binary_length(flat)).as_py() or 0
                if held >= TOGETHER or size >= BYTES:
                    yield from _counted(groups, lengths, words, longest)
                    groups, lengths, words, held, size = [], [], [], 0, 0
        if held:
            yield from _counted(groups, lengths, words, longest)

    return task


def _counted(groups, lengths, words, longest):
    # Sorted as keys are, so that windows leave in the order of their keys.
    names, _, named = _in_key_order(pa.concat_arrays(groups))
    word, sorted_words, shown = _in_key_order(pa.concat_arrays(words))
    word = word + 1
    group = np.repeat(names, np.concatenate(lengths))
    empty, stop = (pc.index(sorted_words, pa.scalar(s)).as_py() + 1 for s in ("", BREAK))
    real = word != empty if empty else np.ones(len(word), dtype=bool)
    word, group = word[real], group[real]
    word[word == stop] = 0
    columns = [word]
    for _ in range(longest - 1):
        after = np.zeros_like(word)
        after[:-1] = columns[-1][1:]
        # The window ends where the piece does.
        columns.append(after)
    for j in range(1, longest):
        columns[j] = np.where(columns[j - 1] > 0, columns[j], 0)
    starts = word > 0
    columns = [group[starts]] + [c[starts] for c in columns]
    if not len(columns[0]):
        return
    packed = _packed(columns, [len(named)] + [len(sorted_words) + 1] * longest)
    by = np.lexsort(packed[::-1])
    new = np.ones(len(by), dtype=bool)
    new[1:] = False
    for p in packed:
        p = p[by]
        new[1:] |= p[1:] != p[:-1]
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(by)))
    for at in range(0, len(first), ROWS):
        rows = by[first[at:at + ROWS]]
        parts = [named.take(pa.array(columns[0][rows]))]
        for c in columns[1:]:
            parts.append(shown.take(pa.array(c[rows] - 1, mask=c[rows] == 0)))
        key = pc.binary_join_element_wise(*parts, "\t", null_handling="skip")
        yield pa.RecordBatch.from_arrays([key, pa.array(count[at:at + ROWS])], names=["key", "a"])


def _in_key_order(values):
    """The place of each value among the different ones, these themselves, and as keys show them."""
    coded = values.dictionary_encode()
    shown = _escaped(coded.dictionary)
    order = pc.array_sort_indices(shown)
    place = np.empty(len(order), dtype=np.int64)
    place[order.to_numpy()] = np.arange(len(order))
    return place[coded.indices.to_numpy()], coded.dictionary.take(order), shown.take(order)


def _packed(columns, sizes):
    """The columns in as few 64-bit keys as hold them, in the same order."""
    out, bits = [], 64
    for column, size in zip(columns, sizes):
        need = max(1, int(size).bit_length())
        if bits + need > 63:
            out.append(column.copy())
            bits = need
        else:
            out[-1] = (out[-1] << need) | column
            bits += need
    return out


def _heads(longest, least):
    """Counts of all heads of the windows in a sorted partition.

    Heads that a border may cut, which are those of the first and the last window, are
    given with whatever count they have here and marked ``open``.
    """
    levels = longest + 1

    def task(batches):
        # The window at hand: its parts, and per level the count so far and whether it is the first of the task.
        path, counts, opened = None, [0] * levels, [True] * levels
        for batch in batches:
            keys, times = batch.column(0), batch.column(1).to_numpy()
            if not len(keys):
                continue
            lists = pc.split_pattern(keys, "\t")
            size = pc.list_value_length(lists).to_numpy()
            begin = lists.offsets.to_numpy()[:-1]
            flat = lists.values
            parts = [flat.take(pa.array(begin + j, mask=size <= j)) for j in range(levels)]
            new = np.zeros(len(keys), dtype=bool)
            emitted = []
            for j, part in enumerate(parts):
                filled = pc.fill_null(part, "")
                # A part differs from the one above, or some part before it does.
                new[1:] |= pc.not_equal(filled.slice(1), filled.slice(0, len(keys) - 1)).to_numpy(zero_copy_only=False)
                new[0] = new[0] or path is None or path[j] != filled[0].as_py()
                first = np.flatnonzero(new)
                if not len(first) or first[0]:
                    first = np.insert(first, 0, 0)
                sums = np.add.reduceat(times, first)
                has = size[first] > j
                start = 0
                if not new[0]:
                    sums[0] += counts[j]
                elif path is not None and path[j] and (counts[j] >= least or opened[j]):
                    emitted.append(("\t".join(path[:j + 1]), counts[j], opened[j]))
                first_open = opened[j] if not new[0] else path is None
                if len(first) > 1:
                    done = np.flatnonzero(has[:-1] & (sums[:-1] >= least))
                    if first_open and has[0] and 0 not in done:
                        done = np.insert(done, 0, 0)
                    for d in done:
                        key = keys[int(first[d])].as_py().split("\t")
                        emitted.append(("\t".join(key[:j + 1]), int(sums[d]), bool(d == 0 and first_open)))
                    opened[j] = False
                else:
                    opened[j] = first_open
                counts[j] = int(sums[-1])
            last = keys[len(keys) - 1].as_py().split("\t")
            path = last + [""] * (levels - len(last))
            if emitted:
                yield _rows(emitted)
        if path is not None:
            yield _rows([("\t".join(path[:j + 1]), counts[j], True) for j in range(levels) if path[j]])

    def _rows(rows):
        key, a, is_open = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(key, pa.string()), pa.array(a, pa.int64()), pa.array(is_open)],
                                          names=["key", "a", "open"])

    return task


def _around(stream, side):
    """Scan a sorted stream: for each phrase the counts of the phrases it begins with.

    Returns ``key, side, a, counts, covered``: counts from the group's down to the phrase
    one word shorter. A phrase that occurs no more often than one that goes on from it is
    given once more, as ``covered``.
    """
    def firsts(batches):
        for batch in batches:
            if len(batch):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(0, 1)], names=["key"])
                return

    # One key a partition; the phrases around it may stand in an earlier partition.
    heads = set()
    for row in stream.select("key").mapInArrow(firsts, "key string").collect():
        parts = row["key"].split("\t")
        heads.update("\t".join(parts[:j]) for j in range(1, len(parts)))
    spark = stream.sparkSession
    asked = spark.createDataFrame([(h,) for h in sorted(heads)], "key string")
    known = {r["key"]: r["a"] for r in stream.join(F.broadcast(asked), "key").collect()}

    def task(batches):
        path, counts = [], []
        for batch in batches:
            out = []
            for key, a in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                parts = key.split("\t")
                same = 0
                while same < len(path) and same < len(parts) - 1 and path[same] == parts[same]:
                    same += 1
                path, counts = parts, counts[:same]
                for j in range(same, len(parts) - 1):
                    counts.append(known["\t".join(parts[:j + 1])])
                if len(parts) > 2:
                    out.append((key, side, a, list(counts), False))
                    if len(parts) > 3 and counts[-1] == a:
                        out.append(("\t".join(parts[:-1]), side, a, [], True))
                counts.append(a)
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.string(), pa.int64(), pa.list_(pa.int64()), pa.bool_()))],
                    names=["key", "side", "a", "counts", "covered"])

    return stream.mapInArrow(task, "key string, side string, a long, counts array<long>, covered boolean")


def _merge(batches):
    """Merge the rows of each phrase, which follow each other, into its score."""
    now, held = None, {}

    def closed():
        if held and "covered" not in held:
            group, *words = map(_plain, now.split("\t"))
            a, n = held["a"], held["heads"][0]
            # Cut after k words: the head of k words and the tail of the others.
            score, k = min((1000 * a * n // (held["heads"][k] * held["tails"][len(words) - k]), k)
                           for k in range(1, len(words)))
            yield group, " ".join(words), a, held["heads"][k], held["tails"][len(words) - k], n, score

    names, types = ["group", "phrase", "a", "l", "r", "n", "score"], [pa.string()] * 2 + [pa.int64()] * 5

    def rows(out):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    for batch in batches:
        out = []
        for key, side, a, counts, covered in zip(*(c.to_pylist() for c in batch.columns)):
            if key != now:
                out.extend(closed())
                now, held = key, {}
            if covered:
                held["covered"] = True
            else:
                held["a"], held[side] = a, counts
        if out:
            yield rows(out)
    out = list(closed())
    if out:
        yield rows(out)
