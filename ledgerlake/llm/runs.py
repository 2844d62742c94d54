"""Periodic runs of words: found as maximal pairs on the LCP-interval tree, and collapsed to one period.

A run is a stretch of words with smallest period q, ``min_length`` words and
``min_exponent`` periods long at least, that no neighbouring word extends.  Its
places s and s + q share exactly length - q words, and the words before them
differ: they are a maximal pair whose distance is at most its length over
``min_exponent - 1``.  The other way round, such a pair spans a stretch that
keeps its distance as a period and cannot be extended.  So runs are read off the
maximal pairs, without extending anything.

The tree of LCP intervals over a batch's suffix array is walked bottom-up.  An interval
holds the lists of its places by the word before them (the class).  When two
children meet, a place pairs only with places of other classes and of the other
child.  No pairs within a group are spelled out: of an interval's places the two
of a smallest-period pair are next to each other in the text (a place between
would give the stretch a smaller period), so each place of the smaller child
looks at its two neighbours in the larger one.  A neighbour that is not yet next
to it in the whole interval gives a multiple of a period: the smallest period of
a stretch is kept.  Intervals shallower than any run allows, and documents where
no window of that depth occurs twice (told by window hashes, which can only let
too many through), are left out.

Suffixes are sorted by prefix doubling on whole batches of documents at once: a
word's number differs between documents, so no prefix crosses one.  Memory is
four bytes a word and doubling for the documents of a batch (one document if it
is longer than the batch).

Null, empty and blank texts have no words and no run.  Repeated rows are done
alike; a null id stays.  Columns other than doc_id and text are not read.
"""

from __future__ import annotations

from bisect import bisect, insort
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.wordhash import mix, window_hashes

BATCH_BYTES = 2 << 20


def _dense(*keys: np.ndarray) -> np.ndarray:
    """Ranks (from 0, equal for equals) of rows given by one or two number columns, first column first."""
    order = np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0], kind="stable")
    new = np.zeros(len(order), bool)
    for k in keys:
        new[1:] |= k[order[1:]] != k[order[:-1]]
    ranks = np.empty(len(order), np.int32)
    ranks[order] = np.cumsum(new)
    return ranks


def suffixes(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of a number sequence, and the LCP of each suffix with the one before it in the array."""
    n = len(words)
    levels = [_dense(words)]
    step = 1
    while levels[-1].max(initial=-1) < n - 1:
        now = levels[-1]
        after = np.full(n, -1, np.int64)
        after[: max(n - step, 0)] = now[step:]
        levels.append(_dense(now.astype(np.int64) * (n + 1) + after + 1))
        step *= 2
    order = np.empty(n, np.int64)
    order[levels[-1]] = np.arange(n)
    shared = np.zeros(n, np.int64)
    a, b = order[:-1].copy(), order[1:].copy()
    for k in range(len(levels) - 1, -1, -1):
        same = (a < n) & (b < n)
        same[same] = levels[k][a[same]] == levels[k][b[same]]
        a, b = a + (same << k), b + (same << k)
        shared[1:] += same << k
    return order, shared


class Interval:
    """Places of an LCP interval: in text order, and listed by the word before them."""

    __slots__ = ("order", "classes")

    def __init__(self, place: int, left: int):
        self.order, self.classes = [place], {left: [place]}

    def absorb(self, other: Interval) -> None:
        if len(other.order) * 8 < len(self.order):
            for place in other.order:
                insort(self.order, place)
        else:
            self.order = sorted(self.order + other.order)
        for left, places in other.classes.items():
            if left in self.classes:
                self.classes[left] += places
            else:
                self.classes[left] = places


def maximal_pairs(order: list[int], shared: list[int], left: list[int], depth: int, reach: int) -> Iterator[tuple[int, int, int]]:
    """(i, j, common length) of maximal pairs next to each other, i < j, at most common length // ``reach`` apart.

    ``order`` and ``shared`` are the suffix array and its LCPs, ``left`` the class of
    each of its places; intervals of less than ``depth`` are not looked at.
    """

    def meet(x: Interval, y: Interval, common: int):
        small, large = (x, y) if len(x.order) < len(y.order) else (y, x)
        far, row = common // reach, large.order
        for cls, places in small.classes.items():
            if len(large.classes) == 1 and cls in large.classes:
                continue  # no place of the other child has another word before it
            for i in places:
                k = bisect(row, i)
                for j in row[max(k - 1, 0) : k + 1]:
                    if abs(i - j) <= far and class_of[j] != cls:
                        found.append((i, j, common) if i < j else (j, i, common))
        large.absorb(small)
        return large

    found: list[tuple[int, int, int]] = []
    class_of = dict(zip(order, left))
    stack: list[list] = []  # open intervals: LCP, places so far
    for k, place in enumerate(order):
        node, common = Interval(place, left[k]), shared[k + 1] if k + 1 < len(order) else 0
        while stack and stack[-1][0] > common:
            depth_of, so_far = stack.pop()
            node = meet(so_far, node, depth_of)
        if common >= depth:
            if stack and stack[-1][0] == common:
                stack[-1][1] = meet(stack[-1][1], node, common)
            else:
                stack.append([common, node])
        if found:
            yield from found
            found.clear()


def find_runs(words: np.ndarray, border: np.ndarray, min_length: int = 24, min_exponent: int = 3) -> np.ndarray:
    """Rows (start, length, period), sorted, of all runs in documents laid end to end; ``words`` are numbers, equal for equal words.

    ``border`` has the documents' borders; starts count from the first word of all.
    """
    if min_exponent < 3:
        raise ValueError("runs of less than three periods are not next to each other among an interval's places")
    depth = -(-min_length * (min_exponent - 1) // min_exponent)
    doc = np.repeat(np.arange(len(border) - 1), np.diff(border))
    if len(words) <= depth:
        return np.zeros((0, 3), np.int64)
    # documents in which a window of the least depth occurs twice
    windows = mix(window_hashes(mix(words.astype(np.uint64) + np.uint64(1)), depth) ^ mix(doc[: len(words) - depth + 1].astype(np.uint64)))
    windows = windows[doc[: len(windows)] == doc[depth - 1 :]]
    at = doc[: len(words) - depth + 1][doc[: len(words) - depth + 1] == doc[depth - 1 :]]
    by = np.argsort(windows, kind="stable")
    again = np.zeros(len(border) - 1, bool)
    again[at[by[1:]][windows[by[1:]] == windows[by[:-1]]]] = True
    taken = np.flatnonzero(again[doc])
    if not len(taken):
        return np.zeros((0, 3), np.int64)
    numbers = _dense(doc[taken], words[taken])  # documents share no number
    order, shared = suffixes(numbers)
    left = np.concatenate(([-1], numbers[:-1]))[order]
    # maximal stretches of the array whose neighbours share enough words
    deep = np.concatenate((shared >= depth, [False]))
    starts = np.flatnonzero(deep[1:] & ~deep[:-1])
    ends = np.flatnonzero(deep[:-1] & ~deep[1:]) + 1
    best: dict[tuple[int, int], int] = {}
    for a, b in zip(starts.tolist(), ends.tolist()):
        places, lcps, classes = (c[a:b].tolist() for c in (order, shared, left))
        for i, j, common in maximal_pairs(places, lcps, classes, depth, min_exponent - 1):
            q = j - i
            if common + q >= min_length and q < best.get((i, common + q), q + 1):
                best[i, common + q] = q
    if not best:
        return np.zeros((0, 3), np.int64)
    runs = np.array(sorted((i, n, q) for (i, n), q in best.items()), np.int64)
    runs[:, 0] = taken[runs[:, 0]]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


RUNS = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def collapse_runs(docs: DataFrame, min_length: int = 24, min_exponent: int = 3) -> DataFrame:
    """doc_id, n_words, runs (by start, then period; starts count words from 0) and collapsed, for every row of ``docs`` (doc_id, text).

    ``collapsed`` has the words left, joined by one space, when each run keeps its first period only.
    """
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def done(ids: list, texts: list[bytes]) -> pa.RecordBatch:
        split = [t.split() for t in texts]
        number = defaultdict(count().__next__)
        border = np.concatenate(([0], np.cumsum([len(w) for w in split]))).astype(np.int64)
        words = np.fromiter(map(number.__getitem__, chain.from_iterable(split)), np.int64, int(border[-1]))
        found = find_runs(words, border, min_length, min_exponent)
        change = np.zeros(len(words) + 1, np.int64)
        np.add.at(change, found[:, 0] + found[:, 2], 1)
        np.add.at(change, found[:, 0] + found[:, 1], -1)
        gone = np.cumsum(change[:-1]) > 0
        of = np.searchsorted(border, found[:, 0], "right") - 1
        first = np.searchsorted(of, np.arange(len(ids) + 1))
        found[:, 0] -= border[of]
        left = []
        for k, w in enumerate(split):
            if first[k] < first[k + 1]:
                w = [w[i] for i in np.flatnonzero(~gone[border[k] : border[k + 1]]).tolist()]
            left.append(b" ".join(w).decode())
        runs = pa.StructArray.from_arrays([pa.array(found[:, c]) for c in range(3)], fields=list(run_type))
        columns = [pa.array(ids, pa.int64()), pa.array(np.diff(border)), pa.ListArray.from_arrays(pa.array(first, pa.int32()), runs), pa.array(left, pa.string())]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "runs", "collapsed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, size = [], [], 0
        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                ids.append(i)
                texts.append(text or b"")
                size += len(texts[-1])
                if size > BATCH_BYTES or len(ids) > 20_000:
                    yield done(ids, texts)
                    ids, texts, size = [], [], 0
        if ids:
            yield done(ids, texts)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, RUNS)


def with_planted_runs(docs: DataFrame, one_in: int = 10) -> DataFrame:
    """doc_id and text, where the texts of a tenth of the ids (by crc32) repeat a stretch of their words from some word on.

    With h = crc32(doc_id) and g = h div ``one_in``, h a multiple of ``one_in``, and n
    words: each word i >= a becomes word a + (i - a) % p, a = g % n, p = 1 + (n - a) div (3 + g % 8).
    Texts without words, and rows without an id, stay.
    """
    h = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary"))
    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    hit = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.when(h % one_in == 0, F.floor(h / one_in)).alias("g"))
    hit = hit.withColumn("w", F.when(F.col("g").isNotNull(), words)).withColumn("n", F.size("w"))
    hit = hit.withColumn("a", F.when(F.col("n") > 0, F.expr("cast(g % n as int)"))).withColumn("p", F.expr("cast(1 + (n - a) div (3 + g % 8) as int)"))
    repeated = F.expr("array_join(transform(sequence(0, n - 1), i -> w[if(i < a, i, a + (i - a) % p)]), ' ')")
    return hit.select("doc_id", F.when(F.col("a").isNotNull(), repeated).otherwise(F.col("text")).alias("text"))


def run_digest(collapsed: DataFrame) -> DataFrame:
    """doc_id, n_runs, the run of greatest exponent (ties: smallest start, then period) and digests of all runs and of what is left."""
    first = F.expr(
        "aggregate(slice(runs, 2, greatest(size(runs), 1)), runs[0], (b, r) -> if(r.length * b.period > b.length * r.period, r, b))"
    )
    spelled = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    top = collapsed.withColumn("top", F.when(F.size("runs") > 0, first))
    return top.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        F.col("top.start").alias("start"), F.col("top.length").alias("length"), F.col("top.period").alias("period"),
        F.expr("(1000 * top.length) div top.period").alias("exponent_milli"),
        F.sha2(spelled, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
