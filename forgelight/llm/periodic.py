"""Periodic runs of words within documents, by maximal pairs, and texts with their repetitions collapsed.

A run is a stretch of words with smallest period q, at least 2 q long, that no neighbouring word
extends. For its first words i and i + q, the longest match L from both is its length less q: a pair
that is maximal on both sides, with a distance of at most L. The suffixes of a batch of documents are sorted, and the tree
of their LCP intervals is walked bottom-up. An interval keeps the places of its suffixes in one ordered
list in which the classes of left words are interleaved. Among the suffixes of an interval that match for L
words, only neighbours in that list can be a period apart (one between them would make the period
shorter), and only neighbours of different classes are maximal to the left. So each such pair
is one run, its period is the smallest, and no match is ever extended word by word; looking at pairs of whole class
lists would give the same runs and take the square of their sizes.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import compress, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches

RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"
RUN_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
#: Factor of the rolling sums that tell which stretches of words may occur twice.
MIX = np.uint64(0x9E3779B97F4A7C15)


def repeated(ids: np.ndarray, width: int) -> np.ndarray:
    """Places that begin ``width`` ids which occur elsewhere too, and perhaps a few others (sums may be equal by chance)."""
    n = len(ids) - width + 1
    if n < 2:
        return np.zeros(0, "int64")
    sums, plain = np.zeros(n, "uint64"), ids.astype("uint64")
    for i in range(width):
        sums = sums * MIX + plain[i : i + n] + np.uint64(1)
    order = np.argsort(sums, kind="stable")
    same = sums[order[1:]] == sums[order[:-1]]
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    return np.flatnonzero(twice)


def suffix_array(ids: np.ndarray) -> np.ndarray:
    """Places in the order of the suffixes that begin there; the last id occurs once.

    Prefix doubling: each round sorts only those suffixes that are not told apart yet.
    """
    sa = np.argsort(ids, kind="stable")
    new = np.ones(len(ids), bool)
    new[1:] = ids[sa[1:]] != ids[sa[:-1]]
    rank = np.empty(len(ids), "int64")
    rank[sa] = np.maximum.accumulate(np.where(new, np.arange(len(ids)), 0))
    width = 1
    while True:
        alone = new & np.append(new[1:], True)
        slots = np.flatnonzero(~alone)
        if not len(slots):
            return sa
        places = sa[slots]
        first, then = rank[places], rank[places + width]
        order = np.argsort(first * len(ids) + then, kind="stable")
        places, first, then = places[order], first[order], then[order]
        sa[slots] = places
        parted = np.ones(len(slots), bool)
        parted[1:] = (first[1:] != first[:-1]) | (then[1:] != then[:-1])
        new[slots] = parted
        rank[places] = np.maximum.accumulate(np.where(parted, slots, 0))
        width *= 2


def matches(ids: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """For each suffix in order, how many ids it has in common with the one before; 0 for the first.

    A suffix whose left id is that of its predecessor in order too matches for one id less than the
    suffix to its left; only the others are compared, many at a time.
    """
    before = np.full(len(ids), -1)
    before[sa[1:]] = sa[:-1]
    at = np.arange(len(ids))
    follows = np.zeros(len(ids), bool)
    follows[1:] = (before[1:] > 0) & (before[:-1] >= 0) & (ids[at[:-1]] == ids[before[1:] - 1])
    lengths = np.zeros(len(ids), "int64")
    pending = np.flatnonzero(~follows & (before >= 0))
    for _ in range(32):
        pending = pending[ids[pending + lengths[pending]] == ids[before[pending] + lengths[pending]]]
        lengths[pending] += 1
    for i in pending.tolist():  # each of them longer still
        a, b, step = i + int(lengths[i]), int(before[i]) + int(lengths[i]), 64
        while True:
            n = min(step, len(ids) - max(a, b))
            differ = ids[a : a + n] != ids[b : b + n]
            to = int(differ.argmax())
            if differ[to]:
                break
            a, b, step = a + n, b + n, step * 2
        lengths[i] = a + to - i
    # what follows takes one less than its left neighbour
    base = np.maximum.accumulate(np.where(follows, 0, at))
    return (lengths[base] - (at - base))[sa] * (before[sa] >= 0)


def maximal_pairs(ids: np.ndarray, min_length: int) -> dict[tuple[int, int], int]:
    """{(start, period): length} of all runs in ids, of at least min_length; the first and the last id occur once."""
    least = max(-(-min_length // 2), 1)
    sa = suffix_array(ids)
    lcp = matches(ids, sa)
    word, found = ids.tolist(), {}

    def look(i: int, j: int, same: int) -> None:
        """A pair is a run if it differs on both sides and is no further apart than it matches."""
        period = j - i
        if period <= same and period + same >= min_length and word[i - 1] != word[j - 1] and word[i + same] != word[j + same]:
            found[i, period] = period + same

    def close(same: int, parts: list[list[int]]) -> list[int]:
        """The places of an interval, from those of its children; what the smaller ones bring meets its neighbours."""
        parts.sort(key=len)
        whole = parts.pop()
        added = [i for part in parts for i in part]
        if 8 * len(added) < len(whole):
            for i in added:
                insort(whole, i)
        else:
            whole += added
            whole.sort()
        for i in added:
            at = bisect_left(whole, i)
            if at:
                look(whole[at - 1], i, same)
            if at + 1 < len(whole):
                look(i, whole[at + 1], same)
        return whole

    open_: list[tuple[int, list[list[int]]]] = []

    def drop_to(done: list[int], same: int) -> list[int]:
        """Close the open intervals that go deeper than same, of which done is the last child."""
        while open_ and open_[-1][0] > same:
            depth, parts = open_.pop()
            parts.append(done)
            done = close(depth, parts)
        return done

    linked, done, last = np.flatnonzero(lcp >= least), [], -1
    for slot, left, place, same in zip(linked.tolist(), sa[linked - 1].tolist(), sa[linked].tolist(), lcp[linked].tolist(), strict=True):
        if slot != last + 1:
            drop_to(done, 0)
            done = [left]
        done = drop_to(done, same)
        if open_ and open_[-1][0] == same:
            open_[-1][1].append(done)
        else:
            open_.append((same, [done]))
        done, last = [place], slot
    drop_to(done, 0)
    return found


def runs_of(documents: list[list[bytes]], min_length: int) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of the runs of each document, by start, then period."""
    # ids of one document's words are not those of another's, so no match goes beyond a document
    ids, ends = [], np.zeros(len(documents) + 1, "int64")
    fresh = count()
    for k, words in enumerate(documents):
        own: defaultdict[bytes, int] = defaultdict(fresh.__next__)
        ids.append(np.fromiter(map(own.__getitem__, words), "int64", len(words)))
        ends[k + 1] = ends[k] + len(words) + 1
        ids.append(np.array([next(fresh)]))
    out: list[list[tuple[int, int, int]]] = [[] for _ in documents]
    if not documents:
        return out
    every = np.concatenate(ids)
    # a run of min_length has a match of at least half of it: documents with no such match have none
    some = np.unique(np.searchsorted(ends, repeated(every, max(-(-min_length // 2), 1)), "right") - 1).tolist()
    if not some:
        return out
    begins = np.cumsum([1, *(ends[k + 1] - ends[k] for k in some)])
    chosen = np.concatenate([[next(fresh)], *(every[ends[k] : ends[k + 1]] for k in some)])
    for (start, period), length in sorted(maximal_pairs(chosen, min_length).items()):
        k = int(np.searchsorted(begins, start, "right")) - 1
        out[some[k]].append((start - int(begins[k]), length, period))
    return out


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that stay when of each run only its first period does, joined by a space."""
    if not runs:
        return b" ".join(words)
    depth = np.zeros(len(words) + 1, "int64")
    for start, length, period in runs:
        depth[start + period] += 1
        depth[start + length] -= 1
    return b" ".join(compress(words, (np.cumsum(depth[:-1]) == 0).tolist()))


def _scan(min_length: int) -> Callable:
    """For mapInArrow: the text, as the last column, gives way to ``runs`` and ``collapsed``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).cast(pa.binary()).to_pylist()
            documents = [(t or b"").split() for t in texts]
            runs = runs_of(documents, min_length)
            columns = batch.columns[:-1]
            columns.append(pa.array([[dict(zip(("start", "length", "period"), r, strict=True)) for r in own] for own in runs], RUN_TYPE))
            columns.append(pa.array([None if t is None else collapse(w, r) for t, w, r in zip(texts, documents, runs, strict=True)], pa.binary()).cast(pa.string()))
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], "runs", "collapsed"])

    return run


def find_runs(docs: DataFrame, min_length: int = 12, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Runs of words in every document, and its text with each run cut down to one period.

    Words are what white space of ASCII parts. Returns the id column, ``runs`` (start and length in words, period), by start, then period, and
    ``collapsed`` (the words left, joined by one space). A run is at least ``min_length`` (1 or more) and
    twice its smallest period long, and no neighbouring word continues it. Runs may overlap; a word
    goes if any run has it after that run's first period. An empty text or one of white space has no
    words; a null text has no runs and stays null. Rows that repeat, or share an id, are documents
    like others; other columns are not looked at. No row is shuffled: each document is searched whole in the task that
    reads it, in memory that grows with the batch of at most 8 MB of texts, or with the longest text.
    """
    if min_length < 1:
        raise ValueError("min_length must be 1 or more")
    spark = docs.sparkSession
    bound_batches(spark)
    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = f"id {picked.schema['id'].dataType.simpleString()}, runs {RUNS}, collapsed string"
    return picked.mapInArrow(_scan(min_length), schema).withColumnRenamed("id", id_col)
