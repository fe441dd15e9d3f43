"""Benchmark decontamination with a generalised suffix automaton over the words of the test items."""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, settle

#: Bytes of item texts in one automaton, about; it takes some fifty times as many in a Python worker. A larger
#: benchmark takes several automata, one after the other, over the same documents.
BYTES_PER_AUTOMATON = 4 << 20
#: Bytes of item texts that are refused: every automaton is a pass over the documents.
MAX_BENCHMARK_BYTES = 1 << 30
#: Bytes of a pickled automaton in one row of its table.
CHUNK = 8 << 20

#: A-Z to a-z, other ASCII but digits and a-z to space; bytes of non-ASCII characters stay.
FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def words_of(text: bytes | None) -> list[bytes]:
    """The words of a UTF-8 text: runs of ASCII letters and digits, A-Z lower-cased, and non-ASCII characters."""
    return text.translate(FOLD).split() if text else []


class Automaton:
    """Suffix automaton of all texts of items (ids of the items that have it, words), and for each state which windows end there.

    A window is ``window`` consecutive words of an item; an item of fewer words is one window.
    State 0 is the start. For a state, ``length`` is its longest match and ``link`` its suffix
    link. Every window is a suffix of what a state matches; so a state knows, by its chain of
    suffix links, the items of the windows that end at a match (``full``), and short items with
    the matching length that each of them needs (``short``).
    """

    def __init__(self, items: list[tuple[tuple[str, ...], list[bytes]]], window: int):
        self.window = window
        self.ids: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        own: dict[int, set[str]] = {}
        short: dict[int, list[tuple[int, tuple[str, ...]]]] = {}
        pairs: set[int] = set()
        self.least = window
        for item, words in items:
            if not words:
                continue
            codes = [self.ids.setdefault(w, len(self.ids)) for w in words]
            pairs.update((a << 32) | b for a, b in zip(codes, codes[1:], strict=False))
            state = 0
            for code in codes:
                state = self._extend(state, code)
            if len(codes) < window:
                self.least = min(self.least, len(codes))
        # A second walk, when the states no longer change, marks where windows end.
        for item, words in items:
            state = 0
            for i, w in enumerate(words, 1):
                state = self.next[state][self.ids[w]]
                at = state
                while at and self.length[self.link[at]] >= window:
                    at = self.link[at]
                if i >= window:
                    own.setdefault(at, set()).update(item)
            if 0 < len(words) < window:
                at = state
                while at and self.length[self.link[at]] >= len(words):
                    at = self.link[at]
                short.setdefault(at, []).append((len(words), item))
        self.pairs = np.array(sorted(pairs), "int64")
        n = len(self.length)
        self.full: list[frozenset[str]] = [frozenset()] * n
        self.short: list[tuple[tuple[int, tuple[str, ...]], ...]] = [()] * n
        for s in sorted(range(1, n), key=self.length.__getitem__):
            up = self.link[s]
            self.full[s] = frozenset(own[s]) if s in own else self.full[up]
            self.short[s] = (*self.short[up], *short[s]) if s in short else self.short[up]

    def _extend(self, last: int, code: int) -> int:
        """The usual online step, from the state of the item so far; states of earlier items are reused."""
        nxt, link, length = self.next, self.link, self.length
        if code in nxt[last]:
            q = nxt[last][code]
            return q if length[q] == length[last] + 1 else self._clone(last, code, q)
        new = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and code not in nxt[p]:
            nxt[p][code] = new
            p = link[p]
        if p != -1:
            q = nxt[p][code]
            link[new] = q if length[q] == length[p] + 1 else self._clone(p, code, q)
        return new

    def _clone(self, p: int, code: int, q: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        copy = len(nxt)
        nxt.append(dict(nxt[q]))
        length.append(length[p] + 1)
        link.append(link[q])
        link[q] = copy
        while p != -1 and nxt[p].get(code) == q:
            nxt[p][code] = copy
            p = link[p]
        return copy

    def runs(self, codes: np.ndarray) -> Iterator[tuple[int, int]]:
        """Stretches of words that can hold a window: all word pairs in them occur in items."""
        if len(codes) < self.least:
            return
        if self.least < 2:
            fit = codes >= 0
        else:
            pair = (codes[:-1] << 32) | codes[1:]
            at = np.searchsorted(self.pairs, pair)
            known = (codes[:-1] >= 0) & (codes[1:] >= 0) & (at < len(self.pairs))
            fit = known & (self.pairs[np.minimum(at, len(self.pairs) - 1)] == pair) if len(self.pairs) else known & False
        edge = np.flatnonzero(np.diff(np.concatenate(([0], fit.view("int8"), [0]))))
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            b += self.least >= 2
            if b - a >= self.least:
                yield a, b

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Spans [a, b) of words that windows cover, in order and not overlapping, and the items of these windows."""
        spans: list[tuple[int, int]] = []
        found: set[str] = set()
        codes = np.fromiter(map(self.ids.get, words, [-1] * len(words)), "int64", len(words)) if self.ids else np.empty(0, "int64")
        nxt, link, length, window = self.next, self.link, self.length, self.window
        for a, b in self.runs(codes):
            state = matched = 0
            for i, code in enumerate(codes[a:b].tolist(), a + 1):
                while state and code not in nxt[state]:
                    state = link[state]
                    matched = length[state]
                if code in nxt[state]:
                    state, matched = nxt[state][code], matched + 1
                size = 0
                if matched >= window:
                    size = window
                    found |= self.full[state]
                for k, item in self.short[state]:
                    if matched >= k:
                        size = max(size, k)
                        found.update(item)
                if size:
                    start = i - size
                    while spans and spans[-1][1] >= start:
                        start = min(start, spans.pop()[0])
                    spans.append((start, i))
        return spans, found


@lru_cache(maxsize=1)
def _loaded(data: bytes) -> Automaton:
    """The automaton of these bytes; the tasks of one worker load it once."""
    return pickle.loads(data)


def _scanner(automaton, names: list[str], max_span: int | None) -> Callable:
    """For mapInArrow over (..., text, spans, items): adds what one automaton finds, and cuts spans of over max_span words out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _loaded(automaton.value)
        for batch in batches:
            at = {n: i for i, n in enumerate(batch.schema.names)}
            n_words, spans, items, left = [], [], [], []
            texts = batch.column(at["__text"]).cast(pa.large_binary())
            for text, old, had in zip(texts, batch.column(at["__spans"]).to_pylist(), batch.column(at["__items"]).to_pylist(), strict=True):
                words = words_of(text.as_py())
                got, found = own.scan(words)
                n_words.append(len(words))
                spans.append(union([*(tuple(x) for x in old or ()), *got]))
                items.append(sorted(found.union(had or ())))
                if max_span is not None:
                    long = [s for s in spans[-1] if s[1] - s[0] > max_span]
                    left.append(cut(text.as_py(), long) if long else text.as_py())
            new = {
                "__n_words": pa.array(n_words, pa.int64()),
                "__spans": pa.array([[list(x) for x in s] for s in spans], pa.list_(pa.list_(pa.int64()))),
                "__items": pa.array(items, pa.list_(pa.string())),
            } | ({} if max_span is None else {"__text": pa.array(left, pa.large_binary()).cast(batch.schema.field("__text").type)})
            yield pa.RecordBatch.from_arrays([new[n] if n in new else batch.column(at[n]) for n in names], names)

    return run


def union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans in order, overlapping and touching ones made one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def automata(benchmark: DataFrame, window: int, id_col: str, text_col: str, part_bytes: int, most: int) -> tuple[DataFrame, int]:
    """(part, piece, data) of the pickled automata, and how many there are: items are dealt to parts of about ``part_bytes`` by the hash of their text.

    Each part is built in a task of its own and written to the shared folder in pieces. Items over
    ``most`` bytes together are refused.
    """
    items = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if size > most:
        raise ValueError(f"the benchmark has {size} bytes; max_benchmark_bytes is {most}")
    parts = max(1, -(-size // part_bytes))
    # a text that many items have is one, whose ids are told afterwards
    texts = items.filter("text <> ''").groupBy("text").agg(F.array_sort(F.collect_set("item")).alias("items"))

    def build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        own = Automaton([(tuple(i), words_of(t.encode())) for i, t in zip(rows["items"], rows["text"], strict=True)], window)
        data = pickle.dumps(own, pickle.HIGHEST_PROTOCOL)
        at = range(0, len(data), CHUNK)
        return pd.DataFrame({"part": key[0], "piece": range(len(at)), "data": [data[x : x + CHUNK] for x in at]})

    dealt = texts.withColumn("part", F.pmod(F.xxhash64("text"), F.lit(parts)).cast("int")).groupBy("part")
    return settle(dealt.applyInPandas(build, "part int, piece int, data binary"), "automata"), parts


def scan(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 10,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    part_bytes: int = BYTES_PER_AUTOMATON,
    max_benchmark_bytes: int = MAX_BENCHMARK_BYTES,
    cut_over: int | None = None,
) -> DataFrame:
    """Add to each document where benchmark windows occur in it.

    Every column of ``docs`` is kept; ``found`` is added, a struct of n_words, spans (word ranges
    [a, b) covered by windows) and items (ids of items with occurring windows, sorted as strings).
    A column of that name is replaced. Documents are streamed through the broadcast automaton and
    never shuffled. Automata are built in tasks; of a benchmark of over ``part_bytes`` bytes, the
    driver and every task hold one at a time, and what the documents have so far is written to the
    shared folder in between. Over ``max_benchmark_bytes`` it is refused. With ``cut_over``, spans of more words than that are cut out of the text (the
    struct tells where they were). Null and empty texts and items have no words; a null item id counts as ''.
    Lowers the session's Arrow batch limits where they are larger (common.bound_batches).
    """
    spark = docs.sparkSession
    keep = docs.drop("found")
    own = F.struct(F.lit(0).alias("__none"), *[F.col(f"`{c}`") for c in keep.columns if c != text_col])
    rows = keep.select(
        own.alias("__row"),
        F.col(text_col).alias("__text"),
        F.lit(0).cast("long").alias("__n_words"),
        F.array().cast("array<array<long>>").alias("__spans"),
        F.array().cast("array<string>").alias("__items"),
    )
    bound_batches(spark)
    table, parts = automata(benchmark, window, item_id_col, item_text_col, part_bytes, max_benchmark_bytes)
    for i in range(parts):
        pieces = table.filter(F.col("part") == i).orderBy("piece").toLocalIterator()
        data = b"".join(bytes(r["data"]) for r in pieces) or pickle.dumps(Automaton([], window))
        shared = spark.sparkContext.broadcast(data)  # one automaton, whose bound is part_bytes
        last = i + 1 == parts
        rows = rows.mapInArrow(_scanner(shared, rows.columns, cut_over if last else None), rows.schema)
        if not last:
            rows = settle(rows, "automaton-hits")
            shared.destroy()
    return rows.select(
        *[F.col("__text" if c == text_col else f"__row.`{c}`").alias(c) for c in keep.columns],
        F.struct(F.col("__n_words").alias("n_words"), F.col("__spans").alias("spans"), F.col("__items").alias("items")).alias("found"),
    )


def word_offsets(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Byte ranges of the words of a text."""
    inside = np.frombuffer(text.translate(FOLD), "u1") != 0x20
    edge = np.flatnonzero(np.diff(np.concatenate(([0], inside.view("int8"), [0]))))
    return edge[::2], edge[1::2]


def cut(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the words of these spans and what stands between them."""
    starts, ends = word_offsets(data)
    keep, at = [], 0
    for a, b in spans:
        keep.append(data[at : starts[a]])
        at = ends[b - 1]
    return b"".join([*keep, data[at:]])


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 10,
    max_span: int = 0,
    max_coverage: float = 0.5,
    text_col: str = "text",
    **names,
) -> DataFrame:
    """Remove benchmark passages from documents.

    Spans of more than ``max_span`` words that benchmark windows cover are cut out of the text. A
    document of which they cover more than ``max_coverage`` is removed. All columns of ``docs`` are
    kept, in order; names and cases are as in :func:`scan`. Documents without a hit stay as they are.
    """

    found = scan(docs, benchmark, window, text_col, cut_over=max_span, **names)
    hit = F.aggregate("found.spans", F.lit(0).cast("long"), lambda n, s: n + F.when(s[1] - s[0] > max_span, s[1] - s[0]).otherwise(0))
    return found.filter(hit <= F.lit(max_coverage) * F.col("found.n_words")).select(*[f"`{c}`" for c in docs.columns])


def summary(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 (of the comma-joined ids), contaminated."""
    hit = F.aggregate("found.spans", F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])
    rows = found.select(
        F.col(id_col).alias("doc_id"),
        F.col("found.n_words").alias("n_words"),
        hit.alias("n_hit"),
        F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("found.items", ","), 256).alias("items_sha256"),
    )
    return rows.withColumn("contaminated", F.col("n_hit") > 0)


def digest_of(items: set[str]) -> str:
    """items_sha256 of a set of ids, for tests."""
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
