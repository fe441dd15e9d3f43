"""Encoding and decoding with a byte-level BPE vocabulary whose words carry an end mark.

A text is normalised and cut into words, and the bytes of a word are joined pair by pair. Short words of
one length are rows of two contiguous arrays: their parts, and the rank of each two neighbours. A round scans the
ranks of each row for the smallest, deletes the boundary there, and computes the ranks on both sides anew;
so a row is a part shorter after each round, until no two neighbours of it may be joined. A long word, where scanning again and
again would take the square of its length, takes its pairs from a heap in the same order. The words of a
corpus repeat: those of a batch are encoded once each, and a task remembers them for the batches to come.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches
from .packing import byte_alphabet

#: Words of more bytes are joined by a heap, and not remembered.
LONG = 64
#: Short words that a task remembers from batch to batch; with more, it begins anew.
MEMO = 1 << 18
NEVER = 1 << 40


class Encoder:
    """Ids of texts by a vocabulary file in the JSON form of the tokenizers library: what it gives with add_special_tokens=False.

    The file's normaliser is the library's own. Words are found by the file's pattern; only texts with
    characters that this Python's Unicode does not know are cut by the library, whose tables decide whether these
    are letters. Strings of added tokens are one id each, wherever they stand. Ids are bytes, 32 bits each, in this machine's order.
    """

    def __init__(self, tokenizer_path: str):
        import regex
        from tokenizers import Tokenizer

        with open(tokenizer_path, encoding="utf-8") as f:
            told = json.load(f)
        cuts = (told["pre_tokenizer"] or {}).get("pretokenizers") or [{}, {}]
        known = [x.get("type") for x in cuts] == ["Split", "ByteLevel"] and cuts[0]["behavior"] == "Removed" and cuts[0]["invert"] and not cuts[1]["add_prefix_space"] and not cuts[1]["use_regex"]
        added, model = told["added_tokens"], told["model"]
        if not known or model["type"] != "BPE" or any(x[k] for x in added for k in ("normalized", "lstrip", "rstrip", "single_word")) or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "byte_fallback", "ignore_merges")):
            raise ValueError(f"{tokenizer_path} is not a byte-level BPE with words cut by one pattern")
        vocab, end = model["vocab"], model["end_of_word_suffix"] or ""
        pairs = [pair if isinstance(pair, list) else pair.split(" ") for pair in model["merges"]]
        self._bytes = byte_alphabet()
        signs = sorted(self._bytes, key=self._bytes.get)
        self._inner, self._last = (np.array([vocab[x + e] for x in signs], "int64") for e in ("", end))
        self._size = max(vocab.values()) + 1
        keys = np.array([vocab[a] * self._size + vocab[b] for a, b in pairs], "int64")
        self._order = np.argsort(keys)
        self._keys = keys[self._order]
        self._made = np.array([vocab[a + b] for a, b in pairs], "int64")
        self._ranks: dict[int, int] = {}
        self._words = regex.compile(cuts[0]["pattern"]["Regex"]).findall
        self._library = Tokenizer.from_file(tokenizer_path)
        self._added = {x["content"]: np.array([x["id"]], "int32").tobytes() for x in added}
        self._parts = regex.compile(f"({'|'.join(map(regex.escape, sorted(self._added, key=len, reverse=True)))})").split if added else None
        self._known: set[str] = set()
        self._memo: dict[str, bytes] = {}

    def __call__(self, texts: list[str]) -> list[bytes]:
        """The ids of each text."""
        cut = [self._cut(t) for t in texts]
        if len(self._memo) > MEMO:
            self._memo.clear()
        memo = self._memo
        fresh = {w for parts in cut for words in parts if isinstance(words, list) for w in words} - memo.keys()
        lengths: dict[int, list[str]] = {}
        for word in fresh:
            lengths.setdefault(len(word.encode()), []).append(word)
        long = [w for n, words in lengths.items() if n > LONG for w in words]
        for n, words in lengths.items():
            memo.update(zip(words, self.scanned([w.encode() for w in words]) if n <= LONG else map(self.heaped, words), strict=True))
        found = [b"".join([p if isinstance(p, bytes) else b"".join(map(memo.__getitem__, p)) for p in parts]) for parts in cut]
        for word in long:
            del memo[word]
        return found

    def _cut(self, text: str) -> list[list[str] | bytes]:
        """Lists of words, and the ids of the added tokens between them."""
        parts = [text] if not any(x in text for x in self._added) else self._parts(text)
        return [self._added[x] if i % 2 else self._find(x) for i, x in enumerate(parts)]

    def _find(self, text: str) -> list[str]:
        if text.isascii():
            return self._words(text.lower())
        text = self._library.normalizer.normalize_str(text)
        if not self._known.issuperset(text):
            fresh = set(text) - self._known
            self._known |= {c for c in fresh if unicodedata.category(c) != "Cn"}
            if not self._known >= fresh:
                found = self._library.pre_tokenizer.pre_tokenize_str(text)
                return [bytes(self._bytes[c] for c in x).decode() for x, _ in found]
        return self._words(text)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The ranks of pairs of neighbours; NEVER for those that are not joined."""
        keys = left * self._size + right
        at = np.minimum(np.searchsorted(self._keys, keys), len(self._keys) - 1)
        return np.where(self._keys[at] == keys, self._order[at], NEVER)

    def scanned(self, words: list[bytes]) -> list[bytes]:
        """The ids of words of one length, by scanning the ranks of neighbours for the smallest, the first of equal ones."""
        signs = np.frombuffer(b"".join(words), "uint8").reshape(len(words), -1)
        parts = self._inner[signs]
        parts[:, -1] = self._last[signs[:, -1]]
        ranks = np.full(parts.shape, NEVER)  # the last part has no neighbour to its right
        ranks[:, :-1] = self._rank(parts[:, :-1], parts[:, 1:])
        found, live = [b""] * len(words), np.arange(len(words))
        while True:
            at = ranks.argmin(axis=1)
            least = ranks[np.arange(len(live)), at]
            ended, going = least == NEVER, least < NEVER
            for i, ids in zip(live[ended].tolist(), parts[ended].astype("int32"), strict=True):
                found[i] = ids.tobytes()
            live, parts, ranks, at, least = live[going], parts[going], ranks[going], at[going], least[going]
            if not len(live):
                return found
            rows, width = np.arange(len(live)), parts.shape[1]
            columns = np.arange(width)
            parts = parts[columns != at[:, None] + 1].reshape(-1, width - 1)
            ranks = ranks[columns != at[:, None]].reshape(-1, width - 1)
            parts[rows, at] = self._made[least]
            for side in (-1, 0):
                there = (at + side >= 0) & (at + side < width - 2)
                row, i = rows[there], at[there] + side
                ranks[row, i] = self._rank(parts[row, i], parts[row, i + 1])
        return found

    def heaped(self, word: str) -> bytes:
        """The ids of one word of any length, with a heap of (rank, place) and links between neighbours."""
        if not self._ranks:
            self._ranks = dict(zip(self._keys.tolist(), self._order.tolist(), strict=True))
        signs = np.frombuffer(word.encode(), "uint8")
        parts = [*self._inner[signs[:-1]].tolist(), int(self._last[signs[-1]])]
        n, size, get = len(parts), self._size, self._ranks.get
        before, after = [*range(-1, n - 1)], [*range(1, n + 1)]
        heap = [(r, i) for i in range(n - 1) if (r := get(parts[i] * size + parts[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if j >= n or parts[i] < 0 or get(parts[i] * size + parts[j]) != rank:
                continue  # one of the two has been joined to another since
            parts[i], parts[j] = int(self._made[rank]), -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for a in (before[i], i):
                if a >= 0 and after[a] < n and (r := get(parts[a] * size + parts[after[a]])) is not None:
                    heapq.heappush(heap, (r, a))
        return np.array([p for p in parts if p >= 0], "int32").tobytes()


@lru_cache(4)
def encoder(tokenizer_path: str) -> Encoder:
    """One for each file and Python worker, so that later tasks find the words that earlier ones met."""
    return Encoder(tokenizer_path)


@lru_cache(4)
def tokens(tokenizer_path: str) -> tuple[pa.Array, np.ndarray]:
    """The strings of all ids, null for ids without one, and which ids are special."""
    with open(tokenizer_path, encoding="utf-8") as f:
        told = json.load(f)
    if told["decoder"]:
        raise ValueError(f"{tokenizer_path} has a decoder; tokens are joined by spaces only where there is none")
    named = {i: t for t, i in told["model"]["vocab"].items()} | {x["id"]: x["content"] for x in told["added_tokens"]}
    special = {x["id"] for x in told["added_tokens"] if x["special"]}
    size = max(named, default=-1) + 1
    return pa.array([named.get(i) for i in range(size)], pa.string()), np.array([i in special for i in range(size)], bool)


def _encode(tokenizer_path: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            found = [np.frombuffer(ids, "int32") for ids in encode([t or "" for t in texts])]
            ends = np.cumsum([0, *map(len, found)]).astype("int32")
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, "int32"), *found])))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], ids], [*batch.schema.names[:-1], "ids"])

    return run


def _decode(tokenizer_path: str, skip_special: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strings, special = tokens(tokenizer_path)
        for batch in batches:
            lists = batch.column(batch.num_columns - 1)
            ids = np.asarray(lists.flatten().fill_null(-1), "int64")
            ends = np.cumsum([0, *(pc.list_value_length(lists).fill_null(0)).to_pylist()])
            kept = (ids >= 0) & (ids < len(strings))
            if skip_special:
                kept[kept] &= ~special[ids[kept]]
            known = pc.take(strings, pa.array(ids[kept]))
            ends = np.append(0, np.cumsum(kept))[ends]
            if known.null_count:
                there = np.asarray(known.is_valid())
                known, ends = known.drop_null(), np.append(0, np.cumsum(there))[ends]
            texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), known), " ")
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], texts], [*batch.schema.names[:-1], "decoded"])

    return run


def _apply(rows: DataFrame, column: str, run: Callable, made: str) -> DataFrame:
    """Rows with the column, moved to the end, replaced by what run makes of it."""
    bound_batches(rows.sparkSession)
    kept = [f for f in rows.schema if f.name not in (column, made.split()[0])]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), made])
    return rows.select(*[f"`{f.name}`" for f in kept], column).mapInArrow(run, schema)


def encode(docs: DataFrame, tokenizer_path: str, text_col: str = "text") -> DataFrame:
    """Replace texts by ``ids``, an array of the ids that the tokenizers library gives for them without special tokens.

    An empty or null text has no ids. Texts are encoded whole; truncation and padding of the file are not
    applied. Other columns stay as they are, but for one named ``ids``, which is replaced. Rows may repeat. A word
    may be as long as the text. No row is shuffled; a task holds the file's tables, at most MEMO short words and a batch of 8 MB of texts or the longest one.
    """
    return _apply(docs, text_col, _encode(tokenizer_path), "ids array<int>")


def decode(rows: DataFrame, tokenizer_path: str, ids_col: str = "ids", skip_special_tokens: bool = False) -> DataFrame:
    """Replace arrays of ids by ``decoded``: their tokens joined by spaces, as the tokenizers library decodes where a file names no decoder.

    Ids that are null or not in the file are left out; an empty or null array is an empty text. Other columns stay, but for one named ``decoded``.
    """
    return _apply(rows, ids_col, _decode(tokenizer_path, skip_special_tokens), "decoded string")
