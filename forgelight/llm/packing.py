"""Packing of token sequences: exact complements first, best fit for what is left."""

from __future__ import annotations

import json
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bound_batches, settle

#: How a byte-level BPE of this family cuts a text into words.
WORDS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"

#: (lengths in order of place, how many sequences hold just these)
Pattern = tuple[tuple[int, ...], int]


def complements(counts: dict[int, int], size: int) -> tuple[list[Pattern], dict[int, int]]:
    """Use up pieces whose lengths sum to size exactly, longest first.

    For each length, its gap is looked up among the single lengths, then the sums of pairs, then
    those of triples; a combination is taken as often as the counts of its members allow, which
    uses up one of them. Returns the patterns and the counts that are left. The work depends on the
    number of lengths only, not on that of pieces.
    """
    left = np.zeros(size + 1, "int64")
    for length, n in counts.items():
        left[length] = n
    done: list[Pattern] = []

    def take(*parts: int) -> None:
        uses = {x: parts.count(x) for x in parts}
        n = min(int(left[x]) // k for x, k in uses.items())
        if n > 0:
            for x, k in uses.items():
                left[x] -= n * k
            done.append((parts, n))

    def pairs(first: tuple[int, ...], gap: int, most: int) -> None:
        """Take first with pairs (a, gap - a), most >= a >= gap - a, while its members last."""
        a = np.arange(min(most, gap - 1), (gap - 1) // 2, -1)
        for x in a[(left[a] > 0) & (left[gap - a] > 0)].tolist():
            take(*first, x, gap - x)
            if not all(left[y] for y in first):
                return

    for length in range(size, 0, -1):
        gap = size - length
        if left[length] and not gap:
            take(length)
        if left[length] and 0 < gap <= length and left[gap]:
            take(length, gap)
        if left[length] and gap >= 2:
            pairs((length,), gap, length)
        if left[length] and gap >= 3:
            a = np.arange(min(length, gap - 2), (gap + 2) // 3 - 1, -1)
            for x in a[left[a] > 0].tolist():
                if left[x] and left[length]:
                    pairs((length, x), gap - x, x)
    return done, {int(x): int(left[x]) for x in np.flatnonzero(left)}


def best_fit(counts: dict[int, int], size: int) -> list[Pattern]:
    """Best fit, longest first, for all pieces of a length at once: like open sequences are held as one pattern."""
    rooms: dict[int, dict[tuple[int, ...], int]] = {}
    spaces: list[int] = []

    def add(parts: tuple[int, ...], n: int) -> None:
        free = size - sum(parts)
        if free not in rooms:
            rooms[free] = {}
            insort(spaces, free)
        rooms[free][parts] = rooms[free].get(parts, 0) + n

    for length in sorted(counts, reverse=True):
        n = counts[length]
        while n:
            at = bisect_left(spaces, length)
            # the tightest open sequences that a piece fits into, or as many new ones as are needed
            free = spaces[at] if at < len(spaces) else size
            parts, have = rooms[free].popitem() if at < len(spaces) else ((), n)
            each = free // length
            full, rest = divmod(min(n, have * each), each)
            if full:
                add((*parts, *(length,) * each), full)
            if rest:
                add((*parts, *(length,) * rest), 1)
            unused = have - full - bool(rest)
            if at < len(spaces) and free in rooms:
                if parts and unused:
                    rooms[free][parts] = unused
                if not rooms[free]:
                    del rooms[free]
                    spaces.remove(free)
            n -= full * each + rest
    return [(parts, n) for own in rooms.values() for parts, n in own.items()]


def plan(counts: dict[int, int], size: int) -> list[Pattern]:
    """Patterns that hold each length as often as counts says, none longer than size."""
    done, left = complements(counts, size)
    return done + best_fit(left, size)


def byte_alphabet() -> dict[str, int]:
    """The character by which a byte-level vocabulary writes each byte: printable ones as they are, others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Encoder:
    """Ids of whole texts by a byte-level BPE vocabulary in the JSON form of the tokenizers library.

    The ids are those that ``tokenizers`` gives with add_special_tokens=False. tiktoken computes them
    from the same vocabulary, whose ids are the ranks of its merges, at five times the speed; texts
    that hold the string of an added token, which ``tokenizers`` makes one id, go to ``tokenizers`` itself.
    """

    def __init__(self, tokenizer_path: str):
        import tiktoken
        from tokenizers import Tokenizer

        with open(tokenizer_path, encoding="utf-8") as f:
            model = json.load(f)
        self._added = [x["content"] for x in model.get("added_tokens", [])]
        alphabet = byte_alphabet()
        ranks = {bytes(alphabet[c] for c in word): i for word, i in model["model"]["vocab"].items() if word not in self._added}
        self._plain = tiktoken.Encoding("file", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self._whole = Tokenizer.from_file(tokenizer_path)

    def __call__(self, text: str) -> bytes:
        """The ids of a text as unsigned 32-bit integers in this machine's order."""
        if any(x in text for x in self._added):
            return array("I", self._whole.encode(text, add_special_tokens=False).ids).tobytes()
        return array("I", self._plain(text)).tobytes()


def pieces_of(ids: bytes, size: int) -> list[tuple[int, int, int, int]]:
    """(piece, start, length, crc32) of a document: only one of over size ids is cut; its first piece is the shorter."""
    n = len(ids) // 4
    starts = [0, *range(n % size or size, n, size)]
    return [(i, s, e - s, zlib.crc32(ids[4 * s : 4 * e])) for i, (s, e) in enumerate(zip(starts, [*starts[1:], n], strict=True))]


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut_pieces(tokenizer_path: str, size: int) -> Callable:
    """For mapInArrow over (doc_id, text): a row for each piece. A document's ids end with id 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(tokenizer_path)
        names = [x.split()[0] for x in PIECES.split(", ")]
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        for batch in batches:
            rows = [
                (doc_id, *piece)
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True)
                for piece in pieces_of(encode(text.as_py() or "") + bytes(4), size)
            ]
            columns = zip(*rows, strict=True) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names)

    return run


def place(pieces: DataFrame, size: int, length_col: str = "length") -> DataFrame:
    """Add sequence_id and offset to a settled table of pieces: as few sequences of at most size as possible.

    Only the histogram of lengths, at most ``size`` numbers, comes to the driver. The pieces of a
    length are then numbered, and the number decides the pattern, sequence and place. A length of
    many pieces is numbered in bins, so no task holds all of it.
    """
    spark = pieces.sparkSession
    lengths = F.col(length_col)
    binned = pieces.withColumn("bin", F.spark_partition_id())
    binned = settle(binned, "pack-bins")
    sums = binned.groupBy(length_col, "bin").agg(F.count("*").alias("n"))
    before = Window.partitionBy(length_col).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    counts = {int(r[0]): int(r[1]) for r in pieces.groupBy(length_col).count().collect()}
    if any(x < 1 or x > size for x in counts):
        raise ValueError(f"lengths must be 1 to {size}")
    taken = dict.fromkeys(counts, 0)
    rows, sequence = [], 0
    for parts, n in plan(counts, size):
        offset = 0
        for x in dict.fromkeys(parts):
            k = parts.count(x)
            rows.append((x, taken[x], taken[x] + n * k, k, sequence, offset))
            taken[x] += n * k
            offset += k * x
        sequence += n
    slots = spark.createDataFrame(rows, f"{length_col} long, low long, high long, k long, first long, base long")
    # Ranges of a length: their list has a bound that depends on size only, so it may be broadcast.
    lists = slots.groupBy(length_col).agg(F.array_sort(F.collect_list(F.struct("low", "high", "k", "first", "base"))).alias("slots"))
    order = Window.partitionBy(length_col, "bin").orderBy("ids_crc32", "doc_id", "piece")
    numbered = (
        binned.withColumn("at", F.row_number().over(order) - 1)
        .join(sums.drop("n"), [length_col, "bin"])
        .withColumn("at", F.col("at") + F.col("before"))
        .join(F.broadcast(lists), length_col)
        .withColumn("slot", F.expr("filter(slots, s -> s.low <= at and at < s.high)[0]"))
    )
    nth = F.col("at") - F.col("slot.low")
    return numbered.withColumns(
        {
            "sequence_id": F.col("slot.first") + F.floor(nth / F.col("slot.k")),
            "offset": F.col("slot.base") + (nth % F.col("slot.k")) * lengths,
        }
    ).select(*pieces.columns, "sequence_id", "offset")


def pack(docs: DataFrame, tokenizer_path: str, size: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenize documents and pack them into as few sequences of at most ``size`` ids as possible.

    A document's ids end with id 0; only longer ones are cut into pieces of ``size`` ids, the first
    of which may be shorter. Pieces are packed by exact complements: lengths, pairs and triples of
    lengths that fill a gap exactly are consumed first, the rest goes by best fit.

    Returns doc_id, piece, start, length, ids_crc32, sequence_id, offset. A null text is an empty
    one, whose only id is 0. Null ids and repeated rows are documents like others; an empty table
    gives an empty result. Other columns are not read. Lowers the session's Arrow batch limits where they are larger (common.bound_batches).
    """
    bound_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    pieces = settle(texts.mapInArrow(cut_pieces(tokenizer_path, size), PIECES), "pack-pieces")
    return place(pieces, size)
