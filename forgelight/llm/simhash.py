"""Near-duplicates by SimHash fingerprints, found through deletion-variant signatures."""

from __future__ import annotations

import math
from collections import deque
from collections.abc import Callable, Iterator
from functools import reduce
from itertools import accumulate, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, join_by_key, settle
from .graph import components

SEED = 42
#: Shingles whose bits are counted at a time.
BLOCK = 1 << 16
#: Fingerprints of one signature that are compared in one place; a signature of more is cut further.
MAX_RUN = 8192


def words_of(text: bytes | None) -> list[bytes]:
    """Words of a UTF-8 text: what stands between ASCII white space, A-Z lower-cased."""
    return text.lower().split() if text else []


def shingles(words: list[bytes], width: int) -> np.ndarray:
    """XXH64 hashes of the shingles: ``width`` words joined by spaces, repeats included; fewer words are one shingle."""
    if not words:
        return np.zeros(0, "<u8")
    joined = b" ".join(words)
    ends = [e - 1 for e in accumulate(len(w) + 1 for w in words)]
    starts = [0, *[e + 1 for e in ends[:-1]]]
    n = max(1, len(words) - width + 1)
    parts = map(joined.__getitem__, map(slice, starts[:n], ends[min(width, len(words)) - 1 :]))
    return np.fromiter(map(xxhash.xxh64_intdigest, parts, repeat(SEED)), "<u8", n)


def fingerprint(words: list[bytes], width: int) -> int:
    """64-bit SimHash: a bit is 1 if over half of the shingles' hashes have it; no words give 0."""
    if not words:
        return 0
    h = shingles(words, width)
    n = len(h)
    ones = np.zeros(64, "int64")
    for at in range(0, n, BLOCK):
        ones += np.unpackbits(h[at : at + BLOCK].view("u1").reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype="int64")
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, fp) of each row; fp is the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary())
            found = np.fromiter((fingerprint(words_of(t.as_py()), width) for t in texts), "u8", len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view("i8"))], ["doc_id", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, fp long")


def cuts(bits: int) -> int:
    """Segments to cut into, so that one of them differs by one bit at most (two at least, for the size of the keys)."""
    return max(2, bits // 2 + 1)


def mixed(x: np.ndarray) -> np.ndarray:
    """Numbers of 64 bits well mixed; an equal pair of unlike ones only brings more fingerprints together."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def segments(used: int, n: int) -> list[list[int]]:
    """The bits that ``used`` does not have, in order, cut into n runs of near-equal length."""
    free = [i for i in range(64) if not used >> i & 1]
    return [own for i in range(n) if (own := free[len(free) * i // n : len(free) * (i + 1) // n])]


def signatures(fp: np.ndarray, key: np.ndarray, used: int, n: int, plain: bool = False) -> Iterator[tuple[np.ndarray, int]]:
    """(keys, bits used) for each segment of the bits not yet used; keys has a row for each fingerprint.

    The first key of a row is of the segment as it is, the others of it with one bit as a wildcard.
    Fingerprints whose segment differs by one bit at most have the key with that bit as the
    wildcard in common, or the first. Wildcard keys are odd, others even.
    """
    u = fp.view("u8")
    for own in segments(used, n):
        mask = sum(1 << i for i in own)
        wild = np.array([0, *(1 << i for i in own if not plain)], "u8")
        value = (u[:, None] & np.uint64(mask)) & ~wild
        seed = mixed(key.view("u8")[:, None] ^ mixed(np.array([mask], "u8")) ^ mixed(wild + np.uint64(1))[None])
        out = (mixed(value ^ seed) & ~np.uint64(1)) | (wild != 0).astype("u8")
        yield out.view("i8"), used | mask


def one_sided(key: int, used: int, fp: np.ndarray) -> bool:
    """True for a wildcard key whose fingerprints differ in no used bit: the keys without a wildcard have them together."""
    if not key & 1:
        return False
    u = fp.view("u8")
    return not (np.bitwise_or.reduce(u ^ u[0]) & np.uint64(used & (1 << 64) - 1))


#: Fingerprints that are compared all at once.
AT_ONCE = 1024


def forest(fp: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """Links that connect what links of ``bits`` or fewer differing bits connect, one less than nodes at most.

    Fingerprints come in the order of a hash, so that the same ones are linked to first wherever they occur.
    """
    u = fp.view("u8")  # bits of a negative number would be counted on its absolute value
    if len(u) <= AT_ONCE:
        u = u[(np.bitwise_count(u[:, None] ^ u) <= bits).sum(1) > 1]
    out: list[tuple[int, int]] = []
    rest = u[np.argsort(mixed(u), kind="stable")]
    while len(rest) > 1:
        edge, rest = deque(rest[:1]), rest[1:]
        while edge and len(rest):
            x = edge.popleft()
            near = np.bitwise_count(rest ^ x) <= bits
            if near.any():
                new = rest[near]
                out += zip(repeat(int(x.astype("i8"))), new.view("i8").tolist(), strict=False)
                edge.extend(new)
                rest = rest[~near]
    return out


KEYED = "key long, used long, fp long"
OUT = "key long, used long, a long, b long"
#: A signature of more fingerprints than this is cut again by signatures of their other bits, before it is compared in blocks.
RECUT = 1 << 18
#: Cuts after the first; by then the segments leave few bits in which fingerprints could differ.
MAX_CUTS, NEVER = 3, 1 << 62


def _keyed(n: int, names: list[str], plain: bool = False) -> Callable:
    """For mapInArrow over (key, used, fp, ...): a row for each signature of the bits not yet used, other columns as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, used, fp, *rest = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            for own in np.unique(used):
                mine = used == own
                for keys, now in signatures(fp[mine], key[mine], int(own) & (1 << 64) - 1, n, plain):
                    width = keys.shape[1]
                    taken = np.full(keys.size, now, "u8").view("i8")
                    yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(taken), *[pa.array(np.repeat(c[mine], width)) for c in (fp, *rest)]], names)

    return run


def _links_of_runs(bits: int, most: int | None, small: int = 2) -> Callable:
    """For mapInArrow over rows (key, used, fp) in order of key: verified links as (a, b).

    A run of over ``most`` fingerprints is not compared but passed on, as rows without b. Of runs of
    up to ``small`` all links are given, of others a forest.
    """

    def compared(held: list[np.ndarray], name: tuple[int, int]) -> list[tuple[int, int]]:
        fp = np.concatenate(held)
        return [] if one_sided(*name, fp) else forest(fp, bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []  # fingerprints of the last run, which may go on
        name: tuple[int, int] | None = None
        hot = False

        def passed(fp: np.ndarray) -> pa.RecordBatch:
            n = len(fp)
            return pa.RecordBatch.from_arrays([pa.array(np.full(n, name[0])), pa.array(np.full(n, name[1])), pa.array(fp), pa.nulls(n, pa.int64())], ["key", "used", "a", "b"])

        def linked(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
            a, b = np.array(pairs, "i8").reshape(-1, 2).T
            return pa.RecordBatch.from_arrays([pa.nulls(len(a), pa.int64()), pa.nulls(len(a), pa.int64()), pa.array(a), pa.array(b)], ["key", "used", "a", "b"])

        for batch in batches:
            key, used, fp = (batch.column(i).to_numpy() for i in range(3))
            if not len(key):
                continue
            edge = np.flatnonzero(key[1:] != key[:-1]) + 1
            starts, ends = np.concatenate(([0], edge)), np.concatenate((edge, [len(key)]))
            pairs: list[tuple[int, int]] = []
            # Whole runs of a few, the most frequent, are compared together: each row with that so many places on.
            inner = np.arange(len(starts))
            inner = (inner > 0) & (inner < len(starts) - 1) & (ends - starts <= small)
            left = np.where(inner, ends - starts, 0).repeat(ends - starts) - (np.arange(len(key)) - starts.repeat(ends - starts))
            for step in range(1, small):
                at = np.flatnonzero(left > step)
                x, y = fp[at], fp[at + step]
                near = np.bitwise_count((x ^ y).view("u8")) <= bits
                pairs += zip(x[near].tolist(), y[near].tolist(), strict=True)
            for i in np.flatnonzero((ends - starts > small) | (np.arange(len(starts)) % max(1, len(starts) - 1) == 0)):
                a, b = starts[i], ends[i]
                if name is None or name[0] != int(key[a]):
                    if held and not hot:
                        pairs += compared(held, name)
                    held, name, hot = [], (int(key[a]), int(used[a])), False
                held.append(fp[a:b])
                if most is not None and (hot or sum(map(len, held)) > most):
                    hot = True
                    yield passed(np.concatenate(held))
                    held = []
            if pairs:
                yield linked(pairs)
        if held and not hot:
            yield linked(compared(held, name))

    return run


def _in_blocks(rows: DataFrame, max_run: int) -> DataFrame:
    """Rows (key, used, ..., size) of long runs, dealt to groups of two blocks each, so that any two rows of a run meet in one."""
    blocks = F.ceil(F.col("size") / F.lit(max_run))
    own = rows.withColumn("__b", F.pmod(F.xxhash64(*[c for c in rows.columns if c not in ("key", "used", "size")]), blocks))
    met = own.withColumn("__o", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    return met.withColumn("key", F.xxhash64("key", F.least("__b", "__o"), F.greatest("__b", "__o")).bitwiseAND(F.lit(-2)).bitwiseOR(F.col("key").bitwiseAND(F.lit(1)))).drop("__b", "__o", "size")


def _compared(nodes: DataFrame, n: int, schema: str, compare: Callable, out: str, max_run: int, recut: int, plain: bool = False) -> DataFrame:
    """What ``compare`` (with the longest run that it may take) finds among nodes (fp, ...) of equal signature: rows whose b is not null.

    Nodes may have a ``key`` from the start: only those of one key meet then. Runs that are too long come back without b. Up to ``recut`` rows, they are dealt to tasks in
    blocks that meet two and two; longer ones are cut again and again by signatures of the bits not yet used, until
    they are no longer so, or MAX_CUTS times: what is alike in all those segments is dealt in blocks however much it is.
    """
    names = [c.split()[0] for c in schema.split(", ")]
    back = [F.col("a").alias("fp") if c == "fp" and "fp" not in out else c for c in names]
    grouped = lambda rows: rows.repartition("key").sortWithinPartitions("key")
    signed = lambda rows: grouped(rows.select(names).mapInArrow(_keyed(n, names, plain), schema)).mapInArrow(compare(max_run), out)

    def long_runs(made: DataFrame) -> DataFrame | None:
        hot = made.filter("b is null").select(back)
        if hot.isEmpty():
            return None
        sizes = settle(hot.groupBy("key").agg(F.count("*").alias("n")), "simhash-sizes")
        return settle(join_by_key(hot, sizes.withColumn("size", F.col("n")), "key"), "simhash-hot")

    started = nodes if "key" in nodes.columns else nodes.withColumn("key", F.lit(0).cast("long"))
    made = settle(signed(started.withColumn("used", F.lit(0).cast("long"))), "simhash-runs")
    found, hot, blocks = [made], long_runs(made), []
    for cut in range(MAX_CUTS + 1):
        if hot is None:
            break
        longer = F.col("size") > (recut if cut < MAX_CUTS else F.lit(NEVER))
        blocks.append(hot.filter(~longer).select(*names, "size"))
        again = settle(signed(hot.filter(longer)), "simhash-runs")
        found.append(again)
        hot = long_runs(again)
    if blocks:
        found.append(grouped(_in_blocks(reduce(DataFrame.union, blocks), max_run).select(names)).mapInArrow(compare(None), out))
    return reduce(DataFrame.union, found).filter("b is not null")


def near_links(nodes: DataFrame, bits: int = 3, max_run: int = MAX_RUN, small: int = 2, recut: int = RECUT) -> DataFrame:
    """Links (a, b) among distinct fingerprints (fp) that connect whatever differs by ``bits`` or fewer bits.

    Deletion variants: the 64 bits are cut into bits // 2 + 1 segments, so of two fingerprints that
    near one segment differs by one bit at most. Every segment is indexed as it is and with each of
    its bits as a wildcard; equal signatures meet by a shuffle on them and are verified. Of a
    signature's verified links a spanning forest is kept, which has the same components. Signatures
    of over ``max_run`` fingerprints are compared in blocks of that size, two at a time in a task; those
    of over ``recut`` are first cut again by signatures of their other bits. With a column ``key``, only nodes of one key are linked; a
    fingerprint may have several.
    """
    found = _compared(nodes.select("fp", *({"key"} & set(nodes.columns))), cuts(bits), KEYED, lambda most: _links_of_runs(bits, most, small), OUT, max_run, recut)
    return found.select("a", "b")


def near_duplicates(docs: DataFrame, width: int = 3, bits: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint of every document and the component of near-duplicates it belongs to.

    Fingerprints of ``bits`` or fewer differing bits are linked. Returns doc_id, fingerprint (16 hex
    digits), component_id (the smallest doc_id reachable, its own included). Words are split at
    ASCII white space; null, empty and blank texts have fingerprint 0, which links like any other.
    Copies share a fingerprint and are one node, however many. A null id is passed over for the
    component unless all of it are null. Repeated rows stay. Other columns are not read.
    Lowers the session's Arrow batch limits where they are larger (common.bound_batches).
    """
    bound_batches(docs.sparkSession)
    rows = settle(fingerprints(docs, width, id_col, text_col), "simhash-rows")
    nodes = settle(rows.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")), "simhash-nodes")
    member = settle(components(near_links(nodes, bits)), "simhash-members")
    reached = member.join(nodes, member.node == nodes.fp).select("root", "fp", "first")
    best = reached.groupBy("root").agg(F.min("first").alias("best"))
    linked = reached.join(best, "root").select("fp", "best")
    whole = settle(nodes.join(linked, "fp", "left").select("fp", F.coalesce("best", "first").alias("component_id"), "n"), "simhash-whole")
    return join_by_key(rows, whole, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _hashes(text_col: str) -> list:
    """128 bits that a text is known by: two hashes of different seeds."""
    return [F.xxhash64(text_col).alias("h1"), F.xxhash64(F.lit(1), text_col).alias("h2")]


def distinct_texts(docs: DataFrame, describe: Callable, schema: str, id_col: str, text_col: str) -> DataFrame:
    """(text_id, h1, h2, first, ...) of each distinct text: a number of its own, its hashes, its smallest id (null if it has none), and what ``describe`` makes of it.

    describe: for mapInArrow over (id, h1, h2, text); schema: of what it gives in place of the text.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), *_hashes(text_col), F.col(text_col).alias("text")).mapInArrow(describe, f"id long, h1 long, h2 long, {schema}")
    names = [c.split()[0] for c in schema.split(", ")]
    texts = rows.groupBy("h1", "h2").agg(F.min("id").alias("first"), *[F.first(c).alias(c) for c in names])
    # numbers are drawn before they are written: they stay what they are
    return settle(texts.withColumn("text_id", F.monotonically_increasing_id()), "simhash-texts")


def first_of_each(docs: DataFrame, texts: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Of the rows of each root in texts (h1, h2, first, root) the one with the smallest id; of rows with a null id, all."""
    least = texts.filter("first is not null").groupBy("root").agg(F.min(F.struct(F.col("first").alias("__id"), F.col("h1").alias("__h1"), F.col("h2").alias("__h2"))).alias("k"))
    keep = settle(least.select("k.*"), "simhash-keep")
    h1, h2 = _hashes(text_col)
    rows = docs.withColumns({"__i": F.col(id_col), "__a": h1, "__b": h2})
    kept = rows.join(keep, (F.col("__i") == F.col("__id")) & (F.col("__a") == F.col("__h1")) & (F.col("__b") == F.col("__h2")), "left_semi").dropDuplicates(["__i", "__a", "__b"])
    return kept.drop("__i", "__a", "__b").union(docs.filter(F.col(id_col).isNull()))


def deduplicate(docs: DataFrame, width: int = 3, bits: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Keep one document of each component of near-duplicates: the one with the smallest id.

    All columns are kept; cases are as in :func:`near_duplicates`. Ids may repeat over unlike texts: a
    row is known by its id and 128 bits of hashes of its text, so every component keeps one row of its own. Rows with a null id
    cannot be told from each other and are all kept.
    """
    bound_batches(docs.sparkSession)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(words_of(t.as_py()), width) for t in batch.column(3).cast(pa.large_binary())), "u8", batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(found.view("i8"))], ["id", "h1", "h2", "fp"])

    texts = distinct_texts(docs, describe, "fp long", id_col, text_col)
    member = settle(components(near_links(texts.select("fp").distinct(), bits)), "simhash-members")
    roots = texts.join(member, texts.fp == member.node, "left").withColumn("root", F.coalesce("root", "fp"))
    return first_of_each(docs, roots, id_col, text_col)


#: Five-word shingles that two texts have in common, of those that either has, to be copies; bits by which their fingerprints may differ.
RESEMBLANCE, SHINGLE, COPY_BITS = 0.8, 5, 9
#: Words in a shingle of the fingerprints by which copies are sought: a changed word changes fewer shingles than with three.
COPY_WIDTH = 2


#: Bits of the parity map of a text's shingles.
MAP_BITS = 1024


def parity_map(hashes: np.ndarray) -> bytes:
    """For each of MAP_BITS buckets of hashes, whether it has an odd number of them: maps of two sets differ in no more bits than the sets in elements."""
    bucket = (hashes >> np.uint64(64 - MAP_BITS.bit_length() + 1)).astype("i8")
    return np.packbits((np.bincount(bucket, minlength=MAP_BITS) & 1).astype(bool)).tobytes()


def described(width: int, shingle: int) -> Callable:
    """For mapInArrow over (id, h1, h2, text): the fingerprint of the text's shingles of ``width`` words, and the number and parity map of the distinct ones of ``shingle`` words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [words_of(t.as_py()) for t in batch.column(3).cast(pa.large_binary())]
            fp = np.fromiter((fingerprint(w, width) for w in words), "u8", len(words))
            sets = [np.unique(shingles(w, shingle)) for w in words]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(fp.view("i8")), pa.array(list(map(len, sets)), pa.int64()), pa.array(list(map(parity_map, sets)), pa.binary())], ["id", "h1", "h2", "fp", "n", "map"])

    return run


def shingle_sets(texts: DataFrame, width: int) -> DataFrame:
    """(text_id, n, hashes) of rows (text_id, text): the distinct hashes of the text's shingles, and their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.unique(shingles(words_of(t.as_py()), width)) for t in batch.column(1).cast(pa.large_binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(f) for f in found], pa.int64()), pa.array([f.view("i8") for f in found], pa.list_(pa.int64()))], ["text_id", "n", "hashes"])

    return texts.select("text_id", "text").mapInArrow(run, "text_id long, n long, hashes array<long>")


def in_bands(nodes: DataFrame, least: float) -> DataFrame:
    """Nodes (n, ...) twice, under the ``key`` of their band of set sizes and of the next one.

    Sets of a similarity of ``least`` or more differ in size by a factor of 1 / least at most. A band
    spans such a factor, so they are in one band or in two neighbours, and meet under the key of the larger.
    """
    band = F.when(F.col("n") > 0, F.floor(F.log("n") / F.lit(math.log(1 / least) * (1 + 1e-9)))).otherwise(F.lit(-2)).cast("long")
    return nodes.withColumn("key", F.explode(F.array(band * 2, band * 2 + 2)))


def resembling(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Those pairs (a, b) of texts whose sets have a Jaccard similarity of ``least`` or more; two empty ones have 1."""
    side = lambda c, *cols: sets.select(F.col("text_id").alias(c), *[F.col(x).alias(f"{x}_{c}") for x in cols])
    sized = pairs.join(side("a", "n"), "a").join(side("b", "n"), "b").filter(F.least("n_a", "n_b") >= least * F.greatest("n_a", "n_b"))
    both = sized.join(side("a", "hashes"), "a").join(side("b", "hashes"), "b")
    common = F.size(F.array_intersect("hashes_a", "hashes_b"))
    return both.withColumn("k", common).filter((F.col("n_a") + F.col("n_b") == 0) | (F.try_divide("k", F.col("n_a") + F.col("n_b") - F.col("k")) >= least)).select("a", "b")


NODES = ["fp", "part", "n", "map", "text_id"]
ACROSS = "key long, used long, fp long, part long, n long, map binary, text_id long"
ACROSS_OUT = ACROSS + ", a long, b long"


class Run:
    """Texts of one signature, and which of them may be copies of each other.

    A pair may be if its fingerprints differ by ``bits`` or fewer and the parity maps do not show that
    its sets have too many elements apart for a similarity of ``least``. No pair of copies is ruled out.
    """

    def __init__(self, bits: int, least: float, key: int, used: int, fp: np.ndarray, part: np.ndarray, n: np.ndarray, maps: np.ndarray, ids: np.ndarray):
        self.bits, self.apart, self.key, self.used = bits, (1 - least) / (1 + least), key, used & (1 << 64) - 1
        self.u, self.part, self.n, self.ids = fp.view("u8"), part, n, ids
        self.maps = np.frombuffer(b"".join(maps), "u8").reshape(len(fp), -1)

    def alike(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Of pairs whose fingerprints are near, those that may be copies."""
        most = np.floor(self.apart * (self.n[i] + self.n[j]) + 1e-6)  # elements apart; a share that is just met counts
        fit = np.flatnonzero(np.abs(self.n[i] - self.n[j]) <= most)
        i, j = (np.broadcast_to(x, len(most))[fit] for x in (i, j))
        return fit[np.bitwise_count(self.maps[i] ^ self.maps[j]).sum(1, dtype="i8") <= most[fit]]

    def near(self, i: int, others: np.ndarray) -> np.ndarray:
        """Those of others that may be copies of text i."""
        at = others[np.bitwise_count(self.u[others] ^ self.u[i]) <= self.bits]
        return at[self.alike(np.full(len(at), i), at)]

    def forest(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs that connect whatever pairs that may be copies connect, in the order of a hash."""
        rest = np.argsort(mixed(self.ids.view("u8")), kind="stable")
        while len(rest) > 1:
            edge, rest = deque(rest[:1]), rest[1:]
            while edge and len(rest):
                i = edge.popleft()
                new = self.near(i, rest)
                if len(new):
                    yield np.full(len(new), i), new
                    edge.extend(new)
                    rest = rest[~np.isin(rest, new)]

    def across(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All pairs of unlike parts that may be copies, each from one of its signatures."""
        if (self.part == self.part[0]).all():
            return
        if len(self.u) <= AT_ONCE:
            i, j = np.nonzero(np.triu(np.bitwise_count(self.u[:, None] ^ self.u) <= self.bits, 1))
            yield from self._own(*self._apart(i, j))
            return
        names, count = np.unique(self.part, return_counts=True)
        largest, place = names[count.argmax()], np.arange(len(self.u))
        for j in np.flatnonzero(self.part != largest):
            i = np.flatnonzero((self.part == largest) | (place > j))
            i = i[np.bitwise_count(self.u[i] ^ self.u[j]) <= self.bits]
            yield from self._own(*self._apart(i, np.full(len(i), j)))

    def _apart(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        other = self.part[i] != self.part[j]
        i, j = i[other], j[other]
        fit = self.alike(i, j)
        return i[fit], j[fit]

    def _own(self, i: np.ndarray, j: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Of pairs, those whose first segment with one bit apart at most, or none, is that of this signature; all if it was cut again."""
        cut = [np.uint64(sum(1 << b for b in own)) for own in segments(0, cuts(self.bits))]
        mine = np.ones(len(i), bool)
        if self.used in cut:
            d = self.u[i] ^ self.u[j]
            mine = ((d & np.uint64(self.used)) == 0) == (not self.key & 1)
            for before in cut[: cut.index(self.used)]:
                mine &= np.bitwise_count(d & before) > 1
        if mine.any():
            yield i[mine], j[mine]


def _pairs_of_runs(bits: int, least: float, most: int | None, whole: bool) -> Callable:
    """For mapInArrow over rows ACROSS in order of key: pairs (a, b) of texts that may be copies, of each run its forest, or, if ``whole``, all across parts.

    A run of over ``most`` rows is passed on, as rows without a and b.
    """
    names = [c.split()[0] for c in ACROSS_OUT.split(", ")]
    kinds = [pa.binary() if c == "map" else pa.int64() for c in names]

    def pairs(name: tuple[int, int], columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        own = Run(bits, least, *name, *columns)
        for i, j in own.across() if whole else own.forest():
            a, b = np.minimum(own.ids[i], own.ids[j]), np.maximum(own.ids[i], own.ids[j])
            yield pa.RecordBatch.from_arrays([*[pa.nulls(len(a), k) for k in kinds[:-2]], pa.array(a), pa.array(b)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        name: tuple[int, int] | None = None
        hot, size = False, 0

        def together() -> list[np.ndarray]:
            return list(map(np.concatenate, zip(*held, strict=True)))

        for batch in batches:
            key, used, *rest = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            if not len(key):
                continue
            edge = np.flatnonzero(key[1:] != key[:-1]) + 1
            for a, b in zip([0, *edge], [*edge, len(key)], strict=True):
                if name is None or name[0] != int(key[a]):
                    if size > 1 and not hot:
                        yield from pairs(name, together())
                    held, name, hot, size = [], (int(key[a]), int(used[a])), False, 0
                held.append([x[a:b] for x in rest])
                size += b - a
                if most is not None and size > most:
                    hot = True
                    own = together()
                    columns = [np.full(len(own[0]), x) for x in name] + own
                    yield pa.RecordBatch.from_arrays([*[pa.array(c, k) for c, k in zip(columns, kinds, strict=False)], *[pa.nulls(len(own[0]), pa.int64())] * 2], names)
                    held = []
        if size > 1 and not hot:
            yield from pairs(name, together())

    return run


def possible_copies(nodes: DataFrame, bits: int, least: float, whole: bool, max_run: int = MAX_RUN, recut: int = RECUT) -> DataFrame:
    """Pairs (a, b), a < b, of text_id in nodes NODES that may be copies (see Run).

    ``whole``: every such pair of unlike parts. Else some that connect what the segments as they are
    (without wildcards) bring together. Texts meet under signatures of a band of set sizes only (see in_bands).
    """
    compare = lambda most: _pairs_of_runs(bits, least, most, whole)
    return _compared(in_bands(nodes.select(NODES), least), cuts(bits), ACROSS, compare, ACROSS_OUT, max_run, recut, plain=not whole).select("a", "b").distinct()


def copies(docs: DataFrame, width: int, bits: int, shingle: int, least: float, id_col: str, text_col: str) -> DataFrame:
    """(text_id, h1, h2, first, root) of each distinct text; root is that of the component of verified links that it is in, or its own number.

    Two texts are linked if their fingerprints differ by ``bits`` or
    fewer and the Jaccard similarity of their sets of ``shingle`` words is ``least`` or more. All such
    links count, but not all pairs of a large group are made: only texts of like set sizes meet; maps of the sets' parities rule out
    nearly all that are no copies; forests of the rest are verified first; then, of what these leave
    apart, every pair between two parts.
    """
    texts = distinct_texts(docs, described(width, shingle), "fp long, n long, map binary", id_col, text_col)
    counts = settle(in_bands(texts.select("fp", "n"), least).groupBy("fp", "key").agg(F.count("*").alias("n")), "simhash-nodes")
    linked = near_links(counts, bits).select(F.explode(F.array("a", "b")).alias("fp"))
    linked = settle(linked.union(counts.filter("n > 1").select("fp")).distinct(), "simhash-linked")
    near = settle(texts.join(linked, "fp", "left_semi"), "simhash-near")

    one = near.select(F.col("text_id").alias("t"), F.col("first").alias("i"), F.col("h1").alias("a"), F.col("h2").alias("b"))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), *_hashes(text_col), F.col(text_col).alias("text"))
    chosen = rows.join(one, (F.col("h1") == F.col("a")) & (F.col("h2") == F.col("b")) & F.col("id").eqNullSafe(F.col("i"))).dropDuplicates(["t"])
    sets = settle(shingle_sets(chosen.select(F.col("t").alias("text_id"), "text"), shingle), "simhash-sets")
    nodes = near.withColumn("part", F.col("text_id")).select(NODES)

    verified = settle(resembling(settle(possible_copies(nodes, bits, least, whole=False), "simhash-forest"), sets, least), "simhash-verified")
    part = settle(components(verified).select(F.col("node").alias("text_id"), F.col("root").alias("p")), "simhash-parts")
    apart = settle(nodes.join(part, "text_id", "left").withColumn("part", F.coalesce("p", "part")).select(NODES), "simhash-parts")
    more = settle(resembling(settle(possible_copies(apart, bits, least, whole=True), "simhash-rest"), sets, least), "simhash-verified")
    member = settle(components(verified.union(more)), "simhash-members").select(F.col("node").alias("text_id"), "root")
    return texts.select("text_id", "h1", "h2", "first").join(member, "text_id", "left").withColumn("root", F.coalesce("root", "text_id"))


def deduplicate_copies(
    docs: DataFrame, width: int = COPY_WIDTH, bits: int = COPY_BITS, shingle: int = SHINGLE, least: float = RESEMBLANCE, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Keep one document of each group of near copies, as :func:`copies` links them: that with the smallest id.

    All columns are kept. Ids may repeat over unlike texts: a row is known by its id and 128 bits of hashes of its text. Rows with
    a null id are all kept. Null, empty and blank texts are copies of each other; no row in, no row out. Lowers the session's Arrow batch limits where they are larger (common.bound_batches).
    """
    bound_batches(docs.sparkSession)
    return first_of_each(docs, copies(docs, width, bits, shingle, least, id_col, text_col), id_col, text_col)
