"""Exact top-k by inner product: the threshold algorithm over sorted lists per dimension."""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bound_batches, settle

#: Components of the candidates whose sorted lists are held together: 4096 candidates of 64 dimensions.
CELLS = 1 << 18
#: Components of the queries that are sent to all tasks at a time, 8 bytes each: 32,768 queries of 64 dimensions. Queries beyond it are sent afterwards.
QUERY_CELLS = 1 << 21
#: Entries read from both ends of each list in the first round; after each later round STEP times as many have been read.
DEPTH, STEP = 16, 4
#: Queries whose scores of a round are held at a time.
CHUNK = 256
#: Sums below this are exact in double precision.
EXACT = 2.0**53
LEAST, MOST = -(2**63), 2**63 - 1


def floors_of(values: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * x) of each component, as doubles where these hold it, else as Python's integers."""
    with np.errstate(over="ignore"):
        x = np.floor(values * scale)
    if np.isfinite(x).all():
        return x
    exact = [[math.floor(Fraction(scale) * Fraction(float(v))) for v in row] for row in values]
    return np.array(exact, dtype=object)


def doubles(x: np.ndarray) -> np.ndarray:
    """The nearest doubles, infinite ones for what is larger than any."""
    if x.dtype != object:
        return x
    most = int(np.finfo("f8").max)
    return np.array([[float(v) if abs(v) <= most else math.inf if v > 0 else -math.inf for v in row] for row in x], "f8").reshape(x.shape)


def scores_of(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Integer inner products of the rows of q with those of x: doubles, or Python's integers within a long where doubles may not hold one."""
    dx, dq = doubles(x), doubles(q)
    over = np.abs(dq).max(axis=1)[:, None] * np.abs(dx).max(axis=1)[None] * x.shape[1] >= EXACT
    if not over.any():
        return dq @ dx.T
    with np.errstate(over="ignore", invalid="ignore"):
        out = np.where(over, 0, dq @ dx.T).astype(object)
    for j, i in np.argwhere(over):
        out[j, i] = max(LEAST, min(MOST, sum(int(a) * int(b) for a, b in zip(q[j], x[i], strict=True))))
    return out


class Best:
    """The k best candidates so far of each query: ties to smaller ids. ``kth`` is the least score of k known ones, else below all."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.kth = np.full(n, -math.inf)
        self.row, self.ids, self.scores = np.empty(0, "i8"), np.empty(0, "i8"), np.empty(0, "i8")

    def add(self, row: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """Add candidates, of which those that k others surely beat may be missing."""
        row, ids, scores = (np.concatenate(x) for x in ((self.row, row), (self.ids, ids), (self.scores, scores)))
        order = np.lexsort((ids, ~scores, row))  # ~s falls as s rises, over all longs
        row, ids, scores = row[order], ids[order], scores[order]
        first = np.searchsorted(row, row, "left")
        keep = np.arange(len(row)) - first < self.k
        self.row, self.ids, self.scores = row[keep], ids[keep], scores[keep]
        full = np.arange(len(row)) - first == self.k - 1
        self.kth[row[full]] = scores[full]


class SortedLists:
    """The values of each dimension of a block of candidates in descending order, and whose they are."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        self.ids, self.x = ids, x
        value = doubles(x)
        self.order = np.argsort(-value, axis=0, kind="stable")
        self.values = np.take_along_axis(value, self.order, axis=0)

    def bounds(self, q: np.ndarray, depth: int) -> np.ndarray:
        """No candidate below the first and above the last ``depth`` of every list scores more, for each query."""
        n = len(self.ids)
        top, low = self.values[depth - 1], self.values[n - depth]
        value = doubles(q)
        with np.errstate(over="ignore", invalid="ignore"):
            bound = np.maximum(value, 0) @ top + np.minimum(value, 0) @ low
            size = np.abs(value) @ np.maximum(np.abs(top), np.abs(low))
            bound = np.where(size >= EXACT, bound + size * 1e-9, bound)
        return np.where(np.isnan(bound), math.inf, bound)

    def search(self, q_ids: np.ndarray, q: np.ndarray, best: Best) -> np.ndarray:
        """Put the candidates of this block among the best of all queries; returns the depth to which each query has read.

        Fagin's threshold algorithm, for all queries together: in each round the lists are read
        deeper from both ends, for a query takes the end that suits the sign of its component. What
        is seen for the first time is scored in full. No unseen candidate scores more than the sum
        of the last values read times the query; a query whose bound is below its kth score, which
        rises with every round, is done. The rounds end when all queries are done or when the lists
        hold no unseen candidate any more.
        """
        n = len(self.ids)
        open_ = np.arange(len(q))
        read = np.full(len(q), n)
        seen = np.zeros(n, bool)
        depth, deep = 0, min(n, DEPTH)
        while len(open_):
            hit = np.zeros(n, bool)
            hit[self.order[depth:deep]] = True
            hit[self.order[n - deep : n - depth]] = True
            new = np.flatnonzero(hit & ~seen)
            seen |= hit
            if len(new):
                parts = [self._score(q_ids, q, open_[at : at + CHUNK], new, best) for at in range(0, len(open_), CHUNK)]
                best.add(*(np.concatenate(p) for p in zip(*parts, strict=True)))
            depth = deep
            if seen.all():
                read[open_] = depth
                break
            # a kth score at the least long may stand for a lesser sum
            done = (self.bounds(q[open_], depth) < best.kth[open_]) & (best.kth[open_] > LEAST)
            read[open_[done]] = depth
            open_ = open_[~done]
            deep = min(n, STEP * depth)
        return read

    def _score(self, q_ids: np.ndarray, q: np.ndarray, own: np.ndarray, new: np.ndarray, best: Best) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, id, score) of new candidates that reach the kth score of their query."""
        scores, ids = scores_of(self.x[new], q[own]), self.ids[new]
        fit = np.ones(scores.shape, bool)
        order = np.argsort(ids, kind="stable")
        first, last = np.searchsorted(ids, q_ids[own], "left", order), np.searchsorted(ids, q_ids[own], "right", order)
        for j in np.flatnonzero(first < last):
            fit[j, order[first[j] : last[j]]] = False
        floor = best.kth[own]
        if scores.dtype != object and len(new) > best.k:
            at = len(new) - best.k
            floor = np.maximum(floor, np.partition(np.where(fit, scores, -math.inf), at, axis=1)[:, at])
        j, i = np.nonzero(fit & (scores >= floor[:, None]).astype(bool))
        return own[j], ids[i], scores[j, i].astype("i8")


def _search(queries: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]], k: int, scale: float):
    """For mapInArrow over candidates (vec_id, x): the k best of the task for each query, as rows FOUND.

    queries: by the length of their vectors, (query_id, row, vectors as floors_of() gives them).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {dim: Best(len(q), k) for dim, (_, _, q) in queries.value.items()}
        held: dict[int, list] = {dim: [] for dim in best}

        def settle_block(dim: int) -> None:
            ids = np.concatenate([x[0] for x in held[dim]])
            x = floors_of(np.concatenate([x[1] for x in held[dim]]), scale)
            held[dim] = []
            q_ids, _, q = queries.value[dim]
            SortedLists(ids, x).search(q_ids, q, best[dim])

        for batch in batches:
            sizes = np.diff(batch.column(1).offsets.to_numpy()) if len(batch) else np.empty(0, int)
            flat = batch.column(1).flatten().to_numpy()
            starts, ids = np.concatenate(([0], np.cumsum(sizes))), batch.column(0).to_numpy()
            for dim in np.unique(sizes).tolist():
                if dim not in held:
                    continue
                own = np.flatnonzero(sizes == dim)
                step = max(64, CELLS // dim)
                for at in range(0, len(own), step):
                    rows = own[at : at + step]
                    held[dim].append((ids[rows], flat[starts[rows][:, None] + np.arange(dim)]))
                    if sum(len(x[0]) for x in held[dim]) >= step:
                        settle_block(dim)
        for dim in held:
            if held[dim]:
                settle_block(dim)
        for dim, own in best.items():
            q_ids, row, _ = queries.value[dim]
            yield pa.RecordBatch.from_arrays([pa.array(q_ids[own.row]), pa.array(row[own.row]), pa.array(own.ids), pa.array(own.scores)], ["query_id", "row", "vec_id", "score"])

    return run


FOUND = "query_id long, row long, vec_id long, score long"


def _parts(rows, cells: int) -> Iterator[list]:
    """Runs of an iterator of (id, row, vector) rows, each of about so many components."""
    rows = iter(rows)
    for first in rows:
        part = [first, *islice(rows, max(0, cells // max(1, len(first[2])) - 1))]
        yield part


def top_k(vectors: DataFrame, is_query, k: int = 20, scale: float = 64.0, id_col: str = "vec_id", vector_col: str = "embedding", query_cells: int = QUERY_CELLS) -> DataFrame:
    """The k best candidates of each query by the inner product of floor(scale * x).

    ``is_query`` makes a condition of the id column; candidates are all rows but those with the
    query's own id. Ties go to the smaller id. Queries are sent to all tasks in blocks of about
    ``query_cells`` components, one block after the other, so that neither the driver nor a task holds more; candidates are streamed past a block as they are
    stored, without a shuffle. A task sorts the dimensions of so many candidates at a time and runs the threshold
    algorithm on them for all queries of the block, from the kth scores that it knows already. Only
    the k best of each task for each query are shuffled.

    Returns query_id, rank (from 1), vec_id, score, and row, which tells repeated rows of one query
    id apart (0 if none). A vector that is null, empty, or holds a null or non-finite component
    takes no part, nor does one with a null id; vectors of other lengths than the query's are no
    candidates. A query with fewer candidates than k gets all. Sums beyond a long go to the nearest
    one. An empty table gives an empty result. Lowers the session's Arrow batch limits where they are larger (common.bound_batches).
    """
    spark = vectors.sparkSession
    bound_batches(spark)
    x = F.transform(F.col(vector_col), lambda v: v.cast("double"))
    fit = F.col(vector_col).isNotNull() & (F.size(vector_col) > 0)
    fit = fit & F.forall(vector_col, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < F.lit(math.inf)))
    rows = vectors.filter(F.col(id_col).isNotNull() & fit).select(F.col(id_col).cast("long").alias("vec_id"), x.alias("x"))
    rows = settle(rows.withColumn("u", F.xxhash64("vec_id", F.monotonically_increasing_id())), "topk-rows")
    order = Window.partitionBy("vec_id").orderBy("u")
    chosen = rows.filter(is_query(F.col("vec_id"))).select("vec_id", (F.row_number().over(order) - 1).cast("long").alias("row"), "x")
    chosen = settle(chosen, "topk-queries")
    found = None
    for part in _parts(chosen.toLocalIterator(), query_cells):
        own = {}
        for dim in {len(r[2]) for r in part}:
            mine = [r for r in part if len(r[2]) == dim]
            own[dim] = (np.array([r[0] for r in mine], "i8"), np.array([r[1] for r in mine], "i8"), floors_of(np.array([r[2] for r in mine], "f8"), scale))
        shared = spark.sparkContext.broadcast(own)
        got = settle(rows.select("vec_id", "x").mapInArrow(_search(shared, k, scale), FOUND), "topk-found")
        shared.destroy()
        found = got if found is None else found.union(got)
    if found is None:
        found = spark.createDataFrame([], FOUND)
    order = Window.partitionBy("query_id", "row").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score", "row")
