import numpy as np
import pytest

from forgelight.llm import topk


def brute(rows, k, scale=64.0):
    good = {}
    for i, (v, x) in enumerate(rows):
        if v is not None and x and all(a is not None and np.isfinite(a) for a in x):
            good[i] = (v, [int(np.floor(scale * float(a))) for a in x])
    out = []
    for v, q in good.values():
        if v % 20 == 0:
            found = [(-sum(a * b for a, b in zip(q, x, strict=True)), w) for w, x in good.values() if w != v and len(x) == len(q)]
            out += [(v, r, w, -s) for r, (s, w) in enumerate(sorted(found)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize(("cells", "query_cells"), [(1 << 18, 1 << 21), (64, 20)])
def test_equals_brute_force_with_ties_nulls_and_odd_lengths(spark, monkeypatch, cells, query_cells):
    monkeypatch.setattr(topk, "CELLS", cells)
    r = np.random.default_rng(3)
    rows = [(i, [float(v) for v in r.integers(-2, 3, 6) / 64]) for i in range(220)] + [(i, [0.5] * 6) for i in range(220, 300)]
    rows += [(400, None), (401, []), (402, [None] * 6), (403, [float("nan")] + [0.0] * 5), (404, [float("inf")] * 6), (420, [1.0, 2.0]), (421, [3.0, 1.0]), (None, [1.0] * 6), (440, [0.0] * 6)]
    df = spark.createDataFrame([(v, x, "clash") for v, x in rows], "vec_id long, embedding array<float>, x string")
    got = topk.top_k(df, lambda i: i % 20 == 0, 7, query_cells=query_cells).select("query_id", "rank", "vec_id", "score").collect()
    assert sorted(map(tuple, got)) == brute(rows, 7)


def test_repeated_ids_are_told_apart(spark):
    df = spark.createDataFrame([(20, [1.0, 0.0]), (20, [0.0, 1.0]), (1, [1.0, 2.0]), (2, [2.0, 1.0])], "vec_id long, embedding array<float>")
    got = {(r["row"], r["rank"]): (r["vec_id"], r["score"]) for r in topk.top_k(df, lambda i: i % 20 == 0, 2).collect()}
    assert sorted(tuple(got[row, rank][0] for rank in (1, 2)) for row in (0, 1)) == [(1, 2), (2, 1)]


def test_rounds_end_by_the_bound_where_values_are_uneven():
    r = np.random.default_rng(1)
    x = np.floor(r.pareto(1.5, (4096, 8)) * 4)
    q = np.array([[9.0, 0, 0, 1, 0, 0, 0, 0], [0, 5.0, -1, 0, 0, 0, 0, 0], [0] * 8])
    lists, best = topk.SortedLists(np.arange(4096), x), topk.Best(3, 5)
    read = lists.search(np.array([-1, -1, -1]), q, best)
    assert read[0] < 1024 and read[1] < 4096
    for j in range(3):
        scores = (x @ q[j]).astype(int)
        assert best.ids[best.row == j].tolist() == np.lexsort((np.arange(4096), -scores))[:5].tolist()


def test_a_later_block_ends_after_its_first_round():
    r = np.random.default_rng(2)
    high, low = r.integers(50, 99, (500, 4)).astype("f8"), r.integers(0, 9, (500, 4)).astype("f8")
    best, q = topk.Best(1, 5), np.ones((1, 4))
    topk.SortedLists(np.arange(500), high).search(np.array([-1]), q, best)
    assert topk.SortedLists(np.arange(500, 1000), low).search(np.array([-1]), q, best) == [topk.DEPTH]
    assert best.ids.max() < 500


def test_huge_components_and_empty_table(spark):
    rows = [(0, [3e38, 1.0]), (1, [1.0, 1.0]), (20, [2e15, 0.0]), (21, [2e15, 1.0]), (40, [-3e38, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = topk.top_k(df, lambda i: i % 20 == 0, 3).collect()
    as_float = [(v, [float(np.float32(a)) for a in x]) for v, x in rows]
    want = [(q, r, w, max(-(2**63), min(2**63 - 1, s))) for q, r, w, s in brute(as_float, 9)]
    by = {}
    for q, _, w, s in want:
        by.setdefault(q, []).append((-s, w))
    want = sorted((q, i, w, -s) for q, own in by.items() for i, (s, w) in enumerate(sorted(own)[:3], 1))
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found) == want
    double = spark.createDataFrame([(0, [1e308]), (20, [1e308]), (1, [-1.0])], "vec_id long, embedding array<double>")
    assert {(r["query_id"], r["vec_id"], r["score"]) for r in topk.top_k(double, lambda i: i % 20 == 0).collect()} == {(0, 20, 2**63 - 1), (0, 1, -(2**63)), (20, 0, 2**63 - 1), (20, 1, -(2**63))}
    assert topk.top_k(df.limit(0), lambda i: i % 20 == 0).count() == 0
