"""Near copies verified by their five-word shingles, against brute force."""

import numpy as np

from forgelight.llm import simhash

WORDS = [f"w{i}" for i in range(400)]


def corpus():
    r = np.random.default_rng(3)
    texts = []
    for _ in range(12):
        base = list(r.choice(WORDS, 150))
        texts.append(base)
        for n in (1, 2, 3, 4, 5, 6, 8, 10):
            t = list(base)
            for at in r.integers(0, 150, n):
                t[at] = "edit"
            texts.append(t)
    texts += [["a", "b"], ["a", "c"], ["a", "b"], []]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    return [*rows, (200, None), (201, ""), (None, rows[0][1])]


def kept(rows, bits, width=simhash.COPY_WIDTH):
    words = [simhash.words_of((t or "").encode()) for _, t in rows]
    fps = [simhash.fingerprint(w, width) for w in words]
    sets = [{b" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for w in words]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            alike = len(sets[i] & sets[j]) / len(sets[i] | sets[j]) if sets[i] | sets[j] else 1
            if (int(fps[i]) ^ int(fps[j])).bit_count() <= bits and alike >= 0.8:
                a, b = group[i], group[j]
                group = [b if g == a else g for g in group]
    best = {}
    for g, (i, _) in zip(group, rows, strict=True):
        if i is not None:
            best[g] = min(i, best.get(g, i))
    return sorted(best.values())


def test_copies_within_nine_bits_go_and_unlike_texts_stay(spark):
    import corpus_pipeline

    rows = corpus()
    docs = spark.createDataFrame([(i, t, "en", "s", None) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = [r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()]
    assert sorted(i for i in got if i is not None) == kept(rows, 9) and got.count(None) == 1
    assert len(kept(rows, 9)) < len(kept(rows, 7)) < len(kept(rows, 3))


def test_every_pair_across_parts_is_given_once(spark):
    """Against brute force: no pair that is a copy is left out, none that the maps rule out is given."""
    r = np.random.default_rng(4)
    base = int(r.integers(0, 2**62))
    fps = list({base ^ sum(1 << int(b) for b in r.choice(63, int(k), replace=False)) for k in r.integers(0, 7, 120)})
    part = [int(x) for x in r.integers(0, 4, len(fps))]
    common = r.integers(0, 2**63, 60)
    sets = [np.unique(np.concatenate([r.choice(common, 50, replace=False), r.integers(0, 2**63, int(k))])).astype("u8") for k in r.integers(0, 30, len(fps))]
    nodes = spark.createDataFrame([(f, p, len(x), simhash.parity_map(x), i) for i, (f, p, x) in enumerate(zip(fps, part, sets, strict=True))], "fp long, part long, n long, map binary, text_id long")
    near = [(i, j) for j in range(len(fps)) for i in range(j) if (fps[i] ^ fps[j]).bit_count() <= 7]
    odd = lambda i, j: int(np.bitwise_count(np.frombuffer(simhash.parity_map(sets[i]), "u1") ^ np.frombuffer(simhash.parity_map(sets[j]), "u1")).sum())
    may = [(i, j) for i, j in near if odd(i, j) <= (len(sets[i]) + len(sets[j])) / 9]
    want = sorted((i, j) for i, j in may if part[i] != part[j])
    alike = {(i, j) for i, j in near if len(np.intersect1d(sets[i], sets[j])) >= 0.8 * len(np.union1d(sets[i], sets[j]))}
    assert {(i, j) for i, j in alike if part[i] != part[j]} <= set(want) and len(want) < len(near) / 2
    for most, recut in ((8192, 1 << 18), (30, 1 << 18), (30, 60)):
        assert sorted(map(tuple, simhash.possible_copies(nodes, 7, 0.8, True, most, recut).collect())) == want
        links = {tuple(x) for x in simhash.possible_copies(nodes, 7, 0.8, False, most, recut).collect()}
        assert links <= set(may)
    old, simhash.AT_ONCE = simhash.AT_ONCE, 8
    try:
        run = simhash.Run(7, 0.8, 2, 0, np.array(fps, "i8"), np.array(part), np.array(list(map(len, sets))), [simhash.parity_map(x) for x in sets], np.arange(len(fps)))
        assert sorted((min(i, j), max(i, j)) for a, b in run.across() for i, j in zip(a.tolist(), b.tolist(), strict=True)) == want
    finally:
        simhash.AT_ONCE = old


def test_a_similarity_that_is_just_met_counts():
    """8 of 10, 20 of 25 and so on: exactly 0.8."""
    r = np.random.default_rng(5)
    for n in range(9, 400, 9):
        x = np.unique(r.integers(0, 2**63, 3 * n)).astype("u8")
        a, b = x[:n], np.concatenate([x[n // 9 : n], x[n : n + n // 9]])
        assert len(np.intersect1d(a, b)) / len(np.union1d(a, b)) == 0.8
        maps = [simhash.parity_map(a), simhash.parity_map(b)]
        run = simhash.Run(9, 0.8, 2, 0, np.array([5, 7]), np.array([1, 2]), np.array([n, n]), maps, np.array([1, 2]))
        assert [tuple(x.item() for x in p) for p in run.across()] == [(0, 1)] and len(list(run.forest())) == 1


def test_an_empty_table_and_very_long_texts(spark):
    r = np.random.default_rng(6)
    long = list(r.choice([f"w{i}" for i in range(50_000)], 200_000))
    near = ["edit" if i % 5000 == 7 else w for i, w in enumerate(long)]
    rows = [(1, " ".join(long)), (2, " ".join(near)), (3, "x" * 300_000), (4, " ".join(long[:150_000])), (5, None), (6, " "), (7, "")]
    docs = spark.createDataFrame([(*x, "clash", 1) for x in rows], "doc_id long, text string, root string, h1 int")
    got = simhash.deduplicate_copies(docs)
    assert sorted(x["doc_id"] for x in got.collect()) == [1, 3, 4, 5] and got.columns == docs.columns
    assert simhash.deduplicate_copies(docs.limit(0)).collect() == [] and simhash.deduplicate(docs.limit(0)).collect() == []


def test_sets_of_like_size_share_a_key(spark):
    n = list(range(400)) + [10**6, 1_250_000, 8 * 10**8, 10**9]
    keys = {}
    for x in simhash.in_bands(spark.createDataFrame([(i,) for i in n], "n long"), 0.8).collect():
        keys.setdefault(x["n"], set()).add(x["key"])
    for a in n:
        assert len(keys[a]) == 2
        for b in n:
            if min(a, b) >= 0.8 * max(a, b):
                assert keys[a] & keys[b], (a, b)


def test_runs_are_cut_until_they_are_short(spark):
    """Fingerprints that share most bits: every link of brute force connects, however small the runs must be."""
    r = np.random.default_rng(9)
    fps = list({int(sum(1 << int(b) for b in r.choice(20, int(k), replace=False))) for k in r.integers(0, 9, 300)})
    want = {(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 3}
    nodes = spark.createDataFrame([(f,) for f in fps], "fp long")
    for most, recut in ((8192, 1 << 18), (20, 40)):
        links = simhash.near_links(nodes, 3, max_run=most, recut=recut).collect()
        assert all((x["a"] ^ x["b"]).bit_count() <= 3 for x in links)
        group = {f: f for f in fps}

        def root(f, group=group):
            while group[f] != f:
                f = group[f]
            return f

        for x in links:
            group[root(x["a"])] = root(x["b"])
        assert all(root(fps[i]) == root(fps[j]) for i, j in want)


def test_an_id_over_two_texts_keeps_the_one_that_is_no_copy(spark):
    texts = [" ".join(np.random.default_rng(i).choice(WORDS, 90)) for i in range(3)]
    rows = [(1, texts[0]), (2, texts[0]), (2, texts[1]), (3, texts[2]), (3, texts[0]), (3, texts[2])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for run in (simhash.deduplicate, simhash.deduplicate_copies):
        assert sorted(map(tuple, run(docs).collect())) == sorted([(1, texts[0]), (2, texts[1]), (3, texts[2])])
