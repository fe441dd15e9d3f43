"""Runs of words against brute force over every period, and the query against its contract in plain Python."""

import hashlib
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from forgelight.llm import periodic, queries


def brute(words, least):
    """Every period on its own: stretches whose words are those one period further on."""
    found, n = [], len(words)
    for period in range(1, n // 2 + 1):
        i = 0
        while i + period < n:
            start = i
            while i + period < n and words[i] == words[i + period]:
                i += 1
            length = i - start + period
            own = words[start : start + length]
            if length >= max(least, 2 * period) and not any(own[d:] == own[:-d] for d in range(1, period)):
                found.append((start, length, period))
            i = max(i, start + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=40), max_size=4), st.integers(1, 14))
def test_runs_equal_brute_force(documents, least):
    assert periodic.runs_of(documents, least) == [brute(d, least) for d in documents]


def test_runs_within_runs():
    r = random.Random(7)
    for _ in range(200):
        unit = [b"%d" % r.randint(0, 3) for _ in range(r.randint(1, 6))]
        once = unit * r.randint(1, 4) + [b"x"] * r.randint(0, 3)
        words = once * r.randint(1, 4) + unit[: r.randint(0, 5)]
        assert periodic.runs_of([words], 12) == [brute(words, 12)]
    fib = [b"a"], [b"a", b"b"]
    while len(fib[1]) < 400:
        fib = fib[1], fib[1] + fib[0]
    assert periodic.runs_of([fib[1]], 1) == [brute(fib[1], 1)]


def test_long_texts_take_no_square():
    for words in ([b"a"] * 200_000, [b"%d" % (i % 997) for i in range(200_000)], [w for i in range(30_000) for w in (*[b"l%d" % j for j in range(7)], b"%d" % i)]):
        runs = periodic.runs_of([words], 12)[0]
        assert runs == ([] if words[0] == b"l0" else [(0, 200_000, 1 if words[1] == b"a" else 997)])


def plain(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute(words, 12)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], sha(lines.encode()), sha(b" ".join(w for i, w in enumerate(words) if i not in gone)))


@pytest.fixture(scope="module")
def corpus():
    r = random.Random(2)
    rows = [(i, " ".join(r.choice(["a", "b", "é x", "word"]) for _ in range(r.randint(0, 60))) + r.choice(["", " \n", "\x0b\x0c\t"])) for i in range(250)]
    rows += [(r[0], f"  Lead {r[1]}") for r in rows[:100]]  # ids that repeat, with white space in front
    return [*rows, (None, None), (None, "x " * 30), (1000, None), (1001, ""), (1002, " \n\t"), (1003, "w" * 100_000), (1004, "one two three " * 800), (1005, "x\x1cx x\x1cx " * 12)]


def test_query_equals_plain_run(spark, corpus, tmp_path):
    schema = "doc_id long, text string, runs string, collapsed int, id long, best string"
    df = spark.createDataFrame([(*r, "clash", 1, 2, "clash") for r in corpus], schema)
    df.write.parquet(f"{tmp_path}/a/documents.parquet")
    got = queries.op11_maximal_pairs(spark, f"{tmp_path}/a")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted((plain(*r) for r in corpus), key=repr)
    assert [t for c, t in got.dtypes if c not in ("runs_sha256", "collapsed_sha256")] == ["bigint"] * 6
    df.limit(0).write.parquet(f"{tmp_path}/b/documents.parquet")
    assert queries.op11_maximal_pairs(spark, f"{tmp_path}/b").count() == 0


def test_texts_and_runs_of_the_operator(spark):
    df = spark.createDataFrame([("k", "go " * 15 + "now", 1), ("n", None, 2)], "key string, body string, runs int")
    rows = {r["key"]: r for r in periodic.find_runs(df, 12, "key", "body").collect()}
    assert [tuple(r) for r in rows["k"]["runs"]] == [(0, 15, 1)] and rows["k"]["collapsed"] == "go now"
    assert rows["n"]["runs"] == [] and rows["n"]["collapsed"] is None
    with pytest.raises(ValueError, match="min_length"):
        periodic.find_runs(df, 0, "key", "body")
