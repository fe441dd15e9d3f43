"""The Merkle manifest against trees built by plain loops."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from forgelight.llm import merkle, queries


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(*values):
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(nodes, fanout):
    """(root, for each node the siblings before and after, level by level)."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i : i + fanout] for i in range(0, len(nodes), fanout)]
        for path, i in zip(paths, at, strict=True):
            run = runs[i // fanout]
            path.append(("".join(run[: i % fanout]), "".join(run[i % fanout + 1 :])))
        at, nodes = [i // fanout for i in at], [digest(*r) for r in runs]
    return nodes[0], paths


def plain(rows, fanout):
    """Rows of the query, one by one."""
    groups = {}
    for doc_id, source, lang, n_chars, text in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text) if text is not None else None
        found = leaf(doc_id, source, lang, n_chars, low if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0 else text)
        groups.setdefault(source, []).append(((doc_id is not None, doc_id or 0), leaf(doc_id, source, lang, n_chars, text), found, doc_id))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = [climb([x[1] for x in groups[s].sort() or groups[s]], fanout) for s in names]
    root, tops = climb([t[0] for t in trees], fanout)
    out = []
    for name, (subroot, paths), top in zip(names, trees, tops, strict=True):
        for (_, own, found, doc_id), path in zip(groups[name], paths, strict=True):
            for before, after in path + top:
                found = digest(before, found, after)
            out.append((doc_id, own, subroot, root, digest(*(b + a for b, a in path + top)), found, found == root))
    return out


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, pos long, tree string, root string, path string"


@pytest.fixture(scope="module")
def corpus():
    rows = [(i, "hot" if i % 3 else f"s{i % 50}", ["en", None, ""][i % 3], i if i % 4 else None, f"Text {'Ä' * (i % 5)} {i}") for i in range(700)]
    rows += [(1000, "lone", "en", 1, "only row"), (1001, None, None, None, None), (1002, None, "en", 2, "NULL source"), (None, "hot", None, None, "NO id"), (None, "hot", None, None, "no ID")]
    rows += [(1003, "", "en", 0, ""), (1004, "é", "en", 0, "ABC" * 50_000), (1005, "Z", "en", 0, "-"), (-7, "hot", "-", -1, "1:x"), *[(5, "hot", "en", 5, "Again")] * 40, (5, "hot", "en", 5, "Another")]
    return rows


def query(spark, tmp_path, rows):
    spark.createDataFrame([(*r, 1, "clash", "clash", "clash") for r in rows], SCHEMA).repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    return queries.op13_slot_pivot(spark, str(tmp_path))


def test_manifest_equals_plain_trees(spark, corpus, tmp_path):
    got = query(spark, tmp_path, corpus)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(plain(corpus, 16), key=repr)


@pytest.mark.parametrize("n", [0, 1, 16, 17])
def test_small_tables(spark, corpus, tmp_path, n):
    rows = [r for r in corpus if r[1] == "hot"][:n]
    got = query(spark, tmp_path, rows)
    assert sorted(map(tuple, got.collect()), key=repr) == (sorted(plain(rows, 16), key=repr) if rows else [])


def test_narrow_trees_and_any_change(spark):
    rows = spark.range(100).select("id", F.lit("a").alias("kind"), F.sha2(F.col("id").cast("string"), 256).alias("print"))
    made = merkle.manifest(rows, "kind", "id", "print", fanout=2).collect()
    want, paths = climb([digest(str(i)) for i in range(100)], 2)
    assert {r["root"] for r in made} == {want} and {r["subroot"] for r in made} == {want}
    assert all([tuple(p) for p in r["path"]] == paths[r["id"]] for r in made)
    changed = rows.withColumn("print", F.when(F.col("id") == 77, F.sha2(F.lit("x"), 256)).otherwise(F.col("print")))
    assert merkle.manifest(changed, "kind", "id", "print", fanout=2).first()["root"] != want
