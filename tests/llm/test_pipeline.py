"""The stages over a small corpus with planted cases, and the registry's guard."""

import numpy as np
import pytest

import __spark_entry__
import corpus_pipeline

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda sigma omega rho tau".split()


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("sf"))
    r = np.random.default_rng(8)
    say = lambda n: " ".join(r.choice(WORDS, n))
    passage = say(30)
    docs, labels = [], []
    for i in range(300):
        text = say(int(r.integers(40, 120)))
        if i % 5 == 1:
            text += " you idiot you moron"
        docs.append((i, text))
        labels.append((i, 1, int(i % 5 == 1)))
    docs += [(500, docs[0][1]), (501, docs[0][1]), (502, f"{docs[2][1]} {passage} {docs[3][1]}"), (503, passage), (504, f"{say(60)} mail joe.x1@mail3.example.com"), (505, None), (506, "")]
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in docs]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d, passage


def test_stages(spark, folder, tmp_path):
    d, passage = folder
    docs = spark.read.parquet(f"{d}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, d)
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "packing":
            assert docs.columns == corpus_pipeline.COLUMNS
            seen[name] = {r["doc_id"]: r for r in docs.collect()}
    toxic = {i for i in range(300) if i % 5 == 1}
    assert not toxic & seen["toxicity"].keys() and len(seen["toxicity"]) == 307 - len(toxic)
    near = seen["near_duplicates"]
    assert 0 in near and 500 not in near and 501 not in near and len(near.keys() & {505, 506}) == 1
    clean = seen["decontamination"]
    assert 503 not in clean and passage not in clean[502]["text"] and len(clean) == len(near) - 1
    assert clean[502]["n_chars"] == len(clean[502]["text"]) and clean[5]["text"] == near[5]["text"]
    private = seen["personal_data"]
    assert "joe.x1" not in private[504]["text"] and "@" in private[504]["text"] and len(private) == len(clean)
    assert {r["doc_id"] for r in docs.collect()} == private.keys()


def test_run_and_registry(spark, folder):
    assert corpus_pipeline.run(spark, folder[0]).count() > 0
    names = __spark_entry__.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)) and "pipeline" in names
    assert set(__spark_entry__.oracle_sql()) <= set(names)


def test_the_rest_works_without_llm(monkeypatch):
    monkeypatch.setattr(__spark_entry__, "_llm", lambda: [])
    assert "trend_30d" in __spark_entry__.queries() and "pipeline" not in __spark_entry__.queries()
