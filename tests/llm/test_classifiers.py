import math
import re

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from forgelight.llm import langid, toxicity, url_filter
from forgelight.llm.common import held_out

URLS = [
    (1, "https://WWW.Example.com/en/a?x", "allow", "www.example.com/en/"), (2, "http://a.example.com/en/", "block", "example.com/en/"), (3, "http://a.example.com/EN/", "allow", "com/"),
    (4, "http://x.net/es/1#f", "block", "net/es/"), (5, "http://x.net/es", "allow", None), (6, "http://net/fr/", "block", "net/fr/"), (7, "http://notexample.com", "allow", None),
    (8, None, "allow", None), (9, "", "allow", None), (10, "no scheme.com/en/", "allow", None), (11, "a://b://c.com/x", "allow", None), (12, "http://" + "a." * 5000 + "com/" + "y" * 20000, "allow", "com/"),
    (12, "http://x.net/es/1#f", "block", "net/es/"), (13, "://?://", "allow", None), (14, "http://examplé.com/en/\n", "allow", "com/"),
]
RULES = [("allow", "COM", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]


def test_url_rules(spark):
    df = spark.createDataFrame([(i, u, "x") for i, u, _, _ in URLS], "page_id long, url string, host string")
    got = url_filter.filter_urls(df, RULES).collect()
    assert sorted((r["page_id"], r["verdict"], r["rule"]) for r in got if r["page_id"] != 12) == sorted((i, v, r) for i, _, v, r in URLS if i != 12)
    assert {(r["host"], r["path"]) for r in got if r["page_id"] in (8, 9, 10)} == {("", "")}
    assert {r["host"] for r in got if r["page_id"] == 1} == {"www.example.com"}
    assert {r["verdict"] for r in url_filter.filter_urls(df, [], default="block").collect()} == {"block"}
    assert url_filter.filter_urls(df.limit(0), RULES).count() == 0
    with pytest.raises(ValueError, match="index has"):
        url_filter.filter_urls(df, RULES, max_index_bytes=10)


def test_digest_collisions_are_told_apart(tmp_path, monkeypatch):
    monkeypatch.setattr(url_filter, "_digest", lambda host, path: len(host))
    url_filter.write_index([("block", "aa", "/"), ("block", "bb", "/"), ("allow", "bb", "/"), ("allow", "ccc", "/x")], str(tmp_path / "i"))
    index = url_filter.DigestIndex(str(tmp_path / "i"))
    found = index.find([("bb", "/"), ("zz", "/"), ("aa", "/"), ("ccc", "/x"), ("ccc", "/")])
    assert [index.rule(i) if i >= 0 else None for i in found] == [("bb", "/"), None, ("aa", "/"), ("ccc", "/x"), None] and not index.allow[found[0]]


SYLLABLES = {"en": ["the", "ing", "and", "wh", "sh"], "de": ["sch", "ung", "ein", "ü", "cht"], "fr": ["eau", "oi", "é", "qu", "le"]}


def plain_counts(text):
    """n-grams of the text one by one, over a list."""
    codes = [0]
    for c in text.lower():
        letter = c.isalpha()
        if letter or codes[-1]:
            codes.append(ord(c) if letter else 0)
    codes += [0] * bool(codes[-1])
    mask, want = (1 << 64) - 1, np.zeros(langid.DIM)
    for k in langid.ORDERS:
        for i in range(len(codes) - k + 1):
            h = 0
            for c in codes[i : i + k]:
                h = (h * 0x9E3779B97F4A7C15 + c + 1) & mask
            want[((h ^ h >> 29) * 0xBF58476D1CE4E5B9 & mask) >> 40 & langid.DIM - 1] += 1
    return want


@pytest.mark.parametrize("text", ["Hello, World", "a", "!?x", "Ünïcödé — straße, ловить 東京  the end!", "ab  " * 40 + "é"])
def test_ngrams_do_not_depend_on_blocks(text):
    for block in (1, 2, 3, 7, 1 << 18):
        assert (langid.counts_of(text, block) == plain_counts(text)).all(), block


def documents(spark, n=400):
    r = np.random.default_rng(4)
    rows = []
    for i in range(n):
        lang = list(SYLLABLES)[i % 3]
        words = ["".join(r.choice(SYLLABLES[lang], r.integers(1, 4))) for _ in range(r.integers(3, 60))]
        rows.append((i, " ".join(words), lang if i % 10 else None, "s", 0.5))
    rows += [(1000, None, "en", "s", None), (1001, "", "en", "s", None), (1002, "12 !? 34", "en", "s", None), (1003, "東京 ловить", None, "s", None), (1004, "the " * 100_000, "en", "s", None), (None, "the and", "en", "s", None), (5, "repeated the", "en", "s", None)]
    return spark.createDataFrame([(*r, "clash", 7) for r in rows], "doc_id long, text string, lang string, source string, score double, lang_pred string, share int")


def test_languages(spark):
    docs = documents(spark)
    model = langid.train(docs, lambda i: ~held_out(i))
    got = langid.identify(docs, model)
    assert got.count() == docs.count()
    rows = {r["doc_id"]: r for r in got.collect()}
    want = {r["doc_id"]: r["lang"] for r in docs.collect()}
    tested = [r["doc_id"] for r in docs.filter(held_out(F.col("doc_id"))).collect() if r["doc_id"] is not None and r["doc_id"] < 400 and want[r["doc_id"]]]
    assert np.mean([rows[i]["lang_pred"] == want[i] for i in tested]) > 0.95
    assert all(rows[i]["lang_pred"] == "und" and rows[i]["score"] == 0 for i in (1000, 1001, 1002))
    assert rows[1003]["lang_pred"] != "und" and rows[1003]["rejected"] and rows[1004]["lang_pred"] == "en"
    assert all(0 <= r["score"] <= 1 for r in rows.values())
    none = langid.train(docs.limit(0), lambda i: ~held_out(i))
    assert {r["lang_pred"] for r in langid.identify(docs, none).collect()} == {"und"}


def plain_vector(text, idf):
    x = np.array([(1 + math.log(c)) * w if c else 0.0 for c, w in zip(plain_counts(text), idf, strict=True)])
    return x / math.sqrt(sum(v * v for v in x))


def plain_clusters(x, k):
    """Spherical k-means by loops: the mean first, then the row furthest from all before; twelve rounds."""
    norm = lambda v: v / math.sqrt(v @ v)
    centre = [norm(sum(x) / len(x))]
    while len(centre) < min(k, len(x)):
        centre.append(min(x, key=lambda v: max(v @ c for c in centre)))
    for _ in range(langid.ROUNDS):
        own = [max(range(len(centre)), key=lambda i: (v @ centre[i], -i)) for v in x]
        centre = [norm(sum(v for v, o in zip(x, own, strict=True) if o == i)) if i in own else centre[i] for i in range(len(centre))]
    return centre


def test_languages_equal_a_plain_run(spark):
    """Inverse frequencies, centroids and predictions, computed one by one."""
    docs = documents(spark, 90).filter("doc_id < 90 and text <> 'repeated the'")
    model = langid.train(docs, lambda i: ~held_out(i))
    rows = docs.withColumn("h", held_out(F.col("doc_id"))).collect()
    learned = sorted({(r["lang"], r["text"]) for r in rows if r["lang"] and not r["h"]})
    df = sum(plain_counts(t) > 0 for _, t in learned)
    idf = [math.log((1 + len(learned)) / (1 + d)) + 1 for d in df]
    assert np.allclose(model.idf, idf, rtol=1e-5)
    centres = [(lang, c) for lang in sorted({x for x, _ in learned}) for c in plain_clusters([plain_vector(t, idf) for x, t in learned if x == lang], langid.CENTROIDS)]
    assert [x for x, _ in centres] == model.langs
    got = {r["doc_id"]: r for r in langid.identify(docs, model).collect()}
    for r in rows:
        v = plain_vector(r["text"], model.idf)
        near = [(float(v @ c), lang) for c, lang in zip(model.centres, model.langs, strict=True)]
        best, lang = max(near)
        each = {x: max(s for s, y in near if y == x) for _, x in near}
        assert got[r["doc_id"]]["lang_pred"] == lang and abs(got[r["doc_id"]]["distance"] - (1 - best)) < 1e-5
        assert abs(got[r["doc_id"]]["score"] - 1 / sum(math.exp((s - best) / 0.05) for s in each.values())) < 1e-3
    assert np.allclose(model.centres, [c for _, c in centres], atol=1e-5)


def test_letters_of_many_scripts():
    codes = [*range(0x250, 0x3000), *range(0x4E00, 0x9FFF), *range(0x10000, 0x10400)]
    assert langid.letters_of("".join(map(chr, codes))).tolist() == [c if chr(c).isalpha() else 0 for c in codes]


def test_toxicity_scores_equal_a_plain_run(spark):
    """Features by plain loops, trees walked one by one, calibration by interpolation."""
    r = np.random.default_rng(8)
    rows = []
    for i in range(600):
        words = ["".join(r.choice(SYLLABLES["en"], r.integers(1, 4))) for _ in range(r.integers(5, 30))]
        if i % 3 == 0:
            words.insert(int(r.integers(0, len(words))), ["you idiot", "m0ron!!", "YOU zzvile"][i // 3 % 3])
        rows.append((i, " ".join(words), int(i % 3 == 0)))
    labelled = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.train(labelled)
    got = {x["doc_id"]: x["score"] for x in toxicity.score(labelled.select("doc_id", "text"), model).collect()}
    edges, values = model.calibration.boundaries.toArray(), model.calibration.predictions.toArray()
    assert (np.diff(values) >= 0).all()
    for i, text, _ in rows[::7]:
        x = Vectors.dense(toxicity.features(text, model.lexicon))
        margin = sum(w * t.predict(x) for w, t in zip(model.trees.treeWeights, model.trees.trees, strict=True))
        assert abs(got[i] - np.interp(margin, edges, values)) < 1e-6
        words = re.findall(r"[^\W_]+(?:[*@$!]+[^\W_]+)*", text)
        name = dict(zip(toxicity.FEATURES, toxicity.features(text, model.lexicon), strict=True))
        low = [w.lower() for w in words]
        insult, person = [w in toxicity.INSULT_SET for w in low], [w in toxicity.PERSON_SET for w in low]
        assert name["insults"] == sum(insult) and abs(name["second_person"] - sum(person) / len(words)) < 1e-12
        assert abs(name["learned_weight"] - sum(model.lexicon.words.get(w, 0.0) for w in low) / len(words)) < 1e-12
        assert abs(name["exclamations"] - text.count("!") / len(text)) < 1e-12 and abs(name["capital_words"] - sum(len(w) > 1 and w.isupper() for w in words) / len(words)) < 1e-12
        marked = [i for i, w in enumerate(low) if insult[i] or w in model.lexicon.words]
        near = sum(any(person[j] for j in range(max(0, i - 5), min(len(low), i + 6))) for i in marked)
        assert abs(name["near_second_person"] - near / len(words)) < 1e-12


def test_toxicity(spark):
    r = np.random.default_rng(6)
    rows, labels = [], []
    for i in range(900):
        words = ["".join(r.choice(SYLLABLES["en"], r.integers(1, 4))) for _ in range(r.integers(5, 60))]
        bad = i % 4 == 0
        if bad:
            words.insert(int(r.integers(0, len(words))), ["you idiot", "m0ron", "zzvile"][i // 4 % 3])
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(bad)))
    rows += [(2000, None), (2001, ""), (2002, "you idiot " * 20_000), (None, "fine"), (7, "a repeated id")]
    labels += [(1, None, None), (None, 1, 1), (5000, 1, 1), (3, 1, labels[3][2])]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, raw string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    sample = toxicity.training_rows(docs, marks, lambda i: ~held_out(i))
    assert sample.filter(held_out(F.col("doc_id"))).count() == 0
    again = toxicity.training_rows(docs.orderBy(F.desc("text")).repartition(7), marks, lambda i: ~held_out(i))
    assert sorted(map(tuple, sample.collect())) == sorted(map(tuple, again.collect())) and len({x["doc_id"] for x in sample.collect()}) == sample.count()
    got = toxicity.score(docs.select("doc_id", "text"), toxicity.train(sample))
    rows = {x["doc_id"]: x for x in got.withColumn("h", held_out(F.col("doc_id"))).collect()}
    assert got.count() == docs.count() and all(0 <= x["score"] <= 1 and x["predicted"] == (x["score"] >= 0.5) for x in rows.values())
    tested = [i for i in range(900) if rows[i]["h"]]
    assert np.mean([rows[i]["predicted"] == (i % 4 == 0) for i in tested]) > 0.9
    assert rows[2002]["predicted"] == 1 and rows[2000]["predicted"] == 0
    assert toxicity.train(sample.limit(0)) is None
    assert {x["score"] for x in toxicity.score(docs, None).collect()} == {0.0}


def test_features_of_whole_texts():
    lexicon = toxicity.Lexicon({"zzvile": 3.0}, {"zzvile": 2.0})
    name = dict(zip(toxicity.FEATURES, toxicity.features("YOU idiot!! zzvilest 1d10t i d i o t aaaaa zzvile", lexicon), strict=True))
    assert name["insults"] == 1 and name["learned_words"] == 1 and name["stems"] == 1 and name["near_second_person"] > 0
    assert name["disguised_insults"] == 1 and name["long_runs"] > 0 and name["spaced"] > 0 and name["capital_words"] > 0
    assert not any(toxicity.features(None, lexicon)) and not any(toxicity.features("", lexicon)) and re.match("log", toxicity.FEATURES[0])
