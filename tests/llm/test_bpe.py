"""Encoding and decoding against the tokenizers library."""

import hashlib
import random
import unicodedata

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from forgelight.llm import bpe, queries

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    found = Tokenizer.from_file(PATH)
    found.no_truncation()
    found.no_padding()
    return found


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(PATH)


def ids(encoder, *texts):
    return [np.frombuffer(x, "int32").tolist() for x in encoder(list(texts))]


def want(library, *texts):
    return [library.encode(t, add_special_tokens=False).ids for t in texts]


#: Long words, marks that compose and move, words that begin like contractions, added tokens, white space of all kinds.
TEXTS = [
    "", " ", "a", "The cat's whiskers, they'll've been THERE'S", "x" * 64, "y" * 65, "the" * 5000, "é" * 40, "ﬁ İstanbul ΣΑΣ ẞ", "Ạ̊ é 각",
    "<|endoftext|>", "a<|endoftext|><|startoftext|> B<|ENDOFTEXT|>", "<|endoftext", "12345 ٣½Ⅷ", "漢字かなกไทย한글", "\U0001f468‍\U0001f469‍\U0001f467!!", "a\x1cb\x85c d­e", "՘ \U00010d50 \U0001e6c0 new letters", "'s't''re'll", "\x00�",
]


def test_ids_equal_the_library(encoder, library):
    assert ids(encoder, *TEXTS) == want(library, *TEXTS)
    every = [f"a{chr(c)}b{chr(c)}" for c in range(1, 0x3000)] + [f"x{chr(c)}1" for c in range(0x3000, 0x20000, 7) if not 0xD800 <= c < 0xE000]
    assert ids(encoder, *every) == want(library, *every)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=50), st.text("theinganrsouABC 'é1.́", max_size=150)), min_size=1, max_size=5))
def test_ids_of_any_text(encoder, library, texts):
    assert ids(encoder, *texts) == want(library, *texts)


def test_short_and_long_words_are_joined_alike(encoder):
    r = random.Random(4)
    for n in range(1, 120):
        words = ["".join(r.choice("thinganderouic") for _ in range(n)) for _ in range(4)]
        assert encoder.scanned([w.encode() for w in words]) == [encoder.heaped(w) for w in words]


def test_memory_is_begun_anew(library, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO", 20)
    own, r = bpe.Encoder(PATH), random.Random(1)
    for _ in range(20):
        texts = [" ".join("".join(r.choice("abcde") for _ in range(r.randint(1, 8))) for _ in range(12)) for _ in range(2)]
        assert ids(own, *texts) == want(library, *texts)
        assert len(own._memo) <= 20 + 24


def test_newer_letters_are_there(library):
    """The way by the library's own cuts is taken for some character; without one, the test above would not reach it."""
    assert any(unicodedata.category(c) == "Cn" for t in TEXTS for c in t)


def test_query_equals_the_library(spark, library, tmp_path):
    rows = [*enumerate(TEXTS), (3, "again"), (None, "no id"), (500, None), (501, "word " * 60_000)]
    df = spark.createDataFrame([(*r, "clash", 1, "clash") for r in rows], "doc_id long, text string, ids string, n_tokens int, decoded string")
    df.repartition(3).write.parquet(f"{tmp_path}/a/documents.parquet")
    got = queries.op12_rank_array(spark, f"{tmp_path}/a")
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    expect = []
    for doc_id, text in rows:
        own = library.encode(text or "", add_special_tokens=False).ids
        expect.append((doc_id, len(own), sha(" ".join(map(str, own))), sha(library.decode(own, skip_special_tokens=False))))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(expect, key=repr)
    assert dict(got.dtypes)["n_tokens"] == "bigint"
    df.limit(0).write.parquet(f"{tmp_path}/b/documents.parquet")
    assert queries.op12_rank_array(spark, f"{tmp_path}/b").count() == 0


def test_operators_keep_other_columns(spark, library):
    df = spark.createDataFrame([(1, "Hello <|endoftext|> world", "x"), (2, None, "y")], "`a key` int, body string, other string")
    found = bpe.encode(df, PATH, "body")
    assert found.columns == ["a key", "other", "ids"]
    rows = {r["a key"]: r for r in bpe.decode(found, PATH, skip_special_tokens=True).collect()}
    assert rows[1]["decoded"] == library.decode(library.encode("Hello <|endoftext|> world", add_special_tokens=False).ids, skip_special_tokens=True) and rows[1]["other"] == "x" and rows[2]["decoded"] == ""
    odd = spark.createDataFrame([([1, None, 10**8, -1, 2],), (None,), ([],)], "ids array<int>").withColumn("n", F.lit(1))
    assert sorted(r["decoded"] for r in bpe.decode(odd, PATH).collect()) == ["", "", library.decode([1, 2], skip_special_tokens=False)]
    with pytest.raises(ValueError, match="is not a byte-level BPE"):
        bpe.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
