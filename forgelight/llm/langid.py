"""Language identification: nearest of several centroids per language, over normalised TF-IDF n-gram vectors."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, settle

#: Labelled rows of each language that centroids are learned from, about; all if there are fewer.
MAX_ROWS_PER_LANG = 2_000
#: Bytes of centroids that may be sent to every executor, 4 x 32 KB a language; a lang column with more values than that allows is refused.
MAX_MODEL_BYTES = 1 << 30
#: Size of an n-gram vector; n-grams are hashed to a place.
DIM = 1 << 13
#: Letters in an n-gram.
ORDERS = (1, 2, 3)
CENTROIDS = 4
ROUNDS = 12
#: A text is rejected if its distance from the nearest centroid is above this quantile of the learned rows' distances.
REJECT_QUANTILE = 0.995
#: Characters of a text that are counted at a time.
BLOCK = 1 << 18


def letters_of(text: str) -> np.ndarray:
    """Code points of a lower-case text, 0 for all but letters."""
    if text.isascii():
        code = np.frombuffer(text.encode(), "u1")
        keep = (code >= 0x61) & (code <= 0x7A)
    else:
        code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        keep = ((code >= 0x61) & (code <= 0x7A)) | ((code >= 0xC0) & (code < 0x250) & (code != 0xD7) & (code != 0xF7))
        high = code >= 0x250
        found, place = np.unique(code[high], return_inverse=True)
        keep[high] = np.array([chr(c).isalpha() for c in found.tolist()], bool)[place]
        for one in (0xAA, 0xB5, 0xBA):
            keep |= code == one
    return np.where(keep, code, 0).astype("u4")


def counts_of(text: str | None, block: int = BLOCK) -> np.ndarray | None:
    """How often each hashed n-gram occurs in the whole text; None if the text has no letter.

    Each stretch of other characters than letters counts as one edge, as do both ends of the text. A
    text is taken in blocks; each begins with the last letters of the one before, whose own n-grams
    are not counted again.
    """
    if not text:
        return None
    text = text.lower()
    out, seen, reach = np.zeros(DIM), False, max(ORDERS) - 1
    carry = np.zeros(1, "u4")  # the edge before the text, which ends no n-gram but itself
    counted = 0  # of the carried codes, those whose n-grams have been counted
    for at in range(0, len(text), block):
        last = at + block >= len(text)
        fresh = np.concatenate([letters_of(text[at : at + block]), np.zeros(int(last), "u4")])
        seen = seen or bool(fresh.any())
        code = np.concatenate([carry, fresh])
        first = np.ones(len(code), bool)
        first[1:] = (code[1:] != 0) | (code[:-1] != 0)
        code = code[first]  # the carried part has no two edges in a row, so it stays as it is
        h = np.zeros(len(code), "u8")
        for k in range(reach + 1):
            h = h[: len(code) - k] * np.uint64(0x9E3779B97F4A7C15) + code[k:] + np.uint64(1)
            new = h[max(0, counted - k) :]  # n-grams that end after what was counted
            if k + 1 in ORDERS and len(new):
                mixed = (new ^ (new >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
                out += np.bincount((mixed >> np.uint64(40)).astype("i8") % DIM, minlength=DIM)
        carry = code[-max(1, reach) :]
        counted = len(carry)
    return out if seen else None


def vector_of(text: str | None) -> np.ndarray | None:
    """Damped counts (1 + log) of the n-grams of a text, not yet weighted; None if it has no letter."""
    counts = counts_of(text)
    if counts is not None:
        some = counts > 0
        counts[some] = 1 + np.log(counts[some])
    return counts


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-12)


def cluster(x: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Spherical k-means: k unit centroids at most, the first at the mean, each next at the row furthest from all before."""
    k = min(k, len(x))
    centre = unit(x.mean(0))[None]
    while len(centre) < k:
        centre = np.vstack([centre, x[np.argmin((x @ centre.T).max(1))]])
    for _ in range(rounds):
        own = np.argmax(x @ centre.T, axis=1)
        centre = np.vstack([unit(x[own == i].sum(0)) if (own == i).any() else centre[i] for i in range(len(centre))])
    return centre


@dataclass
class Centroids:
    """Inverse document frequencies, unit centroids with the language of each, and the distance of rejection."""

    idf: np.ndarray
    centres: np.ndarray
    langs: list[str]
    reject: float

    def predict(self, text: str | None) -> tuple[str, float, float] | None:
        """(language, score, distance): the language of the nearest centroid by cosine. None without a letter.

        The score is the softmax of the languages' best cosines, over 0.05.
        """
        x = vector_of(text)
        if x is None or not self.langs:
            return None
        near = (self.centres @ unit(x * self.idf).astype("f4")).astype("f8")
        best = int(near.argmax())
        each: dict[str, float] = {}
        for lang, c in zip(self.langs, near.tolist(), strict=True):
            each[lang] = max(each.get(lang, -1.0), c)
        weight = sum(np.exp((c - near[best]) / 0.05) for c in each.values())
        return self.langs[best], float(1 / weight), float(max(0.0, 1 - near[best]))


def train(docs: DataFrame, allowed: Callable[[Column], Column], seed: int = 11, most: int = MAX_ROWS_PER_LANG) -> Centroids:
    """Learn from text and lang of (doc_id, text, lang) rows that may be learned from and whose lang is not null.

    About ``most`` rows of each language are drawn by the hash of the id. Tasks make their vectors and
    one task per language clusters its rows, a bounded number; the inverse frequencies come from the
    same rows. All languages are learned; so many that the model would exceed MAX_MODEL_BYTES are an error.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", "text", "lang").filter(F.col("lang").isNotNull() & allowed(F.col("doc_id")))
    most_langs = MAX_MODEL_BYTES // (4 * DIM * CENTROIDS)
    sizes = rows.groupBy("lang").count().limit(most_langs + 1).collect()
    if not sizes:
        return Centroids(np.ones(DIM, "f4"), np.zeros((0, DIM), "f4"), [], 1.0)
    if len(sizes) > most_langs:
        raise ValueError(f"more than {most_langs} languages to learn")
    share = spark.createDataFrame([(r[0], min(1.0, most / r[1]) * (1 << 30)) for r in sizes], "lang string, share double")
    # by id and text, so that a repeated id or text is no more than its share
    drawn = rows.join(F.broadcast(share), "lang").filter(F.pmod(F.xxhash64("doc_id", "text", F.lit(seed)), F.lit(1 << 30)) < F.col("share"))
    drawn = settle(drawn.select("lang", "text").distinct(), "lang-sample")

    def frequency(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(DIM), 0
        for batch in batches:
            for text in batch.column(0):
                x = counts_of(text.as_py())
                if x is not None:
                    total += x > 0
                    n += 1
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([total.tolist()], pa.list_(pa.float64()))], ["n", "df"])

    parts = drawn.select("text").mapInArrow(frequency, "n long, df array<double>").select("n", F.posexplode("df").alias("i", "x"))
    sums = parts.groupBy("i").agg(F.sum("x").alias("x"), F.sum("n").alias("n")).collect()  # DIM rows
    idf = np.ones(DIM)
    for r in sums:
        idf[r["i"]] = np.log((1 + r["n"]) / (1 + r["x"])) + 1

    def centres(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        # in one order, for rows come as they are shuffled
        found = [v for v in map(vector_of, sorted(part["text"].dropna())) if v is not None]
        if not found:
            return pd.DataFrame({"lang": [], "centre": [], "distances": []})
        x = unit(np.array(found) * idf)
        own = cluster(x, CENTROIDS)
        away = 1 - (x @ own.T).max(1)
        return pd.DataFrame({"lang": [key[0]] * len(own), "centre": own.tolist(), "distances": [[float(np.quantile(away, REJECT_QUANTILE))]] * len(own)})

    got = drawn.groupBy("lang").applyInPandas(centres, "lang string, centre array<double>, distances array<double>").collect()
    got = sorted(got, key=lambda r: r["lang"])
    if not got:
        return Centroids(idf.astype("f4"), np.zeros((0, DIM), "f4"), [], 1.0)
    return Centroids(idf.astype("f4"), np.array([r["centre"] for r in got], "f4"), [r["lang"] for r in got], max(r["distances"][0] for r in got))


def identify(docs: DataFrame, model: Centroids, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The language of every whole text: doc_id, lang_pred, score (0 to 1), distance, rejected.

    ``lang_pred`` is the language of the nearest centroid, ``und`` if the text is null or has no
    letter (score 0, distance 1, rejected), or if nothing was learned. ``rejected`` is true where
    the distance is above that of nearly all rows learned from: the text may be of no learned
    language. Rows are not shuffled; repeated rows get equal results; other columns are not read.
    Lowers the session's Arrow batch limits where they are larger (common.bound_batches).
    """
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # CENTROIDS x languages x DIM numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            found = [own.predict(t.as_py()) or ("und", 0.0, 1.0) for t in batch.column(1)]
            lang, score, distance = zip(*found, strict=True) if found else ((), (), ())
            rejected = [x == "und" or d > own.reject for x, d in zip(lang, distance, strict=True)]
            arrays = [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(distance, pa.float64()), pa.array(rejected, pa.bool_())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], ["doc_id", "lang_pred", "score", "distance", "rejected"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double, distance double, rejected boolean")
