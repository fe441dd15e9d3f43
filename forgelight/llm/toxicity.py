"""Toxicity: gradient-boosted trees over dense features of whole texts, with isotonic calibration."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, settle

#: About how many labelled rows are learned from; all if there are fewer.
MAX_TRAINING_ROWS = 24_000
#: Toxic rows that must hold a word before the lexicon learns it.
MIN_TOXIC_ROWS = 3
#: Words that the learned part of the lexicon holds at most.
MAX_LEARNED_WORDS = 20_000
#: Letters of a word's beginning that are learned beside whole words.
STEM = 6

# Words of insult in the four languages of the tables, and pronouns that address a reader.
INSULTS = """
idiot idiots moron morons stupid dumb fool fools loser losers clown scum trash garbage pathetic worthless
disgusting filth vermin parasite creep jerk bastard imbecile cretin pig swine hate hateful
idiote imbécile crétin débile stupide ordure salaud salope connard connasse abruti nul pathétique dégoûtant minable
dumm dumme dummkopf trottel abschaum müll wertlos erbärmlich widerlich ekelhaft versager arschloch schwein
estúpido estúpida imbécil tonto tonta basura escoria patético patética inútil asqueroso perdedor payaso cabrón
""".split()
SECOND_PERSON = "you your yours yourself u ur tu te toi ton ta tes vous votre vos du dich dir dein deine ihr euch euer usted ustedes ti tus vosotros vuestro".split()
#: What stands for a letter in a disguised word.
DISGUISE = str.maketrans("013457@$!", "oieastasi")

WORD = re.compile(r"[^\W_]+(?:[*@$!]+[^\W_]+)*")
MIXED = re.compile(r"[^\W\d_][0-9@$!*]+[^\W\d_]")

FEATURES = [
    "log_words", "insult_density", "insults", "learned_density", "learned_words", "learned_weight", "learned_most",
    "stem_density", "stems", "second_person", "near_second_person", "capital_letters", "capital_words",
    "exclamations", "questions", "punctuation", "symbols", "disguised", "disguised_insults", "long_runs", "spaced", "distinct",
]
#: Words between an insult and a pronoun that count as near.
NEAR = 5


def held_words(text: str) -> tuple[set[str], set[str]]:
    """The lower-case words of a text, and their beginnings."""
    words = set(WORD.findall(text.lower()))
    return words, {w[:STEM] for w in words if len(w) > STEM}


@dataclass
class Lexicon:
    """Log odds of words and of word beginnings that occur far more in toxic rows."""

    words: dict[str, float]
    stems: dict[str, float]


def features(text: str | None, lexicon: Lexicon) -> list[float]:
    """The FEATURES of a whole text; an empty or null one has zeros."""
    text = text or ""
    data = text.encode(errors="surrogatepass")
    found = WORD.findall(text)
    n, size = max(1, len(found)), max(1, len(data))
    written = Counter(found)
    counts: Counter[str] = Counter()
    for w, c in written.items():
        counts[w.lower()] += c
    insulting, known = counts.keys() & INSULT_SET, counts.keys() & lexicon.words.keys()
    insults, learned = sum(map(counts.__getitem__, insulting)), sum(map(counts.__getitem__, known))
    weights = [lexicon.words[w] for w in known]
    stems = sum(c for w, c in counts.items() if len(w) > STEM and w[:STEM] in lexicon.stems)
    addressed = counts.keys() & PERSON_SET
    near = 0
    if addressed and (insulting or known):
        low = [w.lower() for w in found]
        p = np.array([i for i, w in enumerate(low) if w in addressed])
        at = np.array([i for i, w in enumerate(low) if w in insulting or w in known])
        spot = np.searchsorted(p, at)
        left, right = at - p[np.maximum(spot - 1, 0)], p[np.minimum(spot, len(p) - 1)] - at
        near = int(((np.abs(left) <= NEAR) | (np.abs(right) <= NEAR)).sum())
    disguised = hidden = 0
    if len(data.translate(None, ODD)) < len(data):
        for w, c in counts.items():
            if MIXED.search(w):
                plain = w.translate(DISGUISE)
                disguised += c
                hidden += c * (plain in INSULT_SET or plain in lexicon.words or w.replace("*", "") in INSULT_SET)
    left_of = lambda marks: (size - len(data.translate(None, marks))) if data else 0
    return [
        math.log1p(len(found)),
        insults / n, float(insults), learned / n, float(learned), sum(lexicon.words[w] * counts[w] for w in known) / n,
        max(weights, default=0.0), stems / n, float(stems), sum(map(counts.__getitem__, addressed)) / n, near / n,
        left_of(CAPITALS) / max(1, sum(len(w) * c for w, c in written.items())),
        sum(c for w, c in written.items() if len(w) > 1 and w.isupper()) / n,
        data.count(b"!") / size, data.count(b"?") / size, left_of(MARKS) / size, left_of(SYMBOLS) / size, disguised / n, float(hidden),
        long_runs(data) / n, spaced_letters(found, counts) / n, len(counts) / n,
    ]


def long_runs(data: bytes) -> int:
    """Stretches of four or more equal bytes."""
    x = np.frombuffer(data, "u1")
    if len(x) < 4:
        return 0
    same = x[1:] == x[:-1]
    runs = same[:-2] & same[1:-1] & same[2:]
    return int(runs[0]) + int((runs[1:] & ~runs[:-1]).sum())


def spaced_letters(found: list[str], counts: Counter[str]) -> int:
    """Stretches of four or more words of one letter, as in s p a c e d words."""
    if sum(c for w, c in counts.items() if len(w) == 1) < 4:
        return 0
    one = np.fromiter((len(w) == 1 for w in found), bool, len(found))
    if len(one) < 4:
        return 0
    runs = one[:-3] & one[1:-2] & one[2:-1] & one[3:]
    return int(runs[0]) + int((runs[1:] & ~runs[:-1]).sum())


INSULT_SET, PERSON_SET = frozenset(INSULTS), frozenset(SECOND_PERSON)
CAPITALS, MARKS, SYMBOLS, ODD = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b".,;:!?'\"()-", b"*#@$%&^~+=<>|\\/{}[]_", b"0123456789@$!*"


def learn_lexicon(rows: DataFrame) -> Lexicon:
    """Log odds from (text, toxic) rows: document counts of words, which Spark sums, in toxic and clean rows.

    A word counts if at least MIN_TOXIC_ROWS toxic rows have it and it is ten times likelier there.
    Rows are the bounded training sample; the driver gets MAX_LEARNED_WORDS words at most.
    """

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            word, kind, toxic = [], [], []
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for k, own in enumerate(held_words(text or "")):
                    word += own
                    kind += [k] * len(own)
                    toxic += [y] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(word, pa.string()), pa.array(kind, pa.int32()), pa.array(toxic, pa.int32())], ["word", "kind", "toxic"])

    n1, n0 = rows.agg(F.sum("toxic"), F.sum(1 - F.col("toxic"))).first()
    if not n1 or not n0:
        return Lexicon({}, {})
    sums = rows.select("text", "toxic").mapInArrow(held, "word string, kind int, toxic int").groupBy("word", "kind")
    sums = sums.agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b")).filter(F.col("a") >= MIN_TOXIC_ROWS)
    odds = F.log((F.col("a") + 0.5) / F.lit(n1 + 1.0)) - F.log((F.col("b") + 0.5) / F.lit(n0 + 1.0))
    kept = sums.withColumn("odds", odds).filter(F.col("odds") >= math.log(10)).orderBy(F.desc("a"), F.desc("odds"), "word", "kind")
    out = Lexicon({}, {})
    for r in kept.limit(MAX_LEARNED_WORDS).collect():
        (out.stems if r["kind"] else out.words)[r["word"]] = r["odds"]
    return out


def with_features(docs: DataFrame, lexicon: Lexicon, text_col: str) -> DataFrame:
    """All columns of docs (but one named features), and the feature array.

    Lowers the session's Arrow batch limits where they are larger (common.bound_batches).
    """
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)  # MAX_LEARNED_WORDS at most
    keep = docs.drop("features")
    own = F.struct(F.lit(0).alias("__none"), *[F.col(f"`{c}`") for c in keep.columns if c != text_col])
    rows = keep.select(own.alias("__row"), F.col(text_col).alias("__text"), F.array().cast("array<double>").alias("__x"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            x = [features(t.as_py(), known) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(x, pa.list_(pa.float64()))], ["__row", "__text", "__x"])

    out = rows.mapInArrow(run, rows.schema)
    return out.select(*[F.col("__text" if c == text_col else f"__row.`{c}`").alias(c) for c in keep.columns], F.col("__x").alias("features"))


@dataclass
class Classifier:
    """Trees, the isotonic calibration of their raw score, and the lexicon that the features need."""

    lexicon: Lexicon
    trees: GBTClassificationModel
    calibration: IsotonicRegressionModel


def training_rows(docs: DataFrame, labels: DataFrame, allowed: Callable[[Column], Column], most: int = MAX_TRAINING_ROWS) -> DataFrame:
    """(doc_id, text, toxic) of about ``most`` rows that may be learned from, drawn by the hash of the id; all if there are fewer.

    Rows without an id or a label are left out; of a repeated id the text with the smallest hash counts, with its highest label.
    """
    marks = labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int"))
    marks = marks.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & allowed(F.col("doc_id")))
    share = min(1.0, most / max(1, marks.count()))
    drawn = marks.filter(F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 30)) < F.lit(share * (1 << 30)))
    drawn = drawn.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    found = texts.join(F.broadcast(drawn), "doc_id")  # about ``most`` small rows
    first = F.min_by("text", F.struct(F.xxhash64("text"), F.md5("text")))
    return found.groupBy("doc_id", "toxic").agg(first.alias("text")).select("doc_id", "text", "toxic")


def train(labelled: DataFrame, seed: int = 7) -> Classifier | None:
    """Learn from (doc_id, text, toxic) rows, such as training_rows() gives. None if a class is missing.

    Of ten parts of the rows, dealt by the id's hash, four give the learned lexicon, four the trees
    and two the calibration, so that none trusts another too much; a part that lacks a class is
    replaced by all rows.
    """
    rows = settle(labelled.withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(10))), "toxic-sample")

    def both(part: DataFrame) -> bool:
        return part.select("toxic").distinct().count() == 2

    if not both(rows):
        return None
    own = rows.filter("part < 4")
    lexicon = learn_lexicon(own if both(own) else rows)
    data = settle(with_features(rows, lexicon, "text").select("part", "toxic", "features"), "toxic-features")
    data = data.select("part", "toxic", F.col("toxic").cast("double").alias("label"), array_to_vector("features").alias("x")).cache()
    fit, held = data.filter("part between 4 and 7"), data.filter("part > 7")
    maker = GBTClassifier(featuresCol="x", labelCol="label", maxIter=20, maxDepth=4, stepSize=0.2, minInstancesPerNode=5, subsamplingRate=0.8, seed=seed)
    trees = maker.fit(fit if both(fit) else data)
    raw = trees.transform(held if both(held) else data).select("label", raw_score("rawPrediction").alias("raw"))
    calibration = IsotonicRegression(featuresCol="raw", labelCol="label", predictionCol="calibrated").fit(raw)
    data.unpersist()
    return Classifier(lexicon, trees, calibration)


def raw_score(column: str) -> Column:
    return vector_to_array(column)[1]


def score(docs: DataFrame, model: Classifier | None, text_col: str = "text", prior: float = 0.0) -> DataFrame:
    """All columns of docs, and score (0 to 1) and predicted (1 if score >= 0.5, else 0); columns of these names are replaced.

    Null and empty texts get a score like others, from features that are all zero. Without a model
    (labels of one class, or none) every score is ``prior``. Rows are never shuffled; repeated rows
    get equal scores.
    """
    keep = docs.drop("score", "predicted", "raw", "calibrated", "__x", "__raw", "__p", "__c")
    names = [f"`{c}`" for c in keep.columns]
    if model is None:
        scored = keep.withColumn("score", F.lit(float(prior)))
    else:
        rows = with_features(keep, model.lexicon, text_col)
        trees = model.trees.copy().setFeaturesCol("__x").setRawPredictionCol("__raw").setProbabilityCol("__p").setPredictionCol("__c")
        rows = trees.transform(rows.select(*names, array_to_vector("features").alias("__x"))).withColumn("raw", raw_score("__raw"))
        scored = model.calibration.transform(rows.select(*names, "raw")).select(*names, F.col("calibrated").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
