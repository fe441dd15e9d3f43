"""Licence scan by the digests of canonical texts."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import license_texts
from .common import bound_batches, join_by_key, settle
from .license_texts import EQUIVALENT

WORD = re.compile(r"[^\W_]+")
#: A line that only says whose copyright it is, of which year.
COPYRIGHT = re.compile(r"(?i)\W*(?:(?:portions\s+)?copyrights?\b|©|\(c\)).*(?:\d{4}|©|\(c\)|<year>|\[year\]|\[yyyy\]).*|\W*all rights reserved\W*")
#: The same of no year: names alone after the word, none of them one that licence texts put there.
HOLDER = re.compile(r"\W*(?:Portions )?Copyright (?:by )?(?!.*\b(?i:notices?|licen[cs]e\w*|laws?|rights?|holders?|owners?|acts?|statements?|grants?)\b)(?:(?:[A-Z][\w.'\u2019&-]*|&),?\s*){1,6}")
#: Marks of a comment or list before the first word of a line.
BULLET = re.compile(r"^\s*(?:\(?(?:\d{1,2}|[a-z])[.)]\s+|[*\-#/;]+\s+)")
#: Rows of a table of known digests that may be broadcast.
MAX_BROADCAST = 100_000


def line_words(line: str) -> list[str]:
    """Canonical words of a line: case, punctuation, list marks and equivalent spellings do not matter; a copyright line has none."""
    if ("opyright" in line or "OPYRIGHT" in line or "(c)" in line or "(C)" in line or "©" in line or "eserved" in line or "ESERVED" in line) and (COPYRIGHT.fullmatch(line.strip()) or HOLDER.fullmatch(line.strip())):
        return []
    return [EQUIVALENT.get(w, w) for w in WORD.findall(BULLET.sub("", line.lower()))]


def digest(words: list[str]) -> str:
    """SHA-256 of the words, space-joined."""
    return hashlib.sha256(" ".join(words).encode(errors="surrogatepass")).hexdigest()


def canonical_words(text: str | None) -> list[str]:
    return [w for line in (text or "").splitlines() for w in line_words(line)]


def known_texts(spark: SparkSession, path: str | None = None) -> DataFrame:
    """(license, text) of known texts: a Parquet table at ``path``, or those that come with the library."""
    return spark.read.parquet(path).select("license", "text") if path else spark.createDataFrame(license_texts.known_texts(), "license string, text string")


def known_digests(texts: DataFrame) -> DataFrame:
    """(digest, license, n_words, head, tail) of known texts (license, text); a digest that several identifiers share has the first in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [canonical_words(t.as_py()) for t in batch.column(1)]
            columns = [[digest(w) for w in words], batch.column(0), [len(w) for w in words], [w[0] if w else None for w in words], [w[-1] if w else None for w in words]]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) if isinstance(c, list) else c for c, t in zip(columns, (pa.string(), None, pa.int32(), pa.string(), pa.string()), strict=True)], ["digest", "license", "n_words", "head", "tail"])

    found = texts.filter("license is not null").select("license", "text").mapInArrow(run, "digest string, license string, n_words int, head string, tail string")
    return found.filter("n_words > 0").groupBy("digest").agg(F.min(F.struct("license", "n_words", "head", "tail")).alias("x")).select("digest", "x.*")


def _named(rows: DataFrame, names: DataFrame, small: bool) -> DataFrame:
    """Rows with the license of their digest, null if it is not known. A large table is joined to each digest once, and frequent ones are broadcast back."""
    if small:
        return rows.join(F.broadcast(names), "digest", "left")
    found = rows.groupBy("digest").agg(F.count("*").alias("n")).join(names, "digest", "left")
    return join_by_key(rows, settle(found, "license-digests"), "digest")


def scan(docs: DataFrame, known: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Find known licences in documents: by the digest of the whole canonical text, and of each of its lines and paragraphs.

    Texts are normalised (case, punctuation, white space, copyright lines, list marks, equivalent
    spellings) and their digests joined to the known ones by equality; ``known`` is a table as
    known_digests() gives it. A line or paragraph (lines up to a blank one) whose length, first and
    last word fit no known text cannot be one, so it gets no digest.

    Returns doc_id, digest (of the whole text), license (the one that the whole text is, else null)
    and notices (identifiers of licences that a line or paragraph of it is, sorted, without repeats).
    Null and empty texts have the digest of no words, no licence and no notices. Repeated rows stay;
    an empty table gives an empty result. Other columns are not read. Of a known table of over
    MAX_BROADCAST rows the shapes are not used: every line and paragraph gets a digest, and the joins shuffle.
    Lowers the session's Arrow batch limits where they are larger (common.bound_batches).
    """
    spark = docs.sparkSession
    bound_batches(spark)
    known = settle(known_digests(known_texts(spark)) if known is None else known, "license-known")
    small = known.count() <= MAX_BROADCAST
    shapes = {(r[0], r[1], r[2]) for r in known.select("n_words", "head", "tail").collect()} if small else None
    shared = spark.sparkContext.broadcast(shapes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fit = shared.value
        for batch in batches:
            whole, parts = [], []
            for text in batch.column(1):
                words, own, first = hashlib.sha256(), set(), True
                block: list[str] = []
                lines = 0

                def close(words: list[str]) -> None:
                    if words and (fit is None or (len(words), words[0], words[-1]) in fit):
                        own.add(digest(words))  # noqa: B023

                for line in (text.as_py() or "").splitlines():
                    found = line_words(line)
                    if found:
                        words.update(("" if first else " ").encode() + " ".join(found).encode(errors="surrogatepass"))
                        first = False
                        close(found)
                        block += found
                        lines += 1
                    elif not line.strip():
                        if lines > 1:
                            close(block)
                        block, lines = [], 0
                if lines > 1:
                    close(block)
                whole.append(words.hexdigest())
                parts.append(sorted(own))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(whole, pa.string()), pa.array(parts, pa.list_(pa.string()))], ["doc_id", "digest", "parts"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, digest string, parts array<string>")
    rows = settle(rows.withColumn("u", F.monotonically_increasing_id()), "license-rows")
    names = known.select("digest", "license")
    parts = rows.select("u", F.explode("parts").alias("digest"))
    hits = _named(parts, names, small).filter("license is not null").groupBy("u").agg(F.array_sort(F.collect_set("license")).alias("notices"))
    out = _named(rows, names, small).join(hits, "u", "left")
    return out.select("doc_id", "digest", "license", F.coalesce("notices", F.array().cast("array<string>")).alias("notices"))
