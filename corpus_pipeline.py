"""From documents to packed training sequences, in five stages of the llm operators.

Each stage takes (spark, docs, sf_dir), works on all rows that the stage before it kept, and
returns a DataFrame; all but the last return the columns of documents. Run over Parquet between the
stages, as check tools and :func:`run` do, no stage is computed twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgelight.llm import decontamination, packing, pii, simhash, toxicity
from forgelight.llm.common import held_out, settle
from forgelight.llm.queries import PII_KEY, table, tokenizer_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A document of whose words benchmark windows cover more than this is dropped; of others the spans are cut out.
MAX_COVERAGE = 0.5


def _sized(docs: DataFrame) -> DataFrame:
    """n_chars follows the text where a stage has changed it."""
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic, as they are."""
    docs = docs.select(COLUMNS)
    rows = toxicity.training_rows(docs, table(spark, sf_dir, "labels"), lambda i: ~held_out(i))
    return toxicity.score(docs, toxicity.train(rows)).filter("predicted = 0").select(COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of texts with 0.8 of their five-word shingles in common, found by fingerprints of 9 or fewer differing bits."""
    return simhash.deduplicate_copies(docs.select(COLUMNS))


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of benchmark windows; those that are mostly benchmark go."""
    clean = decontamination.decontaminate(docs.select(COLUMNS), table(spark, sf_dir, "benchmark"), window=10, max_coverage=MAX_COVERAGE)
    return _sized(clean)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with surrogates in place of personal data."""
    return _sized(pii.pseudonymize(docs.select(COLUMNS), PII_KEY))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed into sequences of 2048 tokens."""
    return packing.pack(docs, tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", cut_benchmark),
    ("personal_data", replace_personal_data),
    ("packing", pack),
]

#: Learned scores, hashes and tokens are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
