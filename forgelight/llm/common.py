"""Helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import forget, settle, shared_dir

__all__ = ["bound_batches", "forget", "held_out", "join_by_key", "settle", "shared_dir"]

#: Rows and bytes of text that an Arrow batch may hold on its way to Python, in place of Spark's 10,000 rows.
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20


def bound_batches(spark: SparkSession) -> None:
    """Make Arrow batches small enough for whole texts; smaller ones that a user has set stay."""
    for name, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        now = int(spark.conf.get(name).rstrip("bB"))
        if now <= 0 or now > most:
            spark.conf.set(name, str(most))


#: Keys that may be broadcast, each of them on more than one in so many rows; there can be no more of these.
HOT_KEYS = 10_000


def join_by_key(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Rows joined to a settled table that has every key once, with ``n``, how many rows have it; n is left out.

    Keys on more than one in HOT_KEYS rows, HOT_KEYS of them at most, are broadcast, so that no task
    gets all rows of one of them; the others meet by a shuffle.
    """
    total = table.agg(F.sum("n")).first()[0] or 0
    hot = F.col("n") * HOT_KEYS > F.lit(total)
    few = F.broadcast(table.filter(hot).drop("n"))
    rest = rows.join(F.broadcast(few.select(key)), key, "left_anti").join(table.filter(~hot).drop("n"), key)
    return rows.join(few, key).unionByName(rest)


def held_out(doc_id: Column) -> Column:
    """True for the fifth of rows that no classifier may learn from; null ids count as the text ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0
