"""The gauge feed as a stream: a change-only series, decided in event time from Spark's state store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import quality, series
from ..schemas import LATEST, SERIES, empty
from ..scratch import forget, settle
from ..sources import publish
from ..sources.ingest import instant

#: Batches, or merged folders of one level, that are merged into one folder of the next level.
COMPACT = 16
#: Names the stream that a root belongs to.
OWNER = "_stream"
#: Folder of the values that are final and last, a table for a batch.
KNOWN = "known"


def final_days(feed: DataFrame, delay: str) -> DataFrame:
    """(repo_id, metric, date, value) of each day of a streaming feed (repo_id, metric, value, date), once, when it is final.

    ``date`` is a day or a full instant, as ISO text; of several values of one day that of the last
    instant stands, of equal instants the largest. A day is final when the watermark, the newest instant seen less
    ``delay``, has passed its end; until then values may come in any order and batch. Values of days that are final
    are left out, and Spark's progress counts them (numRowsDroppedByWatermark). A row without a repo_id
    only moves the time on: one a day lets days become final while nothing else is measured. Dates that are none are left out;
    rows without a repo_id and days without any value come out as nulls, for a filter here would pass below the watermark (see changes()).
    """
    at = F.try_to_timestamp(instant(F.col("date")))
    rows = feed.select("repo_id", "metric", F.col("value").cast("long").alias("value"), at.alias("at")).filter("at is not null").withWatermark("at", delay)
    last = F.max(F.when(F.col("value").isNotNull(), F.struct("at", "value"))).alias("last")
    # windows of a day are UTC days in any session's time zone
    day = F.date_from_unix_date((F.unix_seconds("window.start") / 86_400).cast("int")).cast("string")
    return rows.groupBy(F.window("at", "1 day"), "repo_id", "metric").agg(last).select("repo_id", "metric", day.alias("date"), F.col("last.value").alias("value"))


def changes(days: DataFrame, known: DataFrame) -> DataFrame:
    """Series rows of final days whose value differs from that of the day before, or, for the first of them, from the known one (repo_id, metric, value)."""
    both = days.unionByName(known.withColumn("date", F.lit("")))  # before any day
    in_order = Window.partitionBy("repo_id", "metric").orderBy("date")
    rows = both.withColumn("before", F.lag("value").over(in_order)).filter("date <> '' and (before is null or value <> before)")
    return rows.select([c.split()[0] for c in SERIES.split(", ")])


def take_days(root: str, days: DataFrame, batch_id: int, compact: int = COMPACT) -> None:
    """Write what changes by a batch of final days, and the values that are known after it; a batch that runs again writes the same.

    The known values are a table of one row for each (repo_id, metric) seen so far; that of the batch before stays, for a batch that runs again.
    """
    spark = days.sparkSession
    _claim(spark, root)
    days = settle(days.filter("repo_id is not null and value is not null"), "days")
    folder = f"{root}/{KNOWN}"
    done = [n for n in publish._names(spark, folder) if int(n) < batch_id and (x := publish._fs(spark, f"{folder}/{n}/_SUCCESS"))[0].exists(x[1])]
    known = spark.read.schema(LATEST).parquet(f"{folder}/{done[-1]}") if done else empty(spark, LATEST)
    append_batch(root, changes(days, known), batch_id, compact)
    if not days.isEmpty():
        both = days.unionByName(known.withColumn("date", F.lit("")))
        last = both.groupBy(*series.LATEST_KEY).agg(F.max_by("value", "date").alias("value"))
        last.write.mode("overwrite").parquet(f"{folder}/{batch_id:09d}")
    for n in done[:-1]:
        fs, p = publish._fs(spark, f"{folder}/{n}")
        fs.delete(p, True)
    forget(days)


def _claim(spark: SparkSession, root: str) -> None:
    """The root belongs to the stream that wrote to it first, known by the id in its checkpoint; another one stops."""
    mine = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "-"
    fs, owner = publish._fs(spark, f"{root}/{OWNER}")
    if not fs.exists(owner):
        try:
            publish._put(spark, f"{root}/{OWNER}", mine)
        except quality.GateError:  # another stream was quicker
            pass
    if (whose := publish._get(spark, owner.toString())) != mine:
        raise ValueError(f"{root} holds the tables of the stream {whose}, not of {mine}: a new stream, or one that lost its checkpoint, needs a folder of its own")


def _parts(spark: SparkSession, root: str) -> list[tuple[int, int, int]]:
    """(level, first, last batch) of the folders of the series that are whole."""
    found = publish._names(spark, f"{root}/series")
    parts = [tuple(map(int, n.split("-"))) for n in found]
    done = lambda p: (x := publish._fs(spark, f"{root}/series/{_name(p)}/_SUCCESS"))[0].exists(x[1])
    return [p for p in parts if done(p)]


def _name(part: tuple[int, int, int]) -> str:
    return f"{part[0]:02d}-{part[1]:09d}-{part[2]:09d}"


def _current(parts: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Of folders, those that no merged one of a higher level covers."""
    return [p for p in parts if not any(q[0] > p[0] and q[1] <= p[1] and p[2] <= q[2] for q in parts)]


def append_batch(root: str, batch: DataFrame, batch_id: int, compact: int = COMPACT) -> None:
    """Write a batch of series rows to its own folder; a batch that runs again writes the same one.

    Every ``compact`` batches their folders are merged into one, every ``compact`` of those into one of the next level, and so on: so
    there are at most some ``2 * compact`` folders a level, and a row is written once a level. Folders that were merged stay until the next merge of
    their level, for those who read them just then.
    """
    spark = batch.sparkSession
    _claim(spark, root)
    batch.write.mode("overwrite").parquet(f"{root}/series/{_name((0, batch_id, batch_id))}")
    size, level = compact, 0
    while (batch_id + 1) % size == 0:
        first = batch_id + 1 - size
        parts = [p for p in _parts(spark, root) if p[0] == level and p[1] >= first]
        if parts:
            merged = spark.read.schema(SERIES).parquet(*[f"{root}/series/{_name(p)}" for p in parts])
            merged.hint("rebalance").write.mode("overwrite").parquet(f"{root}/series/{_name((level + 1, first, batch_id))}")
            fs = publish._fs(spark, root)[0]
            for p in _parts(spark, root):
                if p[0] == level and p[2] < first:
                    fs.delete(publish._fs(spark, f"{root}/series/{_name(p)}")[1], True)
        size, level = size * compact, level + 1


def run(feed: DataFrame, root: str, checkpoint: str, delay: str = "2 days", compact: int = COMPACT) -> StreamingQuery:
    """Start the stream over what is available; feed: a streaming table of (repo_id, metric, value, date), see changes().

    Days that are not final and the watermark are in the checkpoint, from which a later run goes on; the series (read_series) and the
    last final values are under root. For many keys set Spark's RocksDB state store.
    """
    out = final_days(feed, delay).writeStream.outputMode("append").foreachBatch(lambda b, i: take_days(root, b, i, compact))
    return out.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_series(spark: SparkSession, root: str) -> DataFrame:
    """The series so far, of all days that are final."""
    parts = _current(_parts(spark, root))
    return spark.read.schema(SERIES).parquet(*[f"{root}/series/{_name(p)}" for p in parts]) if parts else empty(spark, SERIES)


def read_latest(spark: SparkSession, root: str) -> DataFrame:
    """The current value of each (repo_id, metric), as of the days that are final."""
    rows = read_series(spark, root).groupBy(*series.LATEST_KEY).agg(F.max_by("value", "date").alias("value"))
    return rows.select([c.split()[0] for c in LATEST.split(", ")])
