"""Sharding by sampled splitters: near-equal bytes in every shard, equal texts side by side."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import settle

#: Ranges are as many as RANGES_PER_SHARD for each shard, or one for every ROWS_PER_RANGE rows if that is more, so that a
#: task's range does not grow with the input. The driver holds two numbers for each. A range of more than twice its share is cut again.
RANGES_PER_SHARD = 16
ROWS_PER_RANGE = 1 << 20
#: Sampled weight units for each range, over all rows.
SAMPLES_PER_RANGE = 16
#: Rounds of cutting; a range that is still overfull then holds few, very large rows.
ROUNDS = 8
#: Equal texts stay in one shard if together they are no more than this part of a shard.
GROUP_PART = 0.01

LOWEST = -(2**63)
Splitters = tuple[np.ndarray, np.ndarray]


def ranges_of(h: np.ndarray, u: np.ndarray, splitters: Splitters) -> np.ndarray:
    """Range number of each key (h, u): how many splitters are not above it."""
    sh, su = splitters
    low, high = np.searchsorted(sh, h, "left"), np.searchsorted(sh, h, "right")
    out = low.copy()
    tied = np.flatnonzero(low < high)
    for start in np.unique(low[tied]):
        rows = tied[low[tied] == start]
        end = high[rows[0]]
        out[rows] = start + np.searchsorted(su[start:end], u[rows], "right")
    return out


def _ranged(keys: DataFrame, splitters: Splitters) -> DataFrame:
    @F.pandas_udf("long")
    def number(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for h, u in parts:
            yield pd.Series(ranges_of(h.to_numpy(), u.to_numpy(), splitters).astype("int64"))

    return keys.withColumn("rng", number("h", "u"))


def _totals(keys: DataFrame, splitters: Splitters) -> pd.DataFrame:
    """Rows and bytes of each range; as many rows as ranges, whatever the input."""
    found = _ranged(keys, splitters).groupBy("rng").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).toPandas()
    return found.set_index("rng").reindex(range(len(splitters[0]) + 1), fill_value=0).astype("int64")


def _sample(keys: DataFrame, step: float, salt: int) -> pd.DataFrame:
    """A row is drawn with probability size / step; one above step counts size / step times."""
    part = F.pmod(F.xxhash64("u", F.lit(salt)), F.lit(2**40)) / F.lit(float(2**40))
    drawn = keys.filter(part < F.col("size") / F.lit(step))
    return drawn.select("h", "u", F.greatest(F.lit(1.0), F.col("size") / F.lit(step)).alias("w")).toPandas()


def _cuts(sample: pd.DataFrame, pieces: int, heavy: np.ndarray) -> pd.DataFrame:
    """Keys at the weight quantiles of a sample; between rows of one text only if it is a heavy one, else before its first row."""
    s = sample.sort_values(["h", "u"], kind="stable")
    at = np.searchsorted(s["w"].cumsum().to_numpy(), np.arange(1, pieces) * s["w"].sum() / pieces)
    cut = s[["h", "u"]].iloc[np.minimum(at, len(s) - 1)] if len(s) else s[["h", "u"]]
    return cut.assign(u=np.where(np.isin(cut["h"], heavy), cut["u"], LOWEST))


def _merged(*cuts: pd.DataFrame) -> Splitters:
    both = pd.concat(cuts).astype("int64").drop_duplicates().sort_values(["h", "u"])
    return both["h"].to_numpy(), both["u"].to_numpy()


def find_splitters(keys: DataFrame, n_shards: int) -> tuple[Splitters, pd.DataFrame]:
    """Splitters and the exact totals of their ranges; one stays overfull only if it holds a single row or the copies of one text that is not heavy.

    Heavy texts are those whose rows together exceed GROUP_PART of a shard, n_shards / GROUP_PART of them at most.
    """
    n, total = keys.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    k = max(n_shards * RANGES_PER_SHARD, -(-n // ROWS_PER_RANGE))
    m = k * SAMPLES_PER_RANGE
    groups = keys.groupBy("h").agg(F.sum("size").alias("size")).filter(F.col("size") > F.lit(GROUP_PART * total / n_shards))
    heavy = np.array([r["h"] for r in groups.select("h").collect()], "int64")
    splitters = _merged(_cuts(_sample(keys, max(1.0, total / m), 0), k, heavy))
    totals = _totals(keys, splitters)
    for turn in range(1, ROUNDS + 1):
        over = totals[(totals["bytes"] > 2 * total / k) & (totals["rows"] > 1)]
        if over.empty:
            break
        numbers = keys.sparkSession.createDataFrame([(int(x),) for x in over.index], "rng long")
        rows = _ranged(keys, splitters).join(F.broadcast(numbers), "rng", "left_semi")  # some of the ranges
        drawn = _sample(rows, max(1.0, over["bytes"].sum() / m), turn)
        number = ranges_of(drawn["h"].to_numpy("int64"), drawn["u"].to_numpy("int64"), splitters)
        cuts = [pd.DataFrame({"h": splitters[0], "u": splitters[1]})]
        for rng, part in drawn.groupby(number):
            pieces = int(np.ceil(totals["bytes"].get(rng, 0) * k / total)) + 1
            cuts.append(_cuts(part, pieces, heavy))
        before, splitters = len(splitters[0]), _merged(*cuts)
        if len(splitters[0]) == before and turn >= 3:
            break
        totals = _totals(keys, splitters)
    return splitters, totals


def shard(docs: DataFrame, n_shards: int = 40, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Deal rows to shards 0 .. n_shards-1 of near-equal bytes (the law ``bytes``).

    Sampled splitters: a bounded sample of keys, drawn by size, gives quantile boundaries; rows are
    range-partitioned by (hash of the text, hash of the row); overfull ranges are sampled and cut
    again, between rows of one text only where these exceed GROUP_PART of a shard. Exact running sums
    within the ranges then set the shard of every row, so shards differ by about one row's size or
    GROUP_PART of a shard.

    Returns doc_id, size (UTF-8 bytes + 16), text_crc32, law, shard, slot (gapless from 0 in a
    shard). Equal texts share a shard unless they exceed GROUP_PART of one. A null text has no
    bytes and the checksum of the empty text; null ids and repeated rows are rows like others; an
    empty table gives an empty result. Other columns are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    keys = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text).cast("long") + 16).alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64(text).alias("h"),
        F.xxhash64(F.col(id_col), F.monotonically_increasing_id()).alias("u"),
    )
    keys = settle(keys, "shard-keys")
    splitters, totals = find_splitters(keys, n_shards)
    total = int(totals["bytes"].sum())
    base = totals.cumsum().shift(fill_value=0).astype("int64")
    bases = keys.sparkSession.createDataFrame(base.reset_index(names="rng"), "rng long, bytes long, rows long")
    order = Window.partitionBy("rng").orderBy("h", "u")
    up_to = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    same = Window.partitionBy("rng", "h")
    rows = (
        _ranged(keys, splitters)
        .withColumn("end", F.sum("size").over(up_to))
        .withColumn("at", F.row_number().over(order))
        .withColumn("g_start", F.min(F.col("end") - F.col("size")).over(same))
        .withColumn("g_size", F.sum("size").over(same))
        .join(F.broadcast(bases), "rng")  # a row for each range, one in a million rows beyond the first
    )
    whole = F.col("g_size") <= F.lit(GROUP_PART * total / n_shards)
    middle = F.col("bytes") + F.when(whole, F.col("g_start") + F.col("g_size") / 2).otherwise(F.col("end") - F.col("size") / 2)
    number = F.least(F.lit(n_shards - 1), F.floor(middle * F.lit(n_shards / max(1, total)))).cast("int")
    rows = rows.select("doc_id", "size", "text_crc32", number.alias("shard"), (F.col("rows") + F.col("at")).alias("place"))
    rows = settle(rows, "shard-rows")
    first = rows.groupBy("shard").agg(F.min("place").alias("first"))
    return rows.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("place") - F.col("first")).alias("slot")
    )
