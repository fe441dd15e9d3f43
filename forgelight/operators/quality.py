"""Gates between a run and its publication."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_UNIVERSE = 0.9
MIN_ROWS = 0.98
WATCHED = [("summary", "stars"), ("summary", "first_date"), ("summary", "last_commit_date")]


class GateError(RuntimeError):
    """A gate has refused a build."""


def universe_guard(packages: int, repos: int, prev_packages: int | None, prev_repos: int | None, least: float = MIN_UNIVERSE) -> None:
    """Fail if packages or repositories fall below ``least`` of the previous build; without one nothing is compared."""
    for what, now, before in (("packages", packages, prev_packages), ("repositories", repos, prev_repos)):
        if before and now < least * before:
            raise GateError(f"{what} fell from {before} to {now}")


def universe(resolved: DataFrame) -> tuple[int, int]:
    """(packages, repositories) of resolved packages: a one-row aggregate."""
    slug = F.lower(F.concat_ws("/", "host_domain", "owner", "name"))
    return tuple(resolved.agg(F.count_distinct("package", "origin"), F.count_distinct(slug)).first())


def measures(tables: dict[str, DataFrame], watched: list[tuple[str, str]] = WATCHED) -> DataFrame:
    """(table, column, n): rows of each table (column '*'), and values that are not null in watched columns it has."""
    parts = []
    for name, df in tables.items():
        own = [c for t, c in watched if t == name and c in df.columns]
        counts = [F.struct(F.lit(c).alias("column"), F.count(c).alias("n")) for c in ("*", *own)]
        parts.append(df.agg(F.array(*counts).alias("c")).select(F.lit(name).alias("table"), F.inline("c")))
    return reduce(DataFrame.union, parts)


def regressions(before: DataFrame, after: DataFrame, least: float = MIN_ROWS) -> DataFrame:
    """(table, column, before, after) of measures of two builds that fell below ``least``; what only one has, and zeros before, are skipped."""
    old = before.select("table", "column", F.col("n").alias("before"))
    both = old.join(after.select("table", "column", F.col("n").alias("after")), ["table", "column"])
    return both.filter((F.col("before") > 0) & (F.col("after") < least * F.col("before")))


def row_print(df: DataFrame, columns: list[str] | None = None):
    """A 32-bit number of each row, from the text of its columns; sums of it do not depend on the order of rows."""
    own = sorted(columns or df.columns)
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in own])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def fingerprint(df: DataFrame, by: list[str] = ()) -> DataFrame:
    """Rows and summed row prints, of the whole table or of each group."""
    rows = df.select(*by, row_print(df).alias("p"))
    return rows.groupBy(*by).agg(F.count("*").alias("rows"), F.coalesce(F.sum("p"), F.lit(0)).alias("fingerprint"))


def integrity(tables: dict[str, DataFrame], declared: list[str]) -> DataFrame:
    """(table, rows, fingerprint, present) of every declared table; a missing one has nulls and false."""
    spark = next(iter(tables.values())).sparkSession
    parts = [fingerprint(df).select(F.lit(n).alias("table"), "rows", "fingerprint", F.lit(True).alias("present")) for n, df in tables.items() if n in declared]
    gone = [(n, None, None, False) for n in declared if n not in tables]
    return reduce(DataFrame.union, [*parts, spark.createDataFrame(gone, "table string, rows long, fingerprint long, present boolean")])


def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys that more than one row has; nulls count as equal."""
    return df.groupBy(*key).count().filter("count > 1")


def changed_partitions(previous: DataFrame, current: DataFrame, by: str = "year") -> DataFrame:
    """Partitions (by) that are new or whose fingerprint differs; vanished ones are not reported."""
    old = previous.select(by, F.struct("rows", "fingerprint").alias("o"))
    now = current.select(by, "rows", "fingerprint").join(old, by, "left")
    return now.filter(~F.struct("rows", "fingerprint").eqNullSafe(F.col("o"))).select(by)
