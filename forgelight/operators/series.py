"""The sparse, change-only series (repo_id, date, metric, value), and the current values.

Dates are ISO text, so their order as text is that of time. Nulls mean "not measured" and are never 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..schemas import CLOSING

KEY = ["repo_id", "date", "metric"]
LATEST_KEY = ["repo_id", "metric"]

# Metric names, and how a metric is rebuilt from dated items.
FORWARD_METRICS = ["stars", "forks", "watchers", "issues_open", "issues_closed", "prs_open", "prs_closed", "prs_merged", "releases_total", "size_kb"]
WEEKLY_METRICS = ["commits_total", "contributors_total", "median_days_to_close_issue", "median_days_to_close_pr", "median_open_issue_age_days"]
KINDS = {"stars": "cumulative", "forks": "cumulative", "releases_total": "cumulative", "issues_open": "open", "prs_open": "open"}
DEFAULT_REBUILT = ["stars", "forks", "releases_total"]
RECENT_DAYS = 400


def to_long(snapshot: DataFrame, id_map: DataFrame, metrics: list[str] = FORWARD_METRICS) -> DataFrame:
    """Wide snapshot by node_id to (repo_id, metric, value): listed metrics that are not null, of nodes in the id map."""
    have = [m for m in metrics if m in snapshot.columns]
    wide = snapshot.join(id_map.select("node_id", "repo_id"), "node_id").select("repo_id", *[F.col(m).cast("long").alias(m) for m in have])
    return wide.unpivot(["repo_id"], have, "metric", "value").filter("value is not null")


def change_only(previous: DataFrame, snapshot: DataFrame, date: str) -> DataFrame:
    """Rows of the snapshot that are new or differ from the previous values, dated."""
    before = previous.select("repo_id", "metric", F.col("value").alias("__before"))
    changed = snapshot.join(before, LATEST_KEY, "left").filter(~F.col("value").eqNullSafe(F.col("__before")))
    return changed.select("repo_id", F.lit(date).alias("date"), "metric", "value")


def upsert_replace(prior: DataFrame, incoming: DataFrame, key: list[str]) -> DataFrame:
    """Prior rows and incoming ones; on the same key the incoming row stands."""
    return prior.join(incoming.select(key), key, "left_anti").unionByName(incoming, allowMissingColumns=True)


def upsert_keep(prior: DataFrame, incoming: DataFrame, key: list[str]) -> DataFrame:
    """Prior rows and incoming ones; on the same key the prior row stands."""
    return prior.unionByName(incoming.join(prior.select(key), key, "left_anti"), allowMissingColumns=True)


def cumulative_series(items: DataFrame) -> DataFrame:
    """Running count of dated items, a row for each (repo_id, metric) and UTC day that has any.

    Items are counted by day first, so a repository's window is as long as its days, not its items.
    Items without a time are ignored.
    """
    day = F.substring("created", 1, 10)
    daily = items.filter("created is not null").groupBy("repo_id", "metric", day.alias("date")).count()
    up_to = Window.partitionBy("repo_id", "metric").orderBy("date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return daily.select("repo_id", "date", "metric", F.sum("count").over(up_to).alias("value"))


def open_series(items: DataFrame) -> DataFrame:
    """Running number of open items: +1 on the day of creation, -1 on that of closing; days whose net is 0 give no row.

    The number may go below zero where items close before they are created.
    """
    events = items.filter("created is not null").select(
        "repo_id", "metric", F.explode(F.array(F.struct(F.substring("created", 1, 10).alias("date"), F.lit(1).alias("d")), F.struct(F.substring("closed", 1, 10).alias("date"), F.lit(-1).alias("d")))).alias("e")
    )
    net = events.filter("e.date is not null").groupBy("repo_id", "metric", F.col("e.date").alias("date")).agg(F.sum("e.d").alias("net")).filter("net <> 0")
    up_to = Window.partitionBy("repo_id", "metric").orderBy("date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return net.select("repo_id", "date", "metric", F.sum("net").over(up_to).alias("value"))


def rebuild(items: DataFrame, metrics: list[str] = DEFAULT_REBUILT, kinds: dict[str, str] = KINDS) -> DataFrame:
    """Series of the listed metrics from items, each by its kind; an unknown metric is an error."""
    unknown = [m for m in metrics if m not in kinds]
    if unknown:
        raise ValueError(f"unknown metrics: {unknown}")
    of = {k: [m for m in metrics if kinds[m] == k] for k in ("cumulative", "open")}
    made = {"cumulative": cumulative_series, "open": open_series}
    parts = [made[k](items.filter(F.col("metric").isin(names))) for k, names in of.items() if names]
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def with_year(series: DataFrame) -> DataFrame:
    return series.withColumn("year", F.substring("date", 1, 4).cast("int"))


def closing(rows: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """The closing table of a year: of each (repo_id, metric) the last row and how many there are, in rows of that year and in the closing table ``before``."""
    one = rows.groupBy("repo_id", "metric").agg(F.max("date").alias("last_date"), F.max_by("value", "date").alias("last_value"), F.count("*").alias("n"))
    both = one if before is None else one.unionByName(before.select(one.columns))
    got = both.groupBy("repo_id", "metric").agg(F.max("last_date").alias("last_date"), F.max_by("last_value", "last_date").alias("last_value"), F.sum("n").alias("n"))
    return got.select([c.split()[0] for c in CLOSING.split(", ")])


def closings(rows: DataFrame, before: DataFrame, years: list[int], repeated: Observation | None = None) -> DataFrame:
    """The closing tables (see closing) of all of ``years`` at once, with a column year.

    rows: all series rows of these years; before: the closing table of the years before them. Rows go once through one window by date: the last row of
    a year stands for it, and for the years after it until there is a later one. ``repeated`` is given the number of rows whose key the row before has too.
    """
    closed, first, end = [c.split()[0] for c in CLOSING.split(", ")], min(years), max(years) + 1
    own = with_year(rows).select("repo_id", "metric", F.col("date").alias("last_date"), F.col("value").alias("last_value"), F.lit(1).cast("long").alias("n"), "year")
    by = Window.partitionBy("repo_id", "metric").orderBy("year", "last_date")
    got = own.unionByName(before.select(*closed, F.lit(first - 1).alias("year"))).withColumns({
        "n": F.sum("n").over(by.rowsBetween(Window.unboundedPreceding, Window.currentRow)), "__end": F.coalesce(F.lead("year").over(by), F.lit(end)), "__date": F.lead("last_date").over(by),
    })
    if repeated is not None:
        got = got.observe(repeated, F.count_if(F.col("last_date") == F.col("__date")).alias("rows"))
    begin = F.greatest("year", F.lit(first))
    held = got.filter(begin < F.col("__end")).select(*closed, F.explode(F.sequence(begin, F.col("__end") - 1)).alias("year"))
    return held.filter(F.col("year").isin(years))


def year_rows(series: DataFrame, year: int) -> DataFrame:
    """Rows of one year; where the table is partitioned by year, others are not read."""
    rows = series.filter(F.col("year") == year) if "year" in series.columns else series
    return rows.filter(F.col("date").between(f"{year:04d}-01-01", f"{year:04d}-12-31"))


def recent(series: DataFrame, today: str, days: int = RECENT_DAYS) -> DataFrame:
    """Rows from ``days`` before today on, that day included."""
    first = F.date_format(F.date_sub(F.lit(today).cast("date"), days), "yyyy-MM-dd")
    rows = series.filter(F.col("date") >= first)
    return rows.filter(F.col("year") >= F.substring(first, 1, 4).cast("int")) if "year" in series.columns else rows


def fold_history(working: DataFrame, history: DataFrame, purged: list[str] = ()) -> DataFrame:
    """Working rows over published history; purged metrics do not come back."""
    kept = history.filter(~F.col("metric").isin(list(purged))) if purged else history
    return upsert_replace(kept, working, KEY)


def purge(series: DataFrame, metrics: list[str]) -> tuple[DataFrame, DataFrame]:
    """The series without these metrics, and the years that they covered."""
    gone = F.col("metric").isin(list(metrics))
    return series.filter(~gone), touched_years(series.filter(gone))


def touched_years(*rows: DataFrame) -> DataFrame:
    """(year) that rows of any of these tables lie in."""
    years = [r.select(F.substring("date", 1, 4).cast("int").alias("year")) for r in rows]
    out = years[0]
    for y in years[1:]:
        out = out.union(y)
    return out.distinct()


def combine(*parts: DataFrame) -> DataFrame:
    """Union of partial results; of rows of one key the one with the smallest value."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy(*KEY).agg(F.min("value").alias("value"))


def weekly_delta(previous: DataFrame, snapshot: DataFrame, date: str, metrics: list[str] = WEEKLY_METRICS) -> tuple[DataFrame, DataFrame]:
    """(changed rows, long snapshot) of a wide weekly snapshot by repo_id, held only against the same metrics.

    Of several rows of a repository the first by its values stands.
    """
    values = F.struct(*[F.col(m).cast("long").alias(m) for m in metrics])
    one = snapshot.groupBy("repo_id").agg(F.min(values).alias("v")).select("repo_id", "v.*")
    long = one.unpivot(["repo_id"], metrics, "metric", "value").filter("value is not null")
    return change_only(previous.filter(F.col("metric").isin(metrics)), long, date), long


def go_live(state: DataFrame, date: str) -> DataFrame:
    """State with the first successful date, which is set once."""
    mark = state.sparkSession.createDataFrame([("go_live", date)], "key string, value string")
    return upsert_keep(state, mark, ["key"])
