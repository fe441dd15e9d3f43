"""Health figures of repositories, and the summary of one row for each package."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import ATTRIBUTES, ROLLUPS, conform

SUMMARY_METRICS = [
    "stars", "forks", "watchers", "issues_open", "issues_closed", "prs_open", "prs_closed", "prs_merged", "releases_total", "commits_total",
    "contributors_total", "median_days_to_close_issue", "median_days_to_close_pr", "median_open_issue_age_days",
]
#: Items of each repository that medians look at.
RECENT_ITEMS = 50


def merge_ratio(merged: Column, closed: Column) -> Column:
    """Percent of finished pull requests that were merged, half to even; null without any."""
    return F.bround(100 * merged / F.nullif(merged + closed, F.lit(0))).cast("long")


def _median(x: Column) -> Column:
    return F.bround(F.percentile(x, 0.5)).cast("long")


def release_facts(releases: DataFrame) -> DataFrame:
    """(repo_id, last_release_date, median_days_between_releases) from (repo_id, date) rows; distinct days count."""
    days = releases.filter("date is not null").select("repo_id", F.substring("date", 1, 10).alias("date")).distinct()
    before = F.lag("date").over(Window.partitionBy("repo_id").orderBy("date"))
    gaps = days.withColumn("gap", F.datediff(F.col("date").cast("date"), before.cast("date")))
    return gaps.groupBy("repo_id").agg(F.max("date").alias("last_release_date"), _median(F.col("gap")).alias("median_days_between_releases"))


def days_to_close(items: DataFrame) -> DataFrame:
    """(repo_id, metric, days): median days from opening to closing, of items that have both."""
    both = items.filter("created is not null and closed is not null")
    gap = F.datediff(F.substring("closed", 1, 10).cast("date"), F.substring("created", 1, 10).cast("date"))
    return both.groupBy("repo_id", "metric").agg(_median(gap).alias("days"))


def open_age(items: DataFrame, today: str) -> DataFrame:
    """(repo_id, metric, days): median age of items that are still open."""
    gap = F.datediff(F.lit(today).cast("date"), F.substring("created", 1, 10).cast("date"))
    return items.filter("created is not null and closed is null").groupBy("repo_id", "metric").agg(_median(gap).alias("days"))


def response_medians(repos: DataFrame, items: DataFrame, today: str, k: int = RECENT_ITEMS) -> DataFrame:
    """Three medians for each repository of ``repos``, null where nothing is known.

    items: repo_id, kind (issue or pr), id, created, closed, updated. Closed issues and finished
    pull requests: the k most recently updated of each repository; open issues: its k oldest.
    """
    state = F.when(F.col("closed").isNull(), "open").otherwise("closed")
    own = items.filter("created is not null").withColumn("state", state).filter("kind = 'issue' or state = 'closed'")
    by = Window.partitionBy("repo_id", "kind", "state")
    first = F.row_number().over(by.orderBy(F.when(F.col("state") == "open", F.col("created")), F.desc("updated"), "id"))
    top = own.withColumn("__n", first).filter(F.col("__n") <= k)
    end = F.coalesce(F.substring("closed", 1, 10), F.lit(today)).cast("date")
    gap = F.datediff(end, F.substring("created", 1, 10).cast("date"))
    of = lambda kind, s: _median(F.when((F.col("kind") == kind) & (F.col("state") == s), gap))
    found = top.groupBy("repo_id").agg(
        of("issue", "closed").alias("median_days_to_close_issue"),
        of("pr", "closed").alias("median_days_to_close_pr"),
        of("issue", "open").alias("median_open_issue_age_days"),
    )
    return repos.select("repo_id").distinct().join(found, "repo_id", "left")


def first_year(today: str, days: int = 30) -> int:
    """The first year whose rows trend() reads beside a closing table: that of the day ``days`` ago."""
    return (date.fromisoformat(today) - timedelta(days=days)).year


def trend(series: DataFrame, today: str, metric: str = "stars", days: int = 30, closing: DataFrame | None = None) -> DataFrame:
    """(repo_id, trend_30d): percent change against the value that held ``days`` ago, or the first later one.

    Null with fewer than two rows, or if the earlier value is 0. One aggregation, no window.
    With ``closing``, the closing table (see series.closing) of all years before first_year(), the series need hold no rows of those years: what is
    read does not grow with the history.
    """
    cutoff = F.date_format(F.date_sub(F.lit(today).cast("date"), days), "yyyy-MM-dd")
    got = series.filter(F.col("metric") == metric).groupBy("repo_id").agg(
        F.max_by("value", F.when(F.col("date") <= cutoff, F.col("date"))).alias("held"), F.min_by("value", "date").alias("head"),
        F.max_by("value", "date").alias("now"), F.count("*").alias("n"),
    )
    if closing is not None:
        old = closing.filter(F.col("metric") == metric).select("repo_id", "last_value", F.col("n").alias("m"))
        got = got.join(old, "repo_id", "full_outer").select(
            "repo_id", F.coalesce("held", "last_value").alias("held"), "head", F.coalesce("now", "last_value").alias("now"),
            (F.coalesce("n", F.lit(0)) + F.coalesce("m", F.lit(0))).alias("n"),
        )
    base = F.coalesce("held", "head")
    change = 100.0 * (F.col("now") - base) / F.nullif(base, F.lit(0))
    return got.select("repo_id", F.when(F.col("n") >= 2, change).alias("trend_30d"))


def carry_forward(repos: DataFrame, collected: DataFrame, prior_summary: DataFrame) -> DataFrame:
    """Descriptive attributes of every repository: those collected now, else those of the first prior summary row."""
    new = conform(collected, ATTRIBUTES).withColumn("full_history", F.lit(True))
    names = [c for c in new.columns if c not in ("repo_id", "full_history")]
    old = prior_summary.join(collected.select("repo_id"), "repo_id", "left_anti")
    first = F.min_by(F.struct(*[F.col(c) if c in old.columns else F.lit(None).alias(c) for c in names]), F.struct("package", "origin"))
    old = conform(old.groupBy("repo_id").agg(first.alias("f")).select("repo_id", "f.*"), ATTRIBUTES).withColumn("full_history", F.lit(False))
    return repos.select("repo_id").distinct().join(new.unionByName(old), "repo_id", "left")


def summary(
    repo_packages: DataFrame,
    latest: DataFrame,
    series: DataFrame,
    attributes: DataFrame,
    repos: DataFrame,
    rollups: DataFrame,
    today: str,
    full_history: bool = False,
    closing: DataFrame | None = None,
) -> DataFrame:
    """One row for each (package, origin) with what is known of its repository.

    With ``closing`` (see trend) the series holds rows from first_year() on only; the cadence needs the full history.

    Release facts: the last date is the later of the series' and the carried one; the cadence is
    computed from the series only if that holds the full history, else carried. Dates at which the
    number of releases changed count as releases. Empty inputs give a typed empty table.
    """
    wide = latest.groupBy("repo_id").pivot("metric", SUMMARY_METRICS).agg(F.first("value"))
    changes = series.filter("metric = 'releases_total'").select("repo_id", "date")
    if full_history and closing is not None:
        raise ValueError("the cadence of releases needs the full history, not a closing table")
    if closing is None:
        facts = release_facts(changes).toDF("repo_id", "__last", "__cadence")
    else:
        old = closing.filter("metric = 'releases_total'").select("repo_id", F.col("last_date").alias("date"))
        facts = changes.union(old).groupBy("repo_id").agg(F.substring(F.max("date"), 1, 10).alias("__last"))
    dims = repos.select("repo_id", "first_seen", "last_seen")
    links = repo_packages.groupBy("package", "origin").agg(F.min("repo_id").alias("repo_id"))
    rows = links.join(wide, "repo_id", "left").join(trend(series, today, closing=closing), "repo_id", "left")
    rows = rows.join(conform(attributes, ATTRIBUTES).drop("full_history"), "repo_id", "left").join(facts, "repo_id", "left")
    rows = rows.join(conform(rollups, ROLLUPS), "repo_id", "left").join(dims, "repo_id", "left")
    cadence = F.col("__cadence") if full_history else F.col("median_days_between_releases")
    return rows.select(
        "package", "origin", "repo_id", *[F.col(m).cast("long").alias(m) for m in SUMMARY_METRICS],
        "last_commit_date", "license", "topics", "is_archived", "trend_30d", merge_ratio(F.col("prs_merged"), F.col("prs_closed")).alias("pr_merge_ratio"),
        F.greatest("__last", "last_release_date").alias("last_release_date"), cadence.cast("long").alias("median_days_between_releases"),
        "tools_detected", "first_tool", "first_date", "tool_count", "tools", "latest_tool", "latest_date", "first_seen", "last_seen",
    )


def contributor_totals(commits: DataFrame) -> DataFrame:
    """(repo_id, contributors_total): distinct authors of each repository's commits."""
    return commits.groupBy("repo_id").agg(F.count_distinct("author").alias("contributors_total"))


def top_packages(summary_rows: DataFrame, n: int = 20) -> DataFrame:
    """The n packages with the most stars, ties by name; packages without a number come last."""
    order = [F.desc_nulls_last("stars"), "package", "origin"]
    return summary_rows.select("package", "origin", "repo_id", "stars", "forks", "issues_open", "trend_30d").orderBy(*order).limit(n)
