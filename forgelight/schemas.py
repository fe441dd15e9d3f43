"""Declared schemas of the tables that the library reads and writes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

PACKAGE_INPUT = "package string, origin string, url_raw string, bugreports_raw string, ord long"
REPOS = (
    "repo_id string, node_id string, host string, host_domain string, owner string, name string, name_with_owner string,"
    " supported int, n_packages long, first_seen string, last_seen string, status string"
)
REPO_PACKAGES = "repo_id string, package string, origin string, resolved_from string"
SERIES = "repo_id string, date string, metric string, value long"
#: What is known of each (repo_id, metric) at the end of a year, of all rows up to then.
CLOSING = "repo_id string, metric string, last_date string, last_value long, n long"
LATEST = "repo_id string, metric string, value long"
ITEMS = "repo_id string, metric string, created string, closed string"
ATTRIBUTES = (
    "repo_id string, license string, topics string, is_archived int, last_commit_date string,"
    " last_release_date string, median_days_between_releases long"
)
ADOPTION = (
    "repo_id string, tool string, first_seen_date string, first_seen_censored int, evidence_tiers array<string>,"
    " markers array<string>, authored int, authored_commits long, assisted_commits long, last_confirmed_date string"
)
MODELS = (
    "repo_id string, tool string, provider string, family string, version string, context_window string,"
    " commits long, first_seen string, last_seen string, window_complete int"
)
EVIDENCE = "repo_id string, tool string, tier string, marker string, agnostic boolean"
ONSETS = "repo_id string, tool string, marker string, first_seen_date string, first_seen_censored int"
ROLLUPS = (
    "repo_id string, tools_detected boolean, first_tool string, first_date string, tool_count int, tools string,"
    " latest_tool string, latest_date string"
)
STATE = "key string, value string"

#: Keys that the published tables must be unique on.
KEYS = {
    "repos": ["repo_id"],
    "repo_packages": ["repo_id", "package", "origin"],
    "series": ["repo_id", "date", "metric"],
    "latest": ["repo_id", "metric"],
    "summary": ["package", "origin"],
    "adoption": ["repo_id", "tool"],
    "models": ["repo_id", "tool", "provider", "family", "version", "context_window"],
    "tooling": ["repo_id"],
    "rule_inventory": ["tier", "tool"],
    "silent_channels": ["tier", "tool"],
}


def empty(spark: SparkSession, schema: str) -> DataFrame:
    """A typed table without rows."""
    return spark.createDataFrame([], schema)


def conform(df: DataFrame, schema: str) -> DataFrame:
    """The declared columns in order: ones that df lacks are null, others of df come after them."""
    declared = StructType.fromDDL(schema)
    own = [(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in declared]
    return df.select(*own, *[c for c in df.columns if c not in declared.names])
