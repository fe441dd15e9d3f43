"""The repository dimension: upserts, lifecycle, identity."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import REPOS, conform
from .adoption import reduce_onsets

ATTRIBUTES = ["host", "host_domain", "owner", "name", "name_with_owner", "supported", "n_packages"]


def upsert_repos(prior: DataFrame, found: DataFrame, today: str) -> DataFrame:
    """Repositories after a run that found some.

    New ones are active from today on. Known ones keep first_seen and node_id, take the new
    attributes, and become active unless they are gone or moved. Those not found are retired,
    unless gone; so a moved one becomes retired.
    """
    old = conform(prior, REPOS).select("repo_id", F.struct("*").alias("o"))
    new = found.select("repo_id", F.struct(*ATTRIBUTES).alias("n"))
    both = old.join(new, "repo_id", "full_outer")
    is_new, is_found = F.col("o").isNull(), F.col("n").isNotNull()
    pick = lambda c: F.when(is_found, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c)
    status = (
        F.when(is_new, "active")
        .when(is_found & F.col("o.status").isin("gone", "moved"), F.col("o.status"))
        .when(is_found, "active")
        .when(F.col("o.status") == "gone", "gone")
        .otherwise("retired")
    )
    rows = both.select(
        "repo_id", F.col("o.node_id").alias("node_id"), *map(pick, ATTRIBUTES), F.coalesce("o.first_seen", F.lit(today)).alias("first_seen"),
        F.when(is_found, F.lit(today)).otherwise(F.col("o.last_seen")).alias("last_seen"), status.alias("status"),
    )
    return conform(rows, REPOS)


def apply_identity(repos: DataFrame, identities: DataFrame) -> DataFrame:
    """Identity results (repo_id, node_id, owner, name, name_with_owner, status) put on the repositories that they list."""
    names = ["node_id", "owner", "name", "name_with_owner", "status"]
    new = identities.groupBy("repo_id").agg(F.min(F.struct(*names)).alias("n"))
    rows = repos.join(new, "repo_id", "left")
    for c in names:
        rows = rows.withColumn(c, F.when(F.col("n").isNotNull(), F.col(f"n.{c}")).otherwise(F.col(c)))
    return rows.select(repos.columns)


def to_identify(repos: DataFrame) -> DataFrame:
    return repos.filter("host = 'github' and node_id is null and status = 'active'")


def to_measure(repos: DataFrame) -> DataFrame:
    return repos.filter("node_id is not null and status = 'active'")


def canonical(repos: DataFrame) -> DataFrame:
    """(repo_id, canonical_id): of repositories with one node_id the active one, then the last seen, then the smallest repo_id."""
    own = repos.filter("node_id is not null")
    best = F.min_by("repo_id", F.struct(F.when(F.col("status") == "active", 0).otherwise(1), -F.unix_date(F.coalesce("last_seen", F.lit("0001-01-01")).cast("date")), "repo_id"))
    ids = own.groupBy("node_id").agg(best.alias("canonical_id"), F.count("*").alias("n")).filter("n > 1")
    return own.join(ids, "node_id").select("repo_id", "canonical_id")


def fold_identity(adoption: DataFrame, repos: DataFrame) -> DataFrame:
    """Adoption rows re-keyed to the canonical repository and reduced over every column."""
    rows = adoption.join(canonical(repos), "repo_id", "left")
    rows = rows.withColumn("repo_id", F.coalesce("canonical_id", "repo_id")).drop("canonical_id")
    return reduce_onsets(rows)


def roster(summary: DataFrame) -> DataFrame:
    """Repositories to rebuild: github ones with stars, forks or releases; owner and name from the slug, most stars."""
    have = summary.filter(F.col("repo_id").startswith("github.com/") & ((F.col("stars") > 0) | (F.col("forks") > 0) | (F.col("releases_total") > 0)))
    return have.groupBy("repo_id").agg(F.max("stars").alias("stars")).select("repo_id", F.split_part("repo_id", F.lit("/"), F.lit(2)).alias("owner"), F.split_part("repo_id", F.lit("/"), F.lit(3)).alias("name"), "stars")


def adoption_roster(repos: DataFrame, identities: DataFrame) -> DataFrame:
    """Active github repositories to scan; where the identity is now another's, the row goes; the same one updates the name."""
    own = repos.filter("host = 'github' and status = 'active'").select("repo_id", "owner", "name", "node_id")
    new = identities.groupBy("repo_id").agg(F.min(F.struct("node_id", "owner", "name")).alias("n"))
    rows = own.join(new, "repo_id", "left").filter("n.node_id is null or node_id is null or n.node_id = node_id")
    same = F.col("n.node_id").isNotNull()
    return rows.select("repo_id", F.when(same, F.col("n.owner")).otherwise(F.col("owner")).alias("owner"), F.when(same, F.col("n.name")).otherwise(F.col("name")).alias("name"), F.coalesce("node_id", "n.node_id").alias("node_id"))


def newest(rows: DataFrame, key: list[str], order: list) -> DataFrame:
    """The first row of each key in this order."""
    return rows.withColumn("__n", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).filter("__n = 1").drop("__n")
