"""Development tooling: a wide row of 0/1 flags for each repository, generated from the rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rules
from .dimension import newest


def columns(tooling: list[tuple] = rules.TOOLING) -> list[str]:
    """All columns of the table in order; schema, classifier and empty table follow from the rules."""
    return ["repo_id", "last_scanned", *[t[0] for t in tooling], "readme_source", "has_ci"]


def schema(tooling: list[tuple] = rules.TOOLING) -> str:
    kind = lambda c: "string" if c in ("repo_id", "last_scanned", "readme_source") else "int"
    return ", ".join(f"{c} {kind(c)}" for c in columns(tooling))


def _flag(location: str, paths: list[str], how: str) -> Column:
    empty = F.array().cast("array<string>")
    entries = {"root": F.coalesce("root_entries", empty), "github": F.coalesce("github_entries", empty)}
    own = F.concat(entries["root"], entries["github"]) if location == "both" else entries[location]
    if how == "suffix":
        return F.exists(own, lambda e: F.coalesce(*[F.when(e.endswith(p), True) for p in paths], F.lit(False)))
    return F.coalesce(F.arrays_overlap(own, F.array(*map(F.lit, paths))), F.lit(False))


def classify(trees: DataFrame, scanned_on: str, tooling: list[tuple] = rules.TOOLING) -> DataFrame:
    """Flags of each assessed tree (repo_id, root_entries, github_entries, is_fork): one projection, no shuffle.

    A tree whose fork flag is null could not be assessed and gets no row. has_ci is any of the ci
    flags; readme_source is the first of qmd, rmd, md at the root, else none.
    """
    root = F.coalesce("root_entries", F.array().cast("array<string>"))
    readme = F.coalesce(*[F.when(F.array_contains(F.transform(root, F.lower), f"readme.{x}"), x) for x in ("qmd", "rmd", "md")], F.lit("none"))
    flags = [_flag(loc, paths, how).cast("int").alias(c) for c, loc, paths, how in tooling]
    rows = trees.filter("is_fork is not null").select("repo_id", F.lit(scanned_on).alias("last_scanned"), *flags, readme.alias("readme_source"))
    ci = F.greatest(*[F.col(t[0]) for t in tooling if t[0].startswith("ci_")], F.lit(0))
    return rows.withColumn("has_ci", ci).select(columns(tooling))


def merge_snapshots(prior: DataFrame, incoming: DataFrame, tooling: list[tuple] = rules.TOOLING) -> DataFrame:
    """The newest row of each repository, ties to the incoming one. Columns that one side lacks are null, old ones stay at the end."""
    both = incoming.withColumn("__src", F.lit(1)).unionByName(prior.withColumn("__src", F.lit(0)), allowMissingColumns=True)
    order = [F.desc_nulls_last("last_scanned"), F.desc("__src")]
    known = columns(tooling)
    out = newest(both, ["repo_id"], order).drop("__src")
    for c in known:
        if c not in out.columns:
            out = out.withColumn(c, F.lit(None).cast("int"))
    return out.select(*known, *[c for c in out.columns if c not in known])
