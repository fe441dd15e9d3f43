"""From package metadata to source repositories."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..functions import urls


def first_per_package(packages: DataFrame) -> DataFrame:
    """The first row, by ord, of each (package, origin)."""
    rest = [c for c in packages.columns if c not in ("package", "origin")]
    first = packages.groupBy("package", "origin").agg(F.min_by(F.struct(*rest), "ord").alias("f"))
    return first.select("package", "origin", "f.*")


def resolve_packages(packages: DataFrame) -> DataFrame:
    """The repository of each package: package, origin, ord, host, host_domain, owner, name, resolved_from.

    Candidates are the URLs of both fields that are repositories and no mirrors. One named in both
    fields wins (by order in the URL field), then the first on github, then the first; without any,
    the first pages site. Packages without a hit are left out. Row by row, so nothing is shuffled.
    """
    own = lambda repos: F.filter(repos, lambda r: r.isNotNull() & ~urls.is_mirror(r))
    found = lambda field: own(urls.parse_repos(urls.split_urls(field)))
    pages = lambda field: own(urls.parse_pages(urls.split_urls(field)))
    rows = packages.select("package", "origin", "ord", found(F.col("url_raw")).alias("u"), found(F.col("bugreports_raw")).alias("b"), F.concat(pages(F.col("url_raw")), pages(F.col("bugreports_raw"))).alias("p"))
    bug_slugs = F.transform("b", urls.slug)
    tag = lambda r, t: F.when(r.isNotNull(), F.struct(r["host"].alias("host"), r["host_domain"].alias("host_domain"), r["owner"].alias("owner"), r["name"].alias("name"), F.lit(t).alias("resolved_from")))
    first = lambda x: F.try_element_at(x, F.lit(1))
    github = lambda x: F.filter(x, lambda r: r["host"] == "github")
    both = F.filter("u", lambda r: F.array_contains(bug_slugs, urls.slug(r)))
    u, b = F.col("u"), F.col("b")
    hit = F.coalesce(
        tag(first(both), "both"), tag(first(github(u)), "url"), tag(first(github(b)), "bugreports"), tag(first(u), "url"), tag(first(b), "bugreports"), tag(first(F.col("p")), "pages"),
    )
    # inline drops packages without a hit; a filter would be pushed below and compute it all twice
    return rows.select("package", "origin", "ord", F.inline(F.array_compact(F.array(hit))))


def repo_index(resolved: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(repos, repo_packages): a row for each repository, written as its first package by ord writes it, and the distinct links."""
    rows = resolved.withColumn("repo_id", F.lower(F.concat_ws("/", "host_domain", "owner", "name")))
    first = F.min_by(F.struct("host", "host_domain", "owner", "name"), F.struct("ord", "package", "origin"))
    repos = rows.groupBy("repo_id").agg(first.alias("f"), F.count_distinct("package", "origin").alias("n_packages"))
    repos = repos.select(
        "repo_id", "f.*", F.concat_ws("/", "f.owner", "f.name").alias("name_with_owner"), F.col("f.host").isin(rules.SUPPORTED_HOSTS).cast("int").alias("supported"), "n_packages"
    )
    return repos, rows.select("repo_id", "package", "origin", "resolved_from").distinct()


def classify_candidates(packages: DataFrame) -> DataFrame:
    """package, origin, url, kind (repo, mirror, denied, other) of every URL of both fields."""
    every = F.concat(urls.split_urls(F.col("url_raw")), urls.split_urls(F.col("bugreports_raw")))
    fields = packages.select("package", "origin", every.alias("urls"))
    return fields.select("package", "origin", F.explode(urls.classify(F.col("urls"))).alias("u")).select("package", "origin", "u.*")


def coverage(packages: DataFrame, resolved: DataFrame) -> DataFrame:
    """Report rows (section, key, n, pct): packages and resolved ones by origin, repositories by host, links by how they
    were resolved, and denied and mirror candidates by kind."""
    repos, _ = repo_index(resolved)
    total = packages.groupBy("origin").agg(F.count("*").alias("all"))
    got = resolved.groupBy("origin").agg(F.count("*").alias("got"))
    by = total.join(got, "origin", "left").withColumn("got", F.coalesce("got", F.lit(0)))
    null = F.lit(None).cast("double")
    part = lambda df, section, key, n, pct=null: df.select(F.lit(section).alias("section"), F.col(key).alias("key"), n.cast("long").alias("n"), pct.alias("pct"))
    kinds = classify_candidates(packages).filter("kind in ('denied', 'mirror')").groupBy("kind").count()
    return (
        part(by, "packages", "origin", F.col("all"))
        .union(part(by, "resolved", "origin", F.col("got"), F.round(100.0 * F.col("got") / F.col("all"), 1)))
        .union(part(repos.groupBy("host").count(), "repos", "host", F.col("count")))
        .union(part(resolved.groupBy("resolved_from").count(), "resolved_from", "resolved_from", F.col("count")))
        .union(part(kinds, "candidates", "kind", F.col("count")))
    )
