"""The jobs that chain the operators. Logical plans only; gates run one-row aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..operators import adoption, dimension, health, quality, resolve, series, tooling
from ..schemas import ADOPTION, ATTRIBUTES, ROLLUPS, conform, empty
from ..scratch import settle
from ..sources import ingest

Tables = dict[str, DataFrame]


def daily_update(packages: DataFrame, gauges: DataFrame, prev: Tables, today: str, identities: DataFrame | None = None) -> Tables:
    """Resolve packages, update the dimension, and fold a day's gauges into series, latest and summary.

    prev: repos, latest, series, summary, adoption and state of the last build. With no measured
    repository nothing is written over: all values stay as they were. If prev has ``closing`` (as
    publish.read_state gives it), its series holds the last years only, and what is read does not grow with the history.
    """
    resolved = settle(resolve.resolve_packages(packages), "resolved")
    repos, links = resolve.repo_index(resolved)
    n_packages, n_repos = quality.universe(resolved)
    known = prev["repos"].filter("status = 'active'")
    before = prev["summary"].agg(F.count_distinct("package", "origin")).first()[0], known.count()
    quality.universe_guard(n_packages, n_repos, *before)
    dim = dimension.upsert_repos(prev["repos"], repos, today)
    if identities is not None:
        dim = dimension.apply_identity(dim, identities)
    ids = dimension.to_measure(dim).select("node_id", "repo_id")
    snapshot = settle(series.to_long(gauges, ids), "snapshot")
    if snapshot.isEmpty():
        return prev | {"repos": dim, "repo_packages": links, "working": prev["series"].limit(0)}
    working = series.change_only(prev["latest"], snapshot, today)
    latest = series.upsert_replace(prev["latest"], snapshot, series.LATEST_KEY)
    whole = series.upsert_replace(prev["series"], working, series.KEY)
    collected = conform(gauges.withColumn("last_release_date", F.substring("last_release_at", 1, 10)).join(ids, "node_id"), ATTRIBUTES).select([c.split()[0] for c in ATTRIBUTES.split(", ")])
    attributes = health.carry_forward(dim, collected, prev["summary"])
    rolled = adoption.rollups(conform(prev["adoption"], ADOPTION))
    return prev | {
        "repos": dim, "repo_packages": links, "latest": latest, "series": whole, "working": working,
        "summary": health.summary(links, latest, whole, attributes, dim, rolled, today, closing=prev.get("closing")), "state": series.go_live(prev["state"], today),
    }


def rebuild_series(items: DataFrame, prior: DataFrame, metrics: list[str] = series.DEFAULT_REBUILT, purged: list[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(series, touched years): series rebuilt from items, under what is already there; purged metrics are dropped first."""
    kept, gone = series.purge(prior, list(purged)) if purged else (prior, None)
    made = series.rebuild(items, metrics)
    years = series.touched_years(made)
    return series.upsert_keep(kept, made, series.KEY), years if gone is None else years.union(gone).distinct()


def weekly_update(snapshot: DataFrame, prev: Tables, today: str) -> Tables:
    """Fold a weekly snapshot of five metrics into series and latest; other metrics are untouched."""
    working, long = series.weekly_delta(prev["latest"], snapshot, today)
    return prev | {"series": series.upsert_replace(prev["series"], working, series.KEY), "latest": series.upsert_replace(prev["latest"], long, series.LATEST_KEY), "working": working}


def _onsets_of(commits: DataFrame) -> DataFrame:
    """(repo_id, tool, tier, onset, confirmed): the first commit by which each channel shows a tool."""
    seen = lambda tool, tier: F.struct(tool.alias("tool"), F.lit(tier).alias("tier"))
    bot = F.coalesce(adoption.bot_tool(F.col("author_email")), adoption.bot_tool(F.col("author_login")))
    trailers = F.transform(adoption.trailer_tools(F.col("message")), lambda t: seen(t, "B"))
    every = F.concat(trailers, F.array(seen(adoption.suffix_tool(F.col("author")), "C"), seen(bot, "A")))
    rows = commits.select("repo_id", "committed_at", F.explode(every).alias("x")).filter("x.tool is not null")
    return rows.groupBy("repo_id", "x.tool", "x.tier").agg(F.min("committed_at").alias("onset")).withColumn("confirmed", F.lit(True))


def adoption_update(
    trees: DataFrame, prs: DataFrame, commits: DataFrame, path_commits: DataFrame, revisions: DataFrame, incomplete: DataFrame,
    prev: Tables, known_silent: DataFrame, today: str, only_flagged: bool = False, searches: DataFrame | None = None, incremental: bool = False,
    delivered: DataFrame | None = None,
) -> Tables:
    """Scan trees, pull requests and commits for tools and fold what is found into adoption, models and tooling.

    ``only_flagged``: read commits only of repositories that trees or pull requests have flagged; the
    default reads all, so that a repository which only signs commits is found. ``searches``: answers
    of commit searches (repo_id, tool, tier, body), for agents' own accounts (A), trailers (B) and suffixes of authors (C);
    those that verify give exact dates, counts and models, others evidence with a floor, refused ones nothing. ``delivered``: repositories (repo_id) whose commits were
    fetched, by default those that have any; of others nothing is counted from commits, not even none. ``incremental``: of flagged
    repositories, scan only those with a tool that is not published for them and that have not been
    confirmed today; of the others, what is published is confirmed. ``canary`` of the result lists
    channels gone silent; publish first, then fail on them.
    """
    spark = trees.sparkSession
    markers = rules.markers(spark)
    published = conform(prev["adoption"], ADOPTION)
    cheap = adoption.assemble(adoption.marker_evidence(trees, markers), adoption.ignore_evidence(trees, markers), adoption.pr_evidence(prs))
    scanned = trees.select("repo_id").unionByName(prs.select("repo_id")).distinct()
    flagged, deferred = adoption.gate(cheap, scanned, trees.filter("is_fork is not null").select("repo_id").unionByName(prs.select("repo_id")))
    own, asked, confirmed = commits, cheap, empty(spark, ADOPTION)
    if incremental:
        todo = adoption.skip_confirmed(adoption.incremental(flagged, cheap, published), published, today).distinct()
        own, asked = commits.join(todo, "repo_id", "left_semi"), cheap.join(todo, "repo_id", "left_semi")
        confirmed = adoption.confirmations(cheap.join(todo, "repo_id", "left_anti"), published, today)
    elif only_flagged:
        own = commits.join(flagged, "repo_id", "left_semi")
    channels = [asked, adoption.bot_evidence(own), adoption.trailer_evidence(own), adoption.suffix_evidence(own)]
    onsets, found = _onsets_of(own), None
    signed = own.select("repo_id", "message", F.col("committed_at").alias("date"), F.lit(True).alias("complete"), F.explode(adoption.trailer_tools(F.col("message"))).alias("tool"))
    if searches is not None:
        # bodies are parsed once for evidence, onsets, counts and models
        found = settle(adoption.verify_hits(ingest.search_hits(searches)), "searches")
        channels.append(adoption.search_evidence(found))
        onsets = onsets.unionByName(adoption.search_onsets(found))
        # a repository whose commits are there is not counted from a page of a search too
        signed = signed.unionByName(adoption.search_messages(found).join(own.select("repo_id").distinct(), "repo_id", "left_anti").select(signed.columns))
    evidence = settle(adoption.assemble(*channels), "evidence")
    by_path = adoption.marker_onset(evidence, path_commits, markers, incomplete).withColumn("exact", F.lit(True))
    dates = by_path.unionByName(adoption.ignore_onset(revisions, markers))
    counts = adoption.commit_counts(evidence, own, own.select("repo_id") if delivered is None else delivered)
    if found is not None:
        counts = counts.join(adoption.search_counts(found), ["repo_id", "tool"], "left").withColumn("assisted_commits", F.coalesce("assisted_commits", "searched")).drop("searched")
        counts = counts.join(adoption.identity_searches(found), ["repo_id", "tool"], "left").withColumn("authored_commits", F.greatest("authored_commits", "searched")).drop("searched", "onset")
    guarded = adoption.fork_guard(evidence, trees.select("repo_id", "is_fork"), empty(spark, "repo_id string, marker string"))
    fresh = adoption.detail(guarded.join(counts, ["repo_id", "tool"], "left"), adoption.onset_map(evidence, dates, onsets, adoption.first_agent_pr(prs)), today)
    reduced = adoption.reduce_onsets(published.unionByName(fresh.drop("contradiction"), allowMissingColumns=True).unionByName(confirmed, allowMissingColumns=True))
    folded = dimension.fold_identity(reduced, prev["repos"])
    inventory = adoption.rule_inventory(markers)
    return prev | {
        "evidence": evidence, "deferred": deferred, "adoption": folded.drop("contradiction"), "contradictions": adoption.contradictions(reduced),
        "models": adoption.replace_models(prev["models"], adoption.model_tally(signed)), "rollups": conform(adoption.rollups(folded), ROLLUPS),
        "tooling": tooling.merge_snapshots(prev["tooling"], tooling.classify(trees, today)), "rule_inventory": inventory,
        "silent_channels": adoption.silent_table(inventory, folded, known_silent, today), "canary": adoption.canary(scanned, inventory, folded, known_silent),
    }
