"""Registered queries over onsets and models, carried attributes, gates, publishing, files and the stream, with their SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import rules, schemas
from ..operators import adoption, health, quality, resolve, series
from ..schemas import ADOPTION, conform, empty
from ..scratch import new_path, settle
from ..sources import ingest, publish
from ..streaming import gauge_stream
from . import inputs, jobs
from .inputs import derive
from .registry import CUMULATIVE, FORKS, RESOLVED_SQL, SUMMARY_ITEMS, SUMMARY_SQL, TALLY, TODAY, _summary, _text, query

# ---- onsets and models ----

#: Dates of markers, some of ignore files' tokens and exact or not; of commits, by channel, confirmed or not; of pull requests.
MARKED = f"select distinct repo_id, tool, tier, case when tier = 'D' and tool = 'view' then 'gitignore:' || marker else marker end as marker, agnostic from ({inputs.EVIDENCE})"
MARKER_DATES = "select cast(user_id as string) as repo_id, case when event_type = 'view' then 'gitignore:m' else 'm' end || cast(event_id % 3 as string) as marker, cast(cast(ts as date) as string) || 'T00:00:00Z' as onset, event_id % 2 = 0 as exact from events"
COMMIT_ONSETS = "select cast(user_id as string) as repo_id, event_type as tool, case cast(event_id % 4 as int) when 0 then 'A' when 1 then 'B' else 'C' end as tier, cast(cast(ts as date) as string) || 'T00:00:00Z' as onset, event_id % 3 <> 0 as confirmed from events where event_type <> 'click'"
PR_DATES = "select cast(user_id as string) as repo_id, cast(min(cast(ts as date)) as string) || 'T09:00:00Z' as pr_date from events where event_type = 'signup' group by user_id"

ONSETS_SQL = f"""
with e as ({MARKED}), md as (select repo_id, marker, min(onset) as d, bool_or(exact) as exact from ({MARKER_DATES}) group by 1, 2),
cd as (select repo_id, tool, tier, onset, confirmed, row_number() over (partition by repo_id, tool, tier order by onset, not confirmed) as n from ({COMMIT_ONSETS})),
p as ({PR_DATES}),
o as (select e.repo_id, e.tool, e.marker, e.tier, case when e.tier = 'D' then md.d when e.tier = 'PR' then p.pr_date else cd.onset end as first_seen_date,
    cast(case when e.tier = 'D' then e.marker[:10] = 'gitignore:' and not coalesce(md.exact, false) when e.tier = 'PR' then false else cd.onset is not null and not cd.confirmed end as int) as first_seen_censored
  from e left join md on md.repo_id = e.repo_id and md.marker = e.marker left join cd on cd.repo_id = e.repo_id and cd.tool = e.tool and cd.tier = e.tier and cd.n = 1 left join p on p.repo_id = e.repo_id),
onsets as (select repo_id, tool, marker, first_seen_date, first_seen_censored from (select *, row_number() over (partition by repo_id, tool, marker order by tier) as n from o) where n = 1)
"""


def _onsets(spark, d):
    own = [derive(spark, d, sql) for sql in (MARKED, MARKER_DATES, COMMIT_ONSETS, PR_DATES)]
    return own[0], adoption.onset_map(*own)


@query(ONSETS_SQL + "select * from onsets")
def onset_map(spark, d):
    return _onsets(spark, d)[1]


@query(
    ONSETS_SQL
    + f""", f as ({FORKS}), g as (select e.*, o.first_seen_date as day, greatest(coalesce(o.first_seen_censored, 0), cast(e.tier = 'D' and coalesce(f.is_fork, false) as int)) as cens
  from e left join onsets o on o.repo_id = e.repo_id and o.tool = e.tool and o.marker = e.marker left join f on f.repo_id = e.repo_id),
h as (select repo_id, tool, min(day) filter (cens = 0) as x, min(day) filter (cens = 1) as l, array_to_string(list_sort(list_distinct(list(tier))), ',') as evidence_tiers, array_to_string(list_sort(list_distinct(list(marker))), ',') as markers, bool_or(tier = 'A') as a from g group by 1, 2)
select repo_id, tool, case when x is null or x > l then l else x end as first_seen_date, cast(l is not null and (x is null or x > l) as int) as first_seen_censored, evidence_tiers, markers, cast(a as int) as authored,
  cast(null as bigint) as authored_commits, cast(null as bigint) as assisted_commits, '{TODAY}' as last_confirmed_date, coalesce(x > l, false) as contradiction from h"""
)
def adoption_detail(spark, d):
    evidence, onsets = _onsets(spark, d)
    guarded = adoption.fork_guard(evidence, derive(spark, d, FORKS), empty(spark, "repo_id string, marker string"))
    return _text(adoption.detail(guarded, onsets, TODAY))


@query(f"with t as ({TALLY}), p as (select * replace (commits * 10 as commits, 0 as window_complete) from t where cast(repo_id as int) % 3 <> 1), n as (select * from t where cast(repo_id as int) % 2 = 0) select * from n union all select * from p where repo_id not in (select repo_id from n)")
def replace_models(spark, d):
    commits = derive(spark, d, inputs.COMMITS).withColumn("tool", F.explode(adoption.trailer_tools(F.col("message")))).withColumnRenamed("committed_at", "date")
    t = settle(adoption.model_tally(commits), "tally")
    prior = t.filter("cast(repo_id as int) % 3 <> 1").withColumns({"commits": F.col("commits") * 10, "window_complete": F.lit(0)})
    return adoption.replace_models(prior, t.filter("cast(repo_id as int) % 2 = 0"))


#: Searches for two accounts of a tool in each customer's repository, with trailers for every third: refused, none, a hit and one whose count did not come.
ASKED = """
select cast(c_custkey as string) as repo_id, 'devin' as tool, 'A' as tier, case cast((c_custkey + 3 * i) % 5 as int) when 0 then 'refused' when 1 then 'none' else 'hit' end as state,
  case cast((c_custkey + 3 * i) % 5 as int) when 1 then 0 when 2 then c_custkey % 90 + i when 3 then c_custkey % 7 + 1 end as n,
  case when (c_custkey + 3 * i) % 5 >= 2 then '2024-0' || cast(i + 1 + c_custkey % 8 as string) || '-01T00:00:00Z' end as date
from customer, (select 0 as i union all select 1) v
"""
#: Repositories of which commits were delivered, and what is in them.
DELIVERED = "select cast(c_custkey as string) as repo_id from customer where c_custkey % 3 = 0"
AUTHORED = "select cast(c_custkey as string) as repo_id, 'x' as message, 'devin-ai-integration[bot]' as author_email, cast(null as string) as author_login from customer, (select 1 as j union all select 2) w where c_custkey % 6 = 0"


@query(
    f"""
with s as (select repo_id, tool, max(n) as n, min(date) as onset from ({ASKED}) where state <> 'refused' group by 1, 2), q as (select distinct repo_id, tool from ({ASKED}) union select distinct repo_id, 'aider' from ({ASKED})),
a as (select repo_id, count(*) as own from ({AUTHORED}) group by 1)
select q.repo_id, q.tool, s.onset, case when s.repo_id is not null then coalesce(s.n, case when s.onset is not null then 1 else 0 end) end as searched,
  case when d.repo_id is not null then case when q.tool = 'devin' then coalesce(a.own, 0) else 0 end end as committed,
  greatest(case when s.repo_id is not null then coalesce(s.n, case when s.onset is not null then 1 else 0 end) end, case when d.repo_id is not null then case when q.tool = 'devin' then coalesce(a.own, 0) else 0 end end) as authored_commits
from q left join s on s.repo_id = q.repo_id and s.tool = q.tool left join ({DELIVERED}) d on d.repo_id = q.repo_id left join a on a.repo_id = q.repo_id
"""
)
def identity_searches(spark, d):
    """Counts by searches for accounts and by commits, with null where neither was answered; a tool that was not searched for has those of commits alone."""
    hits = derive(spark, d, ASKED)
    asked = hits.select("repo_id", "tool").union(hits.select("repo_id", F.lit("aider")))
    counts = adoption.commit_counts(asked, derive(spark, d, AUTHORED), derive(spark, d, DELIVERED)).select("repo_id", "tool", F.col("authored_commits").alias("committed"))
    rows = counts.join(adoption.identity_searches(hits), ["repo_id", "tool"], "left")
    return rows.withColumn("authored_commits", F.greatest("searched", "committed"))


#: Pages of trailer searches: k % 4 + 1 commits on a page, of a total that is larger for every third repository, null for every fifth.
PAGES_SQL = "select cast(c_custkey as varchar) as repo_id, i, c_custkey % 3 = 0 and c_custkey % 5 <> 0 as cut, c_custkey as k from customer, (values (0), (1), (2), (3)) v(i) where i <= c_custkey % 4"


@query(f"select repo_id, 'aider' as tool, 'acme' as provider, 'm' || i % 2 as family, cast(null as varchar) as version, cast(null as varchar) as context_window, count(*) as commits, min('2024-01-0' || (i + 1) || 'T00:00:00Z') as first_seen, max('2024-01-0' || (i + 1) || 'T00:00:00Z') as last_seen, cast(not bool_or(cut) as int) as window_complete from ({PAGES_SQL}) group by repo_id, i % 2")
def model_windows(spark, d):
    """Models named on the pages of searches, and whether the page holds all that the search counted."""
    item = """concat('{"commit":{"message":"x\\\\nCo-authored-by: aider (acme/m', i % 2, ') <aider@aider.chat>","author":{"name":"A"},"committer":{"date":"2024-01-0', i + 1, 'T00:00:00Z"}}}')"""
    total = "case when k % 5 = 0 then '' when k % 3 = 0 then concat('\"total_count\":', k % 4 + 2, ',') else concat('\"total_count\":', k % 4 + 1, ',') end"
    body = f"""concat('{{', {total}, '"items":[', concat_ws(',', transform(sequence(0L, k % 4), i -> {item})), ']}}')"""
    raw = derive(spark, d, "select c_custkey as k, cast(c_custkey as string) as repo_id, 'aider' as tool, 'B' as tier from customer").withColumn("body", F.expr(body))
    return adoption.model_tally(adoption.search_messages(adoption.verify_hits(ingest.search_hits(raw))))


#: Markers of which brands are tools, some of them ambient.
RULES = "select distinct p_type as entry, lower(p_brand) as tool, 'root' as location, false as agnostic, p_size % 5 = 0 as ambient from part"
FIXED_RULES = sorted({("A", t) for t in rules.BOTS.values()} | {("B", r[0]) for r in [*rules.CO_AUTHORS, *rules.SIGNATURES]} | {("C", r[0]) for r in rules.AUTHOR_SUFFIXES} | {("PR", t) for t in rules.PR_AGENTS.values()})


@query(f"select tier, tool, 'v9' as ruleset_version from (select 'D' as tier, tool from ({RULES}) where not ambient union (values {', '.join(map(str, FIXED_RULES))}))")
def rule_inventory(spark, d):
    return adoption.rule_inventory(derive(spark, d, RULES), "v9")


# ---- carried values ----

COLLECTED = "select cast(c_custkey as string) as repo_id, 'MIT' as license, cast(c_custkey % 2 as int) as is_archived, '2024-02-01' as last_commit_date from customer where c_custkey % 3 = 0"
PRIOR_SUMMARY = "select 'p' || cast(c_custkey as string) as package, 'cran' as origin, cast(c_custkey % 700 as string) as repo_id, 'GPL-' || cast(c_custkey % 4 as string) as license, 't' || cast(c_nationkey as string) as topics, cast(c_custkey % 5 as int) as is_archived from customer where c_custkey % 4 <> 0"


@query(
    f"""
with c as ({COLLECTED}), s as (select *, row_number() over (partition by repo_id order by package, origin) as n from ({PRIOR_SUMMARY}))
select r.repo_id, coalesce(c.license, s.license) as license, s.topics, coalesce(c.is_archived, s.is_archived) as is_archived, c.last_commit_date, cast(null as varchar) as last_release_date, cast(null as bigint) as median_days_between_releases,
  case when c.repo_id is not null then true when s.repo_id is not null then false end as full_history
from (select cast(c_custkey as varchar) as repo_id from customer) r left join c on c.repo_id = r.repo_id left join s on s.repo_id = r.repo_id and s.n = 1 and c.repo_id is null
"""
)
def carry_forward(spark, d):
    return health.carry_forward(derive(spark, d, "select cast(c_custkey as string) as repo_id from customer"), derive(spark, d, COLLECTED), derive(spark, d, PRIOR_SUMMARY))


@query("select 'go_live' as key, coalesce((select cast(min(cast(ts as date)) as varchar) from events), '2024-02-14') as value union all select 'seen_' || event_type, cast(max(cast(ts as date)) as varchar) from events group by 1")
def go_live(spark, d):
    """The mark is set by the first run and stays when a later one sets it again."""
    first = derive(spark, d, "select cast(min(cast(ts as date)) as string) as day from events").first()[0]
    state = derive(spark, d, "select 'seen_' || event_type as key, cast(max(cast(ts as date)) as string) as value from events group by event_type")
    return series.go_live(series.go_live(state, first or TODAY), TODAY)


@query(f"select repo_id, metric, value from ({inputs.BEFORE})")
def daily_floor(spark, d):
    """A run that measures no repository: all current values stay."""
    prev = {"repos": empty(spark, schemas.REPOS), "latest": derive(spark, d, inputs.BEFORE), "series": empty(spark, schemas.SERIES), "adoption": empty(spark, ADOPTION), "state": empty(spark, schemas.STATE), "summary": empty(spark, "package string, origin string, repo_id string")}
    gauges = derive(spark, d, inputs.WIDE).withColumn("last_release_at", F.lit(None).cast("string"))
    return jobs.daily_update(derive(spark, d, inputs.PACKAGES), gauges, prev, TODAY)["latest"]


# ---- gates ----


@query(RESOLVED_SQL + "select count(distinct package || ' ' || origin) as packages, count(distinct lower(h[2] || '/' || h[3] || '/' || h[4])) as repos, 'packages fell from ' || cast(2 * count(distinct package || ' ' || origin) as varchar) || ' to ' || count(distinct package || ' ' || origin) as refused from res")
def universe_gate(spark, d):
    """The counts that the gate lets through, and what it says where the build before had twice the packages."""
    n, m = quality.universe(resolve.resolve_packages(derive(spark, d, inputs.PACKAGES)))
    quality.universe_guard(n, m, n, m)
    try:
        quality.universe_guard(n, m, 2 * n, m)
        said = None
    except quality.GateError as e:
        said = str(e)
    return spark.createDataFrame([(n, m, said)], "packages long, repos long, refused string")


def _print_sql(columns: list[str], source: str) -> str:
    text = ", ".join(f"coalesce(cast({c} as varchar), '\\N')" for c in sorted(columns))
    return f"select count(*) as n, coalesce(cast(sum(cast('0x' || md5(concat_ws('|', {text}))[:8] as bigint)) as bigint), 0) as f from {source}"


@query(
    f"with o as ({_print_sql(['o_orderkey', 'o_custkey', 'o_orderstatus', 'year'], f'({inputs.BUILD_1})')}), e as ({_print_sql(['repo_id', 'metric', 'value'], f'({inputs.BEFORE})')}) "
    "select 'orders' as \"table\", n as rows, f as fingerprint, true as present from o union all select 'latest', n, f, true from e union all select 'nothing', 0, 0, true union all select 'models', null, null, false"
)
def table_integrity(spark, d):
    tables = {"orders": derive(spark, d, inputs.BUILD_1), "latest": derive(spark, d, inputs.BEFORE), "nothing": derive(spark, d, inputs.BUILD_1).limit(0), "undeclared": derive(spark, d, inputs.BUILD_1)}
    return quality.integrity(tables, ["orders", "latest", "nothing", "models"])


# ---- publishing ----

#: Published first, folded over, and purged: a series of several years.
PUBLISHED_1 = "select cast(o_custkey as string) as repo_id, cast(cast(o_orderdate as date) as string) as date, case when o_orderstatus = 'P' then 'prs_open' when cast(o_orderdate as date) < date '1996-01-01' then 'forks' else 'stars' end as metric, max(o_orderkey) as value from orders group by 1, 2, 3"
PUBLISHED_2 = f"select repo_id, date, metric, value + 1 as value from ({PUBLISHED_1}) where metric = 'stars' and date >= '2000-01-01' and cast(repo_id as int) % 2 = 0"


def _build(spark, d):
    own = {t: empty(spark, "x string") for t in publish.DECLARED}
    own |= {"repos": conform(derive(spark, d, inputs.OLD_REPOS), schemas.REPOS), "latest": derive(spark, d, inputs.BEFORE), "rule_inventory": derive(spark, d, "select 'A' as tier, event_type as tool from events group by event_type")}
    of = {"repo_packages": schemas.REPO_PACKAGES, "adoption": ADOPTION, "models": schemas.MODELS, "state": schemas.STATE, "silent_channels": "tier string, tool string", "tooling": "repo_id string"}
    own |= {t: empty(spark, s) for t, s in of.items()}
    return own | {"summary": derive(spark, d, "select 'p' || cast(c_custkey as string) as package, 'cran' as origin, c_custkey % 9 as stars from customer")}


def _published(spark, d) -> str:
    """Two publications in a new folder: the second folds a working series, changes the summary and purges a metric that was all of a year."""
    root, one = new_path(spark, "published"), _build(spark, d)
    publish.publish(spark, root, "g1", one, derive(spark, d, PUBLISHED_1), "2001-08-01")
    two = one | {"summary": one["summary"].withColumn("stars", F.col("stars") + 1)}
    publish.publish(spark, root, "g2", two, derive(spark, d, PUBLISHED_2), "2001-08-02", purged=["forks"])
    return root


FOLDED = f"(select a.repo_id, a.date, a.metric, coalesce(b.value, a.value) as value from ({PUBLISHED_1}) a left join ({PUBLISHED_2}) b on a.repo_id = b.repo_id and a.date = b.date and a.metric = b.metric where a.metric <> 'forks')"


@query(f"select * from {FOLDED}")
def publish_fold(spark, d):
    return publish.read_series(spark, _published(spark, d))


@query(f"select * from {FOLDED} where date >= cast(date '2001-08-02' - 400 as varchar)")
def publish_recent(spark, d):
    return publish.read_table(spark, _published(spark, d), "recent")


@query(
    f"""
with y as (select distinct date[:4] as year from ({PUBLISHED_1})), c as (select distinct date[:4] as year from ({PUBLISHED_2}) union select distinct date[:4] from ({PUBLISHED_1}) where metric = 'forks')
select y.year, y.year in (select date[:4] from {FOLDED}) as has_rows, y.year in (select year from c) as changed, (select count(*) from {FOLDED} f where f.date[:4] = y.year) as rows, 'g2' as generation, 'g1' as previous, 'summary' as changed_tables, 'g1' as summary_previous from y
"""
)
def publish_manifest(spark, d):
    """A row for each year that the manifest of the second publication knows."""
    m = publish.manifest(spark, root := _published(spark, d))
    assert publish.read_table(spark, root, "summary", m["summary_previous"]).count() == m["tables"]["summary"][0]
    rows = [(str(y), str(y) in m["paths"], str(y) in m["changed_years"], int(m["series"].get(str(y), "0:0").split(":")[0]), m["generation"], m["previous"], ",".join(m["changed_tables"]), m["summary_previous"]) for y in m["years"]]
    return spark.createDataFrame(rows, "year string, has_rows boolean, changed boolean, rows long, generation string, previous string, changed_tables string, summary_previous string")


def _overlap(spark, d) -> tuple[str, list]:
    """Two runs over one state: even repositories are published while the run of the odd ones is under way. That one is refused, then built anew."""
    root, one, said = new_path(spark, "overlap"), _build(spark, d), []
    publish.publish(spark, root, "g1", one, derive(spark, d, PUBLISHED_1), "2001-08-01")
    more = derive(spark, d, PUBLISHED_1).withColumn("value", F.col("value") * 2)
    even, odd = more.filter("cast(repo_id as int) % 2 = 0"), more.filter("cast(repo_id as int) % 2 <> 0")

    def build(turn):
        said.append(turn.generation)
        if len(said) == 1:
            publish.publish(spark, root, "even", one, even, "2001-08-02")
        return one, odd

    publish.publish_again(spark, root, "odd", build, "2001-08-02")
    return root, said


@query(f"select repo_id, date, metric, value * 2 as value from ({PUBLISHED_1})")
def publish_overlap(spark, d):
    """The series after both runs: no row of either is lost."""
    root, said = _overlap(spark, d)
    assert said == ["g1", "even"] and publish.current(spark, root) == "odd"
    return publish.read_series(spark, root)


@query(SUMMARY_SQL + "select * from summary")
def package_summary_asof(spark, d):
    """The summary from published history of several years, by the closing table and the rows of the last years: files of others are not opened."""
    s = series.cumulative_series(derive(spark, d, SUMMARY_ITEMS))
    root = new_path(spark, "asof")
    publish.publish(spark, root, "g1", _build(spark, d), s, TODAY)
    state = publish.read_state(spark, root, TODAY)
    assert all(int(f.split("year=")[1][:4]) >= 2024 for f in state["series"].inputFiles())
    return _summary(spark, d, state["series"], closing=state["closing"])


_ROWS = {"summary": "customer", "repos": f"({inputs.OLD_REPOS})", "latest": f"({inputs.BEFORE})", "rule_inventory": "(select distinct event_type from events)"}


@query(" union all ".join([f"select '{t}' as \"table\", (select count(*) from {_ROWS[t]}) as rows" if t in _ROWS else f"select '{t}', 0" for t in publish.DECLARED]))
def published_tables(spark, d):
    """Every declared table, read back by name from the generation that is published, and counted."""
    root = new_path(spark, "published")
    publish.publish(spark, root, "g1", _build(spark, d), derive(spark, d, PUBLISHED_1), "2001-08-01")
    counts = [publish.read_table(spark, root, t).agg(F.count("*").alias("rows")).select(F.lit(t).alias("table"), "rows") for t in publish.DECLARED]
    return reduce(DataFrame.union, counts)


@query(f"select repo_id, date, metric, value, false as first_run, 'holds data but no pointer' as refused from ({PUBLISHED_1})")
def history_guard(spark, d):
    """A root whose pointers are lost: a run on it is refused, and all its history is there when they are back."""
    root, one = new_path(spark, "guarded"), _build(spark, d)
    first = publish.current(spark, root) is not None
    publish.publish(spark, root, "g1", one, derive(spark, d, PUBLISHED_1), "2001-08-01")
    fs, pointers = publish._fs(spark, f"{root}/{publish.POINTERS}")
    away = publish._fs(spark, f"{root}/.away")[1]
    fs.rename(pointers, away)
    try:
        publish.publish(spark, root, "g2", one, derive(spark, d, PUBLISHED_2), "2001-08-02")
        said = None
    except quality.GateError as e:
        said = "holds data but no pointer" if "holds" in str(e) and "no pointer" in str(e) else str(e)
    fs.rename(away, pointers)
    return publish.read_series(spark, root).withColumns({"first_run": F.lit(first), "refused": F.lit(said)})


# ---- files ----

STANZAS = "select p_partkey as k, 'pkg' || cast(p_partkey % 1000 as string) as package, p_name, p_size from part"


@query(
    """
with s as (select *, 'pkg' || p_partkey % 1000 as package, p_partkey % 3 as part from part), r as (select *, row_number() over (partition by package order by part, p_partkey) as n from s)
select package, 'bioc' as origin, case when p_size % 4 <> 0 then 'https://a.org/' || p_partkey || ', https://b.org/' || p_size end as url_raw, case when p_size % 3 = 0 then 'https://bugs.org/' || p_partkey end as bugreports_raw from r where n = 1
"""
)
def stanza_packages(spark, d):
    """Three folders of one name, the files of one of them with CRLF, whose packages overlap; each is written in the order of its keys."""
    root, paths = new_path(spark, "stanzas"), []
    text = """concat('Package: ', package, '\\n', case when p_size % 4 <> 0 then concat('URL: https://a.org/', k, ',\\n    https://b.org/', p_size, '\\n') else '' end, 'Title: ', p_name, '\\n', case when p_size % 3 = 0 then concat('BugReports: https://bugs.org/', k, '\\n') else '' end)"""
    for i in range(3):
        rows = derive(spark, d, STANZAS).filter(f"k % 3 = {i}").select("k", F.expr(text).alias("value"))
        end = "\r\n" if i == 1 else "\n"
        value = F.regexp_replace(F.rtrim("value"), "\n", end)
        paths.append(f"{root}/{i}/VIEWS")
        rows.orderBy("k").select(value.alias("value")).write.option("lineSep", end + end).text(paths[-1])
    return ingest.stanzas(spark, paths, "bioc").drop("ord")


@query("select p_size % 5 = 4 as broken, case when p_size % 5 = 4 then 'no stanza' end as refused, case when p_size % 5 <> 4 then 'pkg' || p_partkey end as package from part where p_size % 5 <> 4 union select true, 'no stanza', null from part where p_size % 5 = 4")
def stanza_refusal(spark, d):
    """Parts in five sources by size; what one of them sends are pages without a stanza. All together are refused, the others are read."""
    root = new_path(spark, "refused")
    parts = derive(spark, d, "select p_size % 5 as of, p_size % 5 = 4 as broken, p_partkey, p_name from part")
    line = F.when(F.col("broken"), F.concat(F.lit("<p>Package sorry, "), "p_name", F.lit("</p>"))).otherwise(F.concat(F.lit("Package: pkg"), F.col("p_partkey"), F.lit("\nTitle: "), F.col("p_name")))
    for i in range(5):
        parts.filter(F.col("of") == i).select(line.alias("value")).write.option("lineSep", "\n\n").text(f"{root}/{i}")
    try:
        ingest.stanzas(spark, [f"{root}/{i}" for i in range(5)], "bioc")
        said = None
    except ValueError as e:
        said = "no stanza" if str(e) == f"no stanza in {[f'{root}/4']}" else str(e)
    read = ingest.stanzas(spark, [f"{root}/{i}" for i in range(4)], "bioc")
    broken = parts.filter("broken").select("broken", F.lit(said).alias("refused"), F.lit(None).cast("string").alias("package")).distinct()
    return read.select(F.lit(False).alias("broken"), F.lit(None).cast("string").alias("refused"), "package").union(broken)


@query(SUMMARY_SQL + "select * from summary where package is null")
def empty_summary(spark, d):
    """No package: a summary without rows, typed as any other."""
    none = _summary(spark, d, links=lambda rows: rows.filter("package is null"))
    assert none.dtypes == _summary(spark, d).dtypes
    return none


@query("select cast(s_suppkey as varchar) as repo_id, 'stars' as metric, cast(s_nationkey as bigint) as value from supplier")
def read_published(spark, d):
    """A table of an older build, without a column and with narrower types, read back as declared; one that is not there is empty."""
    path = new_path(spark, "earlier")
    derive(spark, d, "select cast(s_suppkey as string) as repo_id, s_nationkey as value, 'stars' as metric from supplier").write.parquet(path)
    return ingest.read_published(spark, path, schemas.LATEST).union(ingest.read_published(spark, f"{path}-none", schemas.LATEST))


# ---- the stream ----

FEED = f"select repo_id, date, metric, value // 3 as value from ({CUMULATIVE})"
FED_SQL = "select repo_id, date, metric, value from (select *, lag(value) over (partition by repo_id, metric order by date) as prev from ({feed})) where prev is null or value <> prev"


def _streamed(spark, d, batches, compact=gauge_stream.COMPACT) -> DataFrame:
    """What a stream makes of batches of a feed that arrive one after the other, with a restart before each; a row without a repository ends it."""
    root, source, checkpoint = (new_path(spark, n) for n in ("stream", "feed", "stream-checkpoint"))
    schema = "repo_id string, metric string, value long, date string"
    end = batches[0].sparkSession.createDataFrame([(None, None, None, "2024-12-31")], schema)
    for i, rows in enumerate([*batches, end]):
        rows.select("repo_id", "metric", F.col("value").cast("long"), "date").write.parquet(f"{source}/{i}")
        feed = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(source)
        gauge_stream.run(feed, root, checkpoint, "2 days", compact).awaitTermination()
    return gauge_stream.read_series(spark, root)


@query(FED_SQL.format(feed=FEED))
def gauge_stream_series(spark, d):
    """The cumulative series as a feed in three batches of days: what changes from day to day stays."""
    feed = settle(series.cumulative_series(derive(spark, d, inputs.ITEMS)).withColumn("value", F.floor(F.col("value") / 3)), "feed")
    return _streamed(spark, d, [feed.filter(days) for days in ("date < '2024-01-10'", "date >= '2024-01-10' and date < '2024-01-20'", "date >= '2024-01-20'")])


@query(FED_SQL.format(feed=FEED))
def gauge_stream_overlap(spark, d):
    """The same feed in batches that overlap in time: each day's values arrive in two of them, those of odd repositories a batch late, the morning's last."""
    feed = settle(series.cumulative_series(derive(spark, d, inputs.ITEMS)).withColumn("value", F.floor(F.col("value") / 3)), "feed")
    day = F.datediff("date", F.lit("2024-01-01"))
    evening = feed.withColumn("batch", day + F.col("repo_id").cast("int") % 2).withColumn("date", F.concat("date", F.lit("T20:00:00Z")))
    morning = feed.withColumns({"value": F.col("value") + 100, "batch": day + 1}).withColumn("date", F.concat("date", F.lit("T06:00:00Z")))
    rows = settle(evening.unionByName(morning), "feed")
    edges = [-1000, 8, 16, 24, 10000]
    return _streamed(spark, d, [rows.filter((F.col("batch") >= a) & (F.col("batch") < b)).drop("batch") for a, b in zip(edges, edges[1:])], compact=2)
