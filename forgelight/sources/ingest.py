"""Raw responses and metadata files to typed tables. Every reader takes tables of raw rows, not single strings."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..functions.rows import once
from ..operators.resolve import first_per_package
from ..schemas import PACKAGE_INPUT, conform, empty
from ..scratch import settle

TOTAL = "struct<totalCount:long>"
GAUGE = (
    f"struct<data:struct<nodes:array<struct<id:string,nameWithOwner:string,stargazerCount:long,forkCount:long,watchers:{TOTAL},issues_open:{TOTAL},"
    f"issues_closed:{TOTAL},prs_open:{TOTAL},prs_closed:{TOTAL},mergedPRs:{TOTAL},releases:{TOTAL},latestRelease:struct<tagName:string,publishedAt:string,isPrerelease:boolean>,"
    "licenseInfo:struct<spdxId:string>,repositoryTopics:struct<nodes:array<struct<topic:struct<name:string>>>>,isArchived:boolean,isFork:boolean,isMirror:boolean,"
    "isDisabled:boolean,createdAt:string,pushedAt:string,updatedAt:string,diskUsage:long,primaryLanguage:struct<name:string>>>>>"
)
COMMITS = (
    f"struct<data:struct<nodes:array<struct<id:string,nameWithOwner:string,defaultBranchRef:struct<target:struct<history:{TOTAL},"
    "last:struct<nodes:array<struct<committedDate:string>>>>>>>>>"
)
PAGE_INFO = "pageInfo:struct<hasNextPage:boolean,endCursor:string>"
DATED = "struct<starredAt:string,createdAt:string,closedAt:string>"
CONNECTION = f"struct<errors:array<struct<message:string>>,data:struct<node:struct<items:struct<{PAGE_INFO},edges:array<{DATED}>,nodes:array<{DATED}>>>>>"
IDENTITY = "struct<data:map<string,struct<id:string,nameWithOwner:string,isArchived:boolean,isFork:boolean,isMirror:boolean,createdAt:string>>,errors:array<struct<type:string,path:array<string>>>>"
ENTRIES = "struct<entries:array<struct<name:string>>>"
SUBTREES = ["claude", "agents", "inst", "site", "docs"]
SUBTREE_NAMES = {"claude": ".claude", "agents": ".agents", "inst": "inst", "site": "site", "docs": "docs"}
TREE = (
    f"struct<data:map<string,struct<isFork:boolean,parent:struct<nameWithOwner:string>,root:{ENTRIES},github:{ENTRIES},"
    f"{','.join(f'{s}:{ENTRIES}' for s in SUBTREES)},gitignore:struct<text:string>,rbuildignore:struct<text:string>>>>"
)
PRS = f"struct<data:map<string,struct<pullRequests:struct<{PAGE_INFO},nodes:array<struct<createdAt:string,author:struct<login:string,`__typename`:string>>>>>>>"
SEARCH = (
    "struct<total_count:long,message:string,items:array<struct<commit:struct<message:string,author:struct<name:string,date:string>,committer:struct<date:string>>>>,_corrupt_record:string>"
)
HISTORY = "struct<data:struct<node:struct<history:struct<nodes:array<struct<oid:string,committedDate:string,file:struct<text:string>>>>>>>"


def instant(ts: Column, floor: Column | bool = False) -> Column:
    """ISO text of a full instant: a day alone becomes its end if it is a floor, else its start. Null and other text stay."""
    floor = F.lit(floor) if isinstance(floor, bool) else floor
    return F.when(ts.rlike(r"^\d{4}-\d\d-\d\d$"), F.concat(ts, F.when(floor, "T23:59:59Z").otherwise("T00:00:00Z"))).otherwise(ts)


def metadata(table: DataFrame, origin: str) -> DataFrame:
    """Package metadata rows (package, url_raw, bugreports_raw, ord) of one registry: the first row of each package, tagged."""
    return conform(first_per_package(table.withColumn("origin", F.lit(origin))), PACKAGE_INPUT)


#: Lines of one stanza at most: what has more is no file of stanzas.
MAX_LINES = 100_000


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow over (file, start, value), the lines of a task in order: add a line's number in its split and how many empty lines are before it there."""
    split, rows, empty_ = None, 0, 0
    for batch in batches:
        names = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
        blank = pc.equal(pc.utf8_length(pc.utf8_trim(batch.column(2), " \t\r")), 0).to_pylist()
        at, before = [], []
        for name, none in zip(names, blank, strict=True):
            if name != split:
                split, rows, empty_ = name, 0, 0
            at.append(rows)
            before.append(empty_)
            rows, empty_ = rows + 1, empty_ + none
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at, pa.int64()), pa.array(before, pa.int64()), pa.array(blank, pa.bool_())], ["file", "start", "value", "row", "before", "blank"])


def stanzas(spark: SparkSession, paths: list[str], origin: str) -> DataFrame:
    """Packages of files of stanzas, parted by empty lines: the first stanza of each package by file order and place.

    Lines may end with LF or CRLF; continuation lines are joined to theirs; missing fields are null.
    A path may be one file or a folder of files, read in the order of their names; a file's end ends a stanza. A file without any
    stanza that has a Package field, an empty one included, is no such file (an error page, say), and
    reading it fails, as it does for a stanza of over MAX_LINES lines.

    Files are read in splits, by as many tasks as their size asks for. Each split counts its empty lines, the sums over the
    splits before it number its stanzas, and a stanza that goes on in the next split is put together by its number.
    """
    if not paths:
        raise ValueError("no files of stanzas")
    texts = [spark.read.text(path).select("value", F.regexp_replace("_metadata.file_path", "^([^:/]+):/+", "$1:/").alias("name"), F.col("_metadata.file_block_start").alias("start")) for path in paths]
    files = [(i, re.sub("^([^:/]+):/+", r"\1:/", n)) for i, t in enumerate(texts) for n in sorted(t.inputFiles())]
    order = spark.createDataFrame([(i, n, k) for k, (i, n) in enumerate(files)], "path int, name string, file int")
    lines = reduce(DataFrame.union, [t.withColumn("path", F.lit(i)) for i, t in enumerate(texts)]).join(F.broadcast(order), ["path", "name"])
    lines = settle(lines.select("file", "start", "value").mapInArrow(_counted, "file int, start long, value string, row long, before long, blank boolean"), "stanza-lines")
    splits = lines.groupBy("file", "start").agg(F.count_if("blank").alias("n"))
    splits = splits.withColumn("earlier", F.sum("n").over(Window.partitionBy("file").orderBy("start")) - F.col("n")).drop("n")
    lines = lines.filter("not blank").join(F.broadcast(splits), ["file", "start"]).withColumn("stanza", F.col("earlier") + F.col("before"))
    if not lines.groupBy("file", "stanza").count().filter(F.col("count") > MAX_LINES).isEmpty():
        raise ValueError(f"a stanza of more than {MAX_LINES} lines in {paths}")
    whole = lines.groupBy("file", "stanza").agg(F.array_sort(F.collect_list(F.struct("start", "row", "value"))).alias("x"))
    text = whole.select("file", "stanza", F.array_join(F.transform("x", lambda r: r["value"]), "\n").alias("stanza_text"))
    unfolded = F.regexp_replace("stanza_text", r"\n[ \t]+", " ")
    field = lambda name: F.nullif(F.trim(F.regexp_extract(unfolded, rf"(?m)^{name}:[ \t]*(.*)$", 1)), F.lit(""))
    rows = text.select("file", (F.col("file") * F.lit(1 << 40) + F.col("stanza")).alias("ord"), field("Package").alias("package"), field("URL").alias("url_raw"), field("BugReports").alias("bugreports_raw"))
    rows = rows.filter("package is not null")
    good = {files[r["file"]][0] for r in rows.select("file").distinct().collect()}  # as many as files were named
    if bad := [p for i, p in enumerate(paths) if i not in good]:
        raise ValueError(f"no stanza in {bad}")
    return metadata(rows.drop("file"), origin)


#: Schema of a response by kind of reader.
RESPONSES = {"gauges": GAUGE, "commits": COMMITS, "trees": TREE, "pull_requests": PRS, "history": HISTORY}
ERRORS = "errors:array<struct<type:string,path:array<string>>>"


def _parsed(raw: DataFrame, kind: str) -> DataFrame:
    """Responses with ``r``, the body as declared, and ``reason``, why it can't be used; null if it can."""
    schema = f"struct<{ERRORS},_corrupt_record:string,{RESPONSES[kind].removeprefix('struct<')}"
    r = raw.withColumn("r", F.from_json("body", schema, {"mode": "PERMISSIVE"}))
    fault = F.coalesce(F.size("r.errors"), F.lit(0)) > 0
    return r.withColumn(
        "reason",
        F.when(F.col("body").isNull(), "no body").when(F.col("r").isNull() | F.col("r._corrupt_record").isNotNull(), "not as declared")
        .when(fault & ~only_not_found(F.col("r.errors")), "error").when(F.col("r.data").isNull(), "no data"),
    )


def quarantined(raw: DataFrame, kind: str) -> DataFrame:
    """Responses of a kind (see RESPONSES) that can't be used, with their bodies and the ``reason``: to be kept and looked at.

    A body that is null, cut off or otherwise no JSON as declared, one with an error other than not-found of an alias, one without data.
    """
    return _parsed(raw, kind).filter("reason is not null").drop("r")


def _readable(raw: DataFrame, kind: str) -> DataFrame:
    return _parsed(raw, kind).filter("reason is null").drop("body", "reason")


def _not_read(raw: DataFrame, good: DataFrame, kind: str, requests: DataFrame | None) -> DataFrame:
    """(repo_id) of requests (batch, repo_id) whose batch has no response that can be used; without requests, what identifies the responses that can't."""
    if requests is None:
        return quarantined(raw, kind).drop("body", "reason")
    return requests.join(good.select("batch").distinct(), "batch", "left_anti").select("repo_id")


def gauges(raw: DataFrame, requests: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, deferred) of responses (body and, for requests, batch).

    A row for each repository: counters, licence, topics, flags and times; a missing counter is null. Deferred:
    repositories of requests (batch, repo_id) whose response is not there or can't be used (see quarantined); they keep
    what was measured before. Without requests, deferred names the responses themselves by their other columns.
    """
    good = _readable(raw, "gauges")
    n = good.select(F.inline(F.col("r.data.nodes"))).filter("id is not null")
    total = lambda c: F.col(f"{c}.totalCount")
    flag = lambda c: F.col(c).cast("int")
    rows = n.select(
        F.col("id").alias("node_id"), F.col("nameWithOwner").alias("name_with_owner"), F.col("stargazerCount").alias("stars"), F.col("forkCount").alias("forks"),
        total("watchers").alias("watchers"), total("issues_open").alias("issues_open"), total("issues_closed").alias("issues_closed"), total("prs_open").alias("prs_open"),
        total("prs_closed").alias("prs_closed"), total("mergedPRs").alias("prs_merged"), total("releases").alias("releases_total"), F.col("diskUsage").alias("size_kb"),
        F.col("licenseInfo.spdxId").alias("license"), F.nullif(F.array_join(F.transform("repositoryTopics.nodes", lambda t: t["topic"]["name"]), ","), F.lit("")).alias("topics"),
        flag("isArchived").alias("is_archived"), flag("isFork").alias("is_fork"), flag("isMirror").alias("is_mirror"), flag("isDisabled").alias("is_disabled"),
        F.col("createdAt").alias("created_at"), F.col("pushedAt").alias("pushed_at"), F.col("updatedAt").alias("updated_at"), F.col("latestRelease.publishedAt").alias("last_release_at"),
        F.col("latestRelease.tagName").alias("last_release_tag"), F.col("primaryLanguage.name").alias("language"),
    )
    return rows, _not_read(raw, good, "gauges", requests)


def commit_totals(raw: DataFrame, requests: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, deferred) of responses: (node_id, commits_total, last_commit_date), null where there is no default branch; deferred as of gauges()."""
    good = _readable(raw, "commits")
    n = good.select(F.inline(F.col("r.data.nodes"))).filter("id is not null")
    target = "defaultBranchRef.target"
    rows = n.select(F.col("id").alias("node_id"), F.col(f"{target}.history.totalCount").alias("commits_total"), F.try_element_at(F.col(f"{target}.last.nodes"), F.lit(1))["committedDate"].alias("last_commit_date"))
    return rows, _not_read(raw, good, "commits", requests)


def connection_items(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(items, deferred) of paged responses (repo_id, metric, page, body).

    Items are (repo_id, metric, created, closed). A page with an error, without data, or with a next
    page but no cursor voids its whole (repo_id, metric), as does a last page that has a next one:
    these keys are returned as deferred, never as part of a curve.
    """
    p = pages.select("repo_id", "metric", "page", F.from_json("body", CONNECTION).alias("r"))
    info, items = F.col("r.data.node.items.pageInfo"), F.col("r.data.node.items")
    more = F.coalesce(info["hasNextPage"], F.lit(False))
    bad = (F.size(F.coalesce("r.errors", F.array())) > 0) | F.col("r.data.node").isNull() | (more & info["endCursor"].isNull())
    state = p.groupBy("repo_id", "metric").agg(F.bool_or(F.coalesce(bad, F.lit(True))).alias("bad"), F.max_by(more, "page").alias("open"))
    deferred = state.filter("bad or open").select("repo_id", "metric")
    every = F.concat(F.coalesce(items["edges"], F.array().cast(f"array<{DATED}>")), F.coalesce(items["nodes"], F.array().cast(f"array<{DATED}>")))
    rows = p.select("repo_id", "metric", F.explode(every).alias("i")).select("repo_id", "metric", F.coalesce("i.starredAt", "i.createdAt").alias("created"), F.col("i.closedAt").alias("closed"))
    return rows.join(deferred, ["repo_id", "metric"], "left_anti"), deferred


def only_not_found(errors: Column) -> Column:
    """True if there are errors and each is a NOT_FOUND of one alias."""
    return F.coalesce((F.size(errors) > 0) & F.forall(errors, lambda e: F.coalesce((e["type"] == "NOT_FOUND") & (F.size(e["path"]) > 0), F.lit(False))), F.lit(False))


def _answers(responses: DataFrame, requests: DataFrame) -> DataFrame:
    """Every request (batch, alias, repo_id) whose batch is in responses (batch, data), with x, what data has under its alias.

    x is null for a null or missing alias. Rows carry what they asked for alone, never the data of their batch.
    """
    said = responses.select("batch", F.explode("data").alias("alias", "x"))
    return requests.join(responses.select("batch"), "batch", "left_semi").join(said, ["batch", "alias"], "left")


def identities(raw: DataFrame, requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(identities, deferred) of batches: raw (batch, body), requests (batch, alias, repo_id).

    A null alias is a repository that is gone. A batch with any other error than not-found of an
    alias, or without data, is deferred whole.
    """
    r = raw.select("batch", F.from_json("body", IDENTITY).alias("r"))
    usable = F.col("r.data").isNotNull() & (F.coalesce(F.size("r.errors"), F.lit(0)).isin(0, -1) | only_not_found(F.col("r.errors")))
    good = r.filter(usable).select("batch", "r.data")
    rows = _answers(good, requests)
    owner = F.split_part("x.nameWithOwner", F.lit("/"), F.lit(1))
    name = F.split_part("x.nameWithOwner", F.lit("/"), F.lit(2))
    got = rows.select("repo_id", F.col("x.id").alias("node_id"), owner.alias("owner"), name.alias("name"), F.col("x.nameWithOwner").alias("name_with_owner"), F.when(F.col("x").isNull(), "gone").otherwise("active").alias("status"), F.col("x.isFork").cast("int").alias("is_fork"))
    return got, requests.join(good.select("batch"), "batch", "left_anti").select("repo_id")


def trees(raw: DataFrame, requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, deferred) of tree responses (batch, body) to requests (batch, alias, repo_id).

    Rows: (repo_id, root_entries, github_entries, gitignore_lines, rbuildignore_lines, is_fork, parent). Names of subtrees are written below
    them (dir/name); a repository that is gone has no entries and a null fork flag. One whose response can't be used (see
    quarantined) is neither gone nor empty: it has no row and is deferred.
    """
    good = _readable(raw, "trees").select("batch", F.col("r.data").alias("data"))
    rows = _answers(good, requests)
    none = F.array().cast("array<string>")
    names = lambda c, pre="": F.coalesce(F.transform(F.col(f"x.{c}.entries"), lambda e: F.concat(F.lit(pre), e["name"])), none)
    root = F.concat(names("root"), *[names(s, f"{SUBTREE_NAMES[s]}/") for s in SUBTREES])
    lines = lambda c: F.coalesce(F.split(F.col(f"x.{c}.text"), r"\r?\n"), none)
    found = rows.select("repo_id", root.alias("root_entries"), names("github").alias("github_entries"), lines("gitignore").alias("gitignore_lines"), lines("rbuildignore").alias("rbuildignore_lines"), F.col("x.isFork").alias("is_fork"), F.col("x.parent.nameWithOwner").alias("parent"))
    return found, _not_read(raw, good, "trees", requests)


def pull_requests(raw: DataFrame, requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, deferred) of pull-request responses: (repo_id, login, typename, created_at, has_next); deferred as of trees()."""
    good = _readable(raw, "pull_requests").select("batch", F.col("r.data").alias("data"))
    x = _answers(good, requests).select("repo_id", F.col("x.pullRequests").alias("p"))
    rows = x.select("repo_id", F.col("p.pageInfo.hasNextPage").alias("has_next"), F.explode("p.nodes").alias("n"))
    found = rows.select("repo_id", F.col("n.author.login").alias("login"), F.col("n.author.__typename").alias("typename"), F.col("n.createdAt").alias("created_at"), "has_next")
    return found, _not_read(raw, good, "pull_requests", requests)


def search_hits(raw: DataFrame) -> DataFrame:
    """Commit searches (repo_id, tool, tier, body) with their state.

    refused: no JSON object, or a message and no total (count null); none: measured, 0, no commit on the page;
    hit: first message, author and date, all messages of the page, and the total, or how many are on the page where none is
    given. Dates are those of committing; where a response has none, of authorship.

    Responses are dealt out by repository and tool before they are parsed, and each is parsed once.
    """
    tasks = int(raw.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # said, for bodies shuffle small and take long to parse
    r = once(raw.repartition(tasks, "repo_id", "tool"), r=F.from_json("body", SEARCH, {"mode": "PERMISSIVE"}))
    r = once(r, items=F.filter("r.items", lambda i: i["commit"].isNotNull()))
    total, items = F.col("r.total_count"), F.col("items")
    n = F.coalesce(F.size(items), F.lit(0))
    date = lambda c: F.coalesce(c["committer"]["date"], c["author"]["date"])
    first = F.try_element_at(items, F.lit(1))["commit"]
    unread = F.col("body").isNull() | F.col("r").isNull() | F.col("r._corrupt_record").isNotNull()
    state = F.when(unread | (total.isNull() & F.col("r.message").isNotNull()), "refused").when((n <= 0) | (total == 0), "none").otherwise("hit")
    page = F.coalesce(F.transform(items, lambda i: F.struct(i["commit"]["message"].alias("message"), date(i["commit"]).alias("date"))), F.array().cast("array<struct<message:string,date:string>>"))
    count = F.when(F.col("state") == "none", F.lit(0).cast("long")).when(F.col("state") == "hit", F.coalesce(total, n.cast("long")))
    return r.withColumn("state", state).select("repo_id", "tool", "tier", "state", count.alias("n"), *[F.when(F.col("state") == "hit", x).alias(c) for c, x in (("message", first["message"]), ("author", first["author"]["name"]), ("date", instant(date(first))))], page.alias("page"))


def _history(raw: DataFrame, key: list[str]) -> tuple[DataFrame, DataFrame]:
    """(pages, deferred) of history pages: those of keys of which every page can be used, with ``nodes``, and the other keys."""
    deferred = quarantined(raw, "history").select(key).distinct()
    pages = _readable(raw, "history").select(*key, F.col("r.data.node.history.nodes").alias("nodes"))
    return pages.join(deferred, key, "left_anti"), deferred


def path_commits(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, deferred) of history pages (repo_id, path, body): (repo_id, path, oid, committed_at), and the (repo_id, path) with a page that can't be used.

    The page that is missing may be the oldest, so of such a path no commit is given; deferred is what marker_onset takes as incomplete.
    """
    pages, deferred = _history(raw, ["repo_id", "path"])
    rows = pages.select("repo_id", "path", F.explode("nodes").alias("n"))
    return rows.select("repo_id", "path", F.col("n.oid").alias("oid"), F.col("n.committedDate").alias("committed_at")), deferred


def file_revisions(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, deferred) of ignore-file pages (repo_id, file, body), newest first: (repo_id, file, n, oid, committed_at, lines), where n rises with time, and the (repo_id, file) with a page that can't be used."""
    pages, deferred = _history(raw, ["repo_id", "file"])
    rows = pages.select("repo_id", "file", F.posexplode("nodes").alias("i", "n"))
    return rows.select("repo_id", "file", (-F.col("i")).alias("n"), F.col("n.oid").alias("oid"), F.col("n.committedDate").alias("committed_at"), F.split("n.file.text", r"\r?\n").alias("lines")), deferred


def read_published(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """An earlier published table, typed; a path that is not there is the first run, any other failure stops."""
    try:
        return conform(spark.read.parquet(path), schema)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return empty(spark, schema)
        raise
