"""Publishing tables as generations: write, verify, then switch a pointer. Nothing that is published is ever written over.

Runs may overlap. Each takes its turn when it reads the state it builds on, writes to a folder of its own, and at the end makes
the very next pointer; if another run has made that one, it stops and drops nothing of what the other published.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import health, quality, series
from ..schemas import CLOSING, KEYS, SERIES, empty

#: Tables that a build must hold, besides the series.
DECLARED = ["summary", "repos", "repo_packages", "latest", "adoption", "models", "tooling", "rule_inventory", "silent_channels", "state"]
#: Folder of pointers: files named by rising numbers, each the name of a generation's folder. The last one holds.
POINTERS = "pointers"
#: What the pointer holds before anything is published.
NONE = "-"
#: In a run's folder: the number of the pointer that it builds on.
SINCE = "_since"
#: In a run's folder, until the run is done: the working series.
WORKING = "working"
COLUMNS = [c.split()[0] for c in SERIES.split(", ")]


class Overtaken(quality.GateError):
    """Another run has published since this one took its turn."""


class Turn(NamedTuple):
    """What is published when a run begins: the number of the last pointer, and the folder and generation it names (None before the first)."""

    number: int
    folder: str | None
    generation: str | None


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _names(spark: SparkSession, path: str) -> list[str]:
    """What a folder holds, but for hidden files; nothing if it is not there."""
    fs, p = _fs(spark, path)
    return sorted(n for x in (fs.listStatus(p) if fs.exists(p) else []) if (n := x.getPath().getName())[0] not in "._")


def _scheme(path) -> str:
    return path.toUri().getScheme()


def _names_it(spark: SparkSession, hidden: str, path: str) -> bool:
    """Give a written file a name that nothing has, in one step that fails for all but one of several runs; False if it is taken.

    A local file gets a second link. HDFS renames without overwriting. In other stores a file
    appears when it is closed, and creating it fails if it is there, so its text is written anew.
    """
    jvm, (fs, target) = spark._jvm, _fs(spark, path)
    target = fs.makeQualified(target)
    source = fs.makeQualified(_fs(spark, hidden)[1])
    scheme = _scheme(target)
    try:
        if scheme == "file":
            jvm.java.nio.file.Files.createLink(*(jvm.java.nio.file.Path.of(p.toUri()) for p in (target, source)))
        elif scheme in ("hdfs", "webhdfs", "viewfs"):
            options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration()).rename(source, target, options)
        else:
            out = fs.create(target, False)
            out.write(bytearray(_get(spark, hidden).encode()))
            out.close()
    except Py4JJavaError as e:
        if "AlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise
    return True


def _put(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file whole or not at all, under a name that is not taken."""
    folder, name = path.rsplit("/", 1)
    fs, hidden = _fs(spark, f"{folder}/.{name}-{uuid.uuid4().hex}")
    out = fs.create(hidden, False)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        if not _names_it(spark, hidden.toString(), path):
            raise quality.GateError(f"{path} is there already")
    finally:
        fs.delete(hidden, False)


def _get(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    opened = fs.open(p)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(opened)).decode()
    finally:
        opened.close()


def _last(spark: SparkSession, root: str) -> tuple[int, str | None]:
    """The number of the last pointer and the folder it names; (-1, None) before the first. Data without a pointer, or an unreadable one, stops."""
    found = _names(spark, f"{root}/{POINTERS}")
    if not found:
        if there := _names(spark, root):
            raise quality.GateError(f"{root} holds {there} but no pointer: its history is not overwritten")
        return -1, None
    name = _get(spark, f"{root}/{POINTERS}/{found[-1]}").strip()
    return int(found[-1]), None if name == NONE else name


def _manifest_in(spark: SparkSession, root: str, folder: str | None) -> dict:
    return json.loads(_get(spark, f"{root}/{folder}/manifest.json")) if folder else {}


def current(spark: SparkSession, root: str) -> str | None:
    """The generation that is published; None before the first."""
    return _manifest_in(spark, root, _last(spark, root)[1]).get("generation")


def begin(spark: SparkSession, root: str) -> Turn:
    """Take a turn: call this before reading the state that a run builds on, and hand it to publish().

    Before the first publication an empty pointer is made: from then on, data without a pointer is lost history and not a first run that failed.
    """
    number, folder = _last(spark, root)
    if number < 0:
        try:
            _put(spark, f"{root}/{POINTERS}/{0:09d}", NONE)
        except quality.GateError:  # another first run was quicker
            pass
        number, folder = _last(spark, root)
    return Turn(number, folder, _manifest_in(spark, root, folder).get("generation"))


def _switch(spark: SparkSession, root: str, turn: Turn, folder: str) -> None:
    """Make a run's folder the published one, if nothing was published since its turn. A run that ends before this leaves what was published as it was."""
    try:
        _put(spark, f"{root}/{POINTERS}/{turn.number + 1:09d}", folder)
    except quality.GateError:
        raise Overtaken(f"{root}: {current(spark, root)} was published after {turn.generation}, which this run builds on") from None


def _folder(spark: SparkSession, root: str, generation: str | None) -> str | None:
    """The folder of a generation, of the current one by default."""
    folder = _last(spark, root)[1]
    if generation is None or not folder:
        return folder
    return _manifest_in(spark, root, folder).get("folders", {}).get(generation, generation)


def read_table(spark: SparkSession, root: str, name: str, generation: str | None = None) -> DataFrame | None:
    """A table of a generation, of the current one by default; None if there is none yet."""
    folder = _folder(spark, root, generation)
    return spark.read.parquet(f"{root}/{folder}/{name}") if folder else None


def manifest(spark: SparkSession, root: str, generation: str | None = None) -> dict:
    return _manifest_in(spark, root, _folder(spark, root, generation))


def read_years(spark: SparkSession, root: str, paths: dict[str, str], folders: dict[str, str]) -> DataFrame:
    """Series rows of years, each from the generation that wrote it last."""
    files = [f"{root}/{folders.get(generation, generation)}/series/year={year}" for year, generation in sorted(paths.items())]
    return spark.read.schema(SERIES).parquet(*files) if files else empty(spark, SERIES)


def read_series(spark: SparkSession, root: str, generation: str | None = None, years: list[int] | None = None) -> DataFrame:
    """The whole series of a generation, or only some years of it: files of others are not opened."""
    m = manifest(spark, root, generation)
    return read_years(spark, root, {y: g for y, g in m.get("paths", {}).items() if years is None or int(y) in years}, m.get("folders", {}))


def read_closing(spark: SparkSession, root: str, year: int, generation: str | None = None) -> DataFrame:
    """The closing table (see series.closing) of all years up to ``year``."""
    m = manifest(spark, root, generation)
    return _closing(spark, root, m.get("closings", {}), m.get("folders", {}), year + 1)


def _closing(spark: SparkSession, root: str, closings: dict[str, str], folders: dict[str, str], before: int) -> DataFrame:
    """The last closing table of a year before ``before``."""
    last = max((int(y) for y in closings if int(y) < before), default=None)
    if last is None:
        return empty(spark, CLOSING)
    generation = closings[str(last)]
    return spark.read.schema(CLOSING).parquet(f"{root}/{folders.get(generation, generation)}/closing/year={last}")


def read_state(spark: SparkSession, root: str, today: str) -> dict[str, DataFrame]:
    """What a daily run builds on: all declared tables, the closing table of the years before the last ones, and the series of those last years, two at most. The files of older years are not opened."""
    first, m = health.first_year(today), manifest(spark, root)
    tables = {t: read_table(spark, root, t) for t in DECLARED}
    last = [int(y) for y in m.get("paths", {}) if int(y) >= first]
    return tables | {"series": read_series(spark, root, years=last), "closing": read_closing(spark, root, first - 1)}


def publish_again(
    spark: SparkSession, root: str, generation: str, build: Callable[[Turn], tuple[dict[str, DataFrame], DataFrame]], today: str, attempts: int = 3, **options
) -> dict:
    """Publish what build(turn) makes of what is published at a turn: (tables, working series). A run that was overtaken builds anew on what is there then.

    So of runs that overlap, each sees the rows of those before it. After ``attempts`` turns in vain Overtaken is raised.
    """
    for attempt in range(attempts):
        turn = begin(spark, root)
        tables, working = build(turn)
        try:
            return publish(spark, root, generation, tables, working, today, turn=turn, **options)
        except Overtaken:
            if attempt == attempts - 1:
                raise
    raise ValueError("attempts must be 1 or more")


def publish(spark: SparkSession, root: str, generation: str, tables: dict[str, DataFrame], working: DataFrame, today: str, purged: list[str] = (), allow_regression: bool = False, turn: Turn | None = None) -> dict:
    """Publish a build and return its manifest.

    ``turn``: what begin() gave before the state was read that the build came from; by default it is
    taken now. If another run publishes after it, Overtaken is raised and nothing changes: what that run
    published is neither dropped nor mixed with this one, which was built without it (see publish_again).
    Every run writes to a folder of its own, also of two that go by one name.

    The working series is folded over all published history. Years that it or a purge touched are
    written anew, into the new generation; its manifest tells for each year which generation holds
    it, so the others keep their files. A year that a purge has emptied has no entry any more, and
    is among the changed ones. All other tables go to the new generation. Keys must be unique, no
    declared table and not the series may be missing or fall by more than the tolerance (unless
    ``allow_regression``). Only then the pointer is switched: until that moment, and if the run
    fails at any step, readers see the generation before, its series included. History that is
    there but can't be read, and data without a pointer, stop the run.

    In the manifest, ``years`` are all years that have ever been published, ``paths`` those that have rows.
    """
    missing = [t for t in DECLARED if t not in tables]
    if missing:
        raise quality.GateError(f"tables missing: {missing}")
    turn = turn or begin(spark, root)
    before = turn.generation
    if _last(spark, root)[0] != turn.number:
        raise Overtaken(f"{root}: {current(spark, root)} was published after {before}, which this run builds on")
    old = {t: spark.read.parquet(f"{root}/{turn.folder}/{t}") for t in DECLARED} if before else {}
    last = _manifest_in(spark, root, turn.folder)
    if generation in (done := last.get("published", [])) or generation == POINTERS:
        raise quality.GateError(f"{generation} is published already")
    folder = f"{generation}.{uuid.uuid4().hex[:12]}"
    folders = last.get("folders", {}) | {generation: folder}
    _put(spark, f"{root}/{folder}/{SINCE}", str(turn.number))
    history = read_years(spark, root, last.get("paths", {}), folders)
    gone = series.purge(history, list(purged))[1] if purged else None
    target = f"{root}/{folder}"
    # what the build computes is computed once: gates and later steps read what was written
    working.write.parquet(f"{target}/{WORKING}")
    working = spark.read.schema(working.schema).parquet(f"{target}/{WORKING}")
    years = series.touched_years(working) if gone is None else series.touched_years(working).union(gone).distinct()
    years = sorted(r[0] for r in years.collect())
    for name in DECLARED:
        tables[name].write.mode("overwrite").parquet(f"{target}/{name}")
    written = {n: spark.read.parquet(f"{target}/{n}") for n in DECLARED}
    touched = read_years(spark, root, {y: g for y, g in last.get("paths", {}).items() if int(y) in years}, folders)
    # as many files for a year as its size asks for
    folded = series.with_year(series.fold_history(working, touched, list(purged)).select(COLUMNS)).hint("rebalance", "year")
    folded.write.mode("overwrite").partitionBy("year").parquet(f"{target}/series")
    own = {n.partition("=")[2]: generation for n in _names(spark, f"{target}/series") if n.startswith("year=")}
    paths = {y: g for y, g in last.get("paths", {}).items() if int(y) not in years} | own
    # closing tables from the first year on that has changed; keys that are repeated are seen on the way, all rows of the build being in these years
    closings = {y: g for y, g in last.get("closings", {}).items() if y in paths}
    first = min([*years, *(int(y) for y in paths if y not in closings)], default=None)
    changing = sorted(int(y) for y in paths if first is not None and int(y) >= first)
    repeated = [quality.duplicate_keys(written[t], KEYS[t]).limit(1).select(F.lit(t).alias("table")) for t in KEYS if t in written]
    found = [r["table"] for r in reduce(DataFrame.union, repeated).collect()]
    if changing:
        rows = read_years(spark, root, {str(y): paths[str(y)] for y in changing}, folders)
        made = series.closings(rows, _closing(spark, root, closings, folders, first), changing, seen := Observation())
        made.write.mode("overwrite").partitionBy("year").parquet(f"{target}/closing")
        closings |= {str(y): generation for y in changing}
        found += ["series"] if seen.get["rows"] else []
    if found:
        raise quality.GateError(f"{', '.join(sorted(found))}: repeated keys")
    prints = {str(r["year"]): f"{r['rows']}:{r['fingerprint']}" for r in quality.fingerprint(series.with_year(read_years(spark, root, own, folders)), ["year"]).collect()}
    if not allow_regression:
        kept = touched.filter(~F.col("metric").isin(list(purged))) if purged else touched
        was, now = old | {"series": kept}, written | {"series": read_years(spark, root, own, folders)}
        found = quality.regressions(quality.measures(was), quality.measures(now)).collect() if before else []
        if found:
            raise quality.GateError(f"regressions: {[tuple(r) for r in found]}")
    series.recent(read_years(spark, root, paths, folders), today).write.mode("overwrite").parquet(f"{target}/recent")
    same = {y: v for y, v in last.get("series", {}).items() if int(y) not in years}
    emptied = [y for y in last.get("paths", {}) if y not in paths]
    counts = {r["table"]: [r["rows"], r["fingerprint"]] for r in quality.integrity(written, DECLARED).collect()}
    changed_tables = sorted(t for t, v in counts.items() if last.get("tables", {}).get(t) != v)
    out = {
        "generation": generation, "previous": before, "published": [*done, generation], "data_through": today, "changed_years": sorted([*emptied, *(y for y, v in prints.items() if last.get("series", {}).get(y) != v)]),
        "changed_tables": changed_tables, "years": sorted({*last.get("years", []), *map(int, paths)}), "paths": paths, "folders": folders, "closings": closings, "series": same | prints, "tables": counts,
        "summary_previous": (before if "summary" in changed_tables else last.get("summary_previous")) if before else None,
    }
    fs, done_with = _fs(spark, f"{target}/{WORKING}")
    fs.delete(done_with, True)
    _put(spark, f"{target}/manifest.json", json.dumps(out, sort_keys=True))
    _switch(spark, root, turn, folder)
    return out


def prune(spark: SparkSession, root: str) -> list[str]:
    """Delete folders that neither the current generation nor the one before it needs, for a year, a table or the previous summary; returns their names.

    Folders of runs that may still switch stay: those that build on what is published now. A run that
    builds on an earlier state can't switch any more.
    """
    number, folder = _last(spark, root)
    now = _manifest_in(spark, root, folder)
    folders = now.get("folders", {})
    past = _manifest_in(spark, root, folders.get(now["previous"], now["previous"])) if now.get("previous") else {}
    needed = {m.get(k) for m in (now, past) for k in ("generation", "summary_previous")} | {g for m in (now, past) for k in ("paths", "closings") for g in m.get(k, {}).values()}
    needed = {folders.get(g, g) for g in needed} | {POINTERS}
    unused = []
    for n in _names(spark, root):
        fs, since = _fs(spark, f"{root}/{n}/{SINCE}")
        if n not in needed and not (fs.exists(since) and int(_get(spark, since.toString())) >= number):
            fs.delete(_fs(spark, f"{root}/{n}")[1], True)
            unused.append(n)
    return unused
