import random
import shutil

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from forgelight import rules, schemas
from forgelight.operators import adoption, health, quality, series, tooling
from forgelight.sources import publish


def test_universe_guard():
    quality.universe_guard(90, 90, 100, 100)
    quality.universe_guard(1, 1, None, 0)
    with pytest.raises(quality.GateError):
        quality.universe_guard(89, 100, 100, 100)


def test_fingerprint_is_free_of_order(spark):
    a = spark.createDataFrame([(1, "x"), (2, None)], "k int, v string")
    b = spark.createDataFrame([(None, 2), ("x", 1)], "v string, k int")
    assert quality.fingerprint(a).first() == quality.fingerprint(b).first()
    c = spark.createDataFrame([(1, "x"), (2, "")], "k int, v string")
    assert quality.fingerprint(a).first() != quality.fingerprint(c).first()


def test_integrity_names_missing_tables(spark):
    got = {r["table"]: (r["rows"], r["present"]) for r in quality.integrity({"a": spark.range(3).toDF("x")}, ["a", "b"]).collect()}
    assert got == {"a": (3, True), "b": (None, False)}


def build(spark, n=200, stars=True):
    e = lambda s: schemas.empty(spark, s)
    summary = spark.range(n).select(F.concat(F.lit("p"), "id").alias("package"), F.lit("cran").alias("origin"), (F.col("id") if stars else F.when(F.col("id") > n / 2, F.col("id"))).alias("stars"))
    return {
        "summary": summary, "repos": e(schemas.REPOS), "repo_packages": e(schemas.REPO_PACKAGES), "latest": e(schemas.LATEST), "adoption": e(schemas.ADOPTION), "models": e(schemas.MODELS),
        "tooling": e(tooling.schema()), "rule_inventory": adoption.rule_inventory(rules.markers(spark)), "silent_channels": e("tier string, tool string, status string, reason string, recorded_on string"), "state": e(schemas.STATE),
    }


def test_publish_round_trip_gates_and_purge(spark, tmp_path, rows):
    root = f"file://{tmp_path}"
    s = lambda *r: spark.createDataFrame(list(r), schemas.SERIES)
    m = publish.publish(spark, root, "g1", build(spark), s(("r", "2023-05-01", "stars", 1), ("r", "2024-01-01", "stars", 2), ("r", "2024-01-01", "forks", 1)), "2024-01-02")
    assert m["years"] == [2023, 2024] and m["changed_years"] == ["2023", "2024"] and publish.current(spark, root) == "g1"
    m = publish.publish(spark, root, "g2", build(spark), s(("r", "2024-01-03", "stars", 3)), "2024-01-03", purged=["forks"])
    assert m["changed_years"] == ["2024"] and m["changed_tables"] == [] and m["previous"] == "g1" and m["summary_previous"] is None
    assert rows(publish.read_series(spark, root)) == [("r", "2023-05-01", "stars", 1), ("r", "2024-01-01", "stars", 2), ("r", "2024-01-03", "stars", 3)]
    with pytest.raises(quality.GateError, match="regressions"):
        publish.publish(spark, root, "g3", build(spark, 150), s(), "2024-01-04")
    with pytest.raises(quality.GateError, match="regressions"):
        publish.publish(spark, root, "g3", build(spark, stars=False), s(), "2024-01-04")
    assert publish.current(spark, root) == "g2"
    publish.publish(spark, root, "g3", build(spark, 150), s(), "2024-01-04", allow_regression=True)
    assert publish.manifest(spark, root)["summary_previous"] == "g2" and publish.read_table(spark, root, "summary").count() == 150
    with pytest.raises(quality.GateError, match="repeated keys"):
        publish.publish(spark, root, "g4", build(spark, 150), s(("r", "2024-01-03", "stars", 3), ("r", "2024-01-03", "stars", 4)), "2024-01-04")
    with pytest.raises(quality.GateError, match="missing"):
        publish.publish(spark, root, "g4", {k: v for k, v in build(spark).items() if k != "models"}, s(), "2024-01-04")


def series_of(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.SERIES)


OLD = [("r", "2023-05-01", "forks", 1), ("r", "2024-01-01", "stars", 2), ("r", "2024-01-03", "stars", 3)]


@pytest.fixture()
def root(spark, tmp_path):
    publish.publish(spark, f"file://{tmp_path}", "g1", build(spark), series_of(spark, *OLD), "2024-01-03")
    return f"file://{tmp_path}"


def test_a_lost_pointer_stops_and_loses_nothing(spark, root, tmp_path, rows):
    (tmp_path / publish.POINTERS).rename(tmp_path / ".away")
    with pytest.raises(quality.GateError, match="no pointer"):
        publish.publish(spark, root, "g2", build(spark), series_of(spark, ("r", "2024-01-05", "stars", 4)), "2024-01-05")
    with pytest.raises(quality.GateError, match="no pointer"):
        publish.read_series(spark, root)
    (tmp_path / ".away").rename(tmp_path / publish.POINTERS)
    assert rows(publish.read_series(spark, root)) == OLD


def test_a_metric_that_is_all_of_a_year_is_purged(spark, root, rows):
    m = publish.publish(spark, root, "g2", build(spark), series_of(spark), "2024-01-04", purged=["forks"])
    assert rows(publish.read_series(spark, root)) == OLD[1:]
    assert m["changed_years"] == ["2023"] and sorted(m["paths"]) == sorted(m["series"]) == ["2024"] and m["years"] == [2023, 2024]
    m = publish.publish(spark, root, "g3", build(spark), series_of(spark, ("r", "2023-06-01", "stars", 1)), "2024-01-05")
    assert m["changed_years"] == ["2023"] and m["paths"] == {"2023": "g3", "2024": "g1"}


def test_a_run_that_fails_at_any_step_leaves_what_was_published(spark, root, rows, monkeypatch):
    new = series_of(spark, ("r", "2024-01-05", "stars", 4))
    for step in ("read_years", "_put", "_switch", "_names_it"):
        calls, real = [], getattr(publish, step)

        def fail(*a, step=step, calls=calls, real=real):
            calls.append(a)
            if step != "read_years" or len(calls) > 3:
                raise OSError("lost")
            return real(*a)

        with monkeypatch.context() as m:
            m.setattr(publish, step, fail)
            with pytest.raises(OSError, match="lost"):
                publish.publish(spark, root, "g2", build(spark, 300), new, "2024-01-05")
        assert publish.current(spark, root) == "g1" and rows(publish.read_series(spark, root)) == OLD and publish.read_table(spark, root, "summary").count() == 200
    publish.publish(spark, root, "g2", build(spark, 300), new, "2024-01-05")
    assert rows(publish.read_series(spark, root)) == [*OLD, ("r", "2024-01-05", "stars", 4)] and publish.manifest(spark, root)["previous"] == "g1"


def test_a_first_run_that_fails_can_be_run_again(spark, tmp_path, rows):
    root, own = f"file://{tmp_path}/new", series_of(spark, ("r", "2024-01-03", "stars", 3))
    with pytest.raises(quality.GateError, match="repeated"):
        publish.publish(spark, root, "g1", build(spark), own.union(own), "2024-01-04")
    assert publish.current(spark, root) is None
    publish.publish(spark, root, "g1", build(spark), own, "2024-01-04")
    assert rows(publish.read_series(spark, root)) == [("r", "2024-01-03", "stars", 3)]
    with pytest.raises(quality.GateError, match="already"):
        publish.publish(spark, root, "g1", build(spark), own, "2024-01-04")


def test_of_runs_that_overlap_none_drops_what_another_published(spark, root, rows, monkeypatch):
    """A whole run published at each step of another: that one stops, and made anew it has the rows of both."""
    mine, other = ("r", "2024-01-05", "stars", 4), ("r", "2023-07-01", "stars", 9)
    here = root.removeprefix("file://")
    calls = []

    def count(name, real):
        def run(*a):
            calls.append(name)
            if len(calls) == at:
                publish.publish(spark, place, "gA", build(spark, 220), series_of(spark, other), "2024-01-05")
            return real(*a)

        return run

    def overlapped(publishing):
        calls.clear()
        with monkeypatch.context() as m:
            for name in ("_names", "_put", "read_years"):
                m.setattr(publish, name, count(name, getattr(publish, name)))
            return publishing()

    place, at = f"{root}/../plain", -1
    shutil.copytree(here, f"{here}/../plain")
    first = publish.begin(spark, place)
    overlapped(lambda: publish.publish(spark, place, "gB", build(spark, 210), series_of(spark, mine), "2024-01-05", turn=first))
    switch = len(calls)
    assert calls[-1] == "_put" and switch > 9
    for at in (1, switch // 2, switch):
        place = f"{root}/../at{at}"
        shutil.copytree(here, f"{here}/../at{at}")
        turn = publish.begin(spark, place)
        with pytest.raises(publish.Overtaken):
            overlapped(lambda turn=turn: publish.publish(spark, place, "gB", build(spark, 210), series_of(spark, mine), "2024-01-05", turn=turn))
        assert rows(publish.read_series(spark, place)) == sorted([*OLD, other], key=repr) and publish.current(spark, place) == "gA"
        assert publish.read_table(spark, place, "summary").count() == 220
        with pytest.raises(publish.Overtaken):  # what was read before is too old for a later try too
            publish.publish(spark, place, "gB", build(spark, 210), series_of(spark, mine), "2024-01-05", turn=turn)
    seen, place, at = [], f"{root}/../again", switch - 1
    shutil.copytree(here, f"{here}/../again")

    def make(turn):
        seen.append(turn.generation)
        return {**build(spark), "summary": publish.read_table(spark, place, "summary", turn.generation)}, series_of(spark, mine)

    overlapped(lambda: publish.publish_again(spark, place, "gB", make, "2024-01-05"))
    assert seen == ["g1", "gA"] and publish.current(spark, place) == "gB" and publish.read_table(spark, place, "summary").count() == 220
    assert rows(publish.read_series(spark, place)) == sorted([*OLD, mine, other], key=repr)


def test_one_name_is_given_once_whatever_the_store(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(publish, "_get", lambda spark, path: "text")
    for scheme in ("file", "hdfs", "s3a"):
        for i in range(3):
            (tmp_path / f"h{i}").write_text("text")

        # the way of each store, tried on local files
        fs, target = publish._fs(spark, f"file://{tmp_path}/{scheme}")
        monkeypatch.setattr(publish, "_scheme", lambda path, scheme=scheme: scheme)
        got = [publish._names_it(spark, f"file://{tmp_path}/h{i}", f"file://{tmp_path}/{scheme}") for i in range(3)]
        assert got == [True, False, False] and fs.exists(target)


def test_prune_leaves_runs_that_may_still_switch(spark, root, rows, monkeypatch):
    mine = series_of(spark, ("r", "2024-01-05", "stars", 4))
    pruned = []

    def switch(spark, place, turn, folder, real=publish._switch):
        pruned.extend(publish.prune(spark, place))
        real(spark, place, turn, folder)

    with monkeypatch.context() as m:
        m.setattr(publish, "_switch", switch)
        publish.publish(spark, root, "g2", build(spark), mine, "2024-01-05")
    assert pruned == [] and len(rows(publish.read_series(spark, root))) == 4
    with monkeypatch.context() as m, pytest.raises(OSError):
        m.setattr(publish, "_switch", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        publish.publish(spark, root, "g3", build(spark), mine, "2024-01-06")
    assert publish.prune(spark, root) == []  # it may have been running still
    publish.publish(spark, root, "g4", build(spark), mine, "2024-01-06")
    assert [n.split(".")[0] for n in publish.prune(spark, root)] == ["g3"]


def test_prune_keeps_what_two_generations_need(spark, root, rows):
    for i in (2, 3, 4):
        publish.publish(spark, root, f"g{i}", build(spark), series_of(spark, ("r", f"2024-01-{i + 3:02d}", "stars", i + 2)), "2024-01-09")
    assert [n.split(".")[0] for n in publish.prune(spark, root)] == ["g2"]  # g1 has the year 2023
    assert len(rows(publish.read_series(spark, root))) == 6 and publish.read_table(spark, root, "summary", "g3").count() == 200
    assert [r["date"] for r in publish.read_series(spark, root, years=[2023]).collect()] == ["2023-05-01"]
    with pytest.raises(quality.GateError, match="already"):
        publish.publish(spark, root, "g1", build(spark), series_of(spark), "2024-01-09")


def test_touched_years(spark, rows):
    a = spark.createDataFrame([("r", "2023-05-01", "stars", 1)], schemas.SERIES)
    assert rows(series.touched_years(a, a)) == [(2023,)]


def test_closing_tables_say_what_the_whole_history_says(spark, tmp_path, rows):
    """Trends and last releases from closing tables and the last years' rows, after a year long past was changed too."""
    r, root = random.Random(5), f"file://{tmp_path}/asof"
    days = [f"{y}-{m:02d}-{d:02d}" for y in range(2019, 2025) if y != 2021 for m in (1, 2, 12) for d in (1, 15, 28)]
    first = {(f"r{i}", day, m): r.randint(0, 9) for i in range(40) for m in ("stars", "releases_total") for day in r.sample(days, r.randint(0, 6))}
    second = {("r1", "2020-06-01", "stars"): 77, ("r2", "2024-03-01", "stars"): 5, ("new", "2020-12-31", "releases_total"): 1}
    publish.publish(spark, root, "g1", build(spark), series_of(spark, *[(*k, v) for k, v in first.items()]), "2024-02-20")
    m = publish.publish(spark, root, "g2", build(spark), series_of(spark, *[(*k, v) for k, v in second.items()]), "2024-03-02")
    assert m["closings"] == {"2019": "g1", "2020": "g2", "2022": "g2", "2023": "g2", "2024": "g2"}
    whole = publish.read_series(spark, root)
    for today in ("2024-03-02", "2024-01-20", "2023-12-01", "2022-01-10", "2019-01-05", "2030-01-01"):
        upto = health.first_year(today)
        state = publish.read_state(spark, root, today)
        assert {int(f.split("year=")[1][:4]) >= upto for f in state["series"].inputFiles()} <= {True}
        want = {x[0]: x[1] for x in rows(health.trend(whole, today))}
        assert {x[0]: x[1] for x in rows(health.trend(state["series"], today, closing=state["closing"]))} == want
    links = spark.createDataFrame([(f"r{i}", f"p{i}", "cran", "url") for i in range(40)] + [("new", "pn", "cran", "url")], schemas.REPO_PACKAGES)
    e = lambda s: schemas.empty(spark, s)
    make = lambda s, **k: rows(health.summary(links, e(schemas.LATEST), s, e(schemas.ATTRIBUTES), e(schemas.REPOS), e(schemas.ROLLUPS), "2024-03-02", **k))
    state = publish.read_state(spark, root, "2024-03-02")
    assert make(state["series"], closing=state["closing"]) == make(whole)
    with pytest.raises(ValueError, match="full history"):
        make(state["series"], closing=state["closing"], full_history=True)


def test_closings_of_several_years_in_one_pass(spark, tmp_path, rows):
    """As one closing table made from the other, over years without rows and after others; keys that two rows have are counted; a publication makes them in one write."""
    r, years = random.Random(8), [2019, 2020, 2022, 2023]
    days = [f"{y}-{m:02d}-{d:02d}" for y in years for m in (1, 6, 12) for d in (1, 31)]
    drawn = {(f"r{i}", day, m): r.choice([None, *range(9)]) for i in range(30) for m in ("stars", "forks") for day in r.sample(days, r.randint(0, 5))}
    before = series.closing(series_of(spark, ("r1", "2018-05-01", "stars", 4), ("old", "2017-01-01", "stars", 6), ("old", "2018-01-01", "stars", None)))
    whole, chained, want = series_of(spark, *[(*k, v) for k, v in drawn.items()]), before, []
    for y in years:
        chained = spark.createDataFrame(series.closing(series.year_rows(whole, y), chained).collect(), schemas.CLOSING)
        want += [(*x, y) for x in rows(chained)]
    seen = Observation()
    assert rows(series.closings(whole, before, years, seen)) == sorted(want, key=repr) and seen.get["rows"] == 0
    assert rows(series.closings(whole.limit(0), before, [2019, 2022])) == [(*x, y) for x in rows(before) for y in (2019, 2022)]
    twice = Observation()
    series.closings(whole.union(whole.limit(2)), before, years, twice).collect()
    assert twice.get["rows"] == 2
    root = f"file://{tmp_path}/closings"
    publish.publish(spark, root, "g1", build(spark), whole, "2024-01-01")
    folder = publish._folder(spark, root, None)
    assert publish._names(spark, f"{root}/{folder}/closing") == [f"year={y}" for y in years] and (tmp_path / "closings" / folder / "closing" / "_SUCCESS").exists()
    chained = None
    for y in years:
        chained = spark.createDataFrame(series.closing(series.year_rows(whole, y), chained).collect(), schemas.CLOSING)
        assert rows(publish.read_closing(spark, root, y)) == rows(chained)


def counted(spark, df, column):
    """The rows with a column that counts how often it is computed, and the count."""
    n = spark.sparkContext.accumulator(0)
    return df.withColumn(column, F.udf(lambda x: n.add(1) or x)(column)), n


def test_a_working_series_is_computed_once(spark, root, rows):
    new, n = counted(spark, series_of(spark, ("r", "2024-01-05", "stars", 4), ("r", "2023-05-02", "forks", 2)), "repo_id")
    publish.publish(spark, root, "g2", build(spark), new, "2024-01-05")
    assert n.value == 2 and len(rows(publish.read_series(spark, root))) == 5
    assert publish._names(spark, f"{root}/{publish._folder(spark, root, None)}/{publish.WORKING}") == []


def test_tables_are_computed_once_and_their_keys_are_checked(spark, root, rows):
    tables = build(spark)
    tables["summary"], n = counted(spark, tables["summary"], "package")
    publish.publish(spark, root, "g2", tables, series_of(spark, ("r", "2024-01-05", "stars", 4)), "2024-01-05")
    assert n.value == 200
    links, again = [("r", "p", "cran", "url")], ("r", "2024-01-06", "stars", 4)
    tables["repo_packages"] = spark.createDataFrame(links * 2, schemas.REPO_PACKAGES)
    with pytest.raises(quality.GateError, match="^repo_packages: repeated keys"):
        publish.publish(spark, root, "g3", tables, series_of(spark), "2024-01-06")
    with pytest.raises(quality.GateError, match="^repo_packages, series: repeated keys"):
        publish.publish(spark, root, "g3", tables, series_of(spark, again, again), "2024-01-06")
    assert publish.current(spark, root) == "g2" and len(rows(publish.read_series(spark, root))) == 4
