from forgelight import schemas
from forgelight.operators import health, series


def items(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.ITEMS)


def test_cumulative_ignores_missing_times_and_order(spark, rows):
    got = series.cumulative_series(items(spark, ("r", "stars", "2024-01-03T05:00:00Z", None), ("r", "stars", None, None), ("r", "stars", "2024-01-01T23:59:59Z", None), ("r", "stars", "2024-01-03T01:00:00Z", None)))
    assert rows(got) == [("r", "2024-01-01", "stars", 1), ("r", "2024-01-03", "stars", 3)]


def test_open_series_skips_days_whose_net_is_zero_and_may_go_below_zero(spark, rows):
    got = series.open_series(items(spark, ("r", "issues_open", "2024-01-01", "2024-01-01"), ("r", "issues_open", "2024-01-05", "2024-01-02"), ("r", "issues_open", "2024-01-05", None)))
    assert rows(got) == [("r", "2024-01-02", "issues_open", -1), ("r", "2024-01-05", "issues_open", 1)]


def test_rebuild_dispatches_and_rejects_unknown(spark, rows):
    data = items(spark, ("r", "stars", "2024-01-01", None), ("r", "prs_open", "2024-01-01", "2024-01-02"))
    assert len(rows(series.rebuild(data, ["stars", "prs_open"]))) == 3
    try:
        series.rebuild(data, ["nonsense"])
        raise AssertionError
    except ValueError as e:
        assert "nonsense" in str(e)


def test_change_only_replayed_gives_nothing(spark, rows):
    before = spark.createDataFrame([("r", "stars", 1)], schemas.LATEST)
    now = spark.createDataFrame([("r", "stars", 2), ("r", "forks", 0)], schemas.LATEST)
    assert rows(series.change_only(before, now, "2024-01-02")) == [("r", "2024-01-02", "forks", 0), ("r", "2024-01-02", "stars", 2)]
    assert rows(series.change_only(now, now, "2024-01-03")) == []


def test_null_is_not_measured(spark, rows):
    wide = spark.createDataFrame([("n1", None, 0), ("n2", 4, 1)], "node_id string, stars int, forks int")
    ids = spark.createDataFrame([("n1", "a"), ("n3", "c")], "node_id string, repo_id string")
    assert rows(series.to_long(wide, ids)) == [("a", "forks", 0)]


def test_upserts_and_purge(spark, rows):
    s = lambda *r: spark.createDataFrame(list(r), schemas.SERIES)
    old, new = s(("r", "2023-12-31", "stars", 1), ("r", "2024-01-01", "forks", 2)), s(("r", "2023-12-31", "stars", 9), ("r", "2024-01-02", "stars", 5))
    assert ("r", "2023-12-31", "stars", 9) in rows(series.upsert_replace(old, new, series.KEY))
    assert ("r", "2023-12-31", "stars", 1) in rows(series.upsert_keep(old, new, series.KEY))
    kept, years = series.purge(old, ["forks"])
    assert rows(kept) == [("r", "2023-12-31", "stars", 1)] and rows(years) == [(2024,)]
    assert ("r", "2024-01-01", "forks", 2) not in rows(series.fold_history(new, old, ["forks"]))
    assert rows(series.recent(old, "2024-01-10", 9)) == [("r", "2024-01-01", "forks", 2)]
    assert rows(series.go_live(series.go_live(spark.createDataFrame([], schemas.STATE), "2024-01-01"), "2024-02-01")) == [("go_live", "2024-01-01")]


def test_trend_base_is_the_value_that_held(spark, rows):
    s = spark.createDataFrame([("a", "2024-01-01", "stars", 10), ("a", "2024-02-20", "stars", 15), ("b", "2024-02-20", "stars", 5), ("c", "2024-01-01", "stars", 0), ("c", "2024-02-20", "stars", 4)], schemas.SERIES)
    assert rows(health.trend(s, "2024-03-01")) == [("a", 50.0), ("b", None), ("c", None)]


def test_medians_round_half_to_even(spark, rows):
    data = items(spark, ("r", "i", "2024-01-01", "2024-01-03"), ("r", "i", "2024-01-01", "2024-01-04"), ("r", "i", "2024-01-01", None))
    assert rows(health.days_to_close(data)) == [("r", "i", 2)]
    assert rows(health.open_age(data, "2024-01-11")) == [("r", "i", 10)]
    days = spark.createDataFrame([("r", "2024-01-01"), ("r", "2024-01-01"), ("r", "2024-01-04"), ("q", "2024-01-01")], "repo_id string, date string")
    assert rows(health.release_facts(days)) == [("q", "2024-01-01", None), ("r", "2024-01-04", 3)]


def test_summary_of_nothing_is_typed(spark):
    e = lambda s: schemas.empty(spark, s)
    got = health.summary(e(schemas.REPO_PACKAGES), e(schemas.LATEST), e(schemas.SERIES), e(schemas.ATTRIBUTES), e(schemas.REPOS), e(schemas.ROLLUPS), "2024-01-01")
    assert got.count() == 0 and dict(got.dtypes)["trend_30d"] == "double" and len(got.columns) == 34


def test_carry_forward_prefers_collected(spark, rows):
    repos = spark.createDataFrame([("a",), ("b",), ("c",)], "repo_id string")
    collected = spark.createDataFrame([("a", "MIT")], "repo_id string, license string")
    prior = spark.createDataFrame([("p", "cran", "a", "GPL"), ("p", "cran", "b", "ISC")], "package string, origin string, repo_id string, license string")
    got = health.carry_forward(repos, collected, prior).select("repo_id", "license")
    assert rows(got) == [("a", "MIT"), ("b", "ISC"), ("c", None)]
