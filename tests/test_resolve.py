import pytest
from pyspark.sql import functions as F

from forgelight import schemas
from forgelight.functions import urls
from forgelight.operators import dimension, resolve

CASES = [
    ("https://github.com/Own/Pkg", ("github", "github.com", "Own", "Pkg")),
    ("http://www.github.com/Own/Pkg.git#readme", ("github", "github.com", "Own", "Pkg")),
    ("git@gitlab.com:grp/sub/n.git", ("gitlab", "gitlab.com", "grp/sub", "n")),
    ("https://gitlab.com/g/s/n/-/issues", ("gitlab", "gitlab.com", "g/s", "n")),
    ("git+https://me@codeberg.org:443/a/b?x", ("codeberg", "codeberg.org", "a", "b")),
    ("codeberg.org/a/b", ("codeberg", "codeberg.org", "a", "b")),
    ("//sr.ht/~me/x", ("sourcehut", "sr.ht", "~me", "x")),
    ("https://git.lab.edu/t/u", ("other", "git.lab.edu", "t", "u")),
    ("https://r-forge.r-project.org/projects/x", ("rforge", "r-forge.r-project.org", "projects", "x")),
    ("https://cran.r-project.org/web/x", None),
    ("https://example.org/a/b", None),
    ("https://me.github.io/x", None),
    ("https://github.com/only", None),
    ("file1", None),
    ("", None),
    (None, None),
]


def test_parse_repos(spark):
    df = spark.createDataFrame([(c,) for c, _ in CASES], "u string")
    got = df.select("u", urls.parse_repos(F.array("u"))[0].alias("r")).collect()
    for r in got:
        assert (tuple(r["r"]) if r["r"] else None) == dict(CASES)[r["u"]], r


def packages(spark, *pairs):
    return spark.createDataFrame([(f"p{i}", "cran", u, b, i) for i, (u, b) in enumerate(pairs)], schemas.PACKAGE_INPUT)


@pytest.mark.parametrize(
    ("url", "bug", "want"),
    [
        ("https://gitlab.com/a/b, https://github.com/c/d", None, ("github", "d", "url")),
        ("https://gitlab.com/a/b https://github.com/c/d", "https://gitlab.com/A/B/-/issues", ("gitlab", "b", "both")),
        ("https://github.com/cran/x", "<https://codeberg.org/a/y>", ("codeberg", "y", "bugreports")),
        ("https://own.github.io/site, https://x.org", None, ("github", "site", "pages")),
        ("https://own.github.io", None, ("github", "own.github.io", "pages")),
        ("https://x.org", None, None),
        (None, None, None),
    ],
)
def test_choice(spark, url, bug, want):
    got = resolve.resolve_packages(packages(spark, (url, bug))).select("host", "name", "resolved_from").collect()
    assert [tuple(r) for r in got] == ([want] if want else [])


def test_index_keeps_first_case_and_counts_packages(spark, rows):
    repos, links = resolve.repo_index(resolve.resolve_packages(packages(spark, ("https://github.com/Own/P", None), ("https://github.com/own/p", None))))
    assert [tuple(r) for r in repos.select("repo_id", "owner", "n_packages", "supported").collect()] == [("github.com/own/p", "Own", 2, 1)]
    assert links.count() == 2


def test_lifecycle(spark):
    old = [(f"r{i}", "n", "github", "d", "o", "p", "o/p", 1, 1, "2023", "2023", s) for i, s in enumerate(["active", "gone", "moved", "retired", "moved"])]
    prior = spark.createDataFrame(old, schemas.REPOS)
    found = spark.createDataFrame([(f"r{i}", "github", "d", "o", "p", "o/p", 1, 2) for i in (1, 2, 3, 9)], "repo_id string, host string, host_domain string, owner string, name string, name_with_owner string, supported int, n_packages long")
    got = {r["repo_id"]: (r["status"], r["first_seen"], r["last_seen"], r["node_id"]) for r in dimension.upsert_repos(prior, found, "2024").collect()}
    assert got == {
        "r0": ("retired", "2023", "2023", "n"), "r1": ("gone", "2023", "2024", "n"), "r2": ("moved", "2023", "2024", "n"),
        "r3": ("active", "2023", "2024", "n"), "r4": ("retired", "2023", "2023", "n"), "r9": ("active", "2024", "2024", None),
    }
