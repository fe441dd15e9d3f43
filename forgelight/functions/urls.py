"""Column expressions that take package URLs apart. No Python runs on rows; a miss is null, never ''."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import rules

#: A scheme as RFC 3986 has it, and a host of dotted labels that ends in two letters or more.
SCHEME = r"^[A-Za-z][A-Za-z0-9+.\-]*://"
HOST = r"^[a-z0-9\-]+(\.[a-z0-9\-]+)*\.[a-z]{2,}$"
REPO = "struct<host:string,host_domain:string,owner:string,name:string>"


def split_urls(field: Column) -> Column:
    """Entries of a URL field, in order: split at commas and white space, without angle brackets."""
    parts = F.transform(F.split(field, r"[,\s]+"), lambda u: F.regexp_replace(u, r"^<+|>+$", ""))
    return F.coalesce(F.filter(parts, lambda u: u != ""), F.array().cast("array<string>"))


def _schemed(u: Column) -> Column:
    """The URL with a scheme: // and bare host.tld forms get https; anything else without one is null."""
    return (
        F.when(u.startswith("//"), F.concat(F.lit("https:"), u))
        .when(u.rlike(SCHEME), u)
        .when(F.lower(F.split_part(u, F.lit("/"), F.lit(1))).rlike(HOST), F.concat(F.lit("https://"), u))
    )


def _trimmed(u: Column) -> Column:
    return F.regexp_replace(F.trim(u), r"^<+|>+$", "")


def _after_scheme(u: Column) -> Column:
    """What stands behind the first ://."""
    return F.substr(u, F.locate("://", u) + F.lit(3))


def _authority(u: Column) -> Column:
    """Domain of a URL with scheme: lower case, without userinfo, port and www."""
    host = F.split_part(_after_scheme(u), F.lit("/"), F.lit(1))
    host = F.split_part(F.substring_index(host, "@", -1), F.lit(":"), F.lit(1))
    return F.nullif(F.regexp_replace(F.lower(host), r"^www\.", ""), F.lit(""))


def _path(u: Column) -> Column:
    """From the first / behind the host on, without query and fragment; '' if there is none."""
    rest = _after_scheme(u)
    at = F.locate("/", rest)
    path = F.when(at > 1, F.substr(rest, at)).when(rest.isNotNull(), "")
    return F.substring_index(F.substring_index(path, "?", 1), "#", 1)


def _parts(urls: Column) -> Column:
    """struct(d, p) of domain and path for each URL; d is null for what is no URL.

    Every step is a transform of its own, so that each looks at the values of the step before
    instead of repeating its expressions.
    """
    # git@host:path, with something on both sides of the colon
    scp = lambda s: s.startswith("git@") & (F.locate(":", s) > 5) & (F.length(s) > F.locate(":", s))
    known = F.transform(urls, lambda u: F.struct(_trimmed(u).alias("s"), scp(_trimmed(u)).alias("ssh")))
    full = F.transform(known, lambda x: F.struct(x["s"].alias("s"), x["ssh"].alias("ssh"), _schemed(F.regexp_replace(x["s"], r"(?i)^git\+", "")).alias("u")))
    ssh = lambda x: F.regexp_replace(F.lower(F.substring_index(F.substr(x["s"], F.lit(5)), ":", 1)), r"^www\.", "")
    path = lambda x: F.when(x["ssh"], F.concat(F.lit("/"), F.substr(x["s"], F.locate(":", x["s"]) + F.lit(1)))).otherwise(_path(x["u"]))
    return F.transform(full, lambda x: F.struct(F.when(x["ssh"], ssh(x)).otherwise(_authority(x["u"])).alias("d"), path(x).alias("p")))


def domains(urls: Column) -> Column:
    """Domain of each URL, null where there is none."""
    return F.transform(_parts(urls), lambda x: x["d"])


def is_denied(d: Column) -> Column:
    out = d.isin(rules.DENIED_DOMAINS)
    for s in rules.DENIED_SUFFIXES:
        out = out | d.endswith(s)
    return out


def looks_like_forge(d: Column) -> Column:
    out = F.arrays_overlap(F.split(d, r"\."), F.array(*map(F.lit, rules.FORGE_LABELS)))
    for s in rules.FORGE_SUBSTRINGS:
        out = out | d.contains(s)
    return out


def _segments(p: Column) -> Column:
    return F.filter(F.split(p, "/"), lambda s: s != "")


def _bare_name(x: Column) -> Column:
    return F.regexp_replace(x, r"\.git$", "")


def parse_repos(urls: Column) -> Column:
    """struct(host, host_domain, owner, name) of each URL that is a repository, else null, in order."""
    table = F.create_map(*[F.lit(x) for kv in rules.KNOWN_FORGES.items() for x in kv])
    known = lambda x: F.coalesce(F.try_element_at(table, x["d"]), F.when(~is_denied(x["d"]) & looks_like_forge(x["d"]), F.lit("other")))
    hosted = F.transform(_parts(urls), lambda x: F.struct(x["d"].alias("d"), x["p"].alias("p"), F.when(~x["d"].endswith(rules.PAGES_SUFFIX), known(x)).alias("h")))
    project = lambda p: F.regexp_replace(F.regexp_replace(p, r"/-/.*$", ""), r"/(issues|merge_requests|wiki)(/.*)?$", "")
    cut = F.transform(hosted, lambda x: F.struct(x["d"].alias("d"), x["h"].alias("h"), _segments(F.when(x["h"] == "gitlab", project(x["p"])).otherwise(x["p"])).alias("g")))
    deep = lambda g: F.array_join(F.slice(g, 1, F.greatest(F.size(g) - 1, F.lit(0))), "/")
    owner = lambda x: F.when(x["h"] == "gitlab", deep(x["g"])).otherwise(F.try_element_at(x["g"], F.lit(1)))
    name = lambda x: _bare_name(F.when(x["h"] == "gitlab", F.try_element_at(x["g"], F.lit(-1))).otherwise(F.try_element_at(x["g"], F.lit(2))))
    named = F.transform(cut, lambda x: F.when(x["h"].isNotNull() & (F.size(x["g"]) >= 2), F.struct(x["h"].alias("host"), x["d"].alias("host_domain"), owner(x).alias("owner"), name(x).alias("name"))))
    return F.transform(named, lambda r: F.when((r["owner"] != "") & (r["name"] != ""), r).cast(REPO))


def parse_pages(urls: Column) -> Column:
    """The repository behind each pages site, as parse_repos() gives it: owner and first path segment, or the owner's own site."""
    full = F.transform(urls, lambda u: F.when(~_trimmed(u).startswith("//"), _schemed(_trimmed(u))))
    parts = F.transform(full, lambda u: F.struct(_authority(u).alias("d"), _segments(_path(u)).alias("g")))
    owned = F.transform(parts, lambda x: F.struct(F.when(x["d"].endswith(rules.PAGES_SUFFIX), F.substring(x["d"], F.lit(1), F.length(x["d"]) - F.lit(len(rules.PAGES_SUFFIX)))).alias("o"), x["g"].alias("g")))
    name = lambda x: F.coalesce(_bare_name(F.try_element_at(x["g"], F.lit(1))), F.concat(x["o"], F.lit(rules.PAGES_SUFFIX)))
    return F.transform(owned, lambda x: F.when(x["o"] != "", F.struct(F.lit("github").alias("host"), F.lit("github.com").alias("host_domain"), x["o"].alias("owner"), name(x).alias("name"))).cast(REPO))


def is_mirror(repo: Column) -> Column:
    """Read-only mirrors: by domain, or by owner on github."""
    owner = (repo["host"] == "github") & F.lower(repo["owner"]).isin(rules.MIRROR_OWNERS)
    return repo["host_domain"].isin(rules.MIRROR_DOMAINS) | owner


def slug(repo: Column) -> Column:
    return F.lower(F.concat_ws("/", repo["host_domain"], repo["owner"], repo["name"]))


def classify(urls: Column) -> Column:
    """struct(url, kind) of each URL; kind is repo, mirror, denied or other."""
    kind = lambda r, d: F.when(r.isNotNull(), F.when(is_mirror(r), "mirror").otherwise("repo")).when(is_denied(d), "denied").otherwise("other")
    both = F.arrays_zip(urls.alias("url"), parse_repos(urls).alias("repo"), domains(urls).alias("domain"))
    return F.transform(both, lambda x: F.struct(x["url"].alias("url"), kind(x["repo"], x["domain"]).alias("kind")))
