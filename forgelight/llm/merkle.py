"""A Merkle tree over the rows of a dataset: a subtree for each source, one root over all of them, a proof for each row.

Digests are lowercase hex SHA-256. A parent's children are spread into ``fanout`` columns by
conditional aggregates; those columns concatenated hash to the parent, and those columns without the
child's own are its siblings. All of it is DataFrame code; the driver learns only how many levels there are.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import settle

#: Siblings before and after a node, level by level from its own to the root.
PATH = "array<struct<before: string, after: string>>"


def field(value: Column | str) -> Column:
    """A value as it enters a leaf: ``-`` if null, else its number of UTF-8 bytes, a colon and itself."""
    text = (F.col(value) if isinstance(value, str) else value).cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column | str) -> Column:
    """The digest of a row's values, in the order given."""
    return F.sha2(F.concat(*map(field, values)), 256)


def fold(digest: Column, path: Column) -> Column:
    """The root that a leaf leads to with the siblings of a path."""
    return F.aggregate(path, digest, lambda d, x: F.sha2(F.concat(x["before"], d, x["after"]), 256))


def proof(path: Column) -> Column:
    """The digest of all siblings of a path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda x: F.concat(x["before"], x["after"])), ""), 256)


def _ranges(rows: DataFrame, group: list[str], order: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with ``part`` and ``at``, and (part, group, first, before, n): where each group's rows in a part begin, how many come before, and the group's size.

    Rows are dealt out by ranges of (group, order), so that a group of any size is spread over many
    tasks; only its counts in each range are summed. Nulls come first.
    """
    ranged = rows.repartitionByRange(*group, *order).sortWithinPartitions(*group, *order)
    ranged = settle(ranged.withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.shiftright("at", 33)), "merkle-order")
    each = ranged.groupBy("part", *group).agg(F.min("at").alias("first"), F.count("*").alias("here"))
    of_group = Window.partitionBy(*group)
    each = each.withColumn("before", F.sum("here").over(of_group.orderBy("part")) - F.col("here")).withColumn("n", F.sum("here").over(of_group))
    return ranged, each.drop("here")


def _meet(ranged: DataFrame, each: DataFrame, group: str) -> DataFrame:
    """Rows with what is known of their group in their part; no key of this join has more rows than a part."""
    on = (F.col("l.part") == F.col("r.part")) & F.col(f"l.{group}").eqNullSafe(F.col(f"r.{group}"))
    pos = (F.col("at") - F.col("first") + F.col("before")).alias("pos")
    return ranged.alias("l").join(each.alias("r"), on).select("l.*", *[f"r.{c}" for c in each.columns if c not in ("part", group)], pos)


def _parents(nodes: DataFrame, fanout: int) -> DataFrame:
    """(tree, pos, n, digest, slots): a parent for every ``fanout`` consecutive nodes of a tree, its children spread into slots."""
    slots = [F.max(F.when(F.col("pos") % fanout == i, F.col("digest"))).alias(f"slot{i}") for i in range(fanout)]
    names = [f"slot{i}" for i in range(fanout)]
    made = nodes.groupBy("tree", F.floor(F.col("pos") / fanout).alias("pos"), F.floor((F.col("n") + fanout - 1) / fanout).alias("n")).agg(*slots)
    return made.select("tree", "pos", "n", F.sha2(F.concat_ws("", *names), 256).alias("digest"), F.array(*names).alias("slots"))


def _below(nodes: DataFrame, parents: DataFrame, fanout: int) -> DataFrame:
    """Nodes with their paths and roots, from those of their parents and the parents' slots."""
    up = parents.select("tree", F.col("pos").alias("up"), F.col("slots").alias("family"), F.col("path").alias("above"), "subroot", "root")
    slot = (F.col("pos") % fanout).cast("int")
    before = F.array_join(F.slice("family", F.lit(1), slot), "")
    after = F.array_join(F.slice("family", slot + 2, F.lit(fanout)), "")
    own = F.array(F.struct(before.alias("before"), after.alias("after")))
    found = nodes.withColumn("up", F.floor(F.col("pos") / fanout)).join(up, ["tree", "up"])
    return found.withColumn("path", F.concat(own, F.col("above"))).drop("up", "family", "above")


def _levels(nodes: DataFrame, fanout: int) -> list[DataFrame]:
    """The nodes of each level of all trees, leaves first; a tree is in the lists as long as several nodes of it remain, and then once."""
    levels, n = [nodes], nodes.agg(F.max("n")).first()[0] or 0
    while n > 1:
        levels.append(settle(_parents(levels[-1].filter("n > 1"), fanout), "merkle-level"))
        n = -(-n // fanout)
    return levels


def _roots(levels: list[DataFrame]) -> DataFrame:
    """(tree, digest): what remains of each tree."""
    return reduce(DataFrame.union, [x.filter("n = 1").select("tree", "digest") for x in levels])


def _paths(levels: list[DataFrame], above: DataFrame, fanout: int) -> DataFrame:
    """The leaves with their paths and roots; above: (tree, path, subroot, root) of each tree's own root."""
    known = None
    for nodes in reversed(levels):
        ends = nodes.filter("n = 1").join(above, "tree")
        known = ends if known is None else ends.unionByName(_below(nodes.filter("n > 1"), known, fanout))
    return known


def manifest(rows: DataFrame, group: str = "source", order: str = "doc_id", digest: str = "leaf", fanout: int = 16) -> DataFrame:
    """Rows with ``subroot``, ``root`` and ``path`` (before and after: concatenated digests of the siblings).

    rows: group and order columns, the digest column (the leaf of each row) and any others, which are
    kept. In each group, leaves ascend by ``order``, those of equal order by digest; nulls come first,
    as a group and in order. While several nodes of a group remain, every ``fanout`` consecutive ones
    become the digest of their concatenation, the last of fewer, even of one. What remains is the
    group's subroot (of a single row: its leaf). Subroots ordered by group make the root likewise.
    No row in, no row out. Rows that repeat are leaves like others.

    A group of any size is dealt out by ranges; a level is a shuffle of small rows, a ``fanout``-th of
    those of the level below, and a row of a level meets at most ``fanout`` - 1 others. Levels are
    written to the shared folder, so none is computed again when an executor is lost.
    """
    leaves = rows.select(F.col(group).alias("name"), F.col(order).alias("ord"), F.col(digest).alias("digest"), F.struct(*rows.columns).alias("row"))
    # written first, for ranges are drawn from a sample, and texts are to be read once
    ranged, each = _ranges(settle(leaves, "merkle-rows"), ["name"], ["ord", "digest"])
    # trees go by number from here on: a null or a long name is no key any more
    each = settle(each, "merkle-ranges")
    names, ends = _ranges(each.filter("before = 0").select(F.lit(0).alias("all"), "name"), ["all"], ["name"])
    names = _meet(names, ends, "all").select("name", F.col("pos").alias("tree"))
    each = each.alias("l").join(names.alias("r"), F.col("l.name").eqNullSafe(F.col("r.name"))).select("l.*", "r.tree")
    leaves = settle(_meet(ranged, each, "name").select("tree", "pos", "n", "digest", "row"), "merkle-leaves")
    levels = _levels(leaves, fanout)
    subroots = settle(_roots(levels), "merkle-subroots")
    n = F.lit(subroots.count()).cast("long")
    top = _levels(subroots.select(F.lit(0).alias("tree"), F.col("tree").alias("pos"), n.alias("n"), "digest"), fanout)
    start = _roots(top).select("tree", F.array().cast(PATH).alias("path"), F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root"))
    above = _paths(top, start, fanout).select(F.col("pos").alias("tree"), "path", F.col("digest").alias("subroot"), "root")
    return _paths(levels, settle(above, "merkle-above"), fanout).select("row.*", "subroot", "root", "path")
