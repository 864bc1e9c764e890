"""Merkle dataset manifest with proofs by pointer jumping.

Every row is a leaf. Per language, and then over the languages' subroots, runs
of eight consecutive nodes become their parent. A proof is the siblings on the
way from a leaf to the root.

Positions come from a range sort, not from a window: rows are range-partitioned
by language and id (equal rows are spread by a running number), numbered where
they stand, and a table with one row per partition and language turns these
numbers into positions. Parents are then groupings of eight rows, so a language
with most of the rows is dealt out like any other.

Proofs: each inner node first points at its parent and holds the segment of
siblings beside it. In every round each node that does not reach the root yet is
joined with the node it points at, its segment is followed by that node's, and
its pointer becomes that node's: the distance doubles. A tree of height h needs
log2(h) rounds. Leaves jump last, all eight of a parent in one row, so that the
segment of the way up is shuffled once a parent and not once a leaf. Nodes that
very many others point at are few (one per 8^distance leaves): up to ``FEW`` rows
they are broadcast, beyond that none is pointed at by more than a small share.

Defined results: NULL languages are one language, the first; NULL ids come
first in theirs; rows that repeat an id stand in order of their digests, and
equal rows are leaves of their own. Without rows there is no root and no row. A
table of one row has its leaf as root and an empty proof. Extra columns are
ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subpulse.session import settle

FANOUT = 8
#: Rows of nodes pointed at that may be broadcast; each holds at most a few kilobytes.
FEW = 4096
#: The tree over the subroots; a language's tree has the language's number, from 0.
TOP = -1


def digest(*parts: Column) -> Column:
    """SHA-256 of the concatenated parts, as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*parts), 256))


def hexed(value: str | Column) -> Column:
    return F.lower(F.hex(value))


def leaf_digest(**replaced: Column) -> Column:
    """A row's digest over doc_id, source, lang, n_chars and text, where ``replaced`` stand for columns of their name."""
    def part(name: str) -> Column:
        value = replaced.get(name, F.col(name)).cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return digest(*map(part, ("doc_id", "source", "lang", "n_chars", "text")))


def numbered(rows: DataFrame, order: list[str], group: str | None = None) -> tuple[DataFrame, DataFrame]:
    """``rows`` with ``part`` and ``place``, in order, and (part, [group,] n, first, before) to make positions of them.

    A row's position in its group is ``place - first + before``.
    """
    rows = rows.withColumn("copy", F.monotonically_increasing_id())  # spreads equal rows
    by = [F.asc_nulls_first(c) for c in (*order, "copy")]
    placed = settle(rows.repartitionByRange(*by).sortWithinPartitions(*by).drop("copy").withColumns(
        {"part": F.spark_partition_id(), "place": F.monotonically_increasing_id()}), "placed")
    runs = placed.groupBy("part", *[group] * bool(group)).agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = (Window.partitionBy(F.col(group) if group else F.lit(0)).orderBy("part")
               .rowsBetween(Window.unboundedPreceding, -1))
    return placed, settle(runs.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))), "runs")


def leaves(documents: DataFrame, claimed: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(tree, at, width, doc_id, leaf, claimed): every leaf's tree, position and its tree's number of leaves; and the trees."""
    rows = settle(documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), leaf_digest().alias("leaf"),
        (claimed if claimed is not None else F.lit(None).cast("binary")).alias("claimed")), "leaves")
    placed, runs = numbered(rows, ["lang", "doc_id", "leaf"], "lang")
    sizes = runs.groupBy("lang").agg(F.sum("n").alias("width"))
    langs, lang_runs = numbered(sizes, ["lang"])
    trees = settle(langs.join(lang_runs.drop("n"), "part").select(
        "lang", "width", (F.col("place") - F.col("first") + F.col("before")).alias("tree")), "trees")
    known = runs.join(trees.withColumnRenamed("lang", "its"), F.col("lang").eqNullSafe(F.col("its"))).select(
        F.struct("part", "lang").alias("run"), "first", "before", "tree", "width")
    found = placed.withColumn("run", F.struct("part", "lang")).join(settle(known, "runs"), "run")
    return found.select("tree", (F.col("place") - F.col("first") + F.col("before")).alias("at"), "width", "doc_id", "leaf",
                        "claimed"), trees


def families(nodes: DataFrame, level: int, *kept: str) -> DataFrame:
    """Parents of ``nodes`` (tree, at, width, digest): node, tree, at, width, digest, children in order, and the
    children's own width."""
    child = F.struct("at", "digest", *kept)
    grouped = nodes.groupBy("tree", F.expr(f"at div {FANOUT}").alias("up")).agg(
        F.sort_array(F.collect_list(child)).alias("children"), F.max("width").alias("below"))
    joined = F.array_join(F.transform("children", lambda c: hexed(c["digest"])), "")
    return grouped.select("tree", F.col("up").alias("at"), F.expr(f"(below + {FANOUT - 1}) div {FANOUT}").alias("width"),
                          digest(joined).alias("digest"), "children", "below").withColumn(
        "node", F.struct("tree", F.lit(level).alias("level"), "at"))


def _beside(children: str, nth: str) -> Column:
    """The siblings before and after the child at place ``nth``, from 0."""
    def joined(part: Column) -> Column:
        return F.unhex(F.array_join(F.transform(part, lambda c: F.hex(c["digest"])), ""))

    after = F.greatest(F.size(children) - F.col(nth) - 1, F.lit(0))
    return F.struct(joined(F.slice(children, F.lit(1), F.col(nth))).alias("left"),
                    joined(F.slice(children, F.col(nth) + 2, after)).alias("right"))


def climb(nodes: DataFrame, level: int, width: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """Edges (node, ptr, segment, own digest) of ``nodes`` and all above them, and the nodes that have no parent."""
    edges, tops = [], [nodes.filter("width = 1")]
    while width > 1:
        level, width = level + 1, -(-width // FANOUT)
        parents = settle(families(nodes.filter("width > 1"), level, "node"), "parents")
        edges.append(parents.select(F.col("node").alias("ptr"), "children", F.posexplode("children").alias("nth", "child"))
                     .select(F.col("child.node").alias("node"), "ptr", F.array(_beside("children", "nth")).alias("segment"),
                             F.col("child.digest").alias("own")))
        nodes = parents.drop("children", "below")
        tops.append(nodes.filter("width = 1"))
    return edges, tops


def jumped(edges: DataFrame, root: tuple[int, int, int], height: int) -> DataFrame:
    """(node, segment, subroot): the siblings on each node's way to the root, by doubling the distance it looks ahead."""
    at_root = F.col("ptr") == F.struct(*[F.lit(x).cast(t).alias(n) for x, t, n in zip(
        root, ("long", "int", "long"), ("tree", "level", "at"), strict=True)])
    ways, distance = settle(edges, "ways"), 1
    while distance < height:
        higher = ways.filter((F.col("node.tree") == TOP) | (F.col("node.level") > distance))  # none below is pointed at
        ahead = higher.select(F.col("node").alias("ptr"), F.col("ptr").alias("next"), F.col("segment").alias("rest"),
                              F.col("subroot").alias("its_subroot"))
        moved = ways.filter(~at_root).join(F.broadcast(ahead) if higher.count() <= FEW else ahead, "ptr").select(
            "node", F.col("next").alias("ptr"), F.concat("segment", "rest").alias("segment"),
            F.coalesce("subroot", "its_subroot").alias("subroot"))
        ways = settle(ways.filter(at_root).unionByName(moved), "ways")
        distance *= 2
    return ways.drop("ptr")


def manifest(documents: DataFrame, claimed: Column | None = None) -> DataFrame:
    """One row per document: doc_id, leaf, claimed, subroot, root (32 bytes each) and proof, the siblings left and right
    of the way, level by level. ``claimed`` is another digest of the row, to be held against the proof."""
    found, trees = leaves(documents, claimed)
    widest, n_trees = trees.agg(F.max("width"), F.count(F.lit(1))).first()
    lowest = settle(families(found.withColumnRenamed("leaf", "digest"), 1, "doc_id", "claimed"), "families")
    lone = lowest.filter("below = 1").select(  # a leaf without siblings has no parent in its tree
        "tree", F.struct("tree", F.lit(0).alias("level"), "at").alias("node"), F.col("children")[0]["digest"].alias("digest"),
        "children")
    lowest = lowest.filter("below > 1").drop("below")
    edges, tops = climb(lowest.drop("children"), 1, -(-(widest or 0) // FANOUT))
    subroots = reduce(DataFrame.unionByName, [t.select("tree", "node", "digest") for t in (lone, *tops)])
    subroots = settle(subroots.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("at"),
                                      F.lit(n_trees).cast("long").alias("width"), "digest", "node"), "subroots")
    top_edges, summit = climb(subroots, 0, n_trees)
    top = reduce(DataFrame.unionByName, [s.select("digest", "node") for s in summit]).first()  # the root, or no row at all
    at = tuple(top["node"]) if top else (TOP, 0, 0)
    root, none = F.lit(top and top["digest"]).cast("binary"), F.lit(None).cast("binary")
    rows = [e.select("node", "ptr", "segment", none.alias("subroot")) for e in edges]
    rows += [e.select("node", "ptr", "segment", (F.col("own") if i == 0 else none).alias("subroot"))
             for i, e in enumerate(top_edges)]
    if rows:
        ways = jumped(reduce(DataFrame.unionByName, rows), at, len(edges) + len(top_edges))
    else:  # one leaf, or one family
        ways = lowest.select("node", F.lit(None).cast("array<struct<left: binary, right: binary>>").alias("segment"),
                             none.alias("subroot")).limit(0)
    parents = lowest.select("node", "children").unionByName(lone.select("node", "children"))
    way = F.coalesce("segment", F.array().cast("array<struct<left: binary, right: binary>>"))
    out = parents.join(ways, "node", "left").select("*", F.posexplode("children").alias("nth", "child"))
    return out.select(
        F.col("child.doc_id").alias("doc_id"), F.col("child.digest").alias("leaf"), F.col("child.claimed").alias("claimed"),
        F.coalesce("subroot", root).alias("subroot"), root.alias("root"),
        F.when(F.col("node.level") == 0, way).otherwise(F.concat(F.array(_beside("children", "nth")), way)).alias("proof"))


def folded(leaf: Column, proof: str = "proof") -> Column:
    """The root that follows from a leaf and its proof, as 32 bytes."""
    return F.unhex(F.aggregate(proof, hexed(leaf), lambda below, s: F.sha2(
        F.concat(hexed(s["left"]), below, hexed(s["right"])), 256)))


def proof_digest(proof: str = "proof") -> Column:
    """SHA-256 of all siblings of a proof, from the leaf up and left to right."""
    return digest(F.array_join(F.transform(proof, lambda s: F.concat(hexed(s["left"]), hexed(s["right"]))), ""))
