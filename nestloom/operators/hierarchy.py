"""Full hierarchies from parent-child rows.

Starting at the roots, each round joins the frontier to what lies below it and extends depth and
path.  A round descends several levels at once: what it joins are segments, the pairs of a node
and a descendant up to a stride below it, which are composed of the edges and doubled from round
to round for the nodes that are still unreached.  Nodes that no round reaches hang on a loop:
pointer jumping sends each of them onto its loop in logarithmically many rounds and gathers the
loop's smallest node on the way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nestloom.runtime import materialize, union_all

#: Levels that the first round descends, and the most that any round does.
STRIDE, MAX_STRIDE = 8, 64
#: Parents with over 1/HUBS of all edges, which are fewer than HUBS, are split; with fewer edges than HUB_EDGES none is.
HUBS, HUB_EDGES = 1_000, 10_000


def single_parents(nodes: DataFrame, statements: DataFrame) -> DataFrame:
    """``tree, node, parent`` for every distinct node; parent is null for roots.

    nodes has tree and node, statements has tree, node and parent; other columns are ignored.
    Statements about parents without a row are dropped; of several left for one node the
    smallest parent counts.  Null nodes are no nodes.
    """
    nodes = nodes.select("tree", "node").where("node IS NOT NULL").distinct()
    stated = statements.select("tree", "node", "parent").where("node IS NOT NULL AND parent IS NOT NULL")
    known = stated.join(nodes.select("tree", F.col("node").alias("parent")), ["tree", "parent"], "left_semi")
    chosen = known.groupBy("tree", "node").agg(F.min("parent").alias("parent"))
    return nodes.join(chosen, ["tree", "node"], "left")


def hierarchy(parents: DataFrame, with_path: bool = True, stride: int = STRIDE, hub_edges: int = HUB_EDGES) -> DataFrame:
    """``tree, node, root, depth`` and, if asked for, ``path`` (from the root to the node) of each node.

    ``parents`` is what ``single_parents`` returns.  A root has depth 0 and is its own root.
    Nodes on a loop and all below it have depth -1, the loop's smallest node as root, and no path.
    An empty table gives no rows.
    """
    parents = materialize(parents, "parents")
    path = [F.array("node").alias("path")] if with_path else []
    roots = parents.where("parent IS NULL").select("tree", "node", F.col("node").alias("root"), F.lit(0).alias("depth"), *path)
    edges = parents.where("parent IS NOT NULL")
    n_edges = edges.count()
    if not n_edges:
        return roots
    hubs = Hubs(edges, n_edges, hub_edges)
    steps = [F.array("node").alias("path")] if with_path else []
    segments = edges.select("tree", F.col("parent").alias("top"), "node", F.lit(1).alias("dist"), *steps)
    reach = 1
    while reach < stride:
        segments, reach = doubled(segments, reach, hubs, with_path), 2 * reach
    segments = materialize(segments, "segments")
    levels, frontier, depth, reached = [roots], roots, 0, 0
    while True:
        up = frontier.select("tree", F.col("node").alias("top"), "root", "depth", *[F.col("path").alias("above") for _ in path])
        further = hubs.joined(up, segments).select(
            "tree", "node", "root", (F.col("depth") + F.col("dist")).alias("depth"), *[F.concat("above", "path").alias("path") for _ in path]
        )
        level = materialize(further, "level")
        n, deepest = level.agg(F.count("*"), F.max("depth")).first()
        if n:
            levels.append(level)
            reached += n
        if not n or reached == n_edges or deepest < depth + reach:
            break
        depth += reach
        frontier = level.where(F.col("depth") == depth)
        unreached = segments.join(level.select("tree", "node"), ["tree", "node"], "left_anti")
        if reach < MAX_STRIDE:
            unreached, reach = doubled(unreached, reach, hubs, with_path), 2 * reach
        segments = materialize(unreached, "segments")
    trees = union_all(levels)
    if reached == n_edges:
        return trees
    caught = loops(edges.join(trees.select("tree", "node"), ["tree", "node"], "left_anti"), n_edges - reached, hub_edges)
    empty = [F.lit(None).cast(trees.schema["path"].dataType).alias("path")] if with_path else []
    return trees.unionByName(caught.select("tree", "node", F.col("low").alias("root"), F.lit(-1).alias("depth"), *empty))


class Hubs:
    """The parents with a large share of all edges, and joins that split what lies below them."""

    def __init__(self, edges: DataFrame, n_edges: int, hub_edges: int) -> None:
        self.fans = None
        if n_edges <= hub_edges:
            return
        counts = edges.groupBy("tree", F.col("parent").alias("top")).agg(F.count("*").alias("n"))
        large = counts.where((F.col("n") > hub_edges) & (F.col("n") * HUBS > n_edges))
        # fewer than HUBS rows by arithmetic
        rows = large.select("tree", "top", F.ceil(F.col("n") * HUBS / n_edges).cast("int").alias("fan")).collect()
        if rows:
            self.fans = edges.sparkSession.createDataFrame(rows, large.select("tree", "top", F.lit(1).alias("fan")).schema)

    def joined(self, up: DataFrame, below: DataFrame) -> DataFrame:
        """``up`` (tree, top, ...: each once) and the rows ``below`` (tree, top, node, ...) it."""
        if self.fans is None:
            return below.join(up, ["tree", "top"])
        fans = F.broadcast(self.fans)
        fan = F.coalesce("fan", F.lit(1))
        many = up.join(fans, ["tree", "top"], "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), fan - 1))).drop("fan")
        split = below.join(fans, ["tree", "top"], "left").withColumn("_salt", F.pmod(F.xxhash64("node"), fan).cast("int")).drop("fan")
        return split.join(many, ["tree", "top", "_salt"]).drop("_salt")


def doubled(segments: DataFrame, reach: int, hubs: Hubs, with_path: bool) -> DataFrame:
    """Segments (tree, top, node, dist) up to twice as far as ``reach``."""
    far = segments.where(F.col("dist") == reach)
    up = far.select("tree", F.col("top").alias("start"), F.col("node").alias("top"), *([F.col("path").alias("above")] if with_path else []))
    on = hubs.joined(up, segments)
    on = on.select("tree", F.col("start").alias("top"), "node", (F.col("dist") + reach).alias("dist"), *([F.concat("above", "path").alias("path")] if with_path else []))
    return segments.unionByName(on)


def loops(loose: DataFrame, n: int, hub_edges: int = HUB_EDGES) -> DataFrame:
    """``tree, node, low``: the smallest node of the loop that each of the ``n`` nodes of ``loose`` leads to.

    Every node of ``loose`` (tree, node, parent) has its parent there too.
    """
    # top: the node 2^k parents up; low: the smallest of the 2^k nodes before it
    jumps = materialize(loose.select("tree", "node", F.col("parent").alias("top"), F.col("node").alias("low")), "loose")
    rounds = max(1, (n - 1).bit_length() + 1)
    for k in range(rounds + 1):
        there = jumps.select("tree", F.col("node").alias("top"), F.col("top").alias("further"), F.col("low").alias("low_there"))
        # many nodes may jump to one node of a loop
        both = Hubs(jumps.select("tree", F.col("top").alias("parent")), n, hub_edges).joined(there, jumps)
        if k == rounds:  # each jump ends on the loop, and what is gathered from there covers the whole loop
            return both.select("tree", "node", F.col("low_there").alias("low"))
        jumps = both.select("tree", "node", F.col("further").alias("top"), F.least("low", "low_there").alias("low"))
        if n > hub_edges or k % 3 == 2:  # few nodes are cheaper to join again than to write
            jumps = materialize(jumps, "jumps")
    return jumps


def descendants(tree: DataFrame) -> DataFrame:
    """``tree, ancestor, node, distance`` of all pairs of a node and a node above it, from the paths of ``hierarchy``."""
    pairs = tree.where("depth > 0").select("tree", "node", "depth", F.posexplode(F.slice("path", 1, F.col("depth"))).alias("level", "ancestor"))
    return pairs.select("tree", "ancestor", "node", (F.col("depth") - F.col("level")).cast("int").alias("distance"))
