"""Connected components of links between documents, by edge contraction.

Every round each node that still has links hooks to the least of itself and its
neighbours, in an order that is hashed anew every round; then the ends of all links
are renamed to what they hook to, and loops and repeats go. Only nodes that are the
least of some neighbourhood are left, so nodes and links fall by a constant factor and
rounds grow with the logarithm of the number of nodes, also on long chains. In the end
the hooks are followed from the last round to the first, and a component is named by
its smallest id. Tables of a round are written to the shared folder; all joins that
can meet a hot key are between two plain scans, which Spark splits at hot keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import discard, materialize


def _distinct(links: DataFrame) -> DataFrame:
    return links.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _place(name: str, step: int) -> Column:
    """A node's place in the order of a round; equal hashes are told apart by the id."""
    return F.struct(F.xxhash64(F.lit(step), name).alias("h"), F.col(name).alias("id"))


def _hooks(links: DataFrame, step: int) -> DataFrame:
    """(node, up): every node with links and the least of itself and its neighbours."""
    least = F.least(_place("a", step), _place("b", step))
    ends = F.array(F.struct(F.col("a").alias("node"), least.alias("up")), F.struct(F.col("b").alias("node"), least.alias("up")))
    return links.select(F.inline(ends)).groupBy("node").agg(F.min("up")["id"].alias("up"))


def connected_components(links: DataFrame) -> DataFrame:
    """links: (a, b) long pairs. Returns (node, component) for every node that
    has a link; component is the smallest id reachable. Null ends are ignored,
    repeated links and self-links change nothing, no link gives no row."""
    left = materialize(_distinct(links.where("a is not null and b is not null")))
    hooks: list[DataFrame] = []
    while not left.isEmpty():
        up = materialize(_hooks(left, len(hooks) + 1))
        renamed = left.join(up.toDF("a", "a_up"), "a").join(up.toDF("b", "b_up"), "b").select(F.col("a_up").alias("a"), F.col("b_up").alias("b"))
        shrunk = materialize(_distinct(renamed))
        discard(left)
        left = shrunk
        hooks.append(up)
    # Nodes without links by the next round are roots: nothing is above them.
    rooted = left.toDF("node", "root")
    for up in reversed(hooks):
        found = materialize(up.join(rooted.toDF("up", "root"), "up", "left").select("node", F.coalesce("root", "up").alias("root")))
        discard(up)
        discard(rooted)
        rooted = found
    names = rooted.groupBy("root").agg(F.min("node").alias("component"))
    labels = materialize(rooted.join(names, "root").select("node", "component"))
    discard(rooted)
    discard(left)
    return labels
