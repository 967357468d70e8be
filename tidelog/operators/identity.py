"""Identity resolution by connected components (G1–G4, J5).

G1 vertices: the non-blank identifiers of every row. G2 edges: the row's first
identifier to each of the others. G3 components, in three steps:

1. the edges are brought together by their first identifier, and each task joins up its
   own, some million at a time: every identifier there gets the number of its component
   among these edges, its part, and a part its least identifier;
2. the parts that an identifier lies in are linked, after one shuffle by identifier;
3. the parts, about one for a first identifier at the most, in whatever order the rows
   come, are made components by edge contraction, on two numbers an edge.

A component is named by the least identifier of its parts. A round of the contraction:

1. each task replaces edges by as few that join the same vertices, in the way above;
2. each vertex that still has edges hooks to the least of itself and its neighbours,
   in an order that is another one every round;
3. the ends of all edges are renamed to what they hook to, and loops go.

The renamed graph has the same components, and only vertices that some neighbourhood
has as its least one are left, hardly any of a hub's neighbours. So vertices and edges
fall by a constant factor, and rounds grow with the logarithm of the number of vertices,
whatever names the vertices have and however long the paths are; a graph that fits one
batch of a task is done in one round. In the end the hooks of all rounds are followed,
from the last and smallest round to the first.

Scale notes: identifiers are shuffled as text twice, with their edges and to meet
themselves, and once more to meet the name of their part where the parts are too many to
be broadcast. Without the first of these, rows in no order would have about as many parts
as edges, and each identifier would come once per edge. It is a rebalance, so the edges of
a hub are dealt out over several tasks, which only makes some more parts. A task's edges
are sorted by both ends, so one that runs again numbers its parts alike. Tables of a step
are stored in the shared checkpoint folder, so a lost executor costs at most one step;
nothing stays in storage memory. Joins that
meet a hot key (the edges of a hub, the identifiers of a giant part) are between two
plain scans, the case that Spark's skew join splits; groupings by vertex aggregate before
their shuffle. No step collects a component into one row or one task.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.functions.text import non_blank_array
from tidelog.session import remove_path, scratch_path, stored


# Edges that a task joins up at a time, and rows of a batch that it passes on.
EDGES_AT_ONCE = 1 << 20
_ROWS = 1 << 16

# Parts are numbered by the task and so many bits for each task's own.
_PART_BITS = 40

# The lower half of a number.
_HALF = 0xFFFFFFFF


class Components(NamedTuple):
    labels: DataFrame  # (id, component)
    sizes: DataFrame  # (component, n_members)


def identifier_arrays(rows: DataFrame, id_cols: Sequence[str], typed: bool = False) -> DataFrame:
    """One ``ids`` array per row (non-blank identifiers, column order); rows
    without any identifier are dropped. ``typed`` prefixes the column name so
    equal strings of different kinds stay apart."""
    cols = [F.concat(F.lit(c + ":"), F.col(c).cast("string")) if typed else F.col(c) for c in id_cols]
    if typed:
        cols = [F.when(F.col(c).cast("string").rlike(r"\S"), x) for c, x in zip(id_cols, cols)]
    return rows.select(non_blank_array(cols).alias("ids")).where(F.size("ids") > 0)


def vertices(id_arrays: DataFrame) -> DataFrame:
    return id_arrays.select(F.explode("ids").alias("id")).distinct()


def star_edges(id_arrays: DataFrame, alone: bool = False) -> DataFrame:
    """First identifier of a row -> each other identifier of it; with ``alone``, a row's
    only identifier -> null."""
    others = F.slice("ids", 2, F.size("ids") - 1)
    return id_arrays.where(F.size("ids") >= (1 if alone else 2)).select(
        F.col("ids")[0].alias("src"), (F.explode_outer(others) if alone else F.explode(others)).alias("dst")
    )


def _joined(one: np.ndarray, two: np.ndarray, n: int) -> np.ndarray:
    """Edges between the places 0 to n - 1 -> for each place the least of its component.
    Whoever has a lesser neighbour hooks to its least; one that has none is met by a
    lesser one in the round after, so every two rounds halve what is apart."""
    root = np.arange(n)
    while len(one):
        np.minimum.at(root, np.maximum(one, two), np.minimum(one, two))
        while not np.array_equal(above := root[root], root):
            root = above
        one, two = root[one], root[two]
        apart = one != two
        one, two = one[apart], two[apart]
    return root


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.Array]]:
    """(src, dst) of EDGES_AT_ONCE rows, about."""
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= EDGES_AT_ONCE:
            yield tuple(pa.concat_arrays([b.column(i) for b in held]) for i in (0, 1))
            held, n = [], 0
    if n:
        yield tuple(pa.concat_arrays([b.column(i) for b in held]) for i in (0, 1))


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(src, dst or null) -> (id, part, least): each chunk's ids with the number of
    their component there, and whether they are its least."""
    made = TaskContext.get().partitionId() << _PART_BITS
    for src, dst in _chunks(batches):
        coded = pa.concat_arrays([src, dst]).dictionary_encode()
        order = pc.sort_indices(coded.dictionary)
        place = np.empty(len(order), np.int64)
        place[order.to_numpy()] = np.arange(len(order))
        linked = dst.is_valid().to_numpy(zero_copy_only=False)
        one = place[coded.indices.slice(0, len(src)).filter(pa.array(linked)).to_numpy(zero_copy_only=False)]
        two = place[coded.indices.slice(len(src)).drop_null().to_numpy(zero_copy_only=False)]
        root = _joined(one, two, len(order))
        least = root == np.arange(len(order))
        part = (made + np.cumsum(least) - 1)[root]
        made += int(least.sum())
        out = pa.RecordBatch.from_arrays([coded.dictionary.take(order), pa.array(part), pa.array(least)], names=["id", "part", "least"])
        yield from (out.slice(at, _ROWS) for at in range(0, len(out), _ROWS))


def _placed(edges: DataFrame) -> DataFrame:
    """(src, dst) edges, dst null for an id alone -> (id, part, least), one row or more
    an id."""
    kind = edges.schema["src"].dataType.simpleString()
    pairs = edges.where(F.col("src").isNotNull()).select("src", F.col("dst").cast(kind).alias("dst"))
    near = pairs.hint("rebalance", F.col("src")).sortWithinPartitions("src", "dst")
    return near.mapInArrow(_parts, f"id {kind}, part long, least boolean")


def _met(placed: DataFrame) -> DataFrame:
    """(id, part, other, least): the id's parts in order, each with the one before; the
    first one, where that is null, stands for the id."""
    return placed.select("id", "part", F.lag("part").over(Window.partitionBy("id").orderBy("part")).alias("other"), "least")


def _factor(step: int) -> int:
    return 0x9E3779B1 * (2 * step + 1) & 0x7FFFFFFF | 1


def _in_order(name: str, step: int) -> Column:
    """A vertex's place in the order of a round: the upper half of its number is changed
    by a multiple of the lower one. Done twice, that gives the number back."""
    spread = (F.col(name).bitwiseAND(_HALF) * F.lit(_factor(step)).cast("long")).bitwiseAND(_HALF)
    return F.col(name).bitwiseXOR(F.shiftleft(spread, 32))


def _places(numbers: np.ndarray, step: int) -> np.ndarray:
    """The same of an array."""
    return numbers ^ ((numbers & _HALF) * _factor(step) & _HALF) << 32


def _joined_up(edges: DataFrame, step: int) -> DataFrame:
    """Edges that join the same vertices, as stars around the least in the round's
    order; fewer, where a task's edges make up circles."""

    def stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for src, dst in _chunks(batches):
            ends = np.concatenate([src.to_numpy(), dst.to_numpy()])
            places, at = np.unique(_places(ends, step), return_inverse=True)
            root = _joined(at[: len(src)], at[len(src) :], len(places))
            numbers, member = _places(places, step), np.flatnonzero(root != np.arange(len(places)))
            out = pa.RecordBatch.from_arrays([pa.array(numbers[member]), pa.array(numbers[root[member]])], names=["src", "dst"])
            yield from (out.slice(i, _ROWS) for i in range(0, len(out), _ROWS))

    return edges.select("src", "dst").mapInArrow(stars, "src long, dst long")


def _hooks(edges: DataFrame, step: int) -> DataFrame:
    """(id, up): every vertex with edges and the least of itself and its neighbours."""
    least = F.least(_in_order("src", step), _in_order("dst", step))
    ways = F.array(F.struct(F.col("src").alias("id"), least.alias("up")), F.struct(F.col("dst").alias("id"), least.alias("up")))
    near = edges.select(F.inline(ways)).groupBy("id").agg(F.min("up").alias("up"))
    return near.select("id", _in_order("up", step).alias("up"))


def contract(edges: DataFrame, base: str) -> DataFrame:
    """(src, dst) numbers, not negative -> (id, root): for every vertex with an
    edge to another one one and the same vertex of its component. Tables of the run lie
    below ``base``."""
    spark = edges.sparkSession
    left = stored(_joined_up(edges.where(F.col("src") != F.col("dst")), 1), f"{base}/edges-0")
    hooks: list[DataFrame] = []
    while not left.isEmpty():
        step = len(hooks) + 1
        up = stored(_hooks(left, step), f"{base}/hooks-{step}")
        one, two = up.toDF("src", "src_up"), up.toDF("dst", "dst_up")
        # Most edges lead to what their one end hooks to: of these, one is enough.
        half = left.join(one, "src").where("src_up != dst").select(F.col("src_up").alias("src"), "dst")
        half = half.unionByName(up.select(F.col("up").alias("src")).distinct().withColumn("dst", F.col("src")))
        renamed = half.join(two, "dst").where("src != dst_up").select("src", F.col("dst_up").alias("dst"))
        left = stored(_joined_up(renamed, step + 1), f"{base}/edges-{step}")
        remove_path(spark, f"{base}/edges-{step - 1}")
        hooks.append(up)
    if not hooks:
        return left.toDF("id", "root")
    # What the last round's vertices hook to are roots: nothing is above them. What an
    # earlier round's vertices hook to are the vertices of the next round, or roots.
    rooted, held = hooks[-1].toDF("id", "root"), f"{base}/hooks-{len(hooks)}"
    for step in range(len(hooks) - 1, 0, -1):
        found = hooks[step - 1].join(rooted.toDF("up", "root"), "up", "left").select("id", F.coalesce("root", "up").alias("root"))
        rooted = stored(found, f"{base}/roots-{step}")
        remove_path(spark, held)
        remove_path(spark, f"{base}/hooks-{step}")
        held = f"{base}/roots-{step}"
    return rooted


def _with_tops(parts: DataFrame, links: DataFrame, base: str) -> DataFrame:
    """(part, ...) and links (other, part) -> (..., top): one and the same part for all
    parts of a component, null for a part without links; stored."""
    tops = contract(links.select(F.col("other").alias("src"), F.col("part").alias("dst")), base).toDF("part", "top")
    return stored(parts.join(tops, "part", "left"), f"{base}/parts")


class _Resolved(NamedTuple):
    ids: DataFrame  # (id, part): the distinct ids, each with one of its parts
    names: DataFrame  # (part, component)


def _resolve(edges: DataFrame, base: str) -> _Resolved:
    """(src, dst) edges, dst null for an id alone -> ids by parts, and parts' names."""
    first = F.col("other").isNull()
    met = _met(_placed(edges)).select(F.when(first | F.col("least"), F.col("id")).alias("id"), "part", "other", "least")
    met = stored(met, f"{base}/met")
    parts = _with_tops(met.where("least").select("part", "id"), met.where(~first), base)
    # A part without links is a component, which its least identifier names.
    linked, alone = parts.where(F.col("top").isNotNull()), parts.where(F.col("top").isNull())
    least = stored(linked.groupBy("top").agg(F.min("id").alias("component")), f"{base}/least")
    names = alone.select("part", F.col("id").alias("component")).unionByName(linked.join(least, "top").select("part", "component"))
    return _Resolved(met.where(first).select("id", "part"), names)


def connected_components(vertex_ids: DataFrame, edges: DataFrame) -> DataFrame:
    """(id) vertices + (src, dst) edges -> (id, component = smallest id)."""
    ids, names = _resolve(edges.where(F.col("src") != F.col("dst")), scratch_path(edges.sparkSession, "components"))
    labels = ids.join(names, "part").select("id", "component")
    return vertex_ids.join(labels, "id", "left").select("id", F.coalesce("component", "id").alias("component"))


class Advanced(NamedTuple):
    labels: DataFrame  # (id, component): the whole table after the batch
    changes: DataFrame  # (id, component): its rows that are new or named otherwise
    merges: DataFrame  # (old_component, component): names that were given up


def advance_identities(labels: DataFrame, rows: DataFrame, id_cols: Sequence[str], typed: bool = False) -> Advanced:
    """Yesterday's labels and one batch of rows -> today's labels.

    The batch's identifiers stand for their components, the others for themselves, and
    the components of this small graph are found by the same contraction: its vertices
    are what the batch names, however large the components behind them are. Names last:
    a component keeps its name as long as it meets no other; where components meet, the
    smallest of their names stays and the others go to ``merges``. Only a component of
    new identifiers alone is named by its smallest member. So a name is always one of
    the component's members, though not always the smallest.

    ``labels`` is read (id, component), one row an id; columns beside these are left
    out. A batch that was taken in before changes nothing. The other results are views
    of ``changes`` and ``merges`` over yesterday's table: renamed members are found by
    one join with the merge log, and a table kept by key needs ``changes`` only.
    """
    spark = rows.sparkSession
    base = scratch_path(spark, "advance")
    before = labels.select("id", F.col("component").alias("held"))
    arrays = identifier_arrays(rows, id_cols, typed)
    met = _met(_placed(star_edges(arrays, alone=True)))
    first = F.col("other").isNull()
    known = met.join(before, "id", "left").select(
        F.when(first | F.col("least"), F.col("id")).alias("id"), "part", "other", "least", F.when(first, F.col("held")).alias("held")
    )
    known = stored(known, f"{base}/known")
    # Parts that hold identifiers of the same old component are linked.
    old = stored(known.where(F.col("held").isNotNull()).select("part", F.col("held").alias("name")).distinct(), f"{base}/old")
    links = old.select("part", F.lag("part").over(Window.partitionBy("name").orderBy("part")).alias("other")).unionByName(known.select("part", "other"))
    # A name is an identifier of yesterday, so no new one is the same string; old names
    # come before new identifiers, whatever they look like: the least struct of a
    # component is its smallest old name, if it has one.
    parts = known.where("least").select("part", F.lit(True).alias("fresh"), F.col("id").alias("name")).unionByName(old.withColumn("fresh", F.lit(False)))
    parts = _with_tops(parts, links.where(F.col("other").isNotNull()), base).withColumn("top", F.coalesce("top", "part"))
    least = stored(parts.groupBy("top").agg(F.min(F.struct("fresh", "name"))["name"].alias("component")), f"{base}/least")
    named = parts.where(~F.col("fresh")).join(least, "top").where("name != component")
    merges = stored(named.select(F.col("name").alias("old_component"), "component").distinct(), f"{base}/merges")
    fresh = parts.where("fresh").join(least, "top").select("part", "component")
    new = known.where(first & F.col("held").isNull()).join(fresh, "part").select("id", "component")
    renamed = before.join(merges.withColumnRenamed("old_component", "held"), "held").select("id", "component")
    kept = before.join(merges.withColumnRenamed("old_component", "held"), "held", "left")
    remove_path(spark, f"{base}/old")
    return Advanced(kept.select("id", F.coalesce("component", "held").alias("component")).unionByName(new), renamed.unionByName(new), merges)


def resolve_identities(rows: DataFrame, id_cols: Sequence[str], typed: bool = False) -> Components:
    ids, names = _resolve(star_edges(identifier_arrays(rows, id_cols, typed), alone=True), scratch_path(rows.sparkSession, "components"))
    counts = ids.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    sizes = counts.join(names, "part").groupBy("component").agg(F.sum("n").alias("n_members"))
    return Components(ids.join(names, "part").select("id", "component"), sizes)


def component_members(labels: DataFrame) -> DataFrame:
    """G4 in long form: (component, member), one row per member. Members are
    never gathered into one row, so a giant component stays distributed."""
    return labels.select("component", F.col("id").alias("member"))


def member_pages(labels: DataFrame, per_page: int = 1000) -> DataFrame:
    """A7, G4 as lists: (component, page, members), at most ``per_page`` members a row,
    in order over the pages (numbered from 0).

    A component's members are sorted over range partitions, so a giant one lies in
    several; places go on from the parts before, and only a page is ever one row."""
    base = scratch_path(labels.sparkSession, "pages")
    placed = stored(labels.repartitionByRange("component", "id").select("component", "id", F.spark_partition_id().alias("part")), f"{base}/sorted")
    counts = placed.groupBy("component", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("component").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("component", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    within = F.row_number().over(Window.partitionBy("component", "part").orderBy("id")) - 1
    numbered = placed.withColumn("at", within).join(starts, ["component", "part"])
    page = F.floor((F.col("at") + F.col("start")) / per_page).cast("long")
    return numbered.groupBy("component", page.alias("page")).agg(F.array_sort(F.collect_list("id")).alias("members"))
