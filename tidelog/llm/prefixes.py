"""A prefix trie of conversations, as double-array tries per prefix shard.

A node of depth d is a distinct sequence of the first d turns, named by a digest
of that sequence; the root has depth 0. Steps:

1. Turns become digests and get their places. The table is sorted over range
   partitions, so a conversation with very many turns lies in several of them; its
   parts' places go on from each other.
2. Every turn gets the digest of the sequence up to it: a polynomial over a
   127-bit prime field, worked out in segments that go on from each other too.
3. Conversations of one and the same sequence become one path with its smallest
   conv_id and its number of members: a large group of copies is one path.
4. A node with more than ``ROWS_BELOW`` turns of distinct paths below it is an upper
   node. What hangs below the upper nodes are subtrees of bounded size. They are
   dealt to shards; a shard packs its subtrees into BASE and CHECK arrays over dense
   turn ids, and walks them for the nodes and their aggregates.
5. Upper nodes are shared by shards: their aggregates come together globally. Each
   subtree, and each upper node's own part, is counted on one path that leads to it,
   as a running sum from the path's end, and the paths' sums meet at every node.

So neither a long conversation, nor a first turn that a third of all conversations
share, nor a third of all conversations being copies lands in one task.

Defined results: rows with a null conv_id take no part; turns of one number (also
null, which comes first) are ordered by role and then by the digest of role and
text; repeated rows are turns of their own; null role or text is empty. An empty
table has no node, not even the root. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import materialize

#: Turns of distinct paths below a node, from which on it is an upper node.
ROWS_BELOW = 1024
ROWS_PER_SHARD = 32768
#: Turns of a conversation that are worked on at once.
SEGMENT = 4096
#: conv_ids of a node's ends that are written as one piece of text, as a power of 2.
PIECE_BITS = 12

#: Sequence digests: h -> (h * FACTOR + turn + 1) modulo PRIME; the root's is 0.
PRIME = (1 << 127) - 1
FACTOR = int.from_bytes(hashlib.blake2b(b"conversation prefix", digest_size=15).digest(), "little")
ROOT = bytes(16)
EMPTY = hashlib.sha256(b"").hexdigest()

NODE = "node binary, parent binary, depth long, conv_id long, n_convs long, n_children long, n_leaves long, saved long, top boolean"


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """conv, place (from 0), turn digest and bytes of the text, of every turn."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.md5(F.concat(F.md5(role), text)))
    read = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("number"), role.alias("role"), digest.alias("turn"), F.octet_length(text).cast("long").alias("bytes")
    )
    keys = ["conv", F.asc_nulls_first("number"), "role", "turn"]
    spread = materialize(read.repartitionByRange(*keys).withColumn("part", F.spark_partition_id()))
    within = Window.partitionBy("conv", "part").orderBy(F.asc_nulls_first("number"), "role", "turn")
    counts = spread.groupBy("conv", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = materialize(counts.select("conv", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")))
    placed = spread.withColumn("at", F.row_number().over(within) - 1).join(starts, ["conv", "part"])
    return materialize(placed.select("conv", (F.col("at") + F.col("start")).alias("place"), "turn", "bytes"))


def rebuilt_turns(turns: DataFrame, modulus: int = 5, heads: int = 9) -> tuple[DataFrame, DataFrame]:
    """The turns (conv, depth, turn, bytes) of rebuilt conversations, and every
    conversation's length (conv, length).

    A conversation c takes the first h turns of c - c % ``modulus`` and then its own
    after its first h, where h is crc32(c) % ``heads``.
    """
    lengths = materialize(turns.groupBy("conv").agg(F.count(F.lit(1)).alias("n")))
    head = F.crc32(F.col("conv").cast("string").cast("binary")) % heads
    plan = lengths.select("conv", "n", head.alias("h"), (F.col("conv") - F.col("conv") % modulus).alias("first"))
    bases = lengths.select(F.col("conv").alias("first"), F.col("n").alias("base_n"))
    plan = plan.join(bases, "first", "left").withColumn("taken", F.least("h", F.coalesce("base_n", F.lit(0))))
    plan = materialize(plan.select("conv", "first", "h", "taken", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")))
    own = turns.join(plan, "conv").where("place >= h").select("conv", (F.col("place") - F.col("h") + F.col("taken") + 1).alias("depth"), "turn", "bytes")
    # At most heads - 1 turns of a conversation, for at most 2 * modulus - 1 others.
    lent = turns.where(F.col("place") < heads - 1).withColumnRenamed("conv", "first")
    taken = lent.join(plan.select("conv", "first", "taken"), "first").where("place < taken").select("conv", (F.col("place") + 1).alias("depth"), "turn", "bytes")
    return own.unionByName(taken), plan.select("conv", "length")


def _segment_digests(batches: Iterator[pa.RecordBatch], start: bool) -> Iterator[pa.RecordBatch]:
    """For rows in the order of (conv, segment, depth): with ``start``, the digest
    of every prefix and of the one before it; else each segment's own digest."""
    last, h, before = None, 0, 0
    for batch in batches:
        conv, segment, turn = (batch.column(c).to_pylist() for c in ("conv", "segment", "turn"))
        carried = batch.column("carried").to_pylist() if start else None
        nodes, parents, ends = [], [], []
        for i, key in enumerate(zip(conv, segment)):
            if key != last:
                if last is not None and not start:
                    ends.append((*last, h))
                last, h = key, int.from_bytes(carried[i] or ROOT, "little") if start else 0
            before, h = h, (h * FACTOR + int.from_bytes(turn[i], "little") + 1) % PRIME
            if start:
                nodes.append(h.to_bytes(16, "little"))
                parents.append(before.to_bytes(16, "little"))
        if start:
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("conv", "depth", "turn", "bytes")), pa.array(nodes, pa.binary()), pa.array(parents, pa.binary())], names=["conv", "depth", "turn", "bytes", "node", "parent"])
        elif ends:
            yield _ends(ends)
    if not start and last is not None:
        yield _ends([(*last, h)])


def _ends(ends: list[tuple[int, int, int]]) -> pa.RecordBatch:
    columns = list(zip(*ends))
    return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array([h.to_bytes(16, "little") for h in columns[2]], pa.binary())], names=["conv", "segment", "digest"])


def _carried(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From the digests of full segments, in order, what the next one starts with."""
    whole = pow(FACTOR, SEGMENT, PRIME)
    conv, h = None, 0
    for batch in batches:
        out = []
        for c, s, digest in zip(*(batch.column(n).to_pylist() for n in ("conv", "segment", "digest"))):
            h = ((h if c == conv else 0) * whole + int.from_bytes(digest, "little")) % PRIME
            conv = c
            out.append((c, s + 1, h))
        if out:
            yield _ends(out)


def with_nodes(rebuilt: DataFrame, lengths: DataFrame) -> DataFrame:
    """``rebuilt`` with the digests of the sequence up to a turn and before it."""
    rows = materialize(rebuilt.withColumn("segment", F.floor((F.col("depth") - 1) / SEGMENT).cast("long")))
    order = ["conv", "segment", "depth"]
    # Segments that another one follows: they are full.
    followed = rows.join(lengths, "conv").where(F.floor((F.col("length") - 1) / SEGMENT) > F.col("segment")).select(*order, "turn")
    digests = followed.repartition("conv", "segment").sortWithinPartitions(*order).mapInArrow(lambda b: _segment_digests(b, False), "conv long, segment long, digest binary")
    carried = materialize(digests.repartition("conv").sortWithinPartitions("conv", "segment").mapInArrow(_carried, "conv long, segment long, digest binary"))
    known = rows.join(carried.withColumnRenamed("digest", "carried"), ["conv", "segment"], "left")
    sorted_rows = known.repartition("conv", "segment").sortWithinPartitions(*order)
    return materialize(sorted_rows.mapInArrow(lambda b: _segment_digests(b, True), "conv long, depth long, turn binary, bytes long, node binary, parent binary"))


class DoubleArray:
    """A trie over sequences of dense ids: the child of slot s by id c is
    t = base[s] + c if check[t] == s. Slots are in the order in which they were
    placed, parents first."""

    def __init__(self, paths: list[list[int]]) -> None:
        """``paths`` are sorted and distinct."""
        self.base, self.check = [0], [0]
        self.order = [0]
        first_free = 1
        queue = [(0, 0, len(paths), 0)]  # slot, first path, end, depth
        for slot, low, high, depth in queue:
            groups: list[tuple[int, int, int]] = []
            at = low
            while at < high and len(paths[at]) <= depth:
                at += 1
            while at < high:
                code, end = paths[at][depth], at + 1
                while end < high and paths[end][depth] == code:
                    end += 1
                groups.append((code, at, end))
                at = end
            if not groups:
                continue
            while first_free < len(self.check) and self.check[first_free] >= 0:
                first_free += 1
            base = self._fit([g[0] for g in groups], first_free)
            self.base[slot] = base
            for code, begin, end in groups:
                child = base + code
                self.check[child] = slot
                self.order.append(child)
                queue.append((child, begin, end, depth + 1))

    def _fit(self, codes: list[int], first_free: int) -> int:
        """The least base from which all ``codes`` (sorted) fall on free slots. A base
        may be negative, as the slots that count are base + code."""
        base = first_free - codes[0]
        check = self.check
        while True:
            if (top := base + codes[-1]) >= len(check):
                check.extend([-1] * (top + 1 - len(check)))
                self.base.extend([0] * (top + 1 - len(self.base)))
            if all(check[base + c] < 0 for c in codes):
                return base
            base += 1

    def walk(self, codes: list[int]) -> list[int]:
        """The slots of the prefixes of a path, without the root's."""
        slots, slot = [], 0
        for code in codes:
            child = self.base[slot] + code
            if not 0 < child < len(self.check) or self.check[child] != slot:
                break
            slots.append(child)
            slot = child
        return slots


def shard_nodes(rows: pd.DataFrame) -> pd.DataFrame:
    """The nodes of a shard's subtrees, from the rows (conv, depth, turn, bytes,
    node, parent, members, subtree) of its paths."""
    rows = rows.sort_values(["conv", "depth"], kind="stable")
    first = (rows["conv"] != rows["conv"].shift()).to_numpy()
    # A path's first symbol is its subtree, the others are turns.
    symbol = rows["turn"].where(~first, rows["subtree"].map(lambda b: b"\0" + b))
    codes, _ = pd.factorize(symbol)
    starts = np.append(np.flatnonzero(first), len(rows))
    paths = [codes[a:b].tolist() for a, b in zip(starts, starts[1:])]
    trie = DoubleArray(sorted(paths))

    size = len(trie.check)
    members, convs, example = np.zeros(size, np.int64), np.full(size, np.iinfo(np.int64).max), np.zeros(size, np.int64)
    weights, ids = rows["members"].to_numpy(np.int64), rows["conv"].to_numpy(np.int64)
    for a, path in zip(starts, paths):
        slots = np.array(trie.walk(path))
        members[slots] += weights[a]
        np.minimum.at(convs, slots, ids[a])
        example[slots] = np.arange(a, a + len(slots))
    placed = np.array(trie.order[1:])
    check = np.array(trie.check)
    size_of = rows["bytes"].to_numpy(np.int64)
    saved = np.zeros(size, np.int64)
    saved[placed] = (members[placed] - 1) * size_of[example[placed]]
    children, leaves = np.zeros(size, np.int64), np.zeros(size, np.int64)
    for slot in reversed(trie.order[1:]):  # children come before their parents
        parent = check[slot]
        leaves[slot] = leaves[slot] or 1
        children[parent] += 1
        leaves[parent] += leaves[slot]
        saved[parent] += saved[slot]
    at = example[placed]
    out = rows.iloc[at][["node", "parent", "depth"]].reset_index(drop=True)
    return out.assign(conv_id=convs[placed], n_convs=members[placed], n_children=children[placed], n_leaves=leaves[placed], saved=saved[placed], top=check[placed] == 0)


def end_digests(ends: DataFrame) -> DataFrame:
    """node, ends_sha256: of the decimal ids of (node, conv), ascending and
    comma-joined. Ids become pieces of text first, so that a node where very many
    conversations end is read as few rows, one after another."""
    piece = F.shiftright("conv", PIECE_BITS)
    joined = F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string")), ",")
    pieces = ends.groupBy("node", piece.alias("piece")).agg(joined.alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, hashlib.sha256()
        for batch in batches:
            out = []
            for n, text in zip(batch.column("node").to_pylist(), batch.column("text").to_pylist()):
                if n == node:
                    digest.update(b",")
                else:
                    if node is not None:
                        out.append((node, digest.hexdigest()))
                    node, digest = n, hashlib.sha256()
                digest.update(text.encode())
            if out:
                yield _texts(out)
        if node is not None:
            yield _texts([(node, digest.hexdigest())])

    return pieces.repartition("node").sortWithinPartitions("node", "piece").mapInArrow(run, "node binary, ends_sha256 string")


def _texts(rows: list[tuple[bytes, str]]) -> pa.RecordBatch:
    nodes, texts = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(texts, pa.string())], names=["node", "ends_sha256"])


def _from_the_end(value: str) -> Column:
    """Sum of ``value`` over a path's rows of this depth and deeper, worked out in
    segments; rows hold conv, depth, segment and the sum ``later`` of later ones."""
    own = Window.partitionBy("conv", "segment").orderBy(F.desc("depth"))
    return F.sum(value).over(own) + F.coalesce("later", F.lit(0))


def prefix_trie(rebuilt: DataFrame, lengths: DataFrame, rows_below: int = ROWS_BELOW, rows_per_shard: int = ROWS_PER_SHARD) -> DataFrame:
    """One row per node: node, parent, depth, conv_id (smallest member),
    parent_conv_id, n_convs, n_children, n_leaves, saved, ends_sha256.

    ``rebuilt``: (conv, depth from 1, turn, bytes); ``lengths``: (conv, length), also
    of conversations without turns.
    """
    spark = rebuilt.sparkSession
    lengths = materialize(lengths)
    rows = with_nodes(rebuilt, lengths)
    root = F.lit(bytearray(ROOT)).cast("binary")
    last = rows.join(lengths, "conv").where("depth = length").select("node", "conv")
    ends = materialize(last.unionByName(lengths.where("length = 0").select(root.alias("node"), "conv")))
    paths = materialize(ends.groupBy("node").agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("members")).join(lengths, "conv").select("conv", "members", "length"))
    path_rows = materialize(rows.join(paths, "conv"))

    # How deep each path runs through upper nodes; the root is one of them.
    below = path_rows.groupBy("node").agg(F.sum(F.col("length") - F.col("depth") + 1).alias("n"))
    heavy = materialize(below.where(F.col("n") > rows_below).select("node"))
    upper_depths = path_rows.select("conv", "depth", "node").join(heavy, "node").groupBy("conv").agg(F.max("depth").alias("upper"))
    paths = materialize(paths.join(upper_depths, "conv", "left").fillna(0, ["upper"]))

    # Subtrees below the upper nodes, packed and walked shard by shard.
    under = path_rows.join(paths.select("conv", "upper"), "conv").where("depth > upper")
    subtrees = under.where("depth = upper + 1").select("conv", F.col("node").alias("subtree"))
    n_rows = path_rows.count()
    shards = max(-(-n_rows // rows_per_shard), int(spark.conf.get("spark.sql.shuffle.partitions")))
    under = materialize(under.join(materialize(subtrees), "conv").select("conv", "depth", "turn", "bytes", "node", "parent", "members", "subtree"))
    dealt = under.withColumn("shard", F.pmod(F.xxhash64("subtree"), F.lit(shards)))
    lower = materialize(dealt.groupBy("shard").applyInPandas(shard_nodes, NODE))

    # Upper nodes: every path's rows down to its upper depth, with the root.
    with_root = path_rows.select("conv", "depth", "node", "parent", "bytes", "members").unionByName(
        paths.select("conv", F.lit(0).cast("long").alias("depth"), root.alias("node"), F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("long").alias("bytes"), "members")
    )
    upper = materialize(with_root.join(paths.select("conv", "upper"), "conv").where("depth <= upper").withColumn("segment", F.floor(F.col("depth") / SEGMENT)))
    known = materialize(
        upper.groupBy("node").agg(F.first("parent").alias("parent"), F.first("depth").alias("depth"), F.min("conv").alias("conv"), F.sum("members").alias("n_convs"), F.first("bytes").alias("bytes"))
    )
    own = known.select("conv", "depth", ((F.col("n_convs") - 1) * F.col("bytes")).alias("own"))
    hung = lower.where("top").groupBy(F.col("conv_id").alias("conv")).agg(F.sum("n_leaves").alias("hung_leaves"), F.sum("saved").alias("hung_saved"))
    counted = materialize(upper.select("conv", "depth", "segment", "node").join(own, ["conv", "depth"], "left").fillna(0, ["own"]))
    of_segment = counted.groupBy("conv", "segment").agg(F.sum("own").alias("sum"))
    after = Window.partitionBy("conv").orderBy(F.desc("segment")).rowsBetween(Window.unboundedPreceding, -1)
    later = of_segment.select("conv", "segment", F.sum("sum").over(after).alias("later"))
    summed = counted.join(later, ["conv", "segment"]).withColumn("down", _from_the_end("own")).join(hung, "conv", "left")
    sums = summed.groupBy("node").agg(F.sum(F.coalesce("hung_leaves", F.lit(0))).alias("n_leaves"), F.sum(F.col("down") + F.coalesce("hung_saved", F.lit(0))).alias("saved"))
    born = known.select("parent").unionByName(lower.where("top").select("parent")).where("parent is not null")
    children = born.groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    of_upper = known.join(sums, "node").join(children, "node", "left").select(
        "node", "parent", "depth", F.col("conv").alias("conv_id"), "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
        # An upper node without children is the root of nothing but empty conversations.
        F.when(F.col("n_children").isNull(), F.lit(1)).otherwise(F.col("n_leaves")).cast("long").alias("n_leaves"), "saved",
    )
    nodes = materialize(of_upper.unionByName(lower.drop("top")))

    parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    named = nodes.join(materialize(parents), "parent", "left")
    return named.join(materialize(end_digests(ends)), "node", "left").select(
        "node", "parent", "depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved", F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256")
    )
