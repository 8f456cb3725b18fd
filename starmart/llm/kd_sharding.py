"""Sharding by a k-d tree, in DataFrame operations only.

Every row is a point of metadata dimensions with its bytes as weight.  A node
that has to hold several shards is split along its widest dimension (extent
over the whole table's extent) at the weighted median: the point that divides
its bytes in the ratio of the shards on either side.  Leaves are the shards,
near equal in bytes.

Medians are found by all nodes of a level at once: a histogram of bytes over
equal bins between each node's bounds, then over the bin that holds the
median, until that bin is one value or lighter than the tolerance.  What comes
to the driver is a row for each (node, bin): a bounded number at any size.

Ties: rows are ordered by (coordinate, group, row), where group hashes the
text and row the id.  Copies of a text share all coordinates (those of the
copy first by id), so they stay in one shard unless a median falls inside a
group heavier than the tolerance, which is then cut by the row hash.  A hot
source or a value that a third of the rows share is split the same way.

Plan: one pass writes sizes, hashes and metadata without texts; copies'
coordinates come from a pre-aggregated join; the tree's thresholds become one
expression, so assignment is a projection.  Slots are numbered from counts of
small buckets, never by sorting a shard in one task.

Defined results: null text has no bytes (size 8); null metadata sorts first;
null ids are allowed; rows repeated exactly stay apart as rows; an empty table
gives no rows; other columns are ignored.
"""
from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starmart.llm.common import content_key, written

ROW_BYTES = 8
BINS = 1024
#: A group or median bin lighter than this share of a shard isn't cut.
TOLERANCE = 0.005
#: Bits of the tie order: the group's hash, then the row's.
GROUP_BITS, ROW_BITS = 32, 30
SLOT_ROWS = 50_000


@dataclass
class Node:
    """A node of the tree: shards [first, first + shards); a split sends rows
    with (coordinate of dim, tie) < (value, tie) to ``left``."""

    first: int
    shards: int
    dim: int | None = None
    value: int = 0
    tie: int = 0
    left: Node | None = None
    right: Node | None = None


def category(column: F.Column) -> F.Column:
    """Coordinate of a categorical value: a hash, null before all others."""
    return F.coalesce(F.pmod(F.xxhash64(column), F.lit(1 << 40)), F.lit(-1)).cast("long")


def points(docs: DataFrame, id_col: str, text_col: str, categories: list[str]) -> DataFrame:
    """(id, size, text_crc32, d0 (size), d1.. (categories), tie), written."""
    raw = F.coalesce(F.col(text_col), F.lit(""))
    rows = written(docs.select(
        F.col(id_col).alias("id"), (F.octet_length(raw) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(raw.cast("binary")).cast("long").alias("text_crc32"),
        content_key(F.col(text_col)).alias("key"),
        *(category(F.col(c)).alias(f"c{i}") for i, c in enumerate(categories))), "rows")
    marks = [f"c{i}" for i in range(len(categories))]
    groups = rows.groupBy("key").agg(
        F.min(F.struct(F.col("id").isNull(), "id", *marks)).alias("first"))
    tie = (F.shiftleft(F.pmod(F.xxhash64("key"), F.lit(1 << GROUP_BITS)), ROW_BITS)
           + F.pmod(F.xxhash64("id", "key"), F.lit(1 << ROW_BITS)))
    return written(rows.join(groups, "key").select(
        "id", "size", "text_crc32", F.col("size").alias("d0"),
        *(F.col("first")[m].alias(f"d{i + 1}") for i, m in enumerate(marks)),
        tie.alias("tie")), "points")


def before(value: int, tie: int, dim: int) -> F.Column:
    d = F.col(f"d{dim}")
    return (d < value) | ((d == value) & (F.col("tie") < tie))


def place(node: Node, leaf) -> F.Column:
    """An expression over a tree: ``leaf(node)`` of the leaf a row falls in."""
    if node.left is None:
        return F.lit(leaf(node))
    return F.when(before(node.value, node.tie, node.dim), place(node.left, leaf)).otherwise(
        place(node.right, leaf))


@dataclass
class Search:
    """The search for one node's median: rows with coordinate (or, on one
    value, tie) in [low, high] are in question, ``below`` is the weight known
    to lie before them.  While several groups are in question, tie bins hold
    whole groups."""

    node: Node
    target: float
    slack: float
    low: int
    high: int
    below: float = 0.0
    on_tie: bool = False
    done: bool = False

    def bins(self) -> tuple[int, int]:
        """Origin and width of the bins."""
        step = max(1, -(-(self.high - self.low + 1) // BINS))
        if self.on_tie and self.low >> ROW_BITS != self.high >> ROW_BITS:
            group = 1 << ROW_BITS
            return self.low // group * group, -(-step // group) * group
        return self.low, step

    def x(self) -> str:
        return "tie" if self.on_tie else f"d{self.node.dim}"

    def inside(self) -> str:
        own = f"node = {self.node.first} and {self.x()} between {self.low}L and {self.high}L"
        return own + (f" and d{self.node.dim} = {self.node.value}L" if self.on_tie else "")

    def narrow(self, found: dict[int, tuple[int, int, int]]) -> None:
        """``found``: weight, least and largest x of each bin that has rows."""
        run = self.below
        for b in sorted(found):
            weight, low, high = found[b]
            if run + weight >= self.target or b == max(found):
                break
            run += weight
        self.below, self.low, self.high = run, low, high
        if weight > self.slack and low < high:
            return
        if weight > self.slack and not self.on_tie:
            self.node.value, self.on_tie = low, True
            self.low, self.high = 0, (1 << (GROUP_BITS + ROW_BITS)) - 1
            return
        # Cut before or after the bin, whichever is nearer to the target.
        edge = high + 1 if abs(run + weight - self.target) < abs(run - self.target) else low
        if self.on_tie:
            self.node.tie = edge
        else:
            self.node.value, self.node.tie = edge, 0
        self.done = True


def grow(pts: DataFrame, dims: int, shards: int) -> Node:
    """The tree over written points; a level costs a pass for the extents and
    two to eight for the medians, over the narrow table of points."""
    root = Node(0, shards)
    total = None
    scale: list[int] = []
    level = [root]
    while level := [n for n in level if n.shards > 1]:
        keyed = pts.withColumn("node", place(root, lambda n: n.first))
        extents = {r["node"]: r for r in keyed.groupBy("node").agg(
            F.sum("size").alias("weight"),
            *(f(f"d{d}").alias(f"{k}{d}") for d in range(dims)
              for k, f in (("lo", F.min), ("hi", F.max)))).collect()}
        if total is None:
            if not extents:
                return root
            total = extents[0]["weight"]
            scale = [max(1, extents[0][f"hi{d}"] - extents[0][f"lo{d}"]) for d in range(dims)]
        searches = []
        for n in level:
            r = extents.get(n.first)
            if r is None:
                n.shards = 1  # no rows: its other shards stay empty
                continue
            n.dim = max(range(dims), key=lambda d: ((r[f"hi{d}"] - r[f"lo{d}"]) / scale[d], -d))
            half = n.shards // 2
            searches.append(Search(n, r["weight"] * half / n.shards, total / shards * TOLERANCE,
                                   r[f"lo{n.dim}"], r[f"hi{n.dim}"]))
        while live := [s for s in searches if not s.done]:
            cases = "".join(" when {} then struct(cast(({} - {}L) div {}L as int) as bin, {} as x)".format(
                s.inside(), s.x(), *s.bins(), s.x()) for s in live)
            got = (keyed.withColumn("at", F.expr(f"case{cases} end")).filter("at is not null")
                   .groupBy("node", "at.bin").agg(F.sum("size").alias("w"), F.min("at.x").alias("lo"),
                                                  F.max("at.x").alias("hi")).collect())
            for s in live:
                s.narrow({r["bin"]: (r["w"], r["lo"], r["hi"]) for r in got if r["node"] == s.node.first})
        for s in searches:
            n, half = s.node, s.node.shards // 2
            n.left, n.right = Node(n.first, half), Node(n.first + half, n.shards - half)
        level = [c for s in searches for c in (s.node.left, s.node.right)]
    return root


def with_slots(rows: DataFrame, shard: str, order: list[str]) -> DataFrame:
    """Adds ``slot``, gapless from 0 in each shard: numbers within hash
    buckets of about ``SLOT_ROWS`` rows plus the buckets' offsets."""
    per = rows.groupBy(shard).count().agg(F.max("count")).first()[0] or 0
    n = max(1, math.ceil(per / SLOT_ROWS))
    bucketed = rows.withColumn("_b", F.pmod(F.xxhash64(*order), F.lit(n)))
    counts = bucketed.groupBy(shard, "_b").count()
    offset = F.sum("count").over(
        Window.partitionBy(shard).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select(shard, "_b", F.coalesce(offset, F.lit(0)).alias("_o"))
    number = F.row_number().over(Window.partitionBy(shard, "_b").orderBy(*order)) - 1
    return (bucketed.withColumn("_r", number).join(offsets, [shard, "_b"])
            .withColumn("slot", F.col("_r") + F.col("_o")).drop("_b", "_r", "_o"))


def kd_shards(docs: DataFrame, shards: int | None = None, id_col: str = "doc_id", text_col: str = "text",
              categories: tuple[str, ...] = ("source", "lang"), target_bytes: int | None = None) -> DataFrame:
    """(id, size, text_crc32, shard, slot) of every row.

    Nodes are split until leaves reach their target: ``target_bytes`` (as many
    leaves as it goes into all bytes, one at least), or all bytes divided by
    a fixed number of ``shards``.
    """
    if (shards is None) == (target_bytes is None):
        raise ValueError("give the number of shards or their target bytes")
    pts = points(docs, id_col, text_col, list(categories))
    if shards is None:
        shards = max(1, math.ceil((pts.agg(F.sum("size")).first()[0] or 0) / target_bytes))
    tree = grow(pts, 1 + len(categories), shards)
    placed = pts.select("id", "size", "text_crc32", "tie", place(tree, lambda n: n.first).alias("shard"))
    return with_slots(placed, "shard", ["tie", "id", "text_crc32"]).select(
        F.col("id").alias(id_col), "size", "text_crc32",
        F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"))
