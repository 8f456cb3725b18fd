"""Connected components of a table of links.

Up to ``FEW_LINKS`` links (counted first; 16 bytes each) one task joins them.
Beyond that bound stars alternate: each round rewires every node's links to
its smallest neighbour, first links to larger nodes, then those to smaller
ones.  Rounds end when nothing changes; their number grows with the logarithm
of the longest path, not with the size of a component.  A hub's minimum is
aggregated before the shuffle and its links meet it in a join that Spark
splits when skewed, so no component is ever in one task or on the driver.
Every round is written to the shared folder.  Both ways give the same table.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import written


FEW_LINKS = 1_000_000


def _join_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Components of all links of a bounded partition: labels are lowered
    along links and then replaced by their own labels until nothing moves."""
    parts = [np.stack([b.column(0).to_numpy(), b.column(1).to_numpy()]) for b in batches if b.num_rows]
    if not parts:
        return
    nodes, at = np.unique(np.concatenate(parts, axis=1), return_inverse=True)
    u, v = at.reshape(2, -1)
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, u, least)
        np.minimum.at(new, v, least)
        np.minimum.at(new, label[u], least)
        np.minimum.at(new, label[v], least)
        new = new[new]
        if (new == label).all():
            break
        label = new
    out = np.flatnonzero(label != np.arange(len(nodes)))
    yield pa.RecordBatch.from_pydict({"u": pa.array(nodes[out]), "m": pa.array(nodes[label[out]])})


def _star(links: DataFrame, keep_larger: bool) -> DataFrame:
    """Links (u, v) to (v, m): each kept neighbour v of u to the least m."""
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    if not keep_larger:
        both = both.filter("v < u")
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    met = both.join(least, "u")
    if keep_larger:
        out = met.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = (met.select(F.col("v").alias("u"), F.col("m").alias("v"))
               .union(least.select("u", F.col("m").alias("v"))))
    return out.filter("u <> v")


def components(links: DataFrame) -> DataFrame:
    """(u, m): every node of a link table (u, v), but for the smallest of its
    component, with that smallest node."""
    links = links.select("u", "v").filter("u <> v")
    if links.count() <= FEW_LINKS:
        return written(links.coalesce(1).mapInArrow(_join_all, "u long, m long"), "components")
    now = written(links.distinct(), "links")
    seen = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen or state[0] == 0:
            return now.select("u", F.col("v").alias("m"))
        seen = state
        now = written(_star(written(_star(now, True), "links"), False).distinct(), "links")
