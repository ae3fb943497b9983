"""Connected components of a link table, by alternating star contraction.

Every round is two aggregations and two joins over the links, and the number
of rounds grows with the logarithm of the longest chain. Each task first
replaces its links by a spanning forest, so a dense group of k nodes costs at
most k links per task from then on.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokoledger.llm.common import in_arrow, stored


def forest(us, vs):
    """Spanning forest of the links: (node, root) for each node that is not a root."""
    parent: dict[int, int] = {}

    def find(x):
        top = x
        while parent.get(top, top) != top:
            top = parent[top]
        while parent.get(x, x) != top:
            parent[x], x = top, parent[x]
        return top

    for u, v in zip(us, vs, strict=True):
        a, b = find(u), find(v)
        if a != b:
            parent[max(a, b)] = min(a, b)
    nodes = list(parent)
    return nodes, [find(x) for x in nodes]


def shrink(batches):
    """Batches of links -> their spanning forests."""
    for batch in batches:
        if batch.num_rows:
            nodes, roots = forest(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(roots, pa.int64())], ["u", "v"])


def _state(links: DataFrame) -> tuple:
    row = links.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    ).first()
    return tuple(row)


def components(links: DataFrame, shrunk: bool = False) -> DataFrame:
    """``links(u, v)`` of longs -> ``(node, root)`` for each node that has a link to
    another one; root is the smallest node of the component. Loops and repeated
    links do not matter; no links give no rows. ``shrunk``: the links are spanning
    forests already (``shrink``). Where Python made them, it should shrink them too: a
    second Python function behind the first doubles the workers of each core."""
    proper = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v")
    edges = stored((proper if shrunk else in_arrow(proper, shrink, "u long, v long")).distinct())
    before = _state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least("u", F.min("v")).alias("low"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("low"))
        small = (
            large.join(low, "u").where("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
            .unionByName(low.select("u", F.col("low").alias("v")))
            .distinct()
        )
        edges = stored(small)
        after = _state(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
