"""Exact top-k search by multi-resolution segment statistics.

A vector is cut into segments; mean and deviation of each segment bound the
distance of two vectors from below, and so their inner product from above. The
bounds are taken coarse to fine, and only candidates that may still enter the
top k go on to the next resolution and at last to the exact integer score.
Queries and candidates meet in blocks of bounded size.
"""

from __future__ import annotations

import heapq
import math
import sys
from operator import mul

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tokoledger.llm.common import in_arrow, partitions, stored

CANDIDATES = 4096      # vectors of a candidate block
QUERIES = 1024         # vectors of a query block
TOGETHER = 32          # queries whose bounds are held at once
WIDE = 1 << 23         # vectors with a larger component meet in blocks of their own
LEVELS = (4, 16)       # segments, coarse to fine


def statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """Features whose inner product is an upper bound of the vectors' inner product:
    per segment the scaled mean and the norm of the deviations from it."""
    out = []
    for part in np.array_split(x, min(segments, x.shape[1]), axis=1):
        mean = part.mean(axis=1)
        out += [mean * math.sqrt(part.shape[1]), np.sqrt(((part - mean[:, None]) ** 2).sum(axis=1))]
    return np.stack(out, axis=1)


LONG = 2 ** 63 - 1


def top_k(qkey: np.ndarray, q: np.ndarray, ckey: np.ndarray, cid: np.ndarray, c: np.ndarray, k: int):
    """(query, candidate, score) by position: the k largest exact inner products of every query row, itself (the
    row with its key) left out, ties to the smaller ``cid``. The vectors are integers held as doubles."""
    most = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * q.shape[1]
    own = qkey[:, None] == ckey[None]
    if not most < 2 ** 62:      # beyond 64-bit integers: exact in Python's, for the few vectors with such components
        out = []
        qs, cs = [[[int(x) for x in row] for row in m.tolist()] for m in (q, c)]
        for i, row in enumerate(qs):
            found = [(max(-LONG - 1, min(LONG, sum(map(mul, row, other)))), int(cid[j]), j) for j, other in enumerate(cs) if not own[i, j]]
            out += [(i, j, s) for s, _, j in heapq.nsmallest(k, found, key=lambda x: (-x[0], x[1]))]
        return out
    exact = most < 2 ** 52
    whole = (q, c) if exact else (q.astype(np.int64), c.astype(np.int64))
    mine = [(statistics(q, s), statistics(c, s)) for s in LEVELS]
    slack = 1e-9 * (1 + np.sqrt((q * q).sum(axis=1))[:, None] * np.sqrt((c * c).sum(axis=1))[None].max(initial=0))

    def scores(rows, columns):
        return (whole[0][rows] @ whole[1][columns].T).astype(np.int64)

    out = []
    for lo in range(0, len(q), TOGETHER):
        rows = np.arange(lo, min(lo + TOGETHER, len(q)))
        bound = mine[0][0][rows] @ mine[0][1].T + slack[rows]
        bound[own[rows]] = -np.inf
        open_ = ~own[rows]
        if len(cid) > k:  # exact scores of the best bounds give a threshold for all the rest
            seeds = np.argpartition(-bound, k - 1, axis=1)[:, :k]
            floor = np.array([np.sort(np.where(own[rows[i], s], np.iinfo(np.int64).min, scores(rows[i:i + 1], s)[0]))[0] for i, s in enumerate(seeds)])
            open_ &= bound >= floor[:, None]
            for fine_q, fine_c in mine[1:]:
                columns = np.nonzero(open_.any(axis=0))[0]
                open_[:, columns] &= fine_q[rows] @ fine_c[columns].T + slack[rows] >= floor[:, None]
        columns = np.nonzero(open_.any(axis=0))[0]
        found = scores(rows, columns)
        for i, row in enumerate(rows):
            here = columns[open_[i, columns]]
            s = found[i, open_[i, columns]]
            order = np.lexsort((cid[here], -s))[:k]
            out += [(int(row), int(here[o]), int(s[o])) for o in order]
    return out


def _search(k: int):
    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                queries, candidates = (batch.column(x)[row].values for x in (0, 1))
                keys = [s.field("key").to_numpy() for s in (queries, candidates)]
                ids = [s.field("vec_id").to_numpy() for s in (queries, candidates)]
                mats = [s.field("vector").flatten().to_numpy().reshape(len(s), -1) for s in (queries, candidates)]
                found = top_k(keys[0], mats[0], keys[1], ids[1], mats[1], k)
                if found:
                    q, c, score = (np.array(x, np.int64) for x in zip(*found))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x, pa.int64()) for x in (keys[0][q], ids[0][q], ids[1][c], score)], ["key", "query_id", "vec_id", "score"]
                    )

    return run


def segment_top_k(vectors: DataFrame, queries: str = "vec_id % 50 = 0", k: int = 5, scale: int = 256) -> DataFrame:
    """For each query row the ``k`` highest inner products of floor(scale * component)
    with other rows: query_id, rank, vec_id, score; ties to the smaller vec_id.

    A vector that is null, empty or holds a null or non-finite component takes no
    part, nor does a row without a vec_id. Every other row is a candidate of every query row but
    itself, also where rows share a vec_id: each row is its own query and candidate. Scores are
    exact for components of any size; one beyond a long counts as the nearest long. Only vectors
    of the query's length are its candidates. A query with fewer candidates than
    ``k`` gets them all; without queries the result is empty. Other columns are not read.
    """
    valid = F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    )
    whole = (
        vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")).where(valid)
        .select(
            F.monotonically_increasing_id().alias("key"), "vec_id",
            # as doubles: from 2**53 on they are whole, and the largest one stands for what is beyond
            F.transform("embedding", lambda x: F.when(F.abs(x * scale) < float(1 << 53), F.floor(x * scale).cast("double"))
                        .otherwise(F.least(F.greatest(x * scale, F.lit(-sys.float_info.max)), F.lit(sys.float_info.max)))).alias("vector"),
        )
    )
    wide = F.exists("vector", lambda x: F.abs(x) >= float(WIDE))
    whole = stored(whole.withColumns({"dim": F.size("vector"), "wide": wide}))      # stored, so a row's key stays
    asked = whole.where(queries)
    sizes = {
        r.dim: (math.ceil(r.n / CANDIDATES), math.ceil((r.q or 0) / QUERIES))
        for r in whole.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.sum(F.expr(f"cast({queries} as int)")).alias("q"))
        .orderBy(F.desc("n")).limit(1000).collect()
    }  # of up to 1000 vector lengths; vectors of a rarer length are one block each
    blocks = F.create_map(*[F.lit(x) for d, (c, _) in sizes.items() for x in (d, c)]) if sizes else F.create_map(F.lit(-1), F.lit(1))
    turns = F.create_map(*[F.lit(x) for d, (_, q) in sizes.items() for x in (d, max(1, q))]) if sizes else F.create_map(F.lit(-1), F.lit(1))
    of = lambda counts: F.coalesce(counts[F.col("dim")], F.lit(1))
    packed = lambda df, counts, name: (
        df.withColumn("part", F.pmod(F.xxhash64("key"), of(counts)).cast("int"))
        .groupBy("dim", "part", F.col("wide").alias(f"wide_{name}")).agg(F.collect_list(F.struct("key", "vec_id", "vector")).alias(name))
    )
    candidates = packed(whole, blocks, "candidates").withColumnRenamed("part", "block")
    turned = candidates.withColumn("part", F.explode(F.sequence(F.lit(0), of(turns) - 1)))
    met = turned.join(packed(asked, turns, "queries"), ["dim", "part"]).select("queries", "candidates")
    found = in_arrow(met.repartition(partitions(vectors.sparkSession)), _search(k), "key long, query_id long, vec_id long, score long")
    order = Window.partitionBy("key").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
