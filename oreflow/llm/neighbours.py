"""Nearest neighbours by vantage-point trees, one per shard.

The largest inner product is a smallest distance once every vector gets one
more component, sqrt(M^2 - |x|^2) with M the largest norm, and a query gets 0
there. Shards are cut by a hash of the vector, so equal vectors meet; a tree
splits its vectors at the median distance from a vantage point. A query leaves
out the half-space that the triangle inequality rules out. ``factor`` relaxes
that: a side is left out as soon as its least possible distance times factor
reaches the worst distance kept. Factor one is the exact search.

All queries of a block walk a tree together, so the work is matrix products.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from oreflow.llm.frames import cut, reachable

#: Vectors of a shard, queries of a block, vectors of a leaf.
SHARD_ROWS, BLOCK_ROWS, LEAF_ROWS = 16_384, 4_096, 128
#: Measured on the check tables: see the README.
FACTOR = 1.6


class VantageTree:
    """Tree over the rows of ``points``."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF_ROWS, seed: int = 0):
        self.points, self.leaf, self.rng = points, leaf, np.random.default_rng(seed)
        self.root = self._build(np.arange(len(points)))

    def _build(self, rows: np.ndarray):
        if len(rows) <= self.leaf:
            return rows
        vantage = self.points[rows[self.rng.integers(len(rows))]]
        far = np.sqrt(np.maximum(((self.points[rows] - vantage) ** 2).sum(1), 0))
        middle = float(np.median(far))
        inside = far <= middle
        if inside.all():  # many vectors as far as the median: nothing to split
            inside = far < middle
            if not inside.any():
                return rows
        return (vantage, float(far[inside].max()), float(far[~inside].min()),
                self._build(rows[inside]), self._build(rows[~inside]))

    def search(self, queries: np.ndarray, k: int, factor: float = 1.0) -> np.ndarray:
        """Rows of the k nearest points found for each query; -1 where there are fewer."""
        best = np.full((len(queries), k), np.inf)
        rows = np.full((len(queries), k), -1, np.int64)
        lengths = (self.points ** 2).sum(1)

        def visit(node, active: np.ndarray) -> None:
            if not len(active):
                return
            if isinstance(node, np.ndarray):
                own = queries[active]
                square = (own ** 2).sum(1)[:, None] + lengths[node] - 2 * own @ self.points[node].T
                near = np.hstack([best[active], np.sqrt(np.maximum(square, 0))])
                names = np.hstack([rows[active], np.broadcast_to(node, (len(active), len(node)))])
                if near.shape[1] > k:
                    pick = np.argpartition(near, k - 1, axis=1)[:, :k]
                    near = np.take_along_axis(near, pick, 1)
                    names = np.take_along_axis(names, pick, 1)
                best[active], rows[active] = near, names
                return
            vantage, inner, outer, inside, outside = node
            far = np.sqrt(np.maximum(((queries[active] - vantage) ** 2).sum(1), 0))
            first = far - inner <= outer - far
            visit(inside, active[first])
            visit(outside, active[~first])
            worst = best[active].max(1)
            visit(outside, active[first & ((outer - far) * factor < worst)])
            worst = best[active].max(1)
            visit(inside, active[~first & ((far - inner) * factor < worst)])

        visit(self.root, np.arange(len(queries)))
        return rows


def _found(vectors: pd.DataFrame, queries: pd.DataFrame, k: int, factor: float) -> pd.DataFrame:
    """The k best of one shard for one block of queries."""
    names = ["query_id", "vec_id", "score"]
    if not len(vectors) or not len(queries):
        return pd.DataFrame({n: pd.Series(dtype="float64" if n == "score" else "int64") for n in names})
    vectors = vectors.sort_values("id")
    x = np.vstack(vectors["v"].to_numpy()).astype(np.float64)
    q = np.vstack(queries["v"].to_numpy()).astype(np.float64)
    x, of = np.unique(x + 0.0, axis=0, return_inverse=True)
    order = np.argsort(of.ravel(), kind="stable")
    starts = np.searchsorted(of.ravel()[order], np.arange(len(x) + 1))
    ids = vectors["id"].to_numpy()[order]
    square = (x ** 2).sum(1)
    lifted = np.hstack([x, np.sqrt(np.maximum(square.max() - square, 0))[:, None]])
    tree = VantageTree(lifted)
    rows = tree.search(np.hstack([q, np.zeros((len(q), 1))]), k + 1, factor)
    out = []
    for i, own in enumerate(queries["id"].to_numpy()):
        kept = rows[i][rows[i] >= 0]
        scores = np.einsum("ij,j->i", x[kept], q[i])
        members = np.concatenate([ids[starts[r]:starts[r + 1]] for r in kept])
        scores = np.repeat(scores, starts[kept + 1] - starts[kept])
        other = members != own
        members, scores = members[other], scores[other]
        best = np.lexsort((members, -scores))[:k]
        out.append(pd.DataFrame({"query_id": own, "vec_id": members[best], "score": scores[best]}))
    return pd.concat(out, ignore_index=True)[names]


def search(vectors: DataFrame, is_query: Column, k: int = 20, factor: float = FACTOR,
           shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found for each row that is a query.

    ``vectors`` has vec_id and embedding. Vectors that are null, empty, zero or
    hold a null or non-finite component take no part, as queries or candidates,
    nor do rows without vec_id. All others must have one length; a row is no
    candidate of its own id. Of equal vectors the k + 1 smallest ids are
    indexed, since no query can have others among its k nearest. Ties go to the
    smaller id; repeated rows count once. Scores are inner products in double
    precision of the given vectors. An empty table gives no rows.

    Every shard meets every block of queries, each pair in its own task.
    """
    fit = F.col("embedding").isNotNull() & F.col("vec_id").isNotNull()
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    nonzero = F.exists("embedding", lambda x: x != 0)
    # Adding 0.0 makes one of the two zeros, so equal vectors have equal bytes.
    plain = F.transform("embedding", lambda x: x.cast("double") + F.lit(0.0))
    rows = reachable(vectors).where(fit).where(finite & nonzero).select(
        F.col("vec_id").cast("long").alias("id"), plain.alias("v"),
        F.coalesce(is_query, F.lit(False)).alias("asks")).distinct()
    rows = cut(rows)
    total, asked = rows.agg(F.count("*"), F.count_if("asks")).first()
    shards = max(1, -(-total // shard_rows))
    blocks = max(1, -(-asked // block_rows))
    equal = Window.partitionBy("v").orderBy("id")
    indexed = rows.withColumn("nth", F.row_number().over(equal)).where(F.col("nth") <= k + 1).select(
        "id", "v", F.pmod(F.xxhash64("v"), F.lit(shards)).cast("int").alias("shard"))
    indexed = indexed.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    asking = rows.where("asks").select(
        "id", "v", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"))
    asking = asking.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return _found(left, right, k, factor)

    near = indexed.groupBy("shard", "block").cogroup(asking.groupBy("shard", "block")).applyInPandas(
        run, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
