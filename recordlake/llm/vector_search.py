"""Exact top-k search by inner product: KD-trees per shard, best-first, with the kth score handed on.

Equal rows are folded first.  Vectors are then dealt to shards of about
``SHARD_ROWS`` by a hash of id and vector, so a vector held by very many ids, and
an id of very many vectors, are spread evenly.  In each shard a KD-tree is built
by median splits along the widest side, with a tight bounding box for every node.
No point of a box can score more than the sum over its sides of the larger of
query times low and query times high; a query walks the tree from the best such
bound down and stops when the bound is below its kth score.

The kth score is propagated: each query first searches one shard, and what it
finds there is the score to beat in all others.  A block of at most
``BLOCK_QUERIES`` queries meets a shard in one task, which therefore holds a
bounded number of rows whatever the size of the tables.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordlake.llm.common import written

SHARD_ROWS = 2048
BLOCK_QUERIES = 8192
LEAF = 128
TOP = 5
SCALE = 256
#: Products are summed as floats while that is exact, else as 64-bit integers.
_EXACT = float(2**53)

FOUND = "query_id long, vec_id long, score long"


def quantised(embedding: Column) -> Column:
    """floor(256 x) of every component as a double, or null where the vector takes no part."""
    cells = F.transform(embedding, lambda x: F.floor(x.cast("double") * SCALE).cast("double"))
    sound = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.when(sound & (F.size(embedding) > 0), cells)


class Tree:
    """Nodes as arrays: bounding boxes, children, and the slice of points of each leaf."""

    def __init__(self, ids: np.ndarray, points: np.ndarray):
        self.ids, self.points = ids, points
        self.low, self.high, self.kids, self.span = [], [], [], []
        order = np.arange(len(ids))
        self._grow(order, 0, len(ids))
        self.ids, self.points = ids[order], points[order]
        self.low, self.high = np.array(self.low), np.array(self.high)

    def _grow(self, order: np.ndarray, a: int, b: int) -> int:
        node, held = len(self.kids), self.points[order[a:b]]
        low, high = held.min(axis=0), held.max(axis=0)
        self.low.append(low)
        self.high.append(high)
        self.kids.append(None)
        self.span.append((a, b))
        side = int((high - low).argmax())
        if b - a > LEAF and high[side] > low[side]:
            half = (b - a) // 2
            order[a:b] = order[a:b][np.argpartition(held[:, side], half)]
            self.kids[node] = (self._grow(order, a, a + half), self._grow(order, a + half, b))
        return node

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """The best score any point of each node's box could have, by query."""
        return np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T

    def search(self, query: np.ndarray, own: int, bounds: np.ndarray, k: int, least: float | None) -> list[tuple[int, int]]:
        """(score, id) of the ``k`` best ids, each by its best point, none below ``least``."""
        best: dict[int, float] = {}  # the score of each id
        worst = None  # (score, -id) of the kth of them
        frontier = [(-bounds[0], 0)]
        while frontier:
            bound, node = heapq.heappop(frontier)
            kth = worst[0] if worst else least
            if kth is not None and -bound < kth:
                break
            if self.kids[node]:
                for kid in self.kids[node]:
                    heapq.heappush(frontier, (-bounds[kid], kid))
                continue
            a, b = self.span[node]
            scores, ids = self.points[a:b] @ query, self.ids[a:b]
            fits = ids != own
            if kth is not None:
                fits &= scores >= kth
            at = np.flatnonzero(fits)
            for i in at[np.lexsort((ids[at], -scores[at]))]:
                score, one = scores[i], int(ids[i])
                if worst and (score, -one) <= worst:
                    break
                if one in best:
                    best[one] = max(best[one], score)
                else:
                    if worst:
                        del best[-worst[1]]
                    best[one] = score
                if len(best) == k:
                    worst = min((s, -i) for i, s in best.items())
        return [(int(s), i) for i, s in best.items()]


def _searcher(k: int):
    def run(key, vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(vectors) or not len(queries):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
        points, wanted = np.stack(vectors["x"].to_numpy()), np.stack(queries["x"].to_numpy())
        sums = np.abs(points).max() * np.abs(wanted).max() * points.shape[1]
        if sums >= _EXACT:
            points, wanted = points.astype(np.int64), wanted.astype(np.int64)
        tree = Tree(vectors["vec_id"].to_numpy(), points)
        out = []
        for first in range(0, len(wanted), 1024):
            block = wanted[first : first + 1024]
            bounds = tree.bounds(block)
            own = queries["query_id"].to_numpy()[first : first + 1024]
            least = queries["least"].to_numpy()[first : first + 1024]
            for i in range(len(block)):
                floor = None if pd.isna(least[i]) else least[i]
                out += [(own[i], v, s) for s, v in tree.search(block[i], own[i], bounds[i], k, floor)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype("int64")

    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each query as ``tops``: an array of (-score, vec_id), best first."""
    tops = F.slice(F.array_sort(F.collect_list(F.struct("loss", "vec_id"))), 1, k)
    ids = found.groupBy("query_id", "vec_id").agg((-F.max("score")).alias("loss"))
    return ids.groupBy("query_id").agg(tops.alias("tops"))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = TOP) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of each query's ``k`` best among the other ids.

    Both tables have ``vec_id`` and ``embedding``.  Rows without an id, vectors
    null or empty, or with null or non-finite components take no part; a query
    meets vectors of its own length only.  Rows that repeat an id are one candidate,
    by the best of its vectors; queries that repeat an id are one query, and the best
    score any of its vectors gives a candidate counts.  Ties go to the smaller id.
    Products must fit in 64 bits.  Empty tables give an empty result.
    """
    usable = lambda df: df.select(F.col("vec_id").cast("long").alias("vec_id"), quantised(F.col("embedding")).alias("x")).where(
        "vec_id IS NOT NULL AND x IS NOT NULL"
    )
    points = written(usable(vectors).distinct().withColumn("dim", F.size("x")), "vectors")
    asked = usable(queries).distinct().withColumnRenamed("vec_id", "query_id").withColumn("dim", F.size("x"))
    asked = written(asked, "vector-queries")
    shards = max(1, -(-points.count() // SHARD_ROWS))
    blocks = max(1, -(-asked.count() // BLOCK_QUERIES))
    spread = lambda name, seed, n: F.pmod(F.xxhash64(F.lit(seed), F.col(name), F.col("x")), F.lit(n)).cast("int")
    asked = asked.withColumn("block", spread("query_id", 1, blocks))
    placed = points.withColumn("shard", spread("vec_id", 2, shards))
    placed = placed.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    keys = ["dim", "shard", "block"]
    run = _searcher(k)
    meet = lambda q: placed.groupBy(*keys).cogroup(q.groupBy(*keys)).applyInPandas(run, FOUND)

    home = spread("query_id", 3, shards)
    seeds = written(meet(asked.withColumn("shard", home).withColumn("least", F.lit(None).cast("double"))), "vector-seeds")
    if shards == 1:
        found = seeds
    else:
        bound = _best(seeds, k).select(
            "query_id", F.when(F.size("tops") == k, -F.element_at("tops", -1)["loss"]).cast("double").alias("least")
        )
        others = F.filter(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: s != home)
        rest = asked.join(bound, "query_id", "left").withColumn("shard", F.explode(others))
        found = seeds.unionByName(meet(rest))
    ranked = _best(found, k).select("query_id", F.posexplode("tops").alias("rank", "top"))
    return ranked.select(
        "query_id", (F.col("rank") + 1).alias("rank"), F.col("top.vec_id").alias("vec_id"), (-F.col("top.loss")).alias("score")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return top_k(vectors, vectors.where("vec_id % 50 = 0"))


ORACLE_SQL = f"""
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT q.vec_id AS query_id, v.vec_id, CAST(list_dot_product(q.x, v.x) AS BIGINT) AS score
  FROM usable q JOIN usable v ON q.vec_id % 50 = 0 AND q.vec_id <> v.vec_id AND len(q.x) = len(v.x)),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {TOP}
"""
