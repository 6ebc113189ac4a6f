"""Exact search for the largest inner products, with a KD-tree per shard.

Vectors are dealt to shards by a hash of their id, so equal vectors spread. A shard splits its
vectors at the median of the widest dimension and keeps a tight bounding box for each node. A
query walks the tree best first: the largest inner product that any point of a box can have
bounds the box, and the walk ends when the best box left is below the query's k-th score. A
first round searches one shard per query; the k-th score found there goes with the query to
all other shards, where it prunes from the start. Boxes that reach the k-th score are opened
even if they only tie it, because a smaller id would win.
"""

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplake.llm.common import cut, tasks

SHARD = 100_000  # vectors in a shard, about
LEAF = 512
SCALE = 256
EXACT = float(2**53)  # doubles below are exact integers
LONG = 2**63

FOUND = "query_id bigint, vec_id bigint, score bigint"


class Tree:
    """Points of one dimension with their ids, in the order of the leaves; boxes and children
    by node. A leaf is a range of points, with ids ascending."""

    def __init__(self, ids: np.ndarray, points: np.ndarray):
        low, high, order = [], [], []
        self.children: list[list[int]] = []
        self.leaf: list[slice | None] = []
        todo, placed = [(np.arange(len(ids)), None)], 0
        while todo:
            rows, parent = todo.pop()
            node = len(self.leaf)
            if parent is not None:
                self.children[parent].append(node)
            own = points[rows]
            low.append(own.min(axis=0))
            high.append(own.max(axis=0))
            self.children.append([])
            width = high[-1] - low[-1]
            if len(rows) <= LEAF or not width.size or width.max() <= 0:
                self.leaf.append(slice(placed, placed + len(rows)))
                order.append(np.sort(rows))
                placed += len(rows)
                continue
            self.leaf.append(None)
            values = own[:, width.argmax()]
            middle = np.median(values)
            below = values < middle if middle == values.max() else values <= middle
            todo += [(rows[below], node), (rows[~below], node)]
        self.low, self.high = np.array(low), np.array(high)
        order = np.concatenate(order)
        self.ids, self.points = ids[order], points[order]
        self.largest = np.abs(points).max(initial=0)

    def scores(self, query: np.ndarray, leaf: slice, exact: bool) -> np.ndarray:
        if exact:
            return self.points[leaf] @ query
        ints = [int(x) for x in query]
        sums = [sum(int(a) * b for a, b in zip(row, ints)) for row in self.points[leaf]]
        return np.array([min(max(s, -LONG), LONG - 1) for s in sums], dtype=np.int64)

    def search(self, own: int, query: np.ndarray, k: int, floor: int | None) -> list[tuple[int, int]]:
        """Up to k (score, -id), best first, of which none is below ``floor``."""
        exact = np.abs(query).max(initial=0) * self.largest * max(1, len(query)) < EXACT
        bound = self.high @ np.maximum(query, 0) + self.low @ np.minimum(query, 0)
        if not exact:  # such bounds may be rounded: leave room for it
            bound = bound + np.abs(bound) * 1e-9
        bound = bound.tolist()
        limit = -LONG if floor is None else floor
        best: list[tuple[int, int]] = []  # a heap, the worst on top
        queue = [(-bound[0], 0)]
        while queue:
            most, node = heapq.heappop(queue)
            if -most < limit:
                break
            leaf = self.leaf[node]
            if leaf is None:
                for child in self.children[node]:
                    if bound[child] >= limit:
                        heapq.heappush(queue, (-bound[child], child))
                continue
            scores = self.scores(query, leaf, exact)
            good = np.flatnonzero(scores >= limit)
            if not len(good):
                continue
            # Ids ascend, so a stable sort puts the smaller of equal scores first.
            good = good[np.argsort(-scores[good], kind="stable")][: k + 1]
            for score, vec_id in zip(scores[good].tolist(), self.ids[leaf][good].tolist()):
                found = (int(score), -vec_id)
                if vec_id == own:
                    continue
                if len(best) < k:
                    heapq.heappush(best, found)
                elif found > best[0]:
                    heapq.heapreplace(best, found)
            if len(best) == k:
                limit = max(limit, best[0][0])
        return sorted(best, reverse=True)


def searched(k: int):
    """Rows of a shard: vectors first (``query`` is false), then queries with their floors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards: dict[int, dict[int, tuple]] = {}
        trees: dict[int, dict[int, Tree]] = {}
        for batch in batches:
            names = ("shard", "query", "vec_id", "floor", "vector")
            out: list[tuple[int, int, int]] = []
            for shard, query, vec_id, floor, vector in zip(*(batch.column(n).to_pylist() for n in names)):
                if not query:
                    own = shards.setdefault(shard, {})
                    own[vec_id] = min(own.get(vec_id, vector), vector)
                    continue
                if shard not in trees:
                    trees[shard] = planted(shards.pop(shard, {}))
                if len(vector) in trees[shard]:
                    point = np.floor(np.array(vector, dtype=np.float64) * SCALE)
                    hits = trees[shard][len(vector)].search(vec_id, point, k, floor)
                    out += [(vec_id, -minus_id, score) for score, minus_id in hits]
            columns = list(zip(*out)) if out else ([], [], [])
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"]
            )

    return run


def planted(vectors: dict[int, list]) -> dict[int, Tree]:
    by_size: dict[int, list[int]] = {}
    for vec_id, vector in vectors.items():
        by_size.setdefault(len(vector), []).append(vec_id)
    trees = {}
    for size, ids in by_size.items():
        ids.sort()
        points = np.array([vectors[i] for i in ids], dtype=np.float64).reshape(len(ids), size)
        trees[size] = Tree(np.array(ids, dtype=np.int64), np.floor(points * SCALE))
    return trees


def largest_products(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    shard_size: int = SHARD,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of each query's k largest inner products.

    Components count as floor(256 x). Queries are the rows where ``is_query`` (over the
    input's columns) holds; candidates are all rows with another id and as many components.
    Ties go to the smaller id; with fewer candidates than k there are fewer ranks. Rows
    without an id, and vectors that are null or hold null, NaN or infinity, take no part. Of
    rows that repeat an id the smallest vector counts. Empty vectors score 0 with each other.
    Scores beyond 64 bits end at the bounds of long. Other columns play no part.
    """
    whole = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(
        F.col(id_col).cast("bigint").alias("vec_id"),
        F.transform(vector_col, lambda x: x.cast("double")).alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("query"),
    ).where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & whole)
    shards = max(tasks(vectors.sparkSession), -(-vectors.count() // shard_size))
    home = F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int")
    none = F.lit(None).cast("bigint").alias("floor")
    points = rows.select(home.alias("shard"), F.lit(False).alias("query"), "vec_id", none, "vector")
    queries = cut(rows.where("query").groupBy("vec_id").agg(F.min("vector").alias("vector")))

    def search(asked: DataFrame) -> DataFrame:
        both = points.unionByName(asked).repartitionById(shards, "shard")
        return both.sortWithinPartitions("query").mapInArrow(searched(k), FOUND)

    first = cut(search(queries.select(home.alias("shard"), F.lit(True).alias("query"), "vec_id", none, "vector")))
    floors = first.groupBy("query_id").agg(F.min("score").alias("floor"), F.count(F.lit(1)).alias("n"))
    floors = floors.where(F.col("n") == k).select(F.col("query_id").alias("vec_id"), "floor")
    elsewhere = F.explode(F.array_remove(F.sequence(F.lit(0), F.lit(shards - 1)), home))
    rest = queries.join(floors, "vec_id", "left").select(
        elsewhere.alias("shard"), F.lit(True).alias("query"), "vec_id", "floor", "vector"
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = first.unionByName(search(rest)).withColumn("rank", F.row_number().over(best))
    return found.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


SQL = """
with v as (select vec_id, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as q
    from embeddings where embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select a.vec_id as query_id, b.vec_id, cast(list_dot_product(a.q, b.q) as bigint) as score
    from v a join v b on a.vec_id <> b.vec_id where a.vec_id % 50 = 0),
r as (select *, cast(row_number() over (partition by query_id order by score desc, vec_id)
    as integer) as rank from s)
select query_id, rank, vec_id, score from r where rank <= 5
"""
