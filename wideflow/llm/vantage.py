"""Nearest neighbours by inner product with vantage-point trees, one per shard.

Vectors are spread over shards by the power of two of their largest component (their size class) and
then by their id; queries come in blocks, and each (shard, block) pair is one group. Within a shard the vectors,
divided by the greatest norm, get one more coordinate that makes all
norms 1, so that the largest inner product with a query (of norm 1 too) is the smallest Euclidean distance, for
which the triangle inequality holds. As norms of a shard differ by a factor of 2 * sqrt(dimensions) at most, that coordinate
keeps the digits of small vectors beside huge ones. A subtree is left out when ``factor`` times its
lower bound exceeds the distance of the k-th best so far: a factor of 1 is exact, a larger
one prunes more. The winners' scores are then computed anew on the original vectors. The search tells products apart that
differ by 4e-12 of the product of the norms or more, and takes nearer ones as tied, smaller ids first; ``SPARE`` more points
than needed are kept, so that the scores settle their order.

Equal vectors of a shard become one point that keeps its k + 1 smallest ids, all
that any query can need from them, so large groups of copies cost nothing.

Defined cases: a null id, a null or empty vector, a null, NaN or infinite component and a zero
vector take no part; vectors of other lengths than a query's are not its candidates;
of rows that repeat an id the smallest vector counts, once; ties of score go to the smaller
id, however many there are; with fewer candidates than k all are returned; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import find_package, staged

#: Vectors in a shard and queries in a block, about; they bound a group's memory.
SHARD_ROWS, BLOCK_ROWS = 20_000, 8_000
LEAF = 256
#: Points kept beyond k until scores are exact (rounding may swap near ties).
SPARE = 8


class VantageTree:
    """Points in Euclidean space; inner nodes split at the median distance to a vantage point."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.points, self.leaf = points, leaf
        self.root = self._build(np.arange(len(points)))

    def _build(self, index: np.ndarray):
        if len(index) <= self.leaf:
            return index
        # The point farthest from the first one: a corner, which splits better than a middle.
        d = self._distance(self.points[index[:1]], index)[0]
        vantage = index[np.argmax(d)]
        d = self._distance(self.points[[vantage]], index)[0]
        order = np.argsort(d, kind="stable")
        half = len(index) // 2
        if d[order[0]] == d[order[-1]]:
            return index  # all equally far: nothing to split by
        inner, outer = order[:half], order[half:]
        return vantage, d[inner].max(), d[outer].min(), self._build(index[inner]), self._build(index[outer])

    def _distance(self, q: np.ndarray, index: np.ndarray) -> np.ndarray:
        p = self.points[index]
        d2 = (q * q).sum(1)[:, None] + (p * p).sum(1)[None, :] - 2 * (q @ p.T)
        return np.sqrt(np.maximum(d2, 0))

    def search(self, q: np.ndarray, k: int, factor: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
        """Distances and indexes of the k nearest found of each query, unordered; (inf, -1) where there are fewer.

        Equal distances go to the smaller index. Distance and index of a candidate are one integer: the squared distance
        on a grid in its upper bits, the index in the lower ones.
        """
        width = np.sqrt((self.points * self.points).sum(1).max()) + np.sqrt((q * q).sum(1).max())  # no distance exceeds it
        bits = len(self.points).bit_length()
        unit = max(width * width, np.finfo(float).tiny) / 2.0 ** min(40, 61 - bits)
        slack = 1e-7 * width
        none = np.iinfo(np.int64).max
        best = np.full((len(q), k), none)
        done = {}

        def kth(at):
            last = best[at].max(1)
            return np.where(last == none, np.inf, np.sqrt(((last >> bits) + 1) * unit))

        def leaf(index, at):
            d = self._distance(q[at], index)
            keys = np.rint(d * d / unit).astype(np.int64) << bits | index[None, :]
            best[at] = np.partition(np.concatenate([best[at], keys], 1), k - 1, axis=1)[:, :k]

        def seed(node, at):  # down to the nearest leaf, for a first k-th distance
            if not len(at):
                return
            if not isinstance(node, tuple):
                done[id(node)] = at
                leaf(node, at)
                return
            v, in_max, out_min, inner, outer = node
            near = self._distance(q[at], np.array([v]))[:, 0] <= (in_max + out_min) / 2
            seed(inner, at[near])
            seed(outer, at[~near])

        def visit(node, at):
            if not len(at):
                return
            if not isinstance(node, tuple):
                if id(node) in done:
                    at = np.setdiff1d(at, done[id(node)], assume_unique=True)
                if len(at):
                    leaf(node, at)
                return
            v, in_max, out_min, inner, outer = node
            d = self._distance(q[at], np.array([v]))[:, 0]
            visit(inner, at[factor * (d - in_max) <= kth(at) + slack])
            visit(outer, at[factor * (out_min - d) <= kth(at) + slack])

        seed(self.root, np.arange(len(q)))
        visit(self.root, np.arange(len(q)))
        missing = best == none
        return np.where(missing, np.inf, np.sqrt((best >> bits) * unit)), np.where(missing, -1, best & ((1 << bits) - 1))


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows in double precision, summed in the order of the components."""
    total = np.zeros(len(a))
    for i in range(a.shape[1]):
        total += a[:, i] * b[:, i]
    return total


def _once(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors (double); of rows that repeat an id, the smallest vector."""
    ids = pdf["id"].to_numpy()
    v = np.stack(pdf["v"].to_numpy()).astype(np.float64)
    order = np.lexsort((*v.T[::-1], ids)) if len(np.unique(ids)) < len(ids) else np.argsort(ids)
    ids, v = ids[order], v[order]
    first = np.r_[True, ids[1:] != ids[:-1]]
    return ids[first], v[first]


def _search_group(k: int, factor: float):
    empty = pd.DataFrame({"query_id": np.empty(0, np.int64), "vec_id": np.empty(0, np.int64), "score": np.empty(0)})

    def run(key: tuple, vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if vectors.empty or queries.empty:
            return empty
        ids, v = _once(vectors)
        q_ids, q = _once(queries)
        # Points in the order of their smallest ids, which settles ties.
        _, first, which = np.unique(v, axis=0, return_index=True, return_inverse=True)
        by_id = np.argsort(first)
        points, which = v[first[by_id]], np.argsort(by_id)[which.ravel()]
        order = np.argsort(which, kind="stable")  # ids stay ascending within a point
        begin = np.r_[0, np.cumsum(np.bincount(which, minlength=len(points)))]
        scaled = np.ldexp(points, -int(key[1]))
        scaled /= np.sqrt((scaled * scaled).sum(1).max())
        tree = VantageTree(np.c_[scaled, np.sqrt(np.maximum(1 - (scaled * scaled).sum(1), 0))])
        unit = np.ldexp(q, -np.frexp(np.abs(q).max(1))[1][:, None])
        unit /= np.sqrt((unit * unit).sum(1))[:, None]
        n = min(k + 1 + SPARE, len(points))
        _, found = tree.search(np.c_[unit, np.zeros(len(q))], n, factor)
        row, col = np.nonzero(found >= 0)
        point = found[row, col]
        score = exact_products(q[row], points[point])
        copies = np.minimum(begin[point + 1] - begin[point], k + 1)
        at = np.repeat(begin[point], copies) + np.arange(copies.sum()) - np.repeat(np.cumsum(copies) - copies, copies)
        out = pd.DataFrame({"query_id": np.repeat(q_ids[row], copies), "vec_id": ids[order[at]], "score": np.repeat(score, copies)})
        out = out[out["query_id"] != out["vec_id"]].sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True])
        return out[out.groupby("query_id").cumcount() < k]
    return run


def usable(vector: Column) -> Column:
    """Whether a vector takes part: no null, non-finite or only zero components."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, factor: float = 1.0, id_col: str = "vec_id",
            vector_col: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` vectors of largest inner product, never the query's own row."""
    find_package(vectors)

    def clean(df: DataFrame) -> DataFrame:
        v = F.col(vector_col)
        return df.where(F.col(id_col).isNotNull() & F.coalesce(usable(v), F.lit(False))).select(
            F.col(id_col).cast("long").alias("id"), F.size(v).alias("dims"), v.alias("v"))

    largest = F.array_max(F.transform("v", lambda x: F.abs(x.cast("double"))))
    c, q = clean(vectors).withColumn("class", F.floor(F.log2(largest)).cast("int")), clean(queries)
    torn = staged(c.groupBy("dims", "id").agg(F.min("class").alias("a"), F.max("class").alias("b"))
                  .where("a < b").select("dims", "id"), "ids-of-two-classes")
    if not torn.isEmpty():  # such an id would come from several shards
        one = c.join(torn, ["dims", "id"], "left_semi").groupBy("dims", "id").agg(F.min(F.struct("v", "class")).alias("s"))
        c = c.join(torn, ["dims", "id"], "left_anti").unionByName(one.select("id", "dims", "s.v", "s.class"))
    sizes = staged(c.groupBy("dims", "class").agg(F.ceil(F.count("*") / SHARD_ROWS).alias("shards")), "size-classes")
    blocks = -(-q.count() // BLOCK_ROWS) or 1
    c = (c.join(sizes, ["dims", "class"])
         .withColumn("shard", F.pmod(F.xxhash64("id"), F.col("shards"))).drop("shards")
         .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))))
    q = (q.withColumn("block", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(blocks)).cast("int")).join(sizes, "dims")
         .withColumn("shard", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("shards") - 1))).drop("shards"))
    keys = ["dims", "class", "shard", "block"]
    got = (c.groupBy(keys).cogroup(q.groupBy(keys))
           .applyInPandas(_search_group(k, factor), "query_id long, vec_id long, score double"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (got.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
