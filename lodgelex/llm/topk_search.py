"""Exact top-k search by dual-tree traversal of cover trees.

Candidates are dealt to blocks of bounded size, near vectors together, queries to parts.  A task gets
a block of candidates and a part's queries, builds a cover tree over each and walks both together.
A pair of nodes is given up when no point below the one can reach the worst k-th score of the
queries below the other: <q, p> <= <Q, P> + |Q| r_P + |P| r_Q + r_Q r_P for centres Q, P and
covering radii r.  Values are integers, so scores are exact and ties are decided by the smaller id.

A first round searches each query in a block of its own neighbourhood.  The k-th score found there is
a lower bound: the second round sends the query only to neighbourhoods that can reach it, by the same
inequality, and returns only what reaches it.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodgelex.llm.common import saved

cloudpickle.register_pickle_by_value(sys.modules[__name__])

K = 20
SCALE = 64
#: Vectors in a block, on average; no block has more than twice as many.
BLOCK_ROWS = 4096
#: Queries that a block of candidates meets together.
PART_ROWS = 16_384
#: Points below which a node of a cover tree is a leaf.
LEAF = 256
#: Vectors sampled as centres of neighbourhoods, at most.
CENTRES = 512


def scaled(column: str, scale: int = SCALE):
    """floor(scale * x) of every component, null where the vector has to stay out."""
    number = F.transform(column, lambda x: x.cast("double"))
    finite = F.forall(
        number, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    return F.when(finite, F.transform(number, lambda x: F.floor(x * scale).cast("long")))


class CoverTree:
    """Nested balls: every point of a node lies within the node's radius of its centre.

    A node's children are built around points chosen greedily at half its radius, the covering rule
    of a cover tree, so radii shrink by level; a node of at most ``LEAF`` points is a leaf.
    """

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.points = points
        self.order = np.arange(len(points))
        self.centre: list[int] = []
        self.radius: list[float] = []
        self.span: list[tuple[int, int]] = []
        self.children: list[list[int]] = []
        self.leaf = leaf
        if len(points):
            self._build(0, len(points))

    def _build(self, low: int, high: int) -> int:
        rows = self.order[low:high]
        own = self.points[rows]
        # The centre is the point nearest to the mean.
        first = int(((own - own.mean(0)) ** 2).sum(1).argmin())
        gap = np.sqrt(((own - own[first]) ** 2).sum(1))
        node = len(self.centre)
        self.centre.append(int(rows[first]))
        self.radius.append(float(gap.max()))
        self.span.append((low, high))
        self.children.append([])
        if len(rows) <= self.leaf or self.radius[node] == 0.0:
            return node
        cover, nearest, member = self.radius[node] / 2, gap, np.zeros(len(rows), int)
        count = 1
        while (far := int(nearest.argmax())) is not None and nearest[far] > cover and count < 32:
            other = np.sqrt(((own - own[far]) ** 2).sum(1))
            closer = other < nearest
            member[closer], nearest = count, np.where(closer, other, nearest)
            count += 1
        if count == 1:
            return node
        turn = np.argsort(member, kind="stable")
        self.order[low:high] = rows[turn]
        ends = np.cumsum(np.bincount(member, minlength=count)) + low
        for a, b in zip([low, *ends[:-1]], ends, strict=True):
            if b > a:
                self.children[node].append(self._build(int(a), int(b)))
        return node


def dual_search(queries, query_ids, candidates, candidate_ids, bounds, k: int):
    """Per query the (score, id) of its best k in this block that reach ``bounds``, ties to small ids."""
    q_tree, c_tree = CoverTree(queries), CoverTree(candidates)
    q_norm = np.sqrt((queries**2).sum(1))
    c_norm = np.sqrt((candidates**2).sum(1))
    worst = bounds.astype(float).copy()
    best: list[list[tuple[int, int]]] = [[] for _ in range(len(queries))]

    def reach(q: int, c: int) -> float:
        a, b = q_tree.centre[q], c_tree.centre[c]
        r, s = q_tree.radius[q], c_tree.radius[c]
        return float(queries[a] @ candidates[b]) + q_norm[a] * s + c_norm[b] * r + r * s

    def leaves(q: int, c: int) -> None:
        q_rows = q_tree.order[slice(*q_tree.span[q])]
        c_rows = c_tree.order[slice(*c_tree.span[c])]
        scores = queries[q_rows] @ candidates[c_rows].T
        scores[query_ids[q_rows][:, None] == candidate_ids[c_rows][None, :]] = -np.inf
        top = scores
        if len(c_rows) > k:
            cut = np.partition(scores, len(c_rows) - k, axis=1)[:, len(c_rows) - k]
            limit = np.maximum(cut, worst[q_rows])
        else:
            limit = worst[q_rows]
        for i in np.flatnonzero((top >= limit[:, None]).any(1)):
            row = q_rows[i]
            good = np.flatnonzero((scores[i] >= limit[i]) & (scores[i] > -np.inf))
            merged = best[row] + [(-int(scores[i, j]), int(candidate_ids[c_rows[j]])) for j in good]
            merged.sort()
            best[row] = merged[:k]
            if len(best[row]) == k:
                worst[row] = max(worst[row], -best[row][-1][0])

    def walk(q: int, c: int) -> None:
        need = worst[q_tree.order[slice(*q_tree.span[q])]].min()
        if reach(q, c) < need - 1e-6 * (1 + abs(need)):
            return
        down_q, down_c = q_tree.children[q], c_tree.children[c]
        if not down_q and not down_c:
            leaves(q, c)
        elif down_c and (not down_q or c_tree.radius[c] >= q_tree.radius[q]):
            for child in sorted(down_c, key=lambda x: -reach(q, x)):
                walk(q, child)
        else:
            for child in down_q:
                walk(child, c)

    if len(queries) and len(candidates):
        walk(0, 0)
    return best


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    rows = column.to_pylist()
    return np.array(rows, float).reshape(len(rows), -1)


def search(
    vectors: DataFrame,
    query_where,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = K,
    scale: int = SCALE,
    block_rows: int = BLOCK_ROWS,
    centres: int = CENTRES,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best of every row that ``query_where`` selects.

    The score is the integer inner product of the scaled vectors.  A query's own row is no candidate;
    of equal scores the smaller id comes first.  Sums of products must stay below 2 ** 53.  Vectors that are null, hold null or non-finite
    components, or have no id take no part.  Vectors of different lengths are compared within their
    length only.  Repeated ids are candidates of their own for other queries; as a query one of
    their vectors counts, the first by its bytes, in every run the same.
    """
    base = vectors.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), scaled(vector_col, scale).alias("v"),
        query_where.alias("asks"),
    ).where("v is not null")
    base = saved(base.withColumn("dim", F.size("v")), "vectors")
    counted = base.groupBy("dim").agg(
        F.count("*").alias("n"), F.count(F.when(F.col("asks"), 1)).alias("q")
    ).collect()
    empty = base.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    parts = [
        _search_one(base.where(F.col("dim") == r["dim"]), r["n"], k, block_rows, centres, part_rows)
        for r in counted
        if r["q"] and r["n"] > 1
    ]
    result = empty
    for part in parts:
        result = part if result is empty else result.unionByName(part)
    return result


def _packed(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in rows], pa.binary())


def _unpacked(column: pa.ChunkedArray) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), float).reshape(len(rows), -1)


def _placed(base: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Every vector with its nearest pivot and its distance from it."""
    sizes = (pivots**2).sum(1)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                points = _matrix(batch.column("v"))
                gap = (points**2).sum(1)[:, None] + sizes - 2 * points @ pivots.T
                near = gap.argmin(1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), batch.column("asks"), _packed(points),
                     pa.array(near.astype(np.int32)),
                     pa.array(np.sqrt(((points - pivots[near]) ** 2).sum(1)))],
                    names=["id", "asks", "point", "pivot", "gap"],
                )

    return saved(
        base.select("id", "asks", "v").mapInArrow(
            run, "id long, asks boolean, point binary, pivot int, gap double"
        ),
        "placed",
    )


def _block_search(queries: DataFrame, candidates: DataFrame, k: int) -> DataFrame:
    """The k best of every query in each block it is sent to, at or above its bound."""
    keys = ["pivot", "sub", "part"]

    def run(asked: pa.Table, offered: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int]] = []
        if asked.num_rows and offered.num_rows:
            ids = asked["id"].to_numpy()
            found = dual_search(
                _unpacked(asked["point"]), ids, _unpacked(offered["point"]),
                offered["id"].to_numpy(), asked["bound"].to_numpy(), k,
            )
            out = [(q, i, -s) for q, rows in zip(ids.tolist(), found, strict=True) for s, i in rows]
        columns = list(zip(*out, strict=True)) if out else [[], [], []]
        return pa.table(
            [pa.array(list(c), pa.int64()) for c in columns], names=["query_id", "vec_id", "score"]
        )

    return (
        queries.groupBy(*keys).cogroup(candidates.groupBy(*keys))
        .applyInArrow(run, "query_id long, vec_id long, score long")
    )


def _search_one(base, rows: int, k: int, block_rows: int, centres: int, part_rows: int) -> DataFrame:
    spark = base.sparkSession
    count = min(centres, -(-rows // block_rows))
    # At most ``centres`` rows reach the driver; every row is searched.
    chosen = base.orderBy(F.xxhash64("id"), "id", "v").limit(count).select("v").collect()
    pivots = np.array([r["v"] for r in chosen], float)
    placed = _placed(base, pivots)
    stats = placed.groupBy("pivot").agg(F.count("*").alias("n"), F.max("gap").alias("radius")).collect()
    subs = spark.createDataFrame(
        [(r["pivot"], -(-r["n"] // block_rows)) for r in stats], "pivot int, subs long"
    )
    radius = np.full(len(pivots), -1.0)
    for r in stats:
        radius[r["pivot"]] = r["radius"]
    asking = placed.where("asks").groupBy("id").agg(F.min(F.struct("point", "pivot")).alias("x"))
    asking = saved(asking.select("id", "x.point", "x.pivot"), "queries")
    parts = max(1, -(-asking.count() // part_rows))
    blocks = placed.join(F.broadcast(subs), "pivot").select(  # one row per pivot
        "id", "point", "pivot", F.pmod(F.xxhash64("id"), F.col("subs")).alias("sub"),
        F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"),
    )
    own_part = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(parts)).cast("int").alias("part")

    near = asking.select(
        "id", "point", "pivot", F.lit(0).cast("long").alias("sub"), own_part,
        F.lit(float("-inf")).alias("bound"),
    )
    first = _block_search(near, blocks.where("sub = 0"), k)
    bounds = first.groupBy("query_id").agg(
        F.when(F.count("*") >= k, F.min("score")).cast("double").alias("bound")
    )
    known = asking.join(bounds, F.col("id") == F.col("query_id"), "left").select(
        "id", "point", F.coalesce("bound", F.lit(float("-inf"))).alias("bound")
    )

    def wanted(batches):
        """The neighbourhoods that may hold a vector at or above the query's bound."""
        for batch in batches:
            if batch.num_rows:
                points, bound = _unpacked(batch.column("point")), batch.column("bound").to_numpy()
                norm = np.sqrt((points**2).sum(1))
                reach = points @ pivots.T + norm[:, None] * np.maximum(radius, 0)
                may = (reach >= bound[:, None] - 1e-6 * (1 + np.abs(bound[:, None]))) & (radius >= 0)
                row, pivot = np.nonzero(may)
                at = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(n).take(at) for n in ("id", "point", "bound")),
                     pa.array(pivot.astype(np.int32))],
                    names=["id", "point", "bound", "pivot"],
                )

    sent = known.mapInArrow(wanted, "id long, point binary, bound double, pivot int")
    spread = sent.join(F.broadcast(subs), "pivot").select(
        "id", "point", "bound", "pivot", own_part,
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("subs") - 1)).alias("sub"),
    )
    found = _block_search(spread, blocks, k)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"
    )
