"""Exact top-k by integer inner product with two cover trees.

Queries and candidates are dealt to blocks by hash; each pair of a query block
and a candidate block is one group.  In a group both sides are indexed by a
cover tree: a node's children are a net of its points at a fraction of its
radius, each node knows its covering radius.  Pairs of nodes are visited from
the best bound down; a pair is pruned when

    q . c + |q| R_c + |c| R_q + R_q R_c  <  the worst k-th score among the
                                             node's queries,

so equal scores are never pruned and ties go to the smaller id.  Every group
gives its queries' k best; a window ranks them per query.

Defined results: vectors that are null or hold a null or non-finite component
take no part; vectors of another length than a query's are no candidates of
it; rows with the query's own id are no candidates; repeated query ids count
once; fewer than k candidates give them all.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 4096
QUERY_ROWS = 2048
LEAF = 48
SHRINK = 1.5  # a net's radius is its parent's divided by this
_EXACT = float(1 << 52)


class Node:
    """Points ``rows`` around ``center``; a leaf has no children."""

    __slots__ = ("center", "children", "norm", "radius", "rows")

    def __init__(self, points: np.ndarray, rows: np.ndarray, leaf: int = LEAF):
        self.center = points[rows[0]]
        self.norm = float(np.linalg.norm(self.center))
        far = np.linalg.norm(points[rows] - self.center, axis=1)
        self.radius, self.rows, self.children = float(far.max()), rows, []
        if len(rows) <= leaf or not self.radius:
            return
        rest, loose, net = rows, [], self.radius / SHRINK
        while len(rest):
            near = np.linalg.norm(points[rest] - points[rest[0]], axis=1) <= net
            if near.all() and len(rest) == len(rows):  # cannot happen: the farthest point lies outside the net
                break
            group, rest = rest[near], rest[~near]
            if len(group) * 4 < leaf:
                loose.append(group)  # too few for a node of their own
            else:
                self.children.append(Node(points, group, leaf))
        stray = np.concatenate(loose) if loose else rows[:0]
        for at in range(0, len(stray), leaf):
            self.children.append(_bucket(points, stray[at : at + leaf]))


def _bucket(points: np.ndarray, rows: np.ndarray) -> Node:
    node = Node.__new__(Node)
    node.center = points[rows].mean(axis=0)
    node.norm = float(np.linalg.norm(node.center))
    node.radius = float(np.linalg.norm(points[rows] - node.center, axis=1).max())
    node.rows, node.children = rows, []
    return node


def dual_tree(queries: np.ndarray, query_ids: np.ndarray, points: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """``(query position, id, score)`` of each query's ``k`` best points (int64 arrays)."""
    q, p = queries.astype(float), points.astype(float)
    small = max(1.0, np.abs(q).max()) * max(1.0, np.abs(p).max()) * q.shape[1] < _EXACT
    left, right = (q, p) if small else (queries.astype(object), points.astype(object))  # exact: floats below 2^52, else Python integers
    best_score = np.full((len(q), k), np.iinfo(np.int64).min)
    best_id = np.full((len(q), k), np.iinfo(np.int64).max)
    filled = np.zeros(len(q), np.int64)
    roots = Node(q, np.arange(len(q))), Node(p, np.arange(len(p)))

    def bound(a: Node, b: Node) -> float:
        top = float(a.center @ b.center) + a.norm * b.radius + b.norm * a.radius + a.radius * b.radius
        return top + 1e-9 * abs(top) + 1e-6

    def worst(a: Node) -> float:
        return float(best_score[a.rows, -1].min()) if (filled[a.rows] >= k).all() else -math.inf

    def compare(a: Node, b: Node) -> None:
        found = (left[a.rows] @ right[b.rows].T).astype(np.int64)
        for row, scores in zip(a.rows.tolist(), found, strict=True):
            take = (scores >= best_score[row, -1]) & (ids[b.rows] != query_ids[row])
            if not take.any():
                continue
            s = np.concatenate([best_score[row, : filled[row]], scores[take]])
            i = np.concatenate([best_id[row, : filled[row]], ids[b.rows][take]])
            order = np.lexsort((i, -s))[:k]
            filled[row] = len(order)
            best_score[row, : len(order)], best_id[row, : len(order)] = s[order], i[order]

    stack = [(bound(*roots), *roots)]
    while stack:
        top, a, b = stack.pop()
        if top < worst(a):
            continue
        if not a.children and not b.children:
            compare(a, b)
            continue
        split_first = a.children and (not b.children or a.radius > b.radius)
        pairs = [(c, b) for c in a.children] if split_first else [(a, c) for c in b.children]
        stack += sorted(((bound(*x), *x) for x in pairs), key=lambda x: x[0])  # the best bound is popped first
    rows = np.repeat(np.arange(len(q)), filled)
    mask = np.arange(k) < filled[:, None]
    return rows, best_id[mask], best_score[mask]


def scaled(vector: Column, factor: int = 1024) -> Column:
    """``floor(factor * x)`` of each component; null if the vector takes no part."""
    ok = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.when(ok & (F.size(vector) > 0), F.transform(vector, lambda x: F.floor(x.cast("double") * factor)))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score`` from ``vectors(vec_id, v array<bigint>)`` and ``queries`` of the same columns."""
    vectors = vectors.where("v is not null and vec_id is not null")
    queries = queries.where("v is not null and vec_id is not null").dropDuplicates(["vec_id"])
    blocks = max(1, math.ceil(vectors.count() / block_rows))
    query_blocks = max(1, math.ceil(queries.count() / query_rows))
    deal = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = queries.select("vec_id", "v", F.size("v").alias("dim"), deal(query_blocks).alias("qb"), every(blocks).alias("cb"))
    right = vectors.select("vec_id", "v", F.size("v").alias("dim"), every(query_blocks).alias("qb"), deal(blocks).alias("cb"))

    def search(a: pa.Table, b: pa.Table) -> pa.Table:
        out = [np.empty(0, np.int64)] * 3
        if a.num_rows and b.num_rows:
            (q, qi), (p, pi) = ((np.array(t["v"].to_pylist(), np.int64), t["vec_id"].to_numpy()) for t in (a, b))
            rows, ids, scores = dual_tree(q, qi, p, pi, k)
            out = [qi[rows], ids, scores]
        return pa.Table.from_arrays([pa.array(x) for x in out], ["query_id", "vec_id", "score"])

    keys = ("dim", "qb", "cb")
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(search, "query_id bigint, vec_id bigint, score bigint")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id")))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
