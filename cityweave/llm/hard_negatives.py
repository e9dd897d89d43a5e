"""Hard negatives by anchor-clustered shared lists.

Rows are dealt to cells by the nearest of some centres; a cell knows the
largest angle and the norms of its rows.  The anchors of a cell form clusters;
a cluster that meets a block of rows sorts them once by their angular upper
bound

    |c| * cos(max(0, angle(c, centre) - r)),   r = the largest angle of the cluster,

and every member walks that list, in steps shared as matrix products, until
the bound times its own norm falls below the worst score that it still needs;
equal scores are never cut off.  Two such searches find first each anchor's
positives, then for each positive the negatives inside its window.

A search visits the anchors' own cells first; the k-th scores found there are
carried, and an anchor goes on only to cells whose bound reaches them.  Cells
are cut into blocks and clusters by hash, so a cell or a group of equal
vectors of any size is many groups.  Centres are spherical k-means on at most
``SAMPLE_ROWS`` rows; they steer the work, results don't depend on them.

Defined results: rows without id, label or vector, and vectors with a null or
non-finite component, take no part; an anchor's candidates have its length and
another id; of several anchors under one id the least (label, vector) counts,
repeated candidates count each; scores beyond a long are cut to its range;
fewer rows than asked for give them all; no anchors give none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cityweave.llm.shared import map_batches, written

SAMPLE_ROWS = 20_000  # rows that the centres are fitted on, at most
CENTRES = 64  # at most, and about one for ANCHORS_PER_CENTRE anchors
ANCHORS_PER_CENTRE = 256
MOST_DIMS = 8  # vector lengths that get centres; others share one cell without bounds
BLOCK_ROWS = 4096
CLUSTER_ROWS = 4096
STEP = 512  # rows of a list that a cluster's members take at a time
SLACK = 1e-6  # radians; guards angles against rounding
_EXACT = float(1 << 52)
_MOST, _LEAST = (1 << 63) - 1, -(1 << 63)
LOOSE = -1  # cell of lengths without centres


def floored(vector: Column, factor: int = 256) -> Column:
    """``floor(factor * x)`` of each component; null if the vector takes no part."""
    ok = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.when(ok & (F.size(vector) > 0), F.transform(vector, lambda x: F.floor(x.cast("double") * factor)))


def _unit(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    norm = np.linalg.norm(v, axis=1)
    return v / np.where(norm > 0, norm, 1)[:, None], norm


def _angle(cosine: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosine, -1, 1))


def fit_centres(rows: DataFrame, total: int, sample_rows: int, centres: int) -> dict[int, np.ndarray]:
    """Centres by vector length, from a bounded sample of the rows."""
    share = min(1.0, sample_rows / max(1, total))
    drawn = rows.select("v").sample(share, seed=11).limit(sample_rows).toArrow()["v"].to_pylist()
    by_dim: dict[int, list] = {}
    for v in drawn:
        by_dim.setdefault(len(v), []).append(v)
    out = {}
    for dim in sorted(by_dim, key=lambda d: (-len(by_dim[d]), d))[:MOST_DIMS]:
        u, _ = _unit(np.array(by_dim[dim], float))
        rng = np.random.default_rng(dim)
        c = u[rng.permutation(len(u))[:centres]]
        for _ in range(8):
            near = (u @ c.T).argmax(axis=1)
            sums = np.zeros_like(c)
            np.add.at(sums, near, u)
            c = np.where(np.linalg.norm(sums, axis=1)[:, None] > 0, sums, c)
            c = _unit(c)[0]
        out[dim] = c
    return out


def _placed(rows: DataFrame, centres: dict[int, np.ndarray]) -> DataFrame:
    """Rows with their length, cell, angle to its centre and norm."""
    known = rows.sparkSession.sparkContext.broadcast(centres)

    def make():
        def place(batch: pa.RecordBatch) -> pa.RecordBatch:
            vectors = batch.column(2).to_pylist()
            dims = np.array([len(v) for v in vectors])
            cell, angle, norm = np.full(len(dims), LOOSE), np.full(len(dims), np.pi), np.zeros(len(dims))
            for dim, c in known.value.items():
                at = np.flatnonzero(dims == dim)
                if len(at):
                    u, norm[at] = _unit(np.array([vectors[i] for i in at], float))
                    cosine = u @ c.T
                    cell[at] = cosine.argmax(axis=1)
                    angle[at] = _angle(cosine[np.arange(len(at)), cell[at]])
            new = [pa.array(dims, pa.int32()), pa.array(cell, pa.int32()), pa.array(angle), pa.array(norm)]
            return pa.RecordBatch.from_arrays([*batch.columns, *new], [*batch.schema.names, "dim", "cell", "angle", "norm"])

        return place

    kinds = ", ".join(f"{c} {t}" for c, t in rows.dtypes)
    return map_batches(rows, make, f"{kinds}, dim int, cell int, angle double, norm double")


class Cells:
    """Centres, radii and norms of the cells: at most ``MOST_DIMS`` x the number of centres."""

    def __init__(self, placed: DataFrame, centres: dict[int, np.ndarray]):
        self.centres = centres
        by_cell = placed.where(F.col("cell") != LOOSE).groupBy("dim", "cell")
        self.known = {(r[0], r[1]): tuple(r[2:]) for r in by_cell.agg(F.max("angle"), F.min("norm"), F.max("norm")).collect()}

    def bounds(self, dim: int, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cells of a length, and the highest score that each vector of ``v`` can have there."""
        cells = np.array(sorted(c for d, c in self.known if d == dim))
        radius, least, most = (np.array([self.known[dim, c][i] for c in cells], float) for i in range(3))
        u, norm = _unit(v)
        top = np.cos(np.maximum(0, _angle(u @ self.centres[dim][cells].T) - radius - SLACK))
        return cells, _above(norm[:, None] * np.where(top > 0, most, least) * top, norm[:, None] * most)


def _above(bound: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return bound + 1e-9 * scale + 1e-6


def walk(
    anchors: np.ndarray, anchor_ids: np.ndarray, labels: np.ndarray, same: bool, targets: list[list[tuple]], k: int,
    rows: np.ndarray, ids: np.ndarray, row_labels: np.ndarray,
) -> list[tuple[int, int, int, int]]:
    """``(anchor place, target place, id, score)`` of each target's ``k`` best rows.

    ``targets`` holds for each anchor tuples ``(low, high, worst)``: scores in
    ``[low, high]`` count, and ones below ``worst`` are not needed.
    """
    a, c = anchors.astype(float), rows.astype(float)
    small = max(1.0, np.abs(a).max()) * max(1.0, np.abs(c).max()) * a.shape[1] < _EXACT
    left, right = (a, c) if small else (anchors.astype(object), rows.astype(object))  # exact: floats below 2^52, else Python integers
    unit, a_norm = _unit(a)
    centre = _unit(unit.mean(axis=0, keepdims=True))[0]
    radius = _angle(unit @ centre[0])[a_norm > 0].max(initial=0.0)
    c_unit, c_norm = _unit(c)
    bound = c_norm * np.cos(np.maximum(0, _angle(c_unit @ centre[0]) - radius - SLACK))
    order = np.argsort(-bound, kind="stable")  # the shared list
    bound = bound[order]
    best: list[list[list[tuple[int, int]]]] = [[[] for _ in own] for own in targets]
    need = np.array([min((max(low, worst) for low, _, worst in own), default=np.inf) for own in targets], float)
    for at in range(0, len(order), STEP):
        live = np.flatnonzero(_above(a_norm * bound[at], a_norm * c_norm.max()) >= need)
        if not len(live):
            break  # every member's walk has ended: the list only falls
        part = order[at : at + STEP]
        scores = left[live] @ right[part].T
        scores = scores.astype(np.int64) if small else np.clip(scores, _LEAST, _MOST).astype(np.int64)
        usable = (labels[live][:, None] == row_labels[part][None, :]) == same
        usable &= (anchor_ids[live][:, None] != ids[part][None, :]) & (scores >= (need - 1e-9 * np.abs(need) - 1)[live][:, None])
        for row in np.flatnonzero(usable.any(axis=1)).tolist():
            m, hit = int(live[row]), np.flatnonzero(usable[row])
            s, i = scores[row, hit], ids[part[hit]]
            for t, (low, high, worst) in enumerate(targets[m]):
                own = best[m][t]
                floor = max(low, worst, own[k - 1][0] if len(own) >= k else _LEAST)
                ok = (s >= floor) & (s <= high)
                if ok.any():
                    s2, i2 = s[ok], i[ok]
                    if len(s2) > k:
                        first = np.lexsort((i2, -s2))[:k]
                        s2, i2 = s2[first], i2[first]
                    best[m][t] = sorted([*own, *zip(s2.tolist(), i2.tolist(), strict=True)], key=lambda x: (-x[0], x[1]))[:k]
            need[m] = min(max(low, worst, own[k - 1][0] if len(own) >= k else _LEAST) for (low, _, worst), own in zip(targets[m], best[m], strict=True))
    return [(m, t, i, s) for m, per in enumerate(best) for t, own in enumerate(per) for s, i in own]


TARGETS = "array<struct<low:bigint,high:bigint,worst:bigint>>"


def _visit(anchors: DataFrame, placed: DataFrame, blocks: DataFrame, cells: Cells, same: bool, k: int, own: bool) -> DataFrame:
    """``anchor_id, target, id, score``: the k best of each target in the anchors' own cells, or in all others that can matter."""
    known = placed.sparkSession.sparkContext.broadcast(cells)

    def make():
        def route(batch: pa.RecordBatch) -> pa.RecordBatch:
            place = {n: i for i, n in enumerate(batch.schema.names)}
            dims, cell, vectors, targets = (batch.column(place[n]).to_pylist() for n in ("dim", "cell", "v", "targets"))
            row, goal = [], []
            for i, (dim, c) in enumerate(zip(dims, cell, strict=True)):
                visits = [c]
                if not own:
                    need = min((max(t["low"], t["worst"]) for t in targets[i]), default=np.inf)
                    found, bound = known.value.bounds(dim, np.array([vectors[i]], float)) if c != LOOSE else (np.empty(0), np.empty((1, 0)))
                    visits = [x for x in found[bound[0] >= need].tolist() if x != c]
                row += [i] * len(visits)
                goal += visits
            kept = [batch.column(i).take(pa.array(row, pa.int64())) for i in range(batch.num_columns)]
            return pa.RecordBatch.from_arrays([*kept, pa.array(goal, pa.int32())], [*batch.schema.names, "goal"])

        return route

    kinds = ", ".join(f"{c} {t}" for c, t in anchors.dtypes)
    keys = ("dim", "goal", "block", "cluster")
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    aims = blocks.withColumnRenamed("cell", "goal")
    routed = written(map_batches(anchors, make, f"{kinds}, goal int"), "routed")
    left = routed.join(aims, ["dim", "goal"]).select("vec_id", "label", "v", "targets", "dim", "goal", "cluster", every)
    clusters = left.select(*keys[:3], F.col("cluster").alias("cluster")).distinct()
    dealt = placed.withColumnRenamed("cell", "goal").join(aims, ["dim", "goal"]).withColumn("block", F.pmod(F.xxhash64("vec_id"), "blocks").cast("int"))
    right = dealt.select("dim", "goal", "block", "vec_id", "label", "v").join(clusters, ["dim", "goal", "block"])

    def search(a: pa.Table, c: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if a.num_rows and c.num_rows:
            (av, ai, al), (cv, ci, cl) = ((np.array(t["v"].to_pylist(), np.int64), t["vec_id"].to_numpy(), t["label"].to_numpy()) for t in (a, c))
            targets = [[(t["low"], t["high"], t["worst"]) for t in own] for own in a["targets"].to_pylist()]
            out = [(int(ai[m]), t, i, s) for m, t, i, s in walk(av, ai, al, same, targets, k, cv, ci, cl)]
        columns = list(zip(*out, strict=True)) or [()] * 4
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
        return pa.Table.from_arrays([pa.array(x, t) for x, t in zip(columns, kinds, strict=True)], ["anchor_id", "target", "id", "score"])

    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(search, "anchor_id bigint, target int, id bigint, score bigint")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor_id", "target").orderBy(F.desc("score"), F.asc("id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search(anchors: DataFrame, placed: DataFrame, blocks: DataFrame, cells: Cells, same: bool, k: int, name: str) -> DataFrame:
    """``anchor_id, target, rank, id, score`` of the k best of every target of ``anchors(..., targets)``."""
    first = written(_visit(anchors, placed, blocks, cells, same, k, True), f"{name}-own")
    # the k-th score of the own cell is a floor for all other cells
    kth = _ranked(first, k).where(F.col("rank") == k).groupBy("anchor_id").agg(F.map_from_entries(F.collect_list(F.struct("target", "score"))).alias("kth"))
    carried = anchors.join(kth, F.col("vec_id") == F.col("anchor_id"), "left")
    worst = lambda t, i: F.struct(t["low"].alias("low"), t["high"].alias("high"), F.greatest(t["worst"], F.coalesce(F.try_element_at("kth", i), F.lit(_LEAST))).alias("worst"))
    carried = carried.select(*[F.transform("targets", worst).alias(c) if c == "targets" else F.col(c) for c in anchors.columns])
    return _ranked(first.unionByName(_visit(carried, placed, blocks, cells, same, k, False)), k)


def hard_negatives(
    vectors: DataFrame,
    anchors: Column,
    positives: int = 5,
    negatives: int = 3,
    low_percent: int = 50,
    high_percent: int = 95,
    sample_rows: int = SAMPLE_ROWS,
    centres: int = CENTRES,
    block_rows: int = BLOCK_ROWS,
    cluster_rows: int = CLUSTER_ROWS,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``vectors(vec_id, v array<bigint>, label)``; ``anchors`` tells which rows
    are anchors.  A negative has another label and a score between
    ``low_percent`` and ``high_percent`` of its positive's.
    """
    rows = vectors.where("v is not null and vec_id is not null and label is not null")
    rows = rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"), "v", anchors.alias("_anchor"))
    total, n_anchors = rows.agg(F.count(F.lit(1)), F.count_if("_anchor")).first()
    fitted = fit_centres(rows, total, sample_rows, max(1, min(centres, -(-n_anchors // ANCHORS_PER_CENTRE))))
    placed = written(_placed(rows, fitted), "placed")
    cells = Cells(placed, fitted)
    blocks = written(placed.groupBy("dim", "cell").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("blocks")), "blocks")
    least = placed.where("_anchor").groupBy("vec_id").agg(F.min(F.struct("label", "v", "dim", "cell")).alias("a"), F.count(F.lit(1)).alias("n"))
    mine = least.select("vec_id", "a.label", "a.v", "a.dim", "a.cell")
    # clusters of a cell's anchors: about as many as its share asks for
    per_cell = mine.groupBy("dim", "cell").agg(F.ceil(F.count(F.lit(1)) / cluster_rows).cast("int").alias("parts"))
    mine = mine.join(per_cell, ["dim", "cell"]).withColumn("cluster", F.struct("cell", F.pmod(F.xxhash64("vec_id"), "parts").alias("part"))).drop("parts")
    mine = written(mine, "anchors")
    any_score = F.array(F.struct(F.lit(_LEAST).alias("low"), F.lit(_MOST).alias("high"), F.lit(_LEAST).alias("worst")))
    best = written(_search(mine.withColumn("targets", any_score), placed, blocks, cells, True, positives, "positives").drop("target"), "positives")
    # floor(p * s / 100) without overflow; a negative score has an empty window
    share = lambda p, up: (F.expr("score div 100") * p + F.floor((F.expr("score % 100") * p + up) / 100)).cast("bigint")
    window = F.struct(F.col("rank"), share(low_percent, 99).alias("low"), share(high_percent, 0).alias("high"), F.lit(_LEAST).alias("worst"))
    wanted = best.where("score >= 0").groupBy("anchor_id").agg(F.array_sort(F.collect_list(window)).alias("ws"))
    narrowed = F.transform("ws", lambda w: F.struct(w["low"].alias("low"), w["high"].alias("high"), w["worst"].alias("worst"))).alias("targets")
    aimed = mine.join(wanted, F.col("vec_id") == F.col("anchor_id")).select(*mine.columns, narrowed)
    aimed = written(aimed, "aimed")
    found = _search(aimed, placed, blocks, cells, False, negatives, "negatives")
    named = best.select("anchor_id", (F.col("rank") - 1).alias("target"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return found.join(named, ["anchor_id", "target"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
