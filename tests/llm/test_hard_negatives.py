"""Hard negatives against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cityweave.llm import hard_negatives as hn

from .cases import EXTRA

SCHEMA = "vec_id bigint, embedding array<float>, label int"
FIELDS = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def floored(v):
    if not v or any(x is None or not np.isfinite(x) for x in v):
        return None
    return [max(-(1 << 63), min((1 << 63) - 1, int(np.floor(256 * float(np.float32(x)))))) for x in v]


def brute(rows, step, positives=5, negatives=3):
    clean = [(i, floored(v), g) for i, v, g in rows if i is not None and g is not None and floored(v)]
    anchors = {}
    for i, v, g in clean:
        if i % step == 0:
            anchors[i] = min(anchors.get(i, (g, v)), (g, v))
    out = []
    for a, (g, v) in anchors.items():
        scored = [(max(-(1 << 63), min((1 << 63) - 1, sum(x * y for x, y in zip(v, w, strict=True)))), i, h) for i, w, h in clean if i != a and len(w) == len(v)]
        scored.sort(key=lambda x: (-x[0], x[1]))
        for ps, p in [(s, i) for s, i, h in scored if h == g][:positives]:
            fit = [(s, i) for s, i, h in scored if h != g and 50 * ps <= 100 * s <= 95 * ps][:negatives]
            out += [(a, p, r + 1, i, ps, s) for r, (s, i) in enumerate(fit)]
    return sorted(out)


def table(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in EXTRA if c not in ("label",)}).repartition(3)
    return df.select("*", hn.floored(F.col("embedding")).alias("v"))


def mined(spark, rows, step=7, **options):
    found = hn.hard_negatives(table(spark, rows), F.col("vec_id") % step == 0, **options)
    return sorted(tuple(r[f] for f in FIELDS) for r in found.collect())


def clustered(n, seed=1, dim=8, groups=12):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dim))
    return [(i, (centres[i % groups] + rng.normal(size=dim) * 0.15).round(4).tolist(), int(rng.integers(3))) for i in range(n)]


@pytest.mark.parametrize("options", [{}, {"centres": 1}, {"block_rows": 16, "cluster_rows": 4, "sample_rows": 40}])
def test_against_brute_force(spark, options, monkeypatch):
    monkeypatch.setattr(hn, "ANCHORS_PER_CENTRE", 4)
    rows = clustered(260)
    rows += [(1000 + i, [0.5, 0.25, 0.0, 0.0, 0.0, 0.0, 0.0, -0.5], i % 2) for i in range(120)]  # equal vectors: ties
    rows += [(None, rows[0][1], 1), (2001, None, 1), (2002, [], 1), (2003, [None] * 8, 1), (2004, [float("nan")] * 8, 1)]
    rows += [(2005, [float("inf")] + [0.0] * 7, 1), (2006, rows[0][1], None), (2009, [0.0] * 8, 0), (2016, [0.0] * 8, 0)]
    rows += [(7, rows[7][1], rows[7][2]), (3003, [0.1] * 8, 1), (3003, [0.2] * 8, 0)]  # repeated and ambiguous ids
    rows += [(4000 + i, [0.1 * i, -0.2, 0.3], i % 2) for i in range(30)]  # another length
    assert mined(spark, rows, **options) == brute(rows, 7)


def test_lengths_without_centres(spark, monkeypatch):
    monkeypatch.setattr(hn, "MOST_DIMS", 1)
    rng = random.Random(4)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(2 + i % 4)], i % 3) for i in range(160)]
    assert mined(spark, rows, block_rows=8) == brute(rows, 7)


def test_large_components(spark):
    """Scores beyond 2^53 are exact; beyond a long they are cut to its range."""
    rng = random.Random(2)
    for scale in (3e5, 1e13, 3e30):
        rows = [(i, [rng.uniform(-1, 1) * scale for _ in range(4)], i % 2) for i in range(60)]
        assert mined(spark, rows) == brute(rows, 7)


def test_empty(spark):
    rows = clustered(30)
    assert mined(spark, rows[:0]) == []
    assert mined(spark, [r for r in rows if r[0] % 7]) == []
    assert mined(spark, [(0, [1.0, 2.0], 1), (1, [1.0, 2.0], 1)]) == []


def test_walks_end_early(monkeypatch):
    """On clustered rows a member's walk is cut off after a small part of the shared list."""
    monkeypatch.setattr(hn, "STEP", 32)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(40, 16)) * 4
    points = np.floor(256 * (centres[np.arange(4000) % 40] + rng.normal(size=(4000, 16)) * 0.2)).astype(np.int64)
    at = np.arange(0, 4000, 400)  # anchors of one cluster
    seen = []
    plain = np.flatnonzero
    monkeypatch.setattr(hn.np, "flatnonzero", lambda x: (seen.append(1), plain(x))[1])
    targets = [[(hn._LEAST, hn._MOST, hn._LEAST)] for _ in at]
    ids, labels = np.arange(4000), np.zeros(4000, np.int64)
    found = hn.walk(points[at], at, labels[at], True, targets, 5, points, ids, labels)
    monkeypatch.undo()
    scores = points[at] @ points.T
    for m, a in enumerate(at):
        assert [i for q, _, i, _ in found if q == m] == sorted(set(range(4000)) - {int(a)}, key=lambda j: (-scores[m, j], j))[:5]
    assert sum(seen) < 4000 // 32 * 4


def test_cells_are_pruned(spark, monkeypatch):
    """Anchors go on only to cells whose bound reaches what their own cell gave."""
    monkeypatch.setattr(hn, "ANCHORS_PER_CENTRE", 2)
    visited = []
    original = hn.written
    monkeypatch.setattr(hn, "written", lambda df, name: (lambda out: (visited.append((name, out.count())), out)[1])(original(df, name)))
    rows = clustered(480, seed=3, dim=12, groups=8)
    assert mined(spark, rows, step=48) == brute(rows, 48)
    routed = [n for name, n in visited if name == "routed"]
    assert routed[0] == 10 and routed[1] < 10 * 4, routed  # at most half of the other cells for positives
