"""Hard-negative mining against scores of all pairs."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import hard_negatives
from millrace.llm.hard_negatives import Anchor, Block, Wanted
from millrace.llm.vectors import LAST, stored, whole

DDL = "vec_id int, label int, embedding array<double>, score long, ids string"


def integer(x, scale):
    return math.floor(x * scale) if abs(x) < 2**52 else int(x) * scale


def plain(rows, scale=256, low=80, high=100, n=5):
    good = [(i, lab, [integer(x, scale) for x in v]) for i, lab, v in rows
            if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a in sorted({i for i, _, _ in good if i % 100 == 0}):
        label, v = min((lab, w) for i, lab, w in good if i == a)
        scores = [(max(min(sum(x * y for x, y in zip(v, w)), LAST), -LAST - 1), i, lab == label) for i, lab, w in good if i != a and len(w) == len(v)]
        ranked = sorted(scores, key=lambda s: (-s[0], s[1]))
        for p, positive, _ in [s for s in ranked if s[2]][:n]:
            inside = [s for s in ranked if not s[2] and low * p <= 100 * s[0] <= high * p][:n]
            out += [(a, positive, k + 1, i, p, s) for k, (s, i, _) in enumerate(inside)]
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    centres = [[rng.gauss(0, 1) for _ in range(21)] for _ in range(3)]
    out = []
    for i in range(420):
        centre = centres[i % 3]
        out.append((i, rng.randint(0, 2) if i % 4 else i % 3, [c + rng.gauss(0, 0.4) for c in centre]))
    out += [(420 + k, k % 2, out[100][2]) for k in range(9)]  # ties
    out += [(None, 1, out[1][2]), (500, None, out[1][2]), (501, 1, None), (502, 1, [None] * 21), (503, 1, [math.nan] * 21),
            (504, 0, [math.inf] * 21), (600, 0, [1.0, 2.0]), (601, 0, [0.5, 1.0]), (602, 1, [0.5, 0.9]), (700, 2, []), (701, 2, []), (702, 1, [])]
    return out + [out[5], out[200]]


@pytest.mark.parametrize("block, group", [(4096, 8 << 20), (16, 2_000)])
def test_mine(spark, rows, monkeypatch, block, group):
    monkeypatch.setattr(hard_negatives, "BLOCK", block)
    monkeypatch.setattr(hard_negatives, "GROUP_BYTES", group)
    frame = spark.createDataFrame([(*r, 7, "x") for r in rows], DDL).repartition(3)
    found = hard_negatives.mine(frame, F.col("vec_id") % 100 == 0)
    expected = plain(rows)
    assert sorted(tuple(r) for r in found.collect()) == expected
    assert len(expected) > 50
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def test_large_components(spark):
    """Beyond the integers of doubles, beyond 64 bits in a component, and beyond 64 bits in a score only."""
    rng = random.Random(2)
    for size in (2.0**20, 2.0**27, 2.0**50, 1e300):
        rows = [(i, i % 2, [rng.uniform(-size, size), rng.uniform(0, 1), size * (1 + i % 3)]) for i in range(0, 300, 10)]
        rows += [(i + 5, i % 2, [0.0, rng.uniform(0, 3), 0.0]) for i in range(0, 300, 10)]
        frame = spark.createDataFrame([(*r, 7, "x") for r in rows], DDL)
        found = hard_negatives.mine(frame, F.col("vec_id") % 100 == 0)
        assert sorted(tuple(r) for r in found.collect()) == plain(rows), size


def test_other_limits(spark, rows):
    frame = spark.createDataFrame([(*r, 7, "x") for r in rows], DDL)
    found = hard_negatives.mine(frame, F.col("vec_id") % 100 == 0, positives=2, negatives=2, low=10, high=150, scale=64)
    assert sorted(tuple(r) for r in found.collect()) == plain(rows, 64, 10, 150, 2)
    with pytest.raises(ValueError):
        hard_negatives.mine(frame, F.lit(True), low=101)


def test_empty_table(spark):
    frame = spark.createDataFrame([], DDL)
    assert hard_negatives.mine(frame, F.col("vec_id") % 100 == 0).count() == 0


def test_bounds_drop_candidates():
    """A block's far vectors are left after the first columns, and nothing that may matter is."""
    rng = np.random.default_rng(1)
    x = rng.normal(0, 0.1, (64, 500))
    x[:3] += np.where(np.arange(500) % 50 == 0, 3.0, -3.0)
    kind, raw = stored(whole(x, 256), x)
    ids = np.arange(500, dtype="<i8")
    block = Block(64, 500, kind, ids.tobytes(), np.zeros(500, "<i8").tobytes(), raw, 256)
    vector = whole(np.where(np.arange(64) < 3, 2.0, 0.05), 256)
    sizes = []

    class Watched(Anchor):
        def may_matter(self, least, most):
            sizes.append(len(least))
            return super().may_matter(least, most)

    anchor = Watched(-1, 0, vector, [Wanted(0, -LAST, LAST, 5)], True)
    anchor.scan(block)
    scores = vector @ whole(x, 256)
    best = np.lexsort((ids, -scores))[:5]
    assert anchor.windows[0].ids.tolist() == best.tolist() and anchor.windows[0].scores.tolist() == scores[best].tolist()
    assert sizes[0] == 500 and sizes[1] <= 10
