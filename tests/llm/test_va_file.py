"""Hard negatives against brute force in Python's integers."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from veilsift.llm import va_file


def brute(rows):
    """Rows of the report of (vec_id, embedding, label)."""
    use = []
    for i, v, label in rows:
        if v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        moved = math.fmod(label + 1, 10) if i is not None and math.fmod(i, 7) == 0 else label
        use.append((i, [math.floor(256 * np.float64(x)) if abs(x) < 1e300 else int(math.copysign(1.7976931348623157e308, x)) for x in v], int(moved)))
    key = lambda x: (-x[0], x[1] is None, x[1] or 0)
    clip = lambda s: min(max(s, -(2**63)), 2**63 - 1)
    out = []
    for a, (i, v, label) in enumerate(use):
        if i is None or i % 100:
            continue
        scored = [(clip(sum(x * y for x, y in zip(v, w, strict=True))), j, other) for b, (j, w, other) in enumerate(use) if b != a and len(w) == len(v)]
        positives = sorted(((s, j) for s, j, x in scored if x == label), key=key)[:5]
        for p, pid in positives:
            found = sorted(((s, j) for s, j, x in scored if x != label and 30 * p <= 100 * s <= 90 * p), key=key)[:10]
            out += [(i, pid, n, j, p, s) for n, (s, j) in enumerate(found, 1)]
    return sorted(out, key=repr)


def frame(spark, rows, kind="float"):
    extra = {"row": F.lit("x"), "block": F.lit(1), "rank": F.lit(2), "scores": F.lit(3), "id": F.lit(None).cast("int")}
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int").withColumns(extra)


def report(spark, rows, kind="float"):
    names = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    return sorted((tuple(r[c] for c in names) for r in va_file.report(frame(spark, rows, kind)).collect()), key=repr)


def vectors(n, d, seed, labels=4):
    rng = np.random.default_rng(seed)
    return [(i, np.float32(x).tolist(), int(rng.integers(labels))) for i, x in enumerate(rng.normal(size=(n, d)) + 0.4)]


@pytest.mark.parametrize("block_rows", [va_file.BLOCK_ROWS, 40])
def test_equals_brute_force(spark, monkeypatch, block_rows):
    monkeypatch.setattr(va_file, "BLOCK_ROWS", block_rows)
    rows = vectors(420, 7, 1)
    got = report(spark, rows)
    assert got == brute(rows) and len(got) > 100


def test_odd_rows(spark):
    rows = vectors(230, 3, 2)
    odd = [
        (None, [1.0, 1.0, 0.5], 1), (None, [1.0, 1.0, 0.5], 1), (300, None, 1), (301, [1.0, None, 1.0], 1), (302, [float("nan"), 0.0, 0.0], 1), (303, [float("inf"), 0.0, 0.0], 2), (304, [0.1] * 3, None),
        (400, [0.0, 0.0, 0.0], 1), (500, [1.0, 2.0], 1), (501, [1.0, 2.0], 1), (502, [0.4, 1.0], 2), (600, [], 1), (601, [], 1), (602, [], 2), (-100, [1.0, 1.0, 1.0], -3), (-7, [1.0, 1.0, 1.0], -1), (700, [0.9, 0.8, 0.7], 9),
    ]
    copies = [(800, [1.0, 1.0, 1.0], 1)] * 3 + [(801, [0.5, 0.5, 0.5], 2)] * 30 + [(802, [1.0, 1.0, 1.0], 1)] * 20 + [(800, [1.5, 1.0, 1.0], 2)]
    assert report(spark, rows + odd + copies) == brute(rows + odd + copies)


def test_scores_of_any_size(spark):
    rng = np.random.default_rng(3)
    scale = [1.0, 1e4, 1e9, 1e14, 1e305]
    rows = [(i, (np.abs(rng.normal(size=2)) * scale[i % 5]).tolist(), int(rng.integers(2))) for i in range(120)] + [(200, [0.5, 1e-320], 1)]
    assert report(spark, rows, "double") == brute(rows)


def test_nothing_to_mine(spark):
    assert report(spark, []) == [] and report(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == [] and report(spark, [(100, [1.0], 1)]) == []


def test_bounds_hold_and_spare_most(spark):
    rng = np.random.default_rng(5)
    rows = va_file.exact(va_file.integers(rng.normal(size=(4000, 32)) / 5), False)
    for cells in (4, 64, 256):
        cut = va_file.Approximation(rows, cells)
        for a in rows[:5]:
            low, high = cut.bounds(a, slice(0, 4000))
            score = rows @ a
            assert (low <= score).all() and (score <= high).all()
            at, found = cut.best(a, low, high, 0, (np.arange(4000),), 10, (-50_000, 20_000))
            inside = np.flatnonzero((score >= -50_000) & (score <= 20_000))
            assert at.tolist() == inside[np.lexsort((inside, -score[inside]))][:10].tolist() and found.tolist() == score[at].tolist()
        assert cells == 4 or cut.scored < 0.2 * cut.seen
