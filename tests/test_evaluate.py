"""Matching and misses against plain Python over all pairs."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from veilsift.operators import evaluate

SCHEMA = "id string, idx int, type string, start int, end int, text string"


def shared(a, b):
    return max(0, min(a[4], b[4]) - max(a[3], b[3]))


def candidates(gold, pred, setting, least):
    out = []
    for g in gold:
        for p in pred:
            if g[:1] + g[2:3] != p[:1] + p[2:3]:
                continue
            exact = setting == "exact" or (setting == "hybrid" and g[2] in ("SSN", "ACCOUNT_NUMBER"))
            if (g[3:5] == p[3:5]) if exact else shared(g, p) >= least:
                out.append((-(10**9 if exact else shared(g, p)), g[3] - g[4], g[3], g[1], p[1], g, p))
    return sorted(out, key=lambda c: c[:5])


def brute_match(gold, pred, setting, least):
    cands = candidates(gold, pred, setting, least)
    used_g, used_p, won = set(), set(), []
    for *_, g, p in cands:
        if g[:3] not in used_g and p[:3] not in used_p:
            used_g.add(g[:3]), used_p.add(p[:3]), won.append((g, p))
    out = [(g[0], g[2], g[1], p[1], True) for g, p in won]
    if setting != "exact":
        free = {c[5] for c in cands if c[5][:3] not in used_g}
        claimed = set()
        for g, p in won:
            if g[2] != "ADDRESS" or p[4] - p[3] > 120:
                continue
            line = sorted({c[5] for c in cands if c[6] == p and c[5] in free} | {g}, key=lambda x: (x[3], x[1]))
            at = line.index(g)
            first = last = at
            while first and line[first][3] - line[first - 1][4] <= 30 and g[4] - line[first - 1][3] <= 120:
                first -= 1
            while last + 1 < len(line) and line[last + 1][3] - line[last][4] <= 30 and line[last + 1][4] - line[first][3] <= 120:
                last += 1
            for x in line[first : last + 1]:
                if x != g and x not in claimed:
                    claimed.add(x), out.append((x[0], x[2], x[1], p[1], False))
    return sorted(out)


def brute_misses(gold, pred, setting, least):
    out = []
    for g in gold:
        mine = [p for p in pred if p[0] == g[0]]
        exact = setting == "exact" or (setting == "hybrid" and g[2] in ("SSN", "ACCOUNT_NUMBER"))
        other = sorted(p[2] for p in mine if p[2] != g[2] and shared(g, p))
        same = [shared(g, p) for p in mine if p[2] == g[2] and shared(g, p)]
        far = [g[3] - p[4] if p[4] <= g[3] else p[3] - g[4] if p[3] >= g[4] else 0 for p in mine]
        nearest = min(far, default=None)
        if other:
            category = "wrong_type"
        elif exact and same:
            category = "boundary_mismatch"
        elif not exact and any(s < least for s in same):
            category = "partial_overlap"
        else:
            category = "near_miss" if nearest is not None and 0 < nearest <= 50 else "no_prediction"
        out.append((*g[:3], category, other[0] if other else None, nearest))
    return sorted(out)


def spans(rng, docs, most, kinds, width=300, longest=60):
    out = []
    for d in range(docs):
        for kind in kinds:
            for i in range(rng.integers(0, most)):
                a = int(rng.integers(0, width))
                out.append((f"d{d}", i, kind, a, a + int(rng.integers(0, longest)), "x"))
    return out


@pytest.mark.parametrize(("setting", "least"), [("hybrid", 1), ("overlap", 5), ("exact", 1), ("overlap", 0)])
def test_match_equals_brute_force(spark, setting, least):
    rng = np.random.default_rng(11)
    kinds = ("ADDRESS", "SSN", "PERSON")
    gold, pred = spans(rng, 12, 12, kinds), spans(rng, 12, 12, kinds)
    # ties: the same spans again, and spans that touch end to end
    gold += [("t", i, "ADDRESS", 10 * i, 10 * i + 10, "x") for i in range(30)] + [("u", i, "PERSON", 5, 15, "x") for i in range(5)]
    pred += [("t", i, "ADDRESS", 25 * i + 3, 25 * i + 90, "x") for i in range(8)] + [("u", i, "PERSON", 5 + i % 2, 15, "x") for i in range(4)]
    pred += [("v", 0, "ADDRESS", 0, 1000, "x"), ("v", 1, "ADDRESS", 0, 110, "x")]
    gold += [("v", i, "ADDRESS", a, b, "x") for i, (a, b) in enumerate([(0, 5), (20, 28), (30, 60), (85, 100), (104, 130), (131, 140), (500, 900)])]
    g, p = spark.createDataFrame(gold, SCHEMA), spark.createDataFrame(pred, SCHEMA)
    got = sorted(tuple(r) for r in evaluate.match(g, p, setting, least).select("id", "type", "g_idx", "p_idx", "primary").collect())
    assert got == brute_match(gold, pred, setting, least)


def test_chains_take_many_rounds(spark):
    # each link is better than the one before, so one round settles one link
    gold = [("c", i, "PERSON", 100 * i, 100 * i + 60, "x") for i in range(40)]
    pred = [("c", i, "PERSON", 100 * i + 50 - i, 100 * i + 101 + i, "x") for i in range(40)]
    g, p = spark.createDataFrame(gold, SCHEMA), spark.createDataFrame(pred, SCHEMA)
    assert sorted(tuple(r) for r in evaluate.match(g, p).collect()) == brute_match(gold, pred, "hybrid", 1)


@pytest.mark.parametrize(("setting", "least"), [("hybrid", 3), ("exact", 1)])
def test_misses_equal_brute_force(spark, setting, least):
    rng = np.random.default_rng(12)
    kinds = ("ADDRESS", "SSN", "PERSON", "EMAIL")
    gold, pred = spans(rng, 15, 5, kinds, 900, 30), spans(rng, 10, 4, kinds, 900, 30)
    g, p = spark.createDataFrame(gold, SCHEMA), spark.createDataFrame(pred, SCHEMA)
    rows = evaluate.misses(g, p, setting, least).select("id", "idx", "type", "category", "predicted_type", "nearest").collect()
    assert sorted((tuple(r) for r in rows), key=repr) == sorted(brute_misses(gold, pred, setting, least), key=repr)
    only = evaluate.misses(g, p, setting, least, types=["SSN"]).select("id", "idx", "type", "category", "predicted_type", "nearest").collect()
    assert sorted((tuple(r) for r in only), key=repr) == sorted(brute_misses(gold, [x for x in pred if x[2] == "SSN"], setting, least), key=repr)


def test_no_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    some = spark.createDataFrame([("a", 0, "SSN", 1, 2, "x")], SCHEMA)
    assert evaluate.match(none, some).count() == 0 and evaluate.match(some, none).count() == 0 and evaluate.misses(none, some).count() == 0
    assert evaluate.misses(some, none).first()["category"] == "no_prediction"


def test_a_document_of_many_spans(spark):
    n = F.col("id").cast("int")
    rows = lambda shift: spark.range(100_000).select(F.lit("one").alias("id"), n.alias("idx"), F.lit("ADDRESS").alias("type"), (n * 12 + shift).alias("start"), (n * 12 + shift + 9).alias("end"), F.lit("x").alias("text"))
    g, p = rows(0).cache(), rows(4).cache()
    assert g.count() == p.count()
    start = time.time()
    m = evaluate.match(g, p)
    assert m.where("primary").count() == 100_000
    fn, _ = evaluate.outcomes(g.withColumn("type", F.lit("PERSON")), p, m)
    assert {r["category"] for r in evaluate.misses(fn, p).select("category").distinct().collect()} == {"wrong_type"}
    assert time.time() - start < 60
    plan = evaluate.pairs(g, p)._jdf.queryExecution().optimizedPlan().toString()
    assert "_bin" in plan
