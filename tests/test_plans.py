"""Plans that must hold at any size: no window over a whole table, no nested loop, no text in a shuffle where none is needed."""

import random
import re

import pytest
from pyspark.sql import functions as F

from veilsift import queries
from veilsift.operators import labeling, ordering, prefix, sampling

D = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["random_split", "natural_order", "paragraph_folders", "annotation_status", "document_scan", "eval_matches", "eval_misses", "eval_pairs", "dictionary_cases_joined"])
def test_no_global_window_and_no_nested_loop(spark, name):
    plan = plan_of(queries.queries()[name](spark, D))
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    assert "Exchange SinglePartition" not in plan


def test_document_scan_shuffles_no_text(spark):
    plan = plan_of(queries.queries()["document_scan"](spark, D))
    below = plan.split("Exchange hashpartitioning(doc")[1].split("\n")[1]
    assert "Project [" in below and "text#" not in re.sub(r"CASE WHEN .* END AS m", "m", below)


@pytest.mark.parametrize("group", [None, "g"])
def test_places_over_ranges(spark, monkeypatch, group):
    rng = random.Random(5)
    rows = [(f"k{rng.randrange(40):02}", None if rng.random() < 0.1 else rng.randrange(9), f"g{rng.randrange(3)}") for _ in range(2000)] + [("k07", 3, "g1")] * 900
    frame = spark.createDataFrame(rows, "k string, v int, g string")
    for most in (50_000, 2):
        monkeypatch.setattr(ordering, "MOST_COUNTS", most)
        got = ordering.numbered(frame, [F.col("k"), F.col("v")], group, "place", "total").collect()
        by = {}
        for r in got:
            by.setdefault(r["g"] if group else None, []).append(r)
        for part in by.values():
            part.sort(key=lambda r: r["place"])
            assert [r["place"] for r in part] == list(range(len(part))) and {r["total"] for r in part} == {len(part)}
            keys = [(r["k"], r["v"] is not None, r["v"] or 0) for r in part]
            assert keys == sorted(keys)
        assert len(got) == len(rows)
    assert ordering.numbered(frame.where("false"), [F.col("k")], group).count() == 0


def test_running_totals_over_ranges(spark):
    rng = random.Random(6)
    rows = [(i, f"k{rng.randrange(50):02}", None if i % 17 == 0 else rng.randrange(5)) for i in range(1500)]
    frame = spark.createDataFrame(rows, "i int, k string, n int")
    got = sorted(ordering.running_total(frame, "n", [F.col("k"), F.col("i")], "before", "total").collect(), key=lambda r: (r["k"], r["i"]))
    so_far = 0
    for r in got:
        assert r["before"] == so_far
        so_far += r["n"] or 0
    assert {r["total"] for r in got} == {so_far} and len(got) == 1500


def test_prefixes(spark):
    rng = random.Random(7)
    word = lambda n: "".join(rng.choice("abé/") for _ in range(rng.randint(0, n)))
    texts = [(i, word(8)) for i in range(300)] + [(300, None)]
    starts = sorted({word(4) for _ in range(40)} | {""}) + [None]
    pairs = prefix.prefix_pairs(spark.createDataFrame(texts, "i int, t string"), "t", spark.createDataFrame([(s,) for s in starts], "p string"), "p")
    assert sorted(tuple(r) for r in pairs.select("i", "p").collect()) == sorted((i, p) for i, t in texts for p in starts if t is not None and p is not None and t.startswith(p))
    none = spark.createDataFrame([], "p string")
    assert prefix.prefix_pairs(spark.createDataFrame(texts, "i int, t string"), "t", none, "p").count() == 0
    docs = spark.createDataFrame([("a",), ("ab",), ("zz",)], "doc string")
    folders = spark.createDataFrame([("ab_1",), ("ab",), ("abc",)], "folder string")
    assert sorted(tuple(r) for r in sampling.paragraph_folder(docs, folders).collect()) == [("a", "ab"), ("ab", "ab"), ("zz", None)]
    paths = spark.createDataFrame([("p1/a",), ("p2/b",)], "path string")
    none = spark.createDataFrame([], "x string")
    skipped = spark.createDataFrame([("p1",), ("p1/",)], "x string")
    rows = labeling.status(paths, none, none, none, skipped)
    assert sorted((r["path"], r["skipped"]) for r in rows.collect()) == [("p1/a", True), ("p2/b", False)]
