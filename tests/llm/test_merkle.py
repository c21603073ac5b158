"""Trees, proofs and tampering against a plain recursion."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from veilsift.llm import merkle


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def up(nodes, arity):
    """Root, and for each node the (before, after) of its runs up to it."""
    if len(nodes) == 1:
        return nodes[0], [[]]
    runs = [nodes[i : i + arity] for i in range(0, len(nodes), arity)]
    root, above = up([h(*r) for r in runs], arity)
    return root, [[("".join(r[:j]), "".join(r[j + 1 :])), *above[i]] for i, r in enumerate(runs) for j in range(len(r))]


def brute(rows, arity=2):
    """(doc_id, leaf, subroot, root, proof, folded, verified) of (doc_id, source, lang, n_chars, text)."""

    def leaf(doc_id, source, lang, n_chars, text):
        return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])

    groups = {}
    for r in rows:
        groups.setdefault((r[2] is not None, (r[2] or "").encode()), []).append((r[0] is not None, r[0] or 0, leaf(*r), r))
    names = sorted(groups)
    trees = {}
    for g in names:
        groups[g].sort(key=lambda x: x[:3])
        trees[g] = up([x[2] for x in groups[g]], arity)
    root, above = up([trees[g][0] for g in names], arity) if names else (None, [])
    out = []
    for g, higher in zip(names, above, strict=True):
        for (_, _, own, r), path in zip(groups[g], trees[g][1], strict=True):
            path = [*path, *higher]
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None
            at = leaf(*r[:3], r[3] + 1, r[4]) if bad else own
            for before, after in path:
                at = h(before, at, after)
            out.append((r[0], own, trees[g][0], root, h(*[a + b for a, b in path]), at, at == root))
    return sorted(out, key=repr)


def frame(spark, rows):
    extra = {"g": F.lit("x"), "digest": F.lit(1), "i": F.lit(2), "leaf": F.lit(3), "chunk": F.lit(4)}
    return spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").withColumns(extra)


ODD = [
    (1, "a", "en", 3, "abc"), (2, None, None, None, None), (None, "é", "", 0, ""), (None, "é", "", 0, ""), (5, "a", "en", 1, "x"), (5, "a", "en", 1, "x"), (5, "b", "en", 2, "y"),
    (-7, "-", "-", -1, "-"), (8, "1:a", "=", 9, "日本語 😀"), (9, "a", "Z", 1, "w " * 50_000), (10, "a", "é", 1, "w"), (11, None, None, 5, "t"), (12, None, None, 6, None),
]


@pytest.mark.parametrize("rows", [ODD, ODD[:1], [(i, "s", "en" if i % 3 else "de", i, f"text {i}") for i in range(777)]])
def test_equals_the_rule(spark, rows):
    got = merkle.report(frame(spark, rows))
    names = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    assert sorted((tuple(r[c] for c in names) for r in got.collect()), key=repr) == brute(rows)


def test_empty_table(spark):
    assert merkle.report(frame(spark, []).where("false")).count() == 0


@pytest.mark.parametrize(("arity", "tier", "few"), [(2, 1, 0), (2, 3, 4096), (3, 2, 0), (5, 2, 4096)])
def test_other_runs_and_tiers(spark, monkeypatch, arity, tier, few):
    monkeypatch.setattr(merkle, "FEW_NODES", few)
    rows = [(i, "s", f"l{i % 4 if i % 5 else 7}", i, f"text {i}") for i in range(150)]
    leaf = merkle.leaf_digest(*[F.col(c) for c in merkle.FIELDS])
    out = merkle.manifest(frame(spark, rows), "lang", [F.col("doc_id").alias("id")], leaf, {"doc_id": F.col("doc_id")}, arity, tier)
    out = out.withColumn("folded", merkle.fold(F.col("leaf"), F.col("path"))).collect()
    want = {r[0]: r for r in brute(rows, arity)}
    assert len(out) == 150
    for r in out:
        path = [x["before"] + x["after"] for x in r["path"]]
        assert (r["leaf"], r["subroot"], r["root"], h(*path)) == want[r["doc_id"]][1:5] and r["folded"] == r["root"]
