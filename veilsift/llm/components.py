"""Connected components of an edge table: in place as far as that goes, else by alternating large-star and small-star steps."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, map_rows

#: Links that one task holds at once. If no more are left when each task has contracted its own, one task names all roots.
LOCAL = 1 << 20


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, root) of every node of the links a - b, each once; the root is the least node of the component."""
    nodes, ends = np.unique(np.concatenate((a, b)), return_inverse=True)
    left, right = ends[: len(a)], ends[len(a) :]
    root = np.arange(len(nodes))
    while True:
        x, y = root[left], root[right]
        apart = x != y
        if not apart.any():
            return nodes, nodes[root]
        left, right, x, y = (v[apart] for v in (left, right, x, y))
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (up := root[root]).tobytes() != root.tobytes():
            root = up


def _contract(batches):
    """Links to fewer that connect the same: those of a node to its root, over LOCAL links at a time."""
    held, n = [], 0

    def contracted():
        node, root = stars(*(np.concatenate(x) for x in zip(*held, strict=True)))
        other = node != root
        return node[other], root[other]

    for batch in batches:
        held.append((np.array(batch["a"], np.int64), np.array(batch["b"], np.int64)))
        n += len(held[-1][0])
        if n >= LOCAL:
            held = [contracted()]
            n = len(held[0][0])
            if n >= LOCAL // 2:
                yield {"a": held[0][0], "b": held[0][1]}
                held, n = [], 0
    if n:
        a, b = contracted()
        yield {"a": a, "b": b}


def _least(edges: DataFrame) -> DataFrame:
    """The least of a node and its neighbours; written out, so that the join after it can split a hot node."""
    return cut(edges.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b of one ordered type, no nulls).

    The root is the least node of the component. Self-links and repeated links are allowed. Each
    round is written to the shared folder; only three numbers of a round come to the driver.
    """
    e = cut(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct()
    )
    before = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_least(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = cut(large.where("u > v").distinct())
        low = large.join(_least(large), "u")
        small = low.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select("u", F.col("m").alias("v"))
        )
        e = cut(small.where("u > v").distinct())
        now = tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.hash("u", "v").cast("long"))).first())
        if now == before:
            break
        before = now
    stars = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())


def connected(links: DataFrame) -> DataFrame:
    """What ``components`` gives of ``links`` (long columns a, b, no nulls), in three jobs if few links are left.

    Each task contracts its own links, which can be repeated, to at most one a node. If no more than LOCAL are
    left by that, one task contracts them all; else rounds of stars follow.
    """
    schema = "a long, b long"
    own = cut(map_rows(links, ["a", "b"], schema, _contract, batch_rows=1 << 16))
    if own.count() > LOCAL:
        return cut(components(own))

    def named(batches):
        held = [(np.array(b["a"], np.int64), np.array(b["b"], np.int64)) for b in batches]
        if held:
            node, root = stars(*(np.concatenate(x) for x in zip(*held, strict=True)))
            yield {"node": node, "root": root}

    return cut(map_rows(own.coalesce(1), ["a", "b"], "node long, root long", named, batch_rows=1 << 16))
