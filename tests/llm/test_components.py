"""Components of a long path: many rounds, and what Spark takes a round's table for does not grow with them."""

import random

import pytest

pytest.importorskip("corpus_pipeline")

from veilsift.llm import common, components  # noqa: E402


def test_estimates_do_not_grow_with_the_rounds(spark, monkeypatch):
    sizes = []

    def cut(df):
        out = common.cut(df)
        sizes.append(out._jdf.queryExecution().analyzed().stats().sizeInBytes())
        return out

    monkeypatch.setattr(components, "cut", cut)
    ids = list(range(3000))
    random.Random(1).shuffle(ids)
    paths = [ids[:2000], ids[2000:]]
    edges = [(a, b) for path in paths for a, b in zip(path, path[1:], strict=False)]
    found = components.components(spark.createDataFrame(edges, "a long, b long"))
    assert {r["node"]: r["root"] for r in found.collect()} == {i: min(path) for path in paths for i in path}
    assert len(sizes) > 20 and max(sizes) <= common.UNKNOWN_SIZE


def _brute(edges):
    root = {x: x for e in edges if e[0] != e[1] for x in e}
    while True:
        new = dict(root)
        for a, b in edges:
            if a != b:
                new[a] = new[b] = min(new[a], new[b])
        if new == root:
            return root
        root = new


def _edges():
    ids = [x - 1000 for x in range(2000)]
    rng = random.Random(3)
    rng.shuffle(ids)
    path = list(zip(ids[:60], ids[1:60], strict=False))
    star = [(ids[100], x) for x in ids[101:300]]
    rest = [(rng.choice(ids[400:]), rng.choice(ids[400:])) for _ in range(1200)]
    return path + star + rest + rest[:50] + [(ids[399], ids[399])] + [(-(2**63), 2**63 - 1)]


def test_connected_by_brute_force(spark, monkeypatch):
    edges = _edges()
    want = _brute(edges)
    for local in (components.LOCAL, 16):  # 16: links are contracted in pieces, and rounds of stars follow
        monkeypatch.setattr(components, "LOCAL", local)
        for parts in (1, 7):
            if (local, parts) == (16, 1):
                continue
            frame = spark.createDataFrame(edges, "a long, b long").repartition(parts)
            found = [tuple(r) for r in components.connected(frame).collect()]
            assert len(found) == len(want) and dict(found) == want
    assert components.connected(spark.createDataFrame([], "a long, b long")).collect() == []


def test_pieces_connect_what_all_links_do(monkeypatch):
    edges = _edges()
    monkeypatch.setattr(components, "LOCAL", 64)
    batches = [{"a": [a for a, _ in edges[k : k + 40]], "b": [b for _, b in edges[k : k + 40]]} for k in range(0, len(edges), 40)]
    left = [(a, b) for x in components._contract(batches) for a, b in zip(x["a"].tolist(), x["b"].tolist(), strict=True)]
    assert len(left) < len(edges) and _brute(left) == _brute(edges)


def _written(monkeypatch):
    """Checkpoints that components write from now on."""
    found = []
    monkeypatch.setattr(components, "cut", lambda df: found.append(1) or common.cut(df))
    return found


def test_a_chain_of_near_copies_takes_no_rounds(spark, monkeypatch):
    """Each round wrote its shuffles and four checkpoints in as many files as there are partitions."""
    from veilsift.llm import near_copies

    rng = random.Random(5)
    words = [f"w{rng.randrange(10**9)}" for _ in range(200)]
    texts = [" ".join(f"x{i}" if i < 3 * k else w for i, w in enumerate(words)) for k in range(40)]
    written = _written(monkeypatch)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r["component_id"] for r in near_copies.groups(docs).collect()} == {0}
    assert len(written) <= 6  # two a time


def test_a_chain_of_fingerprints_takes_no_rounds(spark, monkeypatch):
    from veilsift.llm import simhash

    rng, fp, prints = random.Random(7), 0, []
    for k in range(60):
        prints.append((k, fp - (1 << 64) if fp >> 63 else fp))
        for bit in rng.sample(range(64), 4):
            fp ^= 1 << bit
    monkeypatch.setattr(simhash, "fingerprints", lambda docs, *_: spark.createDataFrame(prints, "doc_id long, fp long"))
    written = _written(monkeypatch)
    assert {r["component_id"] for r in simhash.near_duplicates(spark.createDataFrame([(0, "")], "doc_id long, text string")).collect()} == {0}
    assert len(written) <= 2
