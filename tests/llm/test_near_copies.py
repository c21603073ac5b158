"""Near copies: links hold on shingles, none is lost among half-alike texts, one row of each group stays."""

import random

import numpy as np
import pytest

pytest.importorskip("corpus_pipeline")

from veilsift.llm import near_copies  # noqa: E402


def _words(seed, n):
    rng = random.Random(seed)
    return [f"w{rng.randrange(10**9)}" for _ in range(n)]


def _similarity(a, b):
    x, y = (set(near_copies.shingle_hashes(t).tolist()) for t in (a, b))
    return len(x & y) / len(x | y)


def _groups(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r["doc_id"]: r["component_id"] for r in near_copies.groups(docs).collect()}


def test_template_family_stays_apart(spark):
    head = _words(0, 160)
    texts = [" ".join(head + _words(k, 32)) for k in range(1, 41)]  # 0.70 to 0.72 of each other
    texts += [texts[0] + " end"]
    assert all(0.65 < _similarity(texts[0], t) < 0.8 for t in texts[1:40])
    got = _groups(spark, texts)
    assert got == {i: i for i in range(40)} | {40: 0}


def test_repeated_shingles_count_once():
    once, tail = _words(1, 60), _words(2, 60)
    a, b = " ".join(once + tail), " ".join(once * 9 + tail)
    assert _similarity(a, b) > 0.9
    x, y = (int.from_bytes(near_copies.wide_fingerprint(t), "big") for t in (a, b))
    assert (x ^ y).bit_count() <= near_copies.allowed_bits(0.9)


def _family(pairs, head=146, own=24):
    """Texts that are half-alike through a shared passage, and of each a copy with three words changed."""
    passage, texts = _words(3, head), []
    for k in range(pairs):
        words = passage + _words(100 + k, own)
        copy = [f"other{k}" if i in (30, 60, 90) else w for i, w in enumerate(words)]
        texts += [" ".join(words), " ".join(copy)]
    return texts


def _meet(a, b):
    """Whether two texts share a posting and are alike by the sketch."""
    x, y = (np.frombuffer(near_copies.wide_fingerprint(t), np.uint8) for t in (a, b))
    met = (x == y)[near_copies._choices()].all(axis=1).any()
    return met and np.bitwise_count(x[:8] ^ y[:8]).sum() <= near_copies.SKETCH_BITS


def _found(got, met):
    """Pairs that meet are groups; what never meets may be compared as part of a family; others stay apart."""
    for i, root in got.items():
        assert root == i - i % 2 or (root == i and i - i % 2 not in met)


def test_the_count_of_shared_positions_loses_no_near_pair(monkeypatch):
    rng = np.random.default_rng(4)
    most = near_copies.allowed_bits(0.8, near_copies.DEVIATIONS)
    p = rng.integers(0, 2**63, near_copies.WORDS, dtype=np.uint64)
    rows = []
    for k in range(400):  # near ones have their bits spread over as many positions as can be
        bits = np.unpackbits(p.view(np.uint8))
        at = rng.permutation(128)[: 60 + k % 60] * 4 if k < 200 else rng.permutation(512)[:256]
        bits[at] ^= 1
        rows.append(np.packbits(bits).view(np.uint64))
    fp = np.stack(rows)
    true = np.array([sum((int(x) ^ int(y)).bit_count() for x, y in zip(r, p, strict=True)) for r in fp])
    shared = [sum(f"{int(x):016x}"[i] == f"{int(y):016x}"[i] for x, y in zip(r, p, strict=True) for i in range(16)) for r in fp]
    assert near_copies.shared_positions(fp, p).tolist() == shared
    kept = near_copies.retained(fp, p, most)
    assert set(np.flatnonzero(true <= most)) <= set(kept) and min(shared[i] for i in kept) == 128 - most
    assert len(kept) < 230  # of those 200 at random next to none
    looked = []
    count = np.bitwise_count
    monkeypatch.setattr(near_copies.np, "bitwise_count", lambda x: looked.append(len(x)) or count(x))
    d = near_copies._distances(fp, p, most)
    assert looked == [400, len(kept)]  # bits are counted of what the count retains
    assert (d[kept] == true[kept]).all() and (np.delete(d, kept) == near_copies.FAR).all()


def test_families_block_by_block():
    ids, sets = list(range(9)), [near_copies.shingle_hashes(" ".join(_words(0, 60) + _words(k // 3 + 1, 8) + [f"e{k}"])) for k in range(9)]
    fp = np.stack([np.frombuffer(near_copies.fingerprint_of(x), np.uint64) for x in sets])
    want = {(a, b) for a in ids for b in ids if a < b and len(np.intersect1d(sets[a], sets[b])) >= 0.8 * len(np.union1d(sets[a], sets[b]))}
    sizes = [len(x) for x in sets]
    links, doubtful = near_copies._links_of(ids, fp, np.zeros(9, np.int8), sets, sizes, 512, 0.8)
    assert not doubtful
    root = dict(zip(ids, ids, strict=True))
    for a, b in links:
        assert (min(a, b), max(a, b)) in want
        old, new = max(root[a], root[b]), min(root[a], root[b])
        root = {k: new if v == old else v for k, v in root.items()}
    assert all(root[a] == root[b] for a, b in want) and len(links) == 9 - len(set(root.values()))
    side = np.array([0] * 5 + [1] * 4, np.int8)
    links, _ = near_copies._links_of(ids, fp, side, sets, sizes, 512, 0.8)
    assert all(side[a] != side[b] for a, b in links)


def test_sketches_leave_open_what_is_near_the_similarity(monkeypatch):
    monkeypatch.setattr(near_copies, "SKETCH", 512)
    rng = np.random.default_rng(8)
    for share in np.linspace(0.5, 1, 60):
        n = 6000
        both = int(n * 2 * share / (1 + share))
        pool = rng.permutation(np.unique(rng.integers(0, 2**63, 2 * n, dtype=np.uint64)))
        x, y = np.sort(pool[:n]), np.sort(pool[n - both : 2 * n - both])
        true = len(np.intersect1d(x, y)) / len(np.union1d(x, y))
        exact = near_copies.similar(x, y, (n, n), 0.8)
        by_sketch = near_copies.similar(x[:512], y[:512], (n, n), 0.8)
        assert exact == (true >= 0.8) and by_sketch in (None, exact)
        assert by_sketch is not None or abs(true - 0.8) < 0.2
    assert near_copies.similar(x[:100], x[:512], (100, 6000), 0.8) is False  # sizes alone decide


def test_long_texts_by_sketches(spark, monkeypatch):
    monkeypatch.setattr(near_copies, "SKETCH", 64)
    monkeypatch.setattr(near_copies, "FAMILY_BLOCK", 4)
    base = [_words(k, 2000) for k in range(3)]
    texts = []
    for words in base:
        for changed in (0, 20, 45, 60, 160, 400):  # similarities from 1 to 0.2 with the first
            texts.append(" ".join("new" + str(changed) if i % 2000 < changed * 5 and i % 5 == 0 else w for i, w in enumerate(words)))
    texts += [texts[0] + " end", texts[6] + " end"]
    got = _groups(spark, texts)
    root = list(range(len(texts)))
    for _ in texts:
        for a in range(len(texts)):
            for b in range(a):
                if _similarity(texts[a], texts[b]) >= 0.8:
                    root[a] = root[b] = min(root[a], root[b])
    assert got == dict(enumerate(root))


def test_recall_against_all_pairs(spark):
    """Every pair of 0.8 or more among the documents, found by counting shared shingles, lies in one group; no group lacks a chain of such pairs."""
    import pyarrow.parquet as pq

    table = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["doc_id", "text"])
    ids, texts = table["doc_id"].to_pylist(), table["text"].to_pylist()
    sets = [near_copies.shingle_hashes(t) for t in texts]
    owners = {}
    for i, x in enumerate(sets):
        for h in x.tolist():
            owners.setdefault(h, []).append(i)
    shared = {}
    for have in owners.values():
        for j, a in enumerate(have):
            for b in have[:j]:
                shared[b, a] = shared.get((b, a), 0) + 1
    pairs = [(a, b) for (a, b), n in shared.items() if n >= 0.8 * (len(sets[a]) + len(sets[b]) - n)]
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r["doc_id"]: r["component_id"] for r in near_copies.groups(docs).collect()}
    met = sum(got[ids[a]] == got[ids[b]] for a, b in pairs)
    assert len(pairs) > 50 and met >= 0.99 * len(pairs)
    root = {i: i for i in ids}
    for _ in range(30):
        for a, b in pairs:
            low = min(root[ids[a]], root[ids[b]])
            root[ids[a]] = root[ids[b]] = low
    wordless = {i for i, x in zip(ids, sets, strict=True) if not len(x)}
    assert all(got[i] in (i, root[i]) or i in wordless or got[i] in {got[j] for j in ids if root[j] == root[i]} for i in ids)


def test_half_alike_texts_hide_no_copy(spark):
    texts = _family(150)
    assert _similarity(texts[0], texts[1]) > 0.8 and 0.7 < _similarity(texts[0], texts[2]) < 0.77
    met = [k for k in range(0, 300, 2) if _meet(texts[k], texts[k + 1])]
    assert len(met) > 140
    _found(_groups(spark, texts), met)


def test_long_postings_block_by_block(spark, monkeypatch):
    monkeypatch.setattr(near_copies, "BLOCK", 4)
    rows = {"key": np.full(10, 7), "id": np.arange(10), "sketch": np.zeros(10, np.int64), "kin": np.arange(10)}
    out = list(near_copies._postings([rows]))
    assert [x for b in out for x in b["block"]] == [0] * 4 + [1] * 4 + [2] * 2
    assert sorted(x for b in out for x in b["id"]) == list(range(10))
    texts = _family(12)
    met = [k for k in range(0, 24, 2) if _meet(texts[k], texts[k + 1])]
    _found(_groups(spark, texts), met)


def test_postings_of_one_family_add_nothing():
    far = (1 << 40) - 1  # 40 bits away from 0
    rows = {"key": [7] * 4 + [8] * 4 + [9] * 4, "id": list(range(4)) * 3, "sketch": [0] * 8 + [0, 0, far, far], "kin": [1] * 4 + [1, 1, 1, 2] + [1, 1, 2, 3]}
    out = list(near_copies._postings([{k: np.array(v) for k, v in rows.items()}]))
    found = {}
    for b in out:
        for c, i in zip(b["cluster"], b["id"], strict=True):
            found.setdefault(c, []).append(i)
    # posting 7 is one family; 8 holds two; of 9 only what lies together and is of two families comes out
    assert sorted(found.values()) == [[0, 1, 2, 3], [2, 3]]


def test_late_choices_join_what_the_early_ones_miss(spark, monkeypatch):
    monkeypatch.setattr(near_copies, "FIRST", 1)
    texts = _family(12)
    _found(_groups(spark, texts), [k for k in range(0, 24, 2) if _meet(texts[k], texts[k + 1])])


def test_one_row_of_each_group_with_null_and_repeated_ids(spark):
    import corpus_pipeline as cp

    a, b, c, d, e = (" ".join(_words(200 + k, 100)) for k in range(5))
    rows = [(None, a), (None, b), (None, b), (1, c), (2, c + " end"), (2, d), (3, d), (4, e), (None, e)]
    docs = spark.createDataFrame([(i, t, "en", "web", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = cp.one_of_each(spark, docs, "")
    assert got.columns == cp.COLUMNS
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=key) == sorted([(None, a), (None, b), (1, c), (2, d), (4, e)], key=key)


def test_stages_on_odd_rows(spark):
    """Null, empty and very long texts, repeated rows, an empty table and further columns go through every stage."""
    from pyspark.sql import functions as F

    import corpus_pipeline as cp

    long = " ".join(f"{w}." for w in _words(300, 60_000))
    plain = [" ".join(f"{w}." for w in _words(310 + k, 40)) for k in range(6)]
    rows = [(1, None, None), (2, "", "a"), (3, " \n\t", "a"), (4, long, "a"), (4, long, "a"), (None, plain[0], None), (None, plain[1], None), (5, plain[2], "b"), (5, plain[3], "b"), (6, plain[2], "b")]
    docs = spark.createDataFrame([(i, t, "en", s, 0) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long").withColumns({"h": F.lit(1), "id": F.lit("x"), "score": F.lit(0), "_mix": F.lit(2)})
    d = "/root/testdata/sf0.001"
    for table in (docs, docs.where("false")):
        for name, stage in cp.STAGES[:-1]:
            got = stage(spark, table, d)
            assert got.columns == cp.COLUMNS, name
            kept = [tuple(r) for r in got.select("doc_id", "text").collect()]
            assert {k for k in kept} <= {(i, t) for i, t, _ in rows}, name
            if name == "toxicity" and table is docs:
                assert len(kept) == len(rows)
            if name == "near_duplicates" and table is docs:
                assert sorted(map(str, kept)) == sorted(map(str, [(1, None), (4, long), (None, plain[0]), (None, plain[1]), (5, plain[2]), (5, plain[3])]))
        assert {r["doc_id"] for r in cp.pack_sequences(spark, table, d).collect()} == ({i for i, _, _ in rows} if table is docs else set())
