"""Balance of step groups, scores of very long texts, what the last stages of the pipeline take, and ties at the cut of a search."""

import numpy as np
import pytest

from veilsift.llm import mixing, packing, toxicity, vptree

P = pytest.importorskip("public_tokenizers")


def test_step_groups_are_balanced(spark):
    rng = np.random.default_rng(1)
    docs = spark.createDataFrame([(i, " ".join(rng.choice(["alpha", "beta", "gamma", "delta"], rng.integers(1, 700)))) for i in range(300)], "doc_id long, text string").repartition(2)
    rows = packing.pack(docs, P.path("byte_bpe_50k.json"), step_tokens=8192).select("step_group", "sequence_id", "sequence_tokens").distinct().collect()
    tokens, tasks = {}, {}
    for r in rows:
        tokens[r["step_group"]] = tokens.get(r["step_group"], 0) + r["sequence_tokens"]
        tasks.setdefault(r["step_group"] >> 40, set()).add(r["step_group"])
    for groups in tasks.values():
        *full, last = [tokens[g] for g in sorted(groups)]
        assert full and all(t == 8192 for t in full) and last <= 8192


def test_score_of_a_very_long_text_is_that_of_its_features(spark):
    at, w, bias = np.arange(0, 1 << toxicity.BITS, 5), np.linspace(-0.002, 0.002, len(range(0, 1 << toxicity.BITS, 5))), -0.3
    text = " ".join(f"word{i * 7919 % 5003}" for i in range(120_000))
    rows = [(1, text), (2, text + " "), (3, ""), (None, None), (4, "one")]
    got = {r["doc_id"]: r["score"] for r in toxicity.score(spark.createDataFrame(rows, "doc_id long, text string"), (at, w, bias)).collect()}
    words = text.split()
    hasher = toxicity.Hasher()
    seen = set()
    for k in range(0, len(words), 1000):  # the same features by pieces that share two words
        seen |= set(hasher(" ".join(words[k : k + 1002])).tolist())
    weight = dict(zip(at.tolist(), w.tolist(), strict=True))
    want = 1 / (1 + np.exp(-(bias + sum(weight.get(i, 0.0) for i in seen))))
    assert abs(got[1] - want) < 1e-9 and got[1] == got[2] and got[3] == got[None] == pytest.approx(1 / (1 + np.exp(0.3)))


def test_last_stages_take_what_the_mix_wants(spark):
    cp = pytest.importorskip("corpus_pipeline")
    rng = np.random.default_rng(2)
    rows = [(i, " ".join(["w"] * int(rng.integers(1, 60))), "en", f"s{i % 3 if i % 4 else 0}", 1) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = cp.mix_sources(spark, docs, "")
    plan = {r["doc_id"]: r["mix"] for r in mixing.allot(docs, mixing.words(), **cp.MIX).select("doc_id", "mix").collect()}
    times, taken, target = {}, {}, {}
    for r in kept.collect():
        times[r["doc_id"]] = times.get(r["doc_id"], 0) + 1
        taken[r["source"]] = taken.get(r["source"], 0) + len(r["text"].split())
    assert times == {i: m["copies"] for i, m in plan.items() if m["copies"]}
    for i, _, _, source, _ in rows:
        target[source] = plan[i]["target"]
    assert all(abs(taken[s] - target[s]) <= 60 for s in target)
    packed = cp.pack_sequences(spark, kept, "").collect()
    length = {}
    for r in packed:
        length[r["doc_id"]] = length.get(r["doc_id"], 0) + r["length"]
    whole = {r["doc_id"]: r["doc_tokens"] for r in packed}
    assert length == {i: whole[i] * times[i] for i in times}


def test_equal_scores_at_the_cut(spark):
    rng = np.random.default_rng(3)
    v = rng.normal(size=(40, 8))
    rows = [(i, v[i % 40].tolist()) for i in rng.permutation(2000).tolist()]  # each vector fifty times
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for factor in (1.0, 4.0):
        found = {}
        for r in vptree.nearest(frame, frame.where("vec_id < 40"), 20, factor=factor, shard_rows=10).orderBy("query_id", "rank").collect():
            found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        for q, got in found.items():
            s = (v @ v[q]).round(9)
            want = sorted((-s[i % 40], i) for i in range(2000) if i != q)[:20]
            if factor == 1.0 or got[0][1] >= -want[0][0] - 1e-6:
                assert [i for i, _ in got] == [i for _, i in want]
            assert got == sorted(got, key=lambda x: (-x[1], x[0])) and len(got) == 20
