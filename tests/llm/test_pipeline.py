"""The stages by hand on a small table."""

import zlib

import pytest

pytest.importorskip("corpus_pipeline")
import corpus_pipeline as cp  # noqa: E402

from veilsift.llm import near_copies, quality  # noqa: E402


def test_stages_by_brute_force(spark):
    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}
    kept = cp.quality_rules(spark, docs, d)
    assert kept.columns == cp.COLUMNS

    def passes(text):
        m = dict(zip(quality.MEASURES, quality.measure(text), strict=True))
        return not any(eval(rule, {}, m) for _, rule in quality.RULES)

    assert {r["doc_id"] for r in kept.collect()} == {i for i, r in rows.items() if passes(r["text"])}
    clean = cp.not_toxic(spark, kept, d)
    left = {r["doc_id"] for r in clean.collect()}
    single = cp.one_of_each(spark, clean, d)
    ids = {r["doc_id"] for r in single.collect()}
    fp = {i: int.from_bytes(near_copies.wide_fingerprint(rows[i]["text"], cp.SHINGLE), "big") for i in left}
    most = near_copies.allowed_bits(cp.SIMILARITY)
    near = {i: {j for j in left if j != i and bin(fp[i] ^ fp[j]).count("1") <= most} for i in left}

    def shingles(text):
        w = text.lower().split()
        return {tuple(w[k : k + cp.SHINGLE]) for k in range(max(1, len(w) - cp.SHINGLE + 1))}

    sets = {i: shingles(rows[i]["text"]) for i in left}
    pairs = [(i, j) for i in ids for j in ids if i < j and len(sets[i] & sets[j]) >= cp.SIMILARITY * len(sets[i] | sets[j])]
    assert not pairs  # one of each group stays
    assert all(near[i] for i in left - ids)  # only documents with a near copy go
    assert all(i in ids for i in left if not near[i])
    mixed = cp.mix_sources(spark, single, d)
    assert mixed.columns == cp.COLUMNS and {r["doc_id"] for r in mixed.collect()} <= ids
    packed = cp.pack_sequences(spark, mixed, d).collect()
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in mixed.collect()}
    assert all(zlib and r["sequence_tokens"] <= 1024 for r in packed)
