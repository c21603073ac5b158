"""The operators on frames: odd rows, empty tables, clashing columns, and brute force on small tables."""

import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from veilsift.llm import components, html_extract, langid, mixing, packing, quality, simhash, token_count, toxicity, vptree, warc

P = pytest.importorskip("public_tokenizers")
LONG = "word " * 30_000


@pytest.fixture(scope="module")
def docs(spark):
    rows = [
        (1, "The quick brown fox jumps over the lazy dog and then it sleeps a while", "en", "a", 1),
        (2, "The quick brown fox jumps over the lazy dog and then it sleeps a while", "en", "a", None),
        (3, None, None, None, 0),
        (4, "", "en", "b", 0),
        (None, "no id here but ten words are in this text you see", None, "b", 1),
        (6, LONG, "en", None, 1),
        (6, LONG, "en", None, 1),
        (7, "\n\t ", "de", "c", 2),
        (8, "日本語 のテキスト 😀", "ja", "c", 2),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    return spark.createDataFrame(rows, schema).withColumns({"rank": F.lit(1), "fp": F.lit(2), "size": F.lit("x"), "score": F.lit(None).cast("double")})


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


def test_token_counts(docs, none):
    rows = token_count.count_tokens(docs, P.path("piece_bpe_32k.model"), limit=100).collect()
    assert len(rows) == 9
    by = {r["doc_id"]: r for r in rows}
    assert (by[3]["n_bytes"], by[3]["n_tokens"]) == (0, 0) and by[6]["over_limit"] and by[6]["n_bytes"] == len(LONG)
    assert token_count.count_tokens(none, P.path("piece_bpe_32k.model")).count() == 0


def test_packing(docs, none):
    rows = packing.pack(docs, P.path("byte_bpe_50k.json"), with_ids=True).collect()
    size = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == size.get(r["sequence_id"], 0)
        size[r["sequence_id"]] = r["offset"] + r["length"]
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) and len(r["ids"]) == r["length"]
    assert all(n <= 1024 and n & (n - 1) == 0 for n in size.values())
    one = sorted((r["start"], r["ids"]) for r in rows if r["doc_id"] == 1)
    assert sum((i for _, i in one), [])[-1] == 0 and sum(r["length"] for r in rows if r["doc_id"] == 3) == 1
    assert packing.pack(none, P.path("byte_bpe_50k.json")).count() == 0


def test_near_duplicates(docs, none):
    by = {}
    for r in simhash.near_duplicates(docs).collect():
        by.setdefault(r["doc_id"], []).append(r)
    assert by[2][0]["component_id"] == 1 and by[3][0]["fingerprint"] == "0" * 16
    assert {by[i][0]["component_id"] for i in (3, 4, 7)} == {3} and len(by[6]) == 2
    assert by[None][0]["component_id"] is None
    assert simhash.near_duplicates(none).count() == 0


def test_links_connect_what_brute_force_connects(spark, monkeypatch):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 62, 20)
    fps = {int(b) for b in base}
    for b in base[:6]:
        for _ in range(30):  # chains of near ones around six centres
            x = int(b)
            for bit in rng.integers(0, 62, rng.integers(1, 6)):
                x ^= 1 << int(bit)
            fps.add(x)
    fps |= {int(base[0]) ^ (1 << a) ^ (1 << b) for a in range(0, 40) for b in range(40, 50)}
    fps = sorted(fps)
    bits = np.bitwise_count(np.array(fps, np.uint64)[:, None] ^ np.array(fps, np.uint64)[None]) <= 4
    want = list(range(len(fps)))
    for _ in range(len(fps)):
        new = [min(want[j] for j in np.flatnonzero(row)) for row in bits]
        if new == want:
            break
        want = new
    frame = spark.createDataFrame([(f,) for f in fps], "fp long")
    for block in (simhash.BLOCK, 16):
        monkeypatch.setattr(simhash, "BLOCK", block)
        got = {r["node"]: r["root"] for r in components.components(simhash.links(frame)).collect()}
        assert [got.get(f, f) for f in fps] == [fps[w] for w in want]


def test_rules(docs, none):
    by = {r["doc_id"]: r for r in quality.report(docs).collect()}
    assert by[1]["kept"] and by[3]["base_failed"] and by[6]["n_repeat_words"] == 30_000 and not by[6]["kept"]
    assert quality.report(none).count() == 0
    rows = quality.ledger(docs)
    got = {r["rule"]: r for r in quality.ablation(rows, "v1").collect()}
    plain = rows.collect()
    m = quality.mask("v1")
    for name in quality.POLICIES["v1"]:
        bit = 1 << quality.BIT[name]
        assert got[name]["failed"] == sum(bool(r["failed"] & bit) for r in plain)
        assert got[name]["failed_alone"] == sum(r["failed"] & m == bit for r in plain)
        assert got[name]["rejected_without"] == sum(bool(r["failed"] & m & ~bit) for r in plain)


def test_mix(spark, docs, none):
    rows = [(i, f"s{i % 7 if i % 3 else 0}", " ".join(["w"] * (1 + i * 37 % 90))) for i in range(2000)] + [(2000, None, "a b c")]
    frame = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = [r.asDict(recursive=True) for r in mixing.allot(frame, mixing.words()).collect()]
    size, taken, target = {}, {}, {}
    for r in got:
        m = r["mix"]
        assert m["taken"] in (0, m["size"], 2 * m["size"])
        size[r["source"]] = size.get(r["source"], 0) + m["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + m["taken"]
        target[r["source"]] = m["target"]
    order = sorted([s for s in size if s is not None]) + [None]
    weight = dict(zip(order, [3, 1, 2] * 5, strict=False))
    want, full, budget = {}, set(), 1.5 * sum(size.values())
    while True:
        free = [s for s in order if s not in full]
        level = (budget - sum(2 * size[s] for s in full)) / sum(weight[s] for s in free)
        want = {s: 2 * size[s] if s in full else level * weight[s] for s in order}
        over = {s for s in free if want[s] > 2 * size[s]}
        if not over:
            break
        full |= over
    assert all(abs(want[s] - target[s]) < 1e-6 for s in order)
    assert all(abs(taken[s] - target[s]) <= 46 for s in order)
    again = {r["doc_id"]: r["mix"]["taken"] for r in mixing.allot(frame.repartition(7), mixing.words()).collect()}
    assert again == {r["doc_id"]: r["mix"]["taken"] for r in got}
    assert mixing.allot(docs, mixing.words()).count() == 9 and mixing.report(none).count() == 0
    assert mixing.mixed(docs, mixing.words()).columns == docs.columns


def test_mix_odds_are_unequal(spark, monkeypatch):
    """Longer documents are likelier, at the rate that p tells; rows without an id are told by their text."""
    rows = [(i if i % 2 else None, "s", " ".join([f"w{i}"] + ["w"] * (9 if i % 4 < 2 else 599))) for i in range(4000)] + [(9000, "t", "a b " * 900_000)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = mixing.allot(frame, mixing.words(), share=0.4, pattern=(1, 30)).where("source = 's'").select("mix.*").collect()
    need, total = got[0]["target"], sum(r["size"] for r in got)
    assert abs(sum(r["taken"] for r in got) - need) <= 600
    r = need / total
    mean = sum(x["size"] * (x["size"] * 1024 // (x["size"] + 256)) for x in got) / total / 1024
    for size in (10, 600):
        share = sum(x["taken"] > 0 for x in got if x["size"] == size) / 2000
        assert abs(share - (r + r * (1 - r) * (size * 1024 // (size + 256) / 1024 - mean))) < 0.04
    again = mixing.allot(frame.repartition(5), mixing.words(), share=0.4, pattern=(1, 30)).where("source = 's'").select("doc_id", "text", "mix.taken").collect()
    first = mixing.allot(frame, mixing.words(), share=0.4, pattern=(1, 30)).where("source = 's'").select("doc_id", "text", "mix.taken").collect()
    assert sorted(map(str, again)) == sorted(map(str, first))


@pytest.mark.parametrize("name", ["op1_pareto_mix", "op3_rule_ledger", "op8_warc"])
def test_reports_equal_sql(spark, name):
    import duckdb

    from veilsift.llm import queries

    duck = duckdb.connect()
    for t in ("documents", "pages"):
        duck.execute(f"create view {t} as select * from '/root/testdata/sf0.001/{t}.parquet'")
    cur = duck.execute(queries.oracle_sql()[name])
    names = [x[0] for x in cur.description]
    got = queries.queries()[name](spark, "/root/testdata/sf0.001")
    assert sorted(names) == sorted(got.columns)
    assert sorted(repr(tuple(r[c] for c in names)) for r in got.collect()) == sorted(map(repr, cur.fetchall()))


def test_nearest(spark):
    rng = np.random.default_rng(2)
    v = rng.normal(size=(300, 6))
    v[50:120] = v[3]
    rows = [(i, x.tolist()) for i, x in enumerate(v)] + [(900, None), (901, [0.0] * 6), (902, [float("nan")] * 6), (903, [None] * 6), (None, [1.0] * 6), (904, [1.0, 2.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rank", F.lit(1))
    got = {}
    for r in vptree.nearest(frame, frame.where("vec_id % 20 = 0"), 20, factor=1.0, shard_rows=100).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    for q in range(0, 300, 20):
        s = v @ v[q]
        want = sorted(((-round(s[i], 9), i) for i in range(300) if i != q))[:20]
        assert [g[1] for g in got[q]] == [i for _, i in want] and [g[0] for g in got[q]] == list(range(1, 21))
    assert set(got) == set(range(0, 300, 20))
    # clusters far apart: whole shards are passed over, and the answers are still exact
    centres = rng.normal(size=(4, 6)) * 50
    w = centres[np.arange(400) % 4] + rng.normal(size=(400, 6))
    many = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(w)] + [(i + 1000, w[7].tolist()) for i in range(300)], "vec_id long, embedding array<double>")
    found = {}
    for r in vptree.nearest(many, many.where("vec_id < 40 or vec_id = 1005"), 5, factor=1.0, shard_rows=50).collect():
        found.setdefault(r["query_id"], {})[r["rank"]] = r["vec_id"]
    every = {**dict(enumerate(w)), **{i + 1000: w[7] for i in range(300)}}
    ids, vs = np.array(list(every)), np.array(list(every.values()))
    for q in [*range(40), 1005]:
        s = (vs @ every[q]).round(9)
        want = sorted((-x, i) for x, i in zip(s.tolist(), ids.tolist(), strict=True) if i != q)[:5]
        assert [found[q][k] for k in range(1, 6)] == [i for _, i in want]
    assert vptree.nearest(frame.where("false"), frame.where("false")).count() == 0


def test_nearest_of_repeated_ids(spark):
    rows = [(20, [1.0, 0.0]), (20, [0.0, 1.0]), (3, [0.9, 0.1]), (3, [0.1, 0.9]), (4, [0.5, 0.5]), (40, [2.0, 2.0]), (40, [2.0, 2.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [tuple(r) for r in vptree.nearest(frame, frame.where("vec_id % 20 = 0"), 4, factor=1.0).collect()]
    want = []
    for a, (q, v) in enumerate(rows):
        if q % 20 == 0:
            found = sorted((-(v[0] * w[0] + v[1] * w[1]), i) for b, (i, w) in enumerate(rows) if b != a)[:4]
            want += [(q, n, i, -s) for n, (s, i) in enumerate(found, 1)]
    assert sorted(got) == sorted(want)


def test_no_language_is_learnt(spark):
    docs = spark.createDataFrame([(1, "hello there", None), (2, None, None), (None, "1234", None), (2, "", "en")], "doc_id long, text string, lang string")
    for rows in (docs.where("lang is null"), docs.where("doc_id = 2")):  # 2 is held out
        assert {(r["lang_pred"], r["score"]) for r in langid.report(rows).collect()} == {("und", 0.0)}


@pytest.mark.parametrize(
    "rows",
    [
        [(5, "a", "w " * 20)] * 1000,
        [(5, "a", "w " * 20)] * 600 + [(5, "b", "w " * 20)] * 300 + [(6, "b", "w " * 7)] * 300 + [(None, None, "z " * 11)] * 200,
        [(None, "a", "w " * 20)] * 400 + [(None, "a", "w " * 19)] * 300 + [(None, None, f"x{i} y" * (i % 13)) for i in range(300)],
        [(i % 40, "abc"[i % 3], "w " * (i % 7)) for i in range(1500)] + [(7, "a", "w " * 9)] * 1000,
    ],
)
def test_mix_of_repeated_ids(spark, tmp_path, rows):
    path = str(tmp_path / "docs")
    spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(7).write.parquet(path)
    got = mixing.report(spark.read.parquet(path)).collect()
    c = duckdb.connect()
    c.execute(f"create view documents as select * from '{path}/*.parquet'")
    cur = c.execute(mixing.REPORT_SQL)
    names = [x[0] for x in cur.description]
    assert sorted(repr(tuple(r[k] for k in names)) for r in got) == sorted(map(repr, cur.fetchall()))


def test_round_trip(spark):
    big = "<p>" + "x" * 200
    rows = [(1, "u", big), (2, None, big), (3, "u\r\nv", "é" * 60), (4, "u", None), (5, "u", ""), (6, "u", "small"), (7, "u", "small"), (8, "u", "\r\n\r\nWARC/1.1\r\n" * 20)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1))
    by = {r["page_id"]: r for r in warc.report(frame).collect()}
    assert by[2]["record_type"] == "revisit" and by[2]["refers_to"] == 1 and by[2]["payload_bytes"] == 203
    assert {by[i]["record_type"] for i in (1, 3, 4, 5, 6, 7, 8)} == {"response"} and len(by) == 8
    texts = {r["record_id"]: bytes(r["payload"]).decode() for r in warc.round_trip(frame).collect() if r["kind"] == "response"}
    assert texts == {str(i): t or "" for i, _, t in rows if i != 2}
    assert warc.report(frame.where("false")).count() == 0


def test_models(docs, none, spark):
    labels = spark.createDataFrame([(1, 1, 0), (6, 0, 1), (None, 1, 1), (2, None, None)], "doc_id long, quality int, toxic int")
    rows = toxicity.report(docs, labels).collect()
    assert len(rows) == 9 and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.report(none, labels).count() == 0 and toxicity.report(docs, labels.where("false")).count() == 9
    few = toxicity.fit(docs, labels, train_chars=1)  # no room for a text: nothing is learnt
    assert len(few[0]) == 0 and few[2] == -5.0
    by = {r["doc_id"]: r for r in langid.report(docs).collect()}
    assert by[3]["lang_pred"] == by[4]["lang_pred"] == by[7]["lang_pred"] == "und"
    assert langid.report(none).count() == 0
    spans = langid.label(docs, langid.fit(docs), with_spans=True).where("doc_id = 1").first()["spans"]
    assert spans[0]["first"] == 0 and spans[-1]["end"] == 15
    pages = spark.createDataFrame([(1, "u", None), (None, None, "<p>some words stand here</p>")], "page_id long, url string, html string")
    assert sorted(r["text"] for r in html_extract.report(pages).collect()) == ["", "some words stand here"]
    assert html_extract.report(pages.where("false")).count() == 0
    long = "<article>" + "<p>word</p>" * 50_000 + "</article>"
    odd = spark.createDataFrame([(1, "u", long), (1, "u", long), (None, None, None)], "page_id long, url string, html string").withColumns({"text": F.lit(1), "n_chars": F.lit("x")})
    assert sorted(r["n_chars"] for r in html_extract.report(odd).collect()) == [0, 249_999, 249_999]


def test_repeated_pages(spark):
    x, y = "X" * 150, "Y" * 150
    rows = [(1, x), (5, x), (5, x), (6, y), (5, "Z" * 150), (None, y), (6, y), (None, None)]
    frame = spark.createDataFrame([(i, f"http://h/{k}", t) for k, (i, t) in enumerate(rows)], "page_id long, url string, html string")
    got = sorted(((r["page_id"] or 0, r["payload_digest"], r["record_type"], r["refers_to"]) for r in warc.report(frame).collect()), key=str)
    import hashlib

    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    kinds = ["response", "revisit", "revisit", "response", "response", "response", "response", "response"]
    assert got == sorted(((i or 0, sha(t), k, 1 if k == "revisit" else None) for (i, t), k in zip(rows, kinds, strict=True)), key=str)


def test_shared_folder_is_no_local_one_on_a_cluster(monkeypatch):
    from veilsift.llm import common

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        class _jsc:
            @staticmethod
            def sc():
                class Sc:
                    @staticmethod
                    def getCheckpointDir():
                        class No:
                            isDefined = staticmethod(lambda: False)

                        return No

                return Sc

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError):
        common.shared_dir(Session())
