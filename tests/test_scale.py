"""What a task gets and holds: parts that grow in number and not in size, and no text in a shuffle."""

import pytest

from veilsift import rule_queries, sentences
from veilsift.operators import ner
from veilsift.sources import readers

D = "/root/testdata/sf0.001"


def test_rows_made_from_keys_are_dealt(spark, monkeypatch):
    cores = spark.sparkContext.defaultParallelism
    for rows in (rule_queries._keys(spark, D), sentences.view(spark, D)):
        assert rows.rdd.getNumPartitions() == cores > 1
    monkeypatch.setattr(readers, "KEYS_A_TASK", 10)
    assert rule_queries._keys(spark, D).rdd.getNumPartitions() == 15


@pytest.mark.parametrize("piece", [2, 1024])
def test_a_model_gets_equal_texts_once(spark, monkeypatch, piece):
    monkeypatch.setattr(ner, "PIECE", piece)

    def model(texts):
        return [[("PERSON", 0, len(texts), 0.5)] for _ in texts]

    rows = spark.createDataFrame([(i, "same text" if i < 4 else "other") for i in range(5)], "doc_id long, text string").coalesce(1)
    got = {r["id"]: r["end"] for r in ner.detect(rows, {"m": lambda: model}).collect()}
    assert got == ({i: 2 for i in range(5)} if piece > 2 else {i: 1 for i in range(5)})


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_spans_take_their_context_where_texts_are_read(spark):
    """No join in the whole plan: texts meet neither spans nor triggers again, and nothing of their number goes through the driver."""
    queries = rule_queries.queries()
    for name in ("sentence_gateway", "model_entities"):
        plan = _plan(queries[name](spark, D)).replace("BroadcastHashJoin [k#", "")  # cases of a key
        assert "Join" not in plan, name


def test_gateway_keeps_rows_that_are_repeated_or_have_no_id(spark):
    import dataclasses

    from veilsift.operators import dictionary
    from veilsift.options import DetectOptions
    from veilsift.plans import detect as plan

    rows = [(1, "mail a@ex.org or a@ex.org"), (1, "mail a@ex.org or a@ex.org"), (None, "mail b@ex.org"), (None, "Anna mails c@ex.org"), (2, "Anna"), (2, None), (3, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    names = dictionary.dictionary(spark.createDataFrame([("anna",)], "name string"))
    options = dataclasses.replace(DetectOptions(), detectors=("regex", "dict"))
    got = sorted((str(r["id"]), r["text"], r["start"], r["trigger"], r["trigger_match"]) for r in plan.detect_with_gateway(docs, options, names).collect())
    mails = [("1", "a@ex.org", 5, None, None)] * 2 + [("1", "a@ex.org", 17, None, None)] * 2
    assert got == sorted([*mails, ("None", "b@ex.org", 5, None, None), ("None", "Anna", 0, "name", "Anna"), ("None", "c@ex.org", 11, "name", "Anna"), ("2", "Anna", 0, "name", "Anna")], key=lambda x: (x[0], x[1], x[2]))


def test_the_gateway_tests_run_once_a_branch(spark):
    """A filter on the trigger does not run Python functions again: two of them a branch of patterns and one of names."""
    plan = _plan(rule_queries.queries()["sentence_gateway"](spark, D))
    assert plan.count("EvalPython [") == 4


def test_first_name_of_a_text(monkeypatch):
    from veilsift.operators import dictionary

    match = dictionary.Matcher(frozenset({"anna", "anna li po", "bo"}), 3)
    for head in (1, 2, 3, 128):
        monkeypatch.setattr(dictionary, "HEAD", head)
        for text in ("", "none", "a b c Anna Li Po", "Anna Li x", "x Bo", "x y z Bo Anna", "ANNA", "Li Po Anna li, po"):
            hit = next(match(text), None)
            assert match.first_place(text) == (hit and hit[2:]), (head, text)


def test_exact_matching_writes_nothing_and_equals_the_greedy_order(spark, monkeypatch):
    import random

    from veilsift.operators import evaluate

    rng = random.Random(5)
    spans = lambda n: [(str(rng.randrange(4)), i, rng.choice(["SSN", "EMAIL", "ADDRESS"]), s := rng.randrange(4), s + rng.randrange(3)) for i in range(n)]
    gold, pred = spans(60), spans(50)
    want = set()
    for g in gold:
        for p in pred:
            if (g[0], *g[2:]) == (p[0], *p[2:]) and not any(w[:2] == (g[0], g[2]) and (w[2] == g[1] or w[3] == p[1]) for w in want):
                want.add((g[0], g[2], g[1], p[1]))
                break
    monkeypatch.setattr(evaluate.shared, "cut", lambda df: pytest.fail("written"))
    frames = (spark.createDataFrame(x, "id string, idx int, type string, start int, end int") for x in (gold, pred))
    got = [tuple(r)[:4] for r in evaluate.match(*frames, "exact").collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 10


def test_spans_are_merged_as_they_lie(spark, monkeypatch):
    """One exchange by the document from the rows to the merged spans, in parts that grow in number; no list is aggregated, which sorts all rows again."""
    from veilsift import queries
    from veilsift.sources import readers

    for name in ("merge_overlapping", "merge_adjacent"):
        plan = _plan(queries.queries()[name](spark, D))
        assert plan.count("Exchange hashpartitioning") == 1 and "Aggregate" not in plan, name
    monkeypatch.setattr(readers, "ROWS_A_TASK", 500)
    lines = spark.read.parquet(f"{D}/lineitem.parquet").count()
    assert queries.queries()["merge_overlapping"](spark, D).rdd.getNumPartitions() == -(-lines // 500) > 4


def test_detection_merges_by_windows(spark):
    plan = _plan(rule_queries.queries()["sentence_entities_constants"](spark, D))
    assert "Aggregate" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_merged_spans_equal_a_plain_fold(spark):
    import random

    from veilsift.operators import spans

    rng = random.Random(3)
    rows = []
    for n in range(400):
        start = rng.randrange(40)
        rows.append((rng.choice(["a", "b", None]), n, rng.choice("XY"), f"t{n}", start, start + rng.randrange(1, 6), rng.randrange(9) / 8, [rng.choice("pqr")], rng.choice(["  ", " x"])))
    df = spark.createDataFrame(rows, "id string, seq int, type string, text string, start int, end int, score double, sources array<string>, pre string")
    union = lambda a, b: a + [x for x in b if x not in a]
    want = []
    for doc in ("a", "b", None):
        last = None
        for _, seq, kind, text, start, end, score, sources, pre in sorted((r for r in rows if r[0] == doc), key=lambda r: (r[4], r[1])):
            gap = start - last[5] if last else 0
            if last and last[2] == kind and gap <= 2 and (gap <= 0 or not pre[-gap:].strip()):
                last[5:] = [end, max(last[6], score), union(last[7], sources)]
            else:
                want.append(last := [doc, seq, kind, text, start, end, score, sources])
    key = lambda r: (str(r[0]), *r[1:7])
    adjacent = [[r[c] for c in ("id", "seq", "type", "text", "start", "end", "score", "sources")] for r in spans.merge_adjacent(df, 2).collect()]
    assert sorted(adjacent, key=key) == sorted(want, key=key)
    want = []
    for doc in ("a", "b", None):
        for kind in "XY":
            last = None
            for _, _, _, text, start, end, score, sources, _ in sorted((r for r in rows if r[0] == doc and r[2] == kind), key=lambda r: (r[4], r[5], r[1])):
                if last and start < last[4]:
                    last[4:] = [max(last[4], end), max(last[5], score), union(last[6], sources)]
                else:
                    want.append(last := [doc, kind, text, start, end, score, sources])
    merged = [[r[c] for c in ("id", "type", "text", "start", "end", "score", "sources")] for r in spans.merge_overlapping(df).collect()]
    key = lambda r: (str(r[0]), *r[1:6])
    assert sorted(merged, key=key) == sorted(want, key=key)


def _runs_on(texts, run_of, columns="id long, h long, t string"):
    """What a task's function gives of one batch of ``texts``, made by ``run_of`` of a frame that only keeps it."""
    import pyarrow as pa
    from pyspark.sql.types import StructType

    n = len(texts)
    more = [pa.array([False] * n)] if "raw_only" in columns else []
    batch = pa.RecordBatch.from_arrays([pa.array(range(n), pa.int64()), pa.array(range(n), pa.int64()), pa.array(texts), *more], columns.replace(" ", ",").split(",")[::3])

    class Rows:
        schema = StructType.fromDDL(columns)

        def mapInArrow(self, run, ddl):
            return run(iter([batch]))

    return run_of(Rows())


@pytest.mark.parametrize("detector", ["regex", "dict"])
def test_a_task_holds_few_results_of_long_texts(spark, monkeypatch, detector):
    """30 texts in one batch, of 2,000 spans each: as Python objects all of them are over 20 MB."""
    import gc
    import tracemalloc
    from types import SimpleNamespace

    from veilsift.functions import tasks
    from veilsift.operators import dictionary, regex_detect
    from veilsift.options import profile

    alive = []
    monkeypatch.setattr(tasks, "give_back", lambda: alive.append(sum(type(o) in (dictionary.Matcher, regex_detect.Finder) for o in gc.get_objects())))
    monkeypatch.setattr(dictionary, "_shared", lambda rows, names: SimpleNamespace(value=frozenset(["ann"])))
    if detector == "regex":
        found = _runs_on(["mail ann@ex.org " * 2000] * 30, lambda rows: regex_detect._found(rows, profile("constants")), "id long, h long, t string, raw_only boolean")
    else:
        found = _runs_on(["with Ann at home " * 2000] * 30, lambda rows: dictionary._broadcast_matches(rows, None, 1, 40))
    tracemalloc.start()
    sizes, places = [], []
    for b in found:
        sizes.append(b.num_rows)
        places.append((b.column("id")[0].as_py(), b.column("start")[0].as_py()))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(sizes) == 60_000 and max(sizes) <= 4096 and places == sorted(places)
    assert peak < 12e6
    del b, found
    assert alive[-1] == 0  # nothing that the task remembered is held when memory is given back


def test_pieces_are_bounded_by_rows_and_bytes(monkeypatch):
    import pyarrow as pa

    from veilsift.functions import tasks

    monkeypatch.setattr(tasks, "PIECE", 4)
    monkeypatch.setattr(tasks, "PIECE_BYTES", 10)
    texts = pa.array(["a" * 30, None, "bb", "é" * 4, "c" * 10, "d" * 11, "", *"efghi"])
    assert list(tasks.cuts(texts)) == [(0, 1), (1, 3), (4, 1), (5, 1), (6, 4), (10, 2)]
    assert list(tasks.cuts(texts.slice(4))) == [(0, 1), (1, 1), (2, 4), (6, 2)]
    assert list(tasks.cuts(pa.array([], pa.string()))) == []
