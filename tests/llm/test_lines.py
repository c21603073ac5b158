"""Cuckoo filters, and line dedup against a plain reading of its rule, with deletions."""

import hashlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from veilsift.llm import lines
from veilsift.llm.cuckoo import CuckooFilter

SPACE = " \t\n\v\f\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.mark.parametrize("n", [0, 1, 2, 9, 500, 14_700, 60_000])
def test_filter_holds_what_was_added_and_not_removed(n):
    rng = np.random.default_rng(n)
    h = np.unique(rng.integers(-(2**63), 2**63 - 1, n))
    f = CuckooFilter.of(h)
    assert f.holds(h).all() and len(f) == len(h)
    g = CuckooFilter.from_bytes(f.to_bytes())
    g.table = g.table.copy()
    g.remove(h[::3])
    assert g.holds(np.delete(h, np.arange(0, len(h), 3))).all() and len(g) == len(h) - len(h[::3])
    assert f.holds(rng.integers(-(2**63), 2**63 - 1, 50_000)).mean() < 4e-4
    assert not n or g.add(h[::3]) and g.holds(h).all()
    with pytest.raises(KeyError):
        CuckooFilter.sized(4).remove(np.array([7]))


def brute(docs, held=None):
    """(id, n_lines, n_dropped, text) of ``docs`` where ``held`` is what the index holds."""
    key = lambda x: x.strip(SPACE).translate(LOWER)
    having = defaultdict(list)
    for i, t in docs if held is None else held:
        for k in {key(x) for x in (t or "").split("\n")}:
            if len(k) >= 20:
                having[k].append(i)
    top = {k: max((i for i in v if i is not None), default=None) for k, v in having.items() if len(v) >= 3}
    out = []
    for i, t in docs:
        all_ = (t or "").split("\n")
        rest = [x for x in all_ if not (key(x) in top and top[key(x)] != i)]
        out.append((i, len(all_), len(all_) - len(rest), "\n".join(rest)))
    return sorted(out, key=repr)


LINE = "A Line that is Long enough"
ODD = [
    (1, f"{LINE}\nown line of one, which is long\n  {LINE.upper()}\t"), (2, f"x\r\n\v{LINE} \r\n"), (3, f"{LINE}\n{LINE}\nend"), (3, f"{LINE}\nanother of the same id"),
    (4, None), (5, ""), (6, "\n\n"), (None, f"{LINE}\nÄÖÜ not lower-cased here ÄÖÜ"), (None, "äöü not lower-cased here äöü"), (7, "é" * 20), (8, "É" * 20), (9, "é" * 20), (10, "é" * 19), (11, "é" * 20 + "\x85"),
    (12, "short line\nshort line"), (13, "short line"), (14, "short line"), (15, ("word " * 40_000 + "\n") * 3), (16, "word " * 40_000), (17, "word " * 40_000), (-5, LINE),
    (20, "only null ids and copies of it"), (20, "only null ids and copies of it"), (20, "only null ids and copies of it"),
]
NULLS = [(None, "a line only of rows without an id"), (None, "a line only of rows without an id"), (None, "a line only of rows without an id\nmore")]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").withColumns({"id": F.lit("x"), "k1": F.lit(1), "drops": F.lit(None).cast("int")})


def rows_of(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_lines", "n_dropped", "kept").collect()), key=repr)


@pytest.mark.parametrize("limit", [lines.FILTER_BYTES, 0])
def test_equals_the_rule(spark, limit):
    docs = ODD + NULLS
    assert rows_of(lines.dedup_lines(frame(spark, docs), filter_bytes=limit)) == brute(docs)
    digests = {r["kept_sha256"] for r in lines.report(frame(spark, docs)).collect()}
    assert digests == {hashlib.sha256(x[3].encode()).hexdigest() for x in brute(docs)}


def test_tables_without_rows_or_shared_lines(spark):
    assert lines.report(frame(spark, []).where("false")).count() == 0
    assert rows_of(lines.dedup_lines(frame(spark, [(1, "one"), (2, None)]))) == [(1, 1, 0, "one"), (2, 1, 0, "")]


def test_batches_and_deletions(spark, tmp_path):
    rng = np.random.default_rng(4)
    pool = [f"line number {i} of the pool of lines" for i in range(120)]
    docs = [(i, "\n".join(rng.choice(pool, rng.integers(1, 9)))) for i in range(150)]
    folder = f"file://{tmp_path}/index"
    index = lines.LineIndex(spark, folder, shards=5)
    assert rows_of(index.clean(frame(spark, docs[:3]))) == brute(docs[:3], [])
    index.insert(frame(spark, docs[:60])).insert(frame(spark, docs[60:]))
    assert rows_of(index.clean(frame(spark, docs))) == brute(docs)
    gone = [(int(i),) for i in rng.choice(150, 70, replace=False)] + [(10_000,)]
    left = [d for d in docs if (d[0],) not in gone]
    # a later session goes on with what is there
    index = lines.LineIndex(spark, folder, shards=5)
    assert index.batch == 2
    index.delete(spark.createDataFrame(gone, "doc_id long"))
    assert rows_of(index.clean(frame(spark, docs))) == brute(docs, left)
    shared = {(r["k1"], r["k2"]) for r in index.shared().collect()}
    assert sum(len(CuckooFilter.from_bytes(bytes(r["bits"]))) for r in spark.read.parquet(index._path("filters", 3)).collect()) == len(shared)
    index.insert(frame(spark, [d for d in docs if (d[0],) in gone]))
    assert rows_of(index.clean(frame(spark, docs))) == brute(docs)


def test_a_broken_batch_is_written_over(spark, tmp_path):
    docs = [(i, f"{LINE}\nline {i} that stands alone here") for i in range(6)]
    folder = f"file://{tmp_path}/index"
    index = lines.LineIndex(spark, folder, shards=3).insert(frame(spark, docs[:4]))
    # a run that died after the references of its batch, which hold other keys than the next run's
    index.references().withColumn("id", F.col("id") + 100).write.parquet(index._path("references", 2))
    again = lines.LineIndex(spark, folder, shards=3)
    assert again.batch == 1 and rows_of(again.clean(frame(spark, docs))) == brute(docs, docs[:4])
    again.insert(frame(spark, docs[4:]))
    assert again.batch == 2 and rows_of(again.clean(frame(spark, docs))) == brute(docs)


def test_a_full_shard_is_made_anew(spark):
    first = [(i, "\n".join(f"line {k} which is shared by three" for k in range(5))) for i in range(3)]
    more = [(i, "\n".join(f"line {k} which is shared by three" for k in range(900))) for i in range(10, 13)]
    index = lines.LineIndex(spark, shards=2).insert(frame(spark, first)).insert(frame(spark, more))
    assert rows_of(index.clean(frame(spark, first + more))) == brute(first + more)
