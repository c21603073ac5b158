"""The joined way of large dictionaries against the broadcast one, and the sketch of first words before it."""

import random

from pyspark.sql import functions as F

from veilsift.operators import dictionary


def texts(rng, names, n):
    words = [w for x in names for w in x.split()] + ["filler", "words", "that", "are", "no", "name", "Ünïq", "x-y", "O'Neil"]
    return [(i, " ".join(rng.choice(words).title() if rng.random() < 0.5 else rng.choice(words) for _ in range(rng.randint(0, 40)))) for i in range(n)] + [(0, None), (1, ""), (1, "")]


def test_joined_equals_broadcast(spark, monkeypatch):
    rng = random.Random(3)
    syllables = ["an", "be", "ci", "do", "é", "fü"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 3)))
    names = sorted({" ".join(word() for _ in range(rng.randint(1, 4))) for _ in range(300)})
    known = dictionary.dictionary(spark.createDataFrame([(n,) for n in names], "name string"))
    docs = spark.createDataFrame(texts(rng, names, 120), "doc_id long, text string")
    found = lambda k: sorted((tuple(r) for r in dictionary.detect(docs, known, k).dropDuplicates().collect()), key=repr)
    for most in (None, 1, 3):
        monkeypatch.setattr(dictionary, "BROADCAST_NAMES", 2_000_000)
        want = found(most)
        for blocks in (1 << 20, 1):  # a sketch that is far too small lets everything by, and loses nothing
            monkeypatch.setattr(dictionary, "BROADCAST_NAMES", 0)
            monkeypatch.setattr(dictionary, "MOST_BLOCKS", blocks)
            assert found(most) == want
    assert len(want) > 100


def test_sketch_denies_most_other_words(spark):
    rows = spark.range(50_000).select(F.concat(F.lit("name"), "id").alias("word"))
    sketch = dictionary.FirstWords.of(rows, "word")
    assert all(sketch.holds(f"name{i}") for i in range(50_000)) and len(sketch.blocks) * 64 >= 16 * 50_000
    assert sum(sketch.holds(f"other{i}") for i in range(20_000)) < 400


def test_tokens_that_begin_no_name_stay(spark):
    names = dictionary.dictionary(spark.createDataFrame([(f"first{i} last",) for i in range(400)], "name string"))
    docs = spark.createDataFrame([(i, f"first{i} last " + "other tokens here " * 100) for i in range(50)], "doc_id long, text string")
    rows = dictionary.keyed(docs, "doc_id", "text")
    found = dictionary.candidates(rows, names, 3)
    assert found.count() == 50
    # what leaves the first Arrow function: few tokens beside those that begin names
    nodes = found._jdf.queryExecution().executedPlan().toString()
    assert nodes.count("MapInArrow") == 1
