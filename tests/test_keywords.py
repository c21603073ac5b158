"""Context words by the automaton against substring search."""

import dataclasses
import random

import pytest
from pyspark.sql import functions as F

from veilsift import keyword_lists
from veilsift import options as O
from veilsift.operators import gold, keywords, regex_detect


def plain(options, label, pre, post):
    """Positive, negative, ZIP, born as four searches in four strings."""
    w = options.context_window
    around = lambda k: ((pre[-k:] if k else "") + " " + post[:k]).lower()
    parts = [(around(w), options.keywords.get(label, ())), (pre[-25:].lower(), O.NEGATIVE_WORDS.get(label, ())), (around(40), O.ZIP_WORDS), (pre[-20:].lower(), O.BIRTH_WORDS)]
    return sum(1 << i for i, (t, words) in enumerate(parts) if any(x in t for x in words))


@pytest.mark.parametrize("name", ["constants", "config", "lists"])
@pytest.mark.parametrize("window", [40, 10, 70, 0])
def test_context_equals_substring_search(name, window):
    options = dataclasses.replace(O.profile(name), context_window=window)
    context = regex_detect.Context(options)
    words = [*{x for k in (*options.keywords.values(), *O.NEGATIVE_WORDS.values(), O.ZIP_WORDS, O.BIRTH_WORDS) for x in k}, "İ", "ß", "x", "filler", "-", "Σ"]
    rng = random.Random(window)
    most = max(40, window)
    for _ in range(3000):
        text = "".join(rng.choice(words).upper() if rng.random() < 0.3 else rng.choice(words) + rng.choice(["", " "]) for _ in range(40))
        cut = rng.randrange(len(text))
        pre, post = text[:cut][-most:], text[cut:][:most]
        for label in context.labels:
            assert context(label, pre, post) == plain(options, label, pre, post), (label, pre, post)


def test_present(spark):
    rows = [(1, "My SSN and Date of Birth"), (None, None), (2, ""), (2, "nothing"), (3, "x" * 500_000 + " iban")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("id", F.lit("x"))
    got = {(r["id"], tuple(r["types"])) for r in keywords.present(docs, keyword_lists.LISTS).collect()}
    want = {(i, tuple(k for k, w in keyword_lists.LISTS.items() if t and any(x.lower() in t.lower() for x in w))) for i, t in rows}
    assert got == want and keywords.present(docs.where("false"), keyword_lists.LISTS).count() == 0
    assert [r["types"] for r in keywords.present(docs.limit(1), {"all": ("",), "none": ()}).collect()] == [["all"]]


def test_files_of_words_and_corrections(spark, tmp_path):
    (tmp_path / "ssn.txt").write_text("# words\n\nssn\nss #\n")
    made = O.from_mapping({"context_keywords": {"SSN": {"source": "ssn.txt"}}}, str(tmp_path))
    assert made.keywords == {"SSN": ("ssn", "ss #")}
    (tmp_path / "fixes.json").write_text('{"remove_entities": [{"id": "a", "type": "SSN", "start": 1, "end": 4}, {"id": "b", "type": "SSN", "start": 1, "end": 4}]}')
    fixes = gold.corrections_file(spark, str(tmp_path / "fixes.json"))
    spans = spark.createDataFrame([("a", "SSN", 1, 4), ("a", "SSN", 1, 5), ("b", "EMAIL", 1, 4)], "id string, type string, start int, end int")
    assert sorted(tuple(r) for r in gold.correct(spans, fixes).collect()) == [("a", "SSN", 1, 5), ("b", "EMAIL", 1, 4)]
    assert gold.corrections_file(spark, str(tmp_path / "none.json")).count() == 0
