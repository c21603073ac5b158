"""Queries that try one rule after another on rows made from keys, and SQL that tells the result from the keys alone.

Inputs are the sentences of ``sentences`` or small tables of cases, of which each key of ``customer``
takes one by its remainder; what should come out stands beside each case.
"""

from __future__ import annotations

import dataclasses
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import options as O
from . import sentences
from .functions import text as T
from .operators import dictionary, evaluate, gateway, gold, keywords, labeling, ner, ordering, sampling, scan, spans, split
from .plans import detect as plan
from .sources import readers

KEYS = "(SELECT c_custkey AS n FROM customer)"


def _keys(spark: SparkSession, d: str) -> DataFrame:
    return readers.dealt(spark.read.parquet(f"{d}/customer.parquet").select(F.col("c_custkey").alias("n")))


def _cases(spark: SparkSession, d: str, m: int, cases: list[tuple], ddl: str) -> DataFrame:
    """(id, columns of the cases): key n takes all cases whose first value is n % m."""
    table = spark.createDataFrame(cases, f"k int, {ddl}")
    rows = _keys(spark, d).withColumn("k", (F.col("n") % m).cast("int")).join(F.broadcast(table), "k")
    return rows.withColumn("id", F.col("n").cast("string")).drop("k", "n")


def _literal(x) -> str:
    if x is None:
        return "NULL"
    if isinstance(x, bool):
        return str(x).upper()
    if isinstance(x, str):
        return " || chr(10) || ".join("'" + y.replace("'", "''") + "'" for y in x.split("\n"))
    return f"{x}::DOUBLE" if isinstance(x, float) else str(x)


def _cases_sql(m: int, cases: list[tuple], names: str) -> str:
    values = ", ".join("(" + ", ".join(map(_literal, c)) + ")" for c in cases)
    return f"SELECT n::VARCHAR AS id, {names} FROM {KEYS} JOIN (VALUES {values}) AS c(k, {names}) ON n % {m} = k"


def _spans(rows: DataFrame) -> DataFrame:
    return rows.select("id", "type", F.col("start").alias("start_"), F.col("end").alias("end_"), F.round("score", 2).alias("score"))


def _names(spark: SparkSession) -> DataFrame:
    return dictionary.dictionary(spark.createDataFrame([("Anna Kowalski",), ("Anna",), ("kowalski",), ("Of",), ("x",)], "name string"), spark.createDataFrame([("of",)], "s string"))


# --- the plan over sentences

REGEX = {"detectors": ("regex",)}


def sentence_entities_constants(spark, d):
    return _spans(plan.detect_entities(sentences.view(spark, d), dataclasses.replace(O.profile("constants"), **REGEX)))


def sentence_entities_config(spark, d):
    return _spans(plan.detect_entities(sentences.view(spark, d), dataclasses.replace(O.profile("config"), **REGEX)))


def sentence_types(spark, d):
    o = dataclasses.replace(O.profile("constants"), entity_types=("BIRTHDATE", "EMAIL", "SSN"), **REGEX)
    return _spans(plan.detect_entities(sentences.view(spark, d), o))


def sentence_scores(spark, d):
    """A score filter before retyping: retyped numbers go in with the score that they had."""
    o = O.profile("constants")
    o = dataclasses.replace(o, scoring=dataclasses.replace(o.scoring, min_score=0.9), **REGEX)
    return _spans(plan.detect_entities(sentences.view(spark, d), o))


def sentence_override(spark, d):
    o = O.override(O.DetectOptions(), gateway_enabled=False, scores={"EMAIL": 0.5}, detector_order=["regex"], context_keywords={"PHONE_NUMBER": ["zzz"]})
    return _spans(plan.detect_with_gateway(sentences.view(spark, d), o).where("trigger is null"))


def sentence_gateway(spark, d):
    got = plan.detect_with_gateway(sentences.view(spark, d), O.DetectOptions(), _names(spark))
    return got.select("id", "type", F.col("start").alias("start_"), F.col("end").alias("end_"), F.round("score", 2).alias("score"), "trigger")


def sentence_triggers(spark, d):
    rows = sentences.view(spark, d)
    named = dictionary.detect(rows, _names(spark)).select("id", "h", "text", "start")
    return gateway.decide(rows, O.DetectOptions(), named).select("doc_id", "trigger")


def sentence_default_triggers(spark, d):
    """The tests where options give none: digits, then names."""
    rows = sentences.view(spark, d)
    named = dictionary.detect(rows, _names(spark)).select("id", "h", "text", "start")
    return gateway.decide(rows, O.profile("constants"), named).select("doc_id", "trigger")


def _found(profile: str, where: str = "TRUE", score: str = "score") -> str:
    return f"SELECT doc_id AS id, type, start_, end_, {score} AS score FROM {sentences.view_sql()} JOIN {sentences.found_sql(profile)} USING (k) WHERE {where}"


# --- names

NAMES = [
    (0, "Met Anna Kowalski and kowalski", [(4, 17), (22, 30)]), (1, "ANNA, Kowalski; of Anna-Maria", [(0, 14)]), (2, "none of them here", []),
    (3, "xAnna annas  anna\n(KOWALSKI) anna", [(13, 27), (29, 33)]),
]


def dictionary_cases(spark, d):
    rows = _cases(spark, d, len(NAMES), [(k, t) for k, t, _ in NAMES], "text string")
    return dictionary.detect(rows, _names(spark), id_col="id").select("id", "text", F.col("start").alias("start_"), F.col("end").alias("end_"), "score")


def dictionary_cases_joined(spark, d):
    """The same by the way that large dictionaries take."""
    rows = _cases(spark, d, len(NAMES), [(k, t) for k, t, _ in NAMES], "text string").select("id", F.xxhash64("text").alias("h"), F.col("text").alias("t"))
    names = _names(spark)
    return dictionary.greedy(dictionary.candidates(rows, names, dictionary.longest(names))).select("id", F.col("start").alias("start_"), F.col("end").alias("end_"))


WORDS = ["Ann", "O'Neil", "x", "Li2", "Mary-Jo", "the", "Zed", "", "Bo"]


def name_filter(spark, d):
    names = _cases(spark, d, len(WORDS), list(enumerate(WORDS)), "name string")
    known = spark.createDataFrame([("ann", 3.0), ("THE", 7.5), ("the", 6.0), ("zed", 5.0)], "name string, zipf double")
    kept, removed = dictionary.filter_names(names, known, 5.0)
    return kept.select("name", F.lit(None).cast("double").alias("zipf")).unionByName(removed.select("name", "zipf"))


# --- models

BOOSTS = [
    (0, "m1", "PERSON", 0, 5, 0.8, 0, 0.9), (0, "m2", "PERSON", 3, 8, 0.95, 1, 0.99), (0, "m2", "EMAIL", 0, 5, 0.5, 2, 0.5),
    # a chain: the third's only mate has been boosted already
    (1, "m1", "PERSON", 0, 5, 0.5, 0, 0.6), (1, "m2", "PERSON", 3, 8, 0.5, 1, 0.6), (1, "m1", "PERSON", 7, 12, 0.5, 2, 0.5),
    (2, "m1", "PERSON", 0, 5, 0.5, 0, 0.5), (2, "m1", "PERSON", 3, 8, 0.5, 1, 0.5), (2, "m2", "PERSON", 8, 9, 0.5, 2, 0.5),
]


def model_boost(spark, d):
    rows = _cases(spark, d, 3, [b[:-1] for b in BOOSTS], "model string, type string, start int, end int, score double, seq int")
    return spans.agreement_boost(rows).select("id", "seq", F.round("score", 2).alias("score"))


TRIMS = [
    (0, "x  (123-45-6789).  y", "SSN", 1, 18, 4, 15, "123-45-6789"), (1, "a  Anna Li \n b", "PERSON", 1, 12, 3, 10, "Anna Li"), (2, "a      b", "PERSON", 1, 5, 1, 5, None),
    (3, "no #[4111) .", "ACCOUNT_NUMBER", 2, 10, 5, 9, "4111"), (4, "an (x).", "EMAIL", 3, 7, 3, 7, None),
]


def span_trim(spark, d):
    rows = _cases(spark, d, len(TRIMS), [c[:5] for c in TRIMS], "t string, type string, start int, end int").withColumn("text", F.lit(None).cast("string"))
    return spans.trim(rows, F.col("t")).select("id", "type", F.col("start").alias("start_"), F.col("end").alias("end_"), "text")


ADDRESSES = [("Thu", "ner", False), ("A1", "ner", True), ("Thu", "regex", True), ("Main Road", "ner", True), (" ", "ner", False), ("Road", "ner", True), ("9", "ner", True)]


def address_filter(spark, d):
    rows = _cases(spark, d, len(ADDRESSES), [(k, *x) for k, x in enumerate(ADDRESSES)], "text string, source string, stays boolean").withColumn("type", F.lit("ADDRESS"))
    return spans.filter_addresses(rows, O.AddressFilter()).select("id", "text", "source")


def _loud():
    def load():
        name = re.compile("Anna|Oslo|Vela")
        labels = {"Anna": "PERSON", "Oslo": "GPE", "Vela": "ORG"}
        return lambda texts: [[(labels[m[0]], m.start(), m.end() + 1) for m in name.finditer(t)] for t in texts]  # with the blank after

    return ner.general_model(load)


def _failing():
    def load():
        def run(texts):
            raise RuntimeError("no model")

        return run

    return ner.general_model(load)


def model_entities(spark, d):
    """A general model and one that fails; spans are trimmed, labels mapped or dropped."""
    rows = _cases(spark, d, 3, [(0, "So Anna went to Oslo yesterday"), (1, "Vela sold it"), (2, "Anna and Anna met")], "text string")
    o = dataclasses.replace(O.DetectOptions(), detectors=("ner",))
    return _spans(plan.detect_entities(rows, o, models={"general": _loud(), "failing": _failing()}, id_col="id"))


def _chunked():
    def load():
        word = re.compile(r"\S+")

        def classify(text):
            assert len(word.findall(text)) <= ner.MODEL_TOKENS
            return [("GIVENNAME" if m[0] == "Anna" else "UNKNOWN", m.start(), m.end(), 0.876) for m in word.finditer(text) if m[0] != "word"]

        return lambda text: [m.span() for m in word.finditer(text)], classify

    return ner.token_model(load)


def token_chunks(spark, d):
    """A token model on 1,210 words, in chunks that overlap: each of 13 names counts once."""
    word = F.transform(F.sequence(F.lit(0), F.lit(1209)), lambda i: F.when(i % 100 == 0, "Anna").when(i % 100 == 50, "Vela").otherwise("word"))
    rows = _keys(spark, d).select(F.col("n").alias("doc_id"), F.array_join(word, " ").alias("text"))
    got = ner.detect(rows, {"token": _chunked()})
    return got.groupBy("id", "type", "score").agg(F.count("*").alias("n"), F.sum("start").alias("starts"))


ANSWERS = [
    (0, "Jo met Li", 'Sure: [{"type":"person","text":"Jo"},{"type":"ALIEN","text":"met"},{"type":"EMAIL","text":"zz"}] done', [("PERSON", 0, 2, 0.8)]),
    (1, "in Oslo now", '[{"type":"LOCATION","text":"x","start":3,"end":7},{"type":"SSN","start":3,"end":99}]', [("LOCATION", 3, 7, 0.75)]), (2, "t", "none", []), (3, "t", '[{"type":', []),
]


def model_answers(spark, d):
    rows = _cases(spark, d, len(ANSWERS), [c[:3] for c in ANSWERS], "text string, answer string")
    return _spans(ner.parse_answers(rows))


# --- matching and misses

_CASE = "type string, start int, end int, idx int"
GOLD = [(0, "EMAIL", 0, 10, 0), (0, "EMAIL", 8, 14, 1), (1, "EMAIL", 0, 6, 0), (1, "EMAIL", 3, 12, 1), (2, "EMAIL", 0, 4, 0), (3, "SSN", 0, 11, 0)]
PRED = [(0, "EMAIL", 5, 12, 0), (1, "EMAIL", 3, 6, 0), (2, "EMAIL", 0, 2, 0), (2, "EMAIL", 1, 4, 1), (3, "SSN", 0, 10, 0), (3, "SSN", 0, 11, 1)]
MATCHED = [(0, 0, 0), (1, 1, 0), (2, 0, 1), (3, 0, 1)]  # most shared characters, then the longer gold span
AGOLD = [(0, 0, 10, 0), (0, 12, 20, 1), (0, 60, 70, 2), (1, 0, 10, 0), (1, 12, 20, 1), (2, 5, 15, 0), (2, 40, 50, 1), (2, 82, 90, 2)]
APRED = [(0, 0, 65, 0), (1, 0, 130, 0), (2, 0, 88, 0)]
AMATCHED = [(0, 0, 0, True), (0, 1, 0, False), (1, 0, 0, True), (2, 0, 0, True), (2, 1, 0, False)]  # gaps to 30; a prediction over 120 takes one


def _typed(cases, kind):
    return [(k, kind, *x) for k, *x in cases]


def match_greedy(spark, d):
    got = evaluate.match(_cases(spark, d, 4, GOLD, _CASE), _cases(spark, d, 4, PRED, _CASE))
    return got.select("id", "g_idx", "p_idx")


def match_addresses(spark, d):
    got = evaluate.match(_cases(spark, d, 3, _typed(AGOLD, "ADDRESS"), _CASE), _cases(spark, d, 3, _typed(APRED, "ADDRESS"), _CASE))
    return got.select("id", "g_idx", "p_idx", "primary")


MISSED = [
    (0, "EMAIL", 10, 20, 0, "wrong_type", "SSN", 0), (1, "SSN", 10, 20, 0, "boundary_mismatch", None, 0), (2, "EMAIL", 10, 20, 0, "partial_overlap", None, 0),
    (3, "EMAIL", 10, 20, 0, "near_miss", None, 15), (4, "EMAIL", 10, 20, 0, "no_prediction", None, None), (5, "EMAIL", 10, 20, 0, "no_prediction", None, 60),
]
MPRED = [(0, "SSN", 12, 14, 0), (0, "EMAIL", 60, 70, 1), (1, "SSN", 11, 20, 0), (2, "EMAIL", 18, 30, 0), (3, "EMAIL", 35, 40, 0), (5, "EMAIL", 80, 90, 0)]


def _misses(spark, d):
    return evaluate.misses(_cases(spark, d, 6, [m[:5] for m in MISSED], _CASE).withColumn("text", F.lit(" Ab ")), _cases(spark, d, 6, MPRED, _CASE), "hybrid", 3)


def miss_categories(spark, d):
    return _misses(spark, d).select("id", "category", "predicted_type", F.col("nearest").cast("int").alias("nearest"))


def miss_counts(spark, d):
    hits = _cases(spark, d, 6, [(0, "EMAIL")], "type string")
    t = evaluate.miss_tables(_misses(spark, d), hits)
    parts = [
        t["category"].select(F.lit("category").alias("what"), F.concat_ws("/", "type", "category").alias("value"), "n"),
        t["length"].select(F.lit("length").alias("what"), F.concat_ws("/", "type", "length").alias("value"), "n"),
        t["text"].select(F.lit("text").alias("what"), F.concat_ws("/", "type", "text").alias("value"), "n"),
        t["documents"].agg(F.sum("fn").alias("n")).select(F.lit("documents").alias("what"), F.lit("fn").alias("value"), "n"),
    ]
    return dictionary.union_of(parts)


def capped_examples(spark, d):
    rows = _cases(spark, d, 6, [m[:5] for m in MISSED], _CASE)
    return evaluate.capped(rows, "type", 7).select("type", "id")


def select_records(spark, d):
    rows = _keys(spark, d).select(F.concat(F.lit("FILE=f"), (F.col("n") % 7).cast("string"), F.lit("/"), F.col("n").cast("string")).alias("id"))
    ids = spark.createDataFrame([("FILE=f1/1",), ("FILE=f2/2",), ("none",)], "id string")
    return evaluate.select_records(rows, ids, spark.createDataFrame([("f3",)], "f string"))


# --- scan, index, samples, splits

SCANS = [
    ("an SSN 123-45-6789 here", "SSN", 1.0, "123-45-6789"), ("mail a.b@c.org", "EMAIL", 1.0, "a.b@c.org"), ("call (555) 123-4567", "PHONE", 0.8, "(555) 123-4567"),
    ("Customer: Ann Lee", "PERSON_CTX", 0.8, "Ann Lee"), ("address: 12 Oak Street", "ADDRESS_CTX", 0.8, "12 Oak Street"), ("on 01/02/2003", "DATE", 0.5, "01/02/2003"), ("nothing", None, None, None),
]


def scan_rules(spark, d):
    rows = _cases(spark, d, len(SCANS), [(k, s[0]) for k, s in enumerate(SCANS)], "text string").withColumn("m", scan.first_match(F.col("text")))
    return rows.where("m is not null").select("id", "m.type", "m.score", "m.text")


def scan_resume(spark, d):
    """A scan that goes on where its report ends: documents that it has, and those that failed, are left out."""
    rows = _keys(spark, d).select(F.concat(F.lit("d"), (F.col("n") % 40).cast("string")).alias("pdf")).distinct()
    done = spark.createDataFrame([(f"d{i}",) for i in range(0, 40, 3)], "doc string")
    failed = spark.createDataFrame([(f"d{i}", "x" * 2000) for i in range(1, 40, 9)], "doc string, error string")
    scans = done.select("doc", F.lit(True).alias("contains_pii"), F.lit("m").alias("match"), F.lit(3).alias("total_paragraphs"))
    left = scan.resume(rows, scan.report(scans, failed))
    return left.select("pdf", F.lit("todo").alias("state")).unionByName(scan.report(scans, failed).where("status = 'extract_error'").select("pdf", F.concat(F.lit("failed "), F.length("error").cast("string")).alias("state")))


def index_pools(spark, d):
    rows = _keys(spark, d).select((F.col("n") % 3 == 0).alias("likely_scanned"), (F.col("n") % 3 == 1).alias("has_text_ops"))
    scanned, text = sampling.quota(100, 0.35)
    quota = F.when(F.col("pool") == "scanned", scanned).when(F.col("pool") == "text", text)
    return rows.select(sampling.pool(True).alias("pool")).groupBy("pool").agg(F.count("*").alias("n")).withColumn("quota", quota)


def bucket_sample(spark, d):
    rows = _keys(spark, d).select("n", (F.col("n") % 5).cast("int").alias("bucket"))
    return sampling.stratified_sample(rows, ["bucket"], 50, "n").select("n", "bucket")


def pii_partition(spark, d):
    rows = _keys(spark, d).select(
        F.when(F.col("n") % 7 == 0, "extract_error").otherwise("ok").alias("status"), (F.col("n") % 2 == 0).alias("contains_pii"),
        F.when(F.col("n") % 5 != 0, (F.col("n") % 30).cast("int")).alias("page_count"),
    )
    return sampling.partition_report(rows, T.page_bucket(F.col("page_count"), "1,2-5,6-20,21+", "1", True))


def paragraph_folders(spark, d):
    docs = _keys(spark, d).select(F.concat(F.lit("doc"), (F.col("n") % 12).cast("string")).alias("doc")).distinct()
    folders = spark.createDataFrame([("doc1",), ("doc1_old",), ("doc2_b",), ("doc2_a",), ("other",)], "folder string")
    return sampling.paragraph_folder(docs, folders)


def split_counts(spark, d):
    rows = _cases(spark, d, 4, [(0, "SSN"), (0, "EMAIL"), (1, "EMAIL"), (2, "PERSON")], "type string")
    records = rows.groupBy("id").agg(F.collect_list(F.struct("type")).alias("entities")).select(F.concat(F.lit("FILE=f"), (F.col("id").cast("int") % 10).cast("string"), F.lit("/"), "id").alias("id"), "entities")
    splits = spark.createDataFrame([(f"f{i}", "dev" if i < 7 else "test") for i in range(10)], "file string, split string")
    return split.coverage(split.file_stats(records, ["SSN", "EMAIL"]), splits)


# --- annotated records

LINES = [
    ('{"id": "a", "text": "John x", "entities": []}', []),
    ('{"text": "x"}', [("MISSING_ID", None)]), ('{"id": 5, "text": "x"}', [("MISSING_ID", None)]), ("{broken", [("JSON_PARSE_ERROR", None)]), ("   ", []),
    ('{"id": "b", "text": 5}', [("INVALID_TEXT", None), ("MISSING_ENTITIES", None)]), ('{"id": "b", "text": "x", "entities": "y"}', [("INVALID_ENTITIES", None)]),
    ('{"id": "c", "entities": [7, {"type": "PERSON", "start": 0, "end": 2}]}', [("MISSING_TEXT", None), ("INVALID_ENTITY_FORMAT", 0)]),
    ('{"id": "d", "text": " a\\nb", "entities": [{"type": "NO", "start": 1, "end": 2}, {"type": "PERSON", "start": 0, "end": 4, "text": "q"}, {"type": "PERSON", "start": "1", "end": 2}, {"type": "PERSON", "start": 3, "end": 9}, {"type": "PERSON", "start": 1, "end": 2}, {"type": "PERSON", "start": 1, "end": 2}]}',
     [("INVALID_TYPE", 0), ("WHITESPACE_SPAN", 1), ("NEWLINE_IN_SPAN", 1), ("TEXT_MISMATCH", 1), ("INVALID_OFFSETS", 2), ("BAD_OFFSETS", 3), ("SHORT_SPAN", 4), ("SHORT_SPAN", 5), ("DUPLICATE_ENTITY", 5)]),
]
WARNINGS = ("MISSING_ENTITIES", "NEWLINE_IN_SPAN", "TEXT_MISMATCH", "SHORT_SPAN", "DUPLICATE_ENTITY")


def _issues(spark, d):
    lines = _cases(spark, d, len(LINES), [(k, x) for k, (x, _) in enumerate(LINES)], "value string").select(F.col("id").cast("int").alias("n"), "value")
    return gold.validate_lines(lines, ["PERSON"])


def gold_lines(spark, d):
    return _issues(spark, d).groupBy("code", "level", "entity_index").agg(F.count("*").alias("n"))


def gold_summary(spark, d):
    return gold.summary(_issues(spark, d).where("code <> 'JSON_PARSE_ERROR'")).select(F.coalesce("code", F.lit("all")).alias("code"), "n")


ADJACENT = [
    (0, "P", 0, 4, 0, ""), (0, "P", 5, 9, 1, "John "), (0, "P", 9, 12, 2, "hn Smith"), (1, "P", 0, 4, 0, ""), (1, "P", 6, 9, 1, "Jo- "), (1, "Q", 10, 12, 2, "x "),
    (2, "P", 0, 9, 0, ""), (2, "P", 2, 5, 1, "ab"), (2, "P", 8, 12, 2, "ab   "),
]
MERGED = [(0, 0, "P", 0, 12), (1, 0, "P", 0, 4), (1, 1, "P", 6, 9), (1, 2, "Q", 10, 12), (2, 0, "P", 0, 5), (2, 2, "P", 8, 12)]


def gold_adjacent(spark, d):
    rows = _cases(spark, d, 3, ADJACENT, "type string, start int, end int, idx int, pre string")
    return gold.merge_adjacent(rows).select("id", "idx", "type", F.col("start").alias("start_"), F.col("end").alias("end_"))


def gold_types(spark, d):
    rows = _cases(spark, d, 3, ADJACENT, "type string, start int, end int, idx int, pre string")
    return gold.count_types(rows.groupBy("id").agg(F.collect_list(F.struct("type", "start", "end")).alias("entities")))


EVENTS = [
    (0, 1, "add", "A", 0, 1), (0, 2, "add", "B", 2, 3), (0, 3, "undo", None, None, None), (0, 4, "accept", "C", 5, 6), (0, 5, "add", "A", 0, 1),
    (1, 1, "add", "A", 0, 1), (1, 2, "remove", "A", 0, 1), (2, 1, "undo", None, None, None), (2, 2, "add", "D", 1, 2),
]


def annotation_events(spark, d):
    rows = _cases(spark, d, 3, EVENTS, "at int, action string, type string, start int, end int").withColumnRenamed("id", "path")
    return labeling.entities(labeling.undone(rows)).select("path", "type", F.col("start").alias("start_"), F.col("end").alias("end_"))


def annotation_status(spark, d):
    paths = _keys(spark, d).select(F.concat(F.lit("p"), (F.col("n") % 10).cast("string"), F.lit("/"), F.col("n").cast("string")).alias("path"))
    one = lambda *x: spark.createDataFrame([(i,) for i in x], "x string")
    some = paths.where(F.expr("cast(substring_index(path, '/', -1) as int) % 4 = 0"))
    return labeling.status(paths, some, one("p1/1"), one("p2", "p3"), one("p5/", "p9/9"))


def annotation_progress(spark, d):
    s = annotation_status(spark, d)
    each = [labeling.progress(labeling.listed(s, w)).select(F.lit(w).alias("which"), "pdfs", "done", "todo", "skipped") for w in ("All", "Labeled", "Unlabeled", "Skipped", "Unskipped")]
    return dictionary.union_of(each)


SELECTED = [(0, " ab c ", 0, 6, 1, 5), (1, "x  y", 1, 3, None, None), (2, "whole", 0, 5, 0, 5), (3, "a\n\tb", 1, 4, 3, 4)]


def annotation_selection(spark, d):
    rows = _cases(spark, d, 4, [c[:4] for c in SELECTED], "text string, start int, end int")
    return labeling.trimmed(rows).select("id", F.col("start").alias("start_"), F.col("end").alias("end_"))


def annotation_bounds(spark, d):
    rows = _cases(spark, d, 4, [(0, 0, 2), (1, 2, 2), (2, 3, 9), (3, -1, 1)], "start int, end int")
    store = rows.select(F.col("id").alias("path"), F.lit("abcd").alias("text"), F.array(F.struct(F.lit("P").alias("type"), "start", "end")).alias("entities"))
    return labeling.validate_all(store).select("path", F.col("start").alias("start_"), F.col("end").alias("end_"))


# --- scalar functions

TEXTS = ["12345", "12345-6789", "1234", "123-45-6789", "123 45.6789", "  A  b\n c ", "(Mary  ANN);", "123.45.6789", "12345 ", ""]
MAKERS = [("", None, "UNKNOWN"), ("Adobe PDF Library", "", "ACROBAT"), ("Microsoft Word", "x", "WORD"), ("x", "InDesign", "INDESIGN"), ("Canon", None, "SCANNER"), ("zz", "y", "OTHER")]


def text_shapes(spark, d):
    rows = _cases(spark, d, len(TEXTS), list(enumerate(TEXTS)), "t string")
    t = F.col("t")
    return rows.select(
        "id", T.is_zip_like(t).alias("zip"), T.is_postal_4(t).alias("postal"), T.is_ssn_format(t).alias("ssn"), T.clean_label_text(t).alias("clean"),
        T.normalize_name(t).alias("name"), T.length_bucket(F.length(t)).alias("length"),
    )


def file_families(spark, d):
    rows = _cases(spark, d, len(MAKERS), [(k, *m[:2]) for k, m in enumerate(MAKERS)], "producer string, creator string")
    return rows.select("id", T.family(F.col("producer"), F.col("creator")).alias("family"), T.file_hash(F.concat(F.lit("c"), "id").cast("binary")).alias("hash"), T.stat_hash(F.lit("/p"), F.col("id").cast("long"), F.lit(5)).alias("stat"))


def scan_scores(spark, d):
    n = F.col("n")
    rows = _keys(spark, d).select("n", (n % 4 == 0).alias("t"), (n % 3).alias("i"), (n % 2).alias("l"), (n % 5 * 400_000).alias("b"), (n % 7 - 1).alias("p"))
    return rows.select("n", F.round(T.scan_score(F.col("t"), F.col("i"), F.col("l"), F.col("b"), F.col("p")), 2).alias("score"))


def natural_order(spark, d):
    rows = _keys(spark, d).select(F.concat(F.when(F.col("n") % 2 == 0, "File").otherwise("file"), F.col("n").cast("string"), F.lit(".txt")).alias("name"), "n")
    placed = ordering.numbered(rows, [readers.natural_key(F.col("name"))])
    return placed.select("name", (F.col("place") + 1).alias("place"))


EXAMPLES = [
    "(123) 456-7890", "123-456-7890 ext 12", "+1 (2) 3-4-5", "+44 20 1234 5678", "+123 4567 8901", "1234567890", "1-800-555-1234", "800-FLO-WERS", "+49 123 456789",
    "+33 1 23 45 67 89", "+61 2 1234 5678", "(12) 345 6789", "2020-01-02", "1/2/2020", "1-2-2020", "1.2.2020", "1/2/20", "1-2-20", "1.2.20", "January 1, 2020", "Jan. 1 2020",
    "1st January 2020", "2 Feb 2020", "March 2020", "Sept 2020", "20200102", "nothing",
]


def pattern_lists(spark, d):
    """Which patterns of the lists find something in an example: a bit for each."""
    rows = _cases(spark, d, len(EXAMPLES), list(enumerate(EXAMPLES)), "t string")
    bits = [F.when(F.col("t").rlike(T.FLAGS + p), 1 << i).otherwise(0) for i, p in enumerate(O.PHONE_LIST + O.DATE_LIST)]
    return rows.select("id", sum(bits, F.lit(0)).cast("long").alias("bits"))


def type_names(spark, d):
    """The types of the options, and how many documents hold a context word of each."""
    options = O.DetectOptions()
    docs = readers.table(spark, f"{d}/documents.parquet")
    found = keywords.present(docs, options.keywords).select(F.explode("types").alias("type")).groupBy("type").agg(F.count("*").alias("n"))
    types = spark.createDataFrame([(x,) for x in O.entity_types(options)], "type string")
    return types.join(found, "type", "left").select("type", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    each = [
        sentence_entities_constants, sentence_entities_config, sentence_types, sentence_scores, sentence_override, sentence_gateway, sentence_triggers, sentence_default_triggers,
        dictionary_cases, dictionary_cases_joined, name_filter, model_boost, span_trim, address_filter, model_entities, token_chunks, model_answers, match_greedy, match_addresses,
        miss_categories, miss_counts, capped_examples, select_records, scan_rules, scan_resume, index_pools, bucket_sample, pii_partition, paragraph_folders, split_counts,
        gold_lines, gold_summary, gold_adjacent, gold_types, annotation_events, annotation_status, annotation_progress, annotation_selection, annotation_bounds, text_shapes,
        file_families, scan_scores, natural_order, pattern_lists, type_names,
    ]
    return {q.__name__: q for q in each}


def oracle_sql() -> dict[str, str]:
    named = [(k, t[a:b], a, b) for k, t, found in NAMES for a, b in found]
    issues = [(k, code, "WARNING" if code in WARNINGS else "ERROR", -1 if i is None else i) for k, (_, found) in enumerate(LINES) for code, i in found]
    issue = f"({_cases_sql(len(LINES), issues, 'code, level, i')})"
    held = lambda words: " OR ".join(f"contains(t, {_literal(w)})" for w in words)
    status = f"""s AS (SELECT 'p' || n % 10 || '/' || n AS path, 'p' || n % 10 AS pdf, n % 4 = 0 OR n = 1 OR n % 10 IN (2, 3) AS done,
      n % 10 = 5 OR (n % 10 = 9 AND starts_with(n::VARCHAR, '9')) AS skipped FROM {KEYS})"""
    lists = {"All": "TRUE", "Labeled": "done", "Unlabeled": "NOT done", "Skipped": "skipped", "Unskipped": "NOT skipped"}
    bits = " + ".join(f"CASE WHEN regexp_matches(t, {_literal(p)}) THEN {1 << i} ELSE 0 END" for i, p in enumerate(O.PHONE_LIST + O.DATE_LIST))
    shapes = _cases_sql(len(TEXTS), list(enumerate(TEXTS)), "t")
    return {
        "sentence_entities_constants": _found("constants"),
        "sentence_entities_config": _found("config"),
        "sentence_types": _found("constants", "type IN ('BIRTHDATE', 'EMAIL', 'SSN')"),
        # the retyped number had 0.95, the one with a check digit 0.4; a birth date 0.85
        "sentence_scores": _found("constants", "score >= 0.9 AND type <> 'CREDIT_CARD_NUMBER' OR k = 5"),
        "sentence_override": _found("config", score="CASE WHEN type = 'EMAIL' THEN 0.5::DOUBLE WHEN type = 'PHONE_NUMBER' THEN 0.85::DOUBLE ELSE score END"),
        "sentence_gateway": f"""
            SELECT doc_id AS id, type, start_, end_, score, trigger FROM {sentences.view_sql()} JOIN {sentences.triggers_sql()} USING (k)
            JOIN (SELECT * FROM {sentences.found_sql("config")} UNION ALL SELECT 25, 'PERSON', 7, 20, 0.85::DOUBLE) USING (k)""",
        "sentence_triggers": f"SELECT doc_id, trigger FROM {sentences.view_sql()} JOIN {sentences.triggers_sql()} USING (k)",
        "sentence_default_triggers": f"SELECT doc_id, CASE WHEN trigger <> 'address' THEN trigger END AS trigger FROM {sentences.view_sql()} JOIN {sentences.triggers_sql()} USING (k)",
        "dictionary_cases": f"SELECT *, 0.85::DOUBLE AS score FROM ({_cases_sql(len(NAMES), named, 'text, start_, end_')})",
        "dictionary_cases_joined": f"SELECT id, start_, end_ FROM ({_cases_sql(len(NAMES), named, 'text, start_, end_')})",
        "name_filter": "SELECT * FROM (VALUES ('Ann', NULL::DOUBLE), ('O''Neil', NULL), ('Mary-Jo', NULL), ('Bo', NULL), ('the', 7.5), ('Zed', 5.0)) AS x(name, zipf)",
        "model_boost": _cases_sql(3, [(b[0], b[6], b[7]) for b in BOOSTS], "seq, score"),
        "span_trim": _cases_sql(len(TRIMS), [(c[0], c[2], *c[5:]) for c in TRIMS], "type, start_, end_, text"),
        "address_filter": _cases_sql(len(ADDRESSES), [(k, t, s) for k, (t, s, stays) in enumerate(ADDRESSES) if stays], "text, source"),
        "model_entities": _cases_sql(3, [(0, "PERSON", 3, 7, 0.8), (0, "LOCATION", 16, 20, 0.75), (2, "PERSON", 0, 4, 0.8), (2, "PERSON", 9, 13, 0.8)], "type, start_, end_, score"),
        "token_chunks": f"SELECT n AS id, 'PERSON' AS type, 0.88::DOUBLE AS score, 13::BIGINT AS n, {sum(500 * i for i in range(13))}::BIGINT AS starts FROM {KEYS}",
        "model_answers": _cases_sql(len(ANSWERS), [(k, *f) for k, _, _, found in ANSWERS for f in found], "type, start_, end_, score"),
        "match_greedy": _cases_sql(4, MATCHED, "g_idx, p_idx"),
        "match_addresses": _cases_sql(3, AMATCHED, "g_idx, p_idx, \"primary\""),
        "miss_categories": _cases_sql(6, [(m[0], *m[5:]) for m in MISSED], "category, predicted_type, nearest"),
        "miss_counts": f"""
            WITH x AS (SELECT id, type, category FROM ({_cases_sql(6, [(m[0], m[1], m[5]) for m in MISSED], "type, category")}))
            SELECT 'category' AS what, type || '/' || category AS value, count(*) AS n FROM x GROUP BY 1, 2
            UNION ALL SELECT 'length', type || '/4-10', count(*) FROM x GROUP BY type UNION ALL SELECT 'text', type || '/ab', count(*) FROM x GROUP BY type
            UNION ALL SELECT 'documents', 'fn', least(20, count(*)) FROM x""",
        "capped_examples": f"""
            SELECT type, id FROM (SELECT *, row_number() OVER (PARTITION BY type ORDER BY id) AS r FROM ({_cases_sql(6, [(m[0], m[1]) for m in MISSED], "type")})) WHERE r <= 7""",
        "select_records": f"SELECT id FROM (SELECT 'FILE=f' || n % 7 || '/' || n AS id, n FROM {KEYS}) WHERE n IN (1, 2) OR n % 7 = 3",
        "scan_rules": _cases_sql(len(SCANS), [(k, t, s, x) for k, (_, t, s, x) in enumerate(SCANS) if t], "type, score, text"),
        "scan_resume": """
            SELECT 'd' || i AS pdf, 'todo' AS state FROM range(40) AS x(i) WHERE i % 3 <> 0 AND i % 9 <> 1
            UNION ALL SELECT 'd' || i, 'failed 1000' FROM range(40) AS x(i) WHERE i % 9 = 1""",
        "index_pools": f"""
            SELECT CASE n % 3 WHEN 0 THEN 'scanned' WHEN 1 THEN 'text' END AS pool, count(*) AS n, CASE n % 3 WHEN 0 THEN 35 WHEN 1 THEN 65 END AS quota FROM {KEYS} GROUP BY n % 3""",
        "bucket_sample": f"""
            SELECT n, bucket FROM (SELECT n, (n % 5)::INT AS bucket, row_number() OVER (PARTITION BY n % 5 ORDER BY md5('0:' || n), n) AS r FROM {KEYS}) WHERE r <= 10""",
        "pii_partition": f"""
            WITH x AS (SELECT n % 7 <> 0 AS ok, n % 2 = 0 AS pii, CASE WHEN n % 5 <> 0 THEN n % 30 END AS p FROM {KEYS}),
            y AS (SELECT ok, CASE WHEN ok THEN pii END AS contains_pii, p,
              CASE WHEN ok THEN CASE WHEN coalesce(p, 0) <= 1 THEN '1' WHEN p <= 5 THEN '2-5' WHEN p <= 20 THEN '6-20' ELSE '21+' END END AS bucket FROM x)
            SELECT contains_pii, bucket, count(*) AS n, count(*) FILTER (NOT ok) AS errors, count(*) FILTER (ok AND coalesce(p, 0) = 0) AS missing_pages FROM y GROUP BY 1, 2""",
        "paragraph_folders": """
            SELECT 'doc' || i AS doc, CASE i WHEN 1 THEN 'doc1' WHEN 2 THEN 'doc2_a' END AS folder FROM range(12) AS x(i)""",
        "split_counts": f"""
            WITH e AS ({_cases_sql(4, [(0, "SSN"), (0, "EMAIL"), (1, "EMAIL"), (2, "PERSON")], "type")}), x AS (SELECT *, CASE WHEN id::INT % 10 < 7 THEN 'dev' ELSE 'test' END AS split FROM e)
            SELECT split, type, count(*) AS n FROM x WHERE type <> 'PERSON' GROUP BY 1, 2
            UNION ALL SELECT split, '_records', count(DISTINCT id) FROM x GROUP BY 1 UNION ALL SELECT * FROM (VALUES ('dev', '_files', 7), ('test', '_files', 3)) AS v""",
        "gold_lines": f"SELECT code, level, CASE WHEN i >= 0 THEN i END AS entity_index, count(*) AS n FROM {issue} GROUP BY ALL",
        "gold_summary": f"""
            WITH x AS (SELECT code FROM {issue} WHERE code <> 'JSON_PARSE_ERROR') SELECT code, count(*) AS n FROM x GROUP BY code UNION ALL SELECT 'all', count(*) FROM x""",
        "gold_adjacent": _cases_sql(3, MERGED, "idx, type, start_, end_"),
        "gold_types": f"SELECT type, count(*) AS n FROM ({_cases_sql(3, [(c[0], c[1]) for c in ADJACENT], 'type')}) GROUP BY type",
        "annotation_events": f"SELECT id AS path, type, start_, end_ FROM ({_cases_sql(3, [(0, 'A', 0, 1), (0, 'C', 5, 6), (2, 'D', 1, 2)], 'type, start_, end_')})",
        "annotation_status": f"WITH {status} SELECT * FROM s",
        "annotation_progress": f"WITH {status} " + " UNION ALL ".join(
            f"SELECT '{w}' AS which, count(DISTINCT pdf) AS pdfs, count(*) FILTER (done) AS done, count(*) FILTER (NOT done AND NOT skipped) AS todo, count(*) FILTER (skipped) AS skipped FROM s WHERE {c}"
            for w, c in lists.items()
        ),
        "annotation_selection": _cases_sql(4, [(c[0], *c[4:]) for c in SELECTED if c[4] is not None], "start_, end_"),
        "annotation_bounds": f"SELECT id AS path, start_, end_ FROM ({_cases_sql(4, [(1, 2, 2), (2, 3, 9), (3, -1, 1)], 'start_, end_')})",
        "text_shapes": rf"""
            SELECT id, regexp_full_match(t, '\d{{5}}(-\d{{4}})?') AS zip, regexp_full_match(t, '\d{{4}}') AS postal, t IN ('123-45-6789', '123.45.6789') AS ssn,
              trim(regexp_replace(t, '\s+', ' ', 'g')) AS clean, trim(trim(regexp_replace(lower(t), '\s+', ' ', 'g')), '"''.,;:!?()[]{{}}<>') AS name,
              CASE WHEN length(t) <= 3 THEN '1-3' WHEN length(t) <= 10 THEN '4-10' WHEN length(t) <= 20 THEN '11-20' ELSE '21+' END AS length FROM ({shapes})""",
        "file_families": f"""
            SELECT id, family, sha1('c' || id) AS hash, sha1('/p' || id || '5') AS stat FROM ({_cases_sql(len(MAKERS), [(k, m[2]) for k, m in enumerate(MAKERS)], "family")})""",
        "scan_scores": f"""
            SELECT n, round(CASE WHEN n % 4 = 0 THEN 0 ELSE least(1, 0.6 + CASE WHEN n % 3 > 0 THEN 0.3 ELSE 0 END + CASE WHEN n % 2 > 0 THEN 0.1 ELSE 0 END
              + CASE WHEN n % 7 - 1 > 0 AND (n % 5 * 400000) / (n % 7 - 1) > 500000 THEN 0.1 ELSE 0 END) END::DOUBLE, 2) AS score FROM {KEYS}""",
        "natural_order": f"SELECT CASE WHEN n % 2 = 0 THEN 'File' ELSE 'file' END || n || '.txt' AS name, row_number() OVER (ORDER BY n) AS place FROM {KEYS}",
        "pattern_lists": f"SELECT id, ({bits})::BIGINT AS bits FROM ({_cases_sql(len(EXAMPLES), list(enumerate(EXAMPLES)), 't')})",
        "type_names": " UNION ALL ".join(
            f"SELECT '{x}' AS type, " + (f"count_if({held(O.KEYWORDS['config'][x])})" if O.KEYWORDS["config"].get(x) else "0::BIGINT") + "::BIGINT AS n FROM " + ("(SELECT lower(text) AS t FROM documents)" if O.KEYWORDS["config"].get(x) else "(SELECT 1)")
            for x in sorted({*O.PATTERNS["config"], *O.KEYWORDS["config"], *O.SCORES})
        ),
    }
