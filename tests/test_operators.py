"""Operators against plain Python on random and hand-made cases."""

import random
import re

import pytest
from pyspark.sql import functions as F

from veilsift import options
from veilsift.functions import text as T
from veilsift.operators import dictionary, evaluate, gateway, gold, labeling, ner, regex_detect, sampling, scan, spans, split
from veilsift.plans import detect as plan
from veilsift.sources import readers, writers


def plain_normalize(text):
    """(normalised, original offset of each character)."""
    kept = [(c, i) for i, c in enumerate(text)]
    out, i = [], 0
    while i < len(kept):
        if kept[i][0] == "-" and i + 2 < len(kept) and kept[i + 1][0] == "\n":
            i += 2
        else:
            out.append((" " if kept[i][0].isspace() else kept[i][0], kept[i][1]))
            i += 1
    runs = [x for j, x in enumerate(out) if x[0] != " " or j == 0 or out[j - 1][0] != " "]
    return "".join(c for c, _ in runs), [i for _, i in runs]


def test_normalisation_and_offsets(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab- \n\t") for _ in range(rng.randint(1, 14))) for _ in range(400)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    n = T.normalize_text(F.col("t"))
    for r in rows.select("i", n.alias("n")).collect():
        want, offsets = plain_normalize(texts[r["i"]])
        known = regex_detect.Normalized(texts[r["i"]])
        assert r["n"] == known.text == want
        assert [known.original(k) for k in range(len(want))] == offsets, (texts[r["i"]], want)


def test_scalar_functions(spark):
    row = spark.createDataFrame([("4539 1488 0343 6467", "a1b22.txt", "A10", "Microsoft Word", None, 7)], "card string, p string, q string, c string, n string, k int")
    got = row.select(
        T.is_luhn_valid(F.col("card")).alias("luhn"), readers.natural_key(F.col("p")).alias("key"), T.family(F.col("n"), F.col("c")).alias("family"),
        T.page_bucket(F.col("k"), "1,2-5,x,6+").alias("bucket"), T.length_bucket(F.col("k")).alias("length"), T.file_id(F.lit("FILE=a/b")).alias("file"),
        T.normalize_name(F.lit("  “Straße”, ")).alias("name"), T.safe_div(F.lit(1.0), F.lit(0.0)).alias("zero"),
    ).first()
    assert (got["luhn"], got["family"], got["bucket"], got["length"], got["file"], got["zero"]) == (True, "WORD", "6+", "4-10", "a", 0.0)
    assert got["name"].startswith("“strasse”")
    names = spark.createDataFrame([("f10",), ("F2",), ("f1",)], "p string").orderBy(readers.natural_key(F.col("p"))).collect()
    assert [r["p"] for r in names] == ["f1", "F2", "f10"]


def brute_regex(text, o):
    """The pattern rules, for texts without line breaks, in plain Python."""
    out = []
    for label, patterns in o.patterns.items():
        for p in patterns:
            for m in re.finditer(p, text):
                s, e = m.span()
                w = o.context_window
                near = (text[max(0, s - w) : s] + " " + text[e : e + w]).lower()
                has = any(k in near for k in o.keywords.get(label, ()))
                bad = any(k in text[max(0, s - 25) : s].lower() for k in options.NEGATIVE_WORDS.get(label, ()))
                score, digits, ok, kind = o.scores[label], re.sub(r"\D", "", m[0]), not bad, label
                nine = re.fullmatch(r"\d{9}", m[0])
                if label == "ACCOUNT_NUMBER":
                    ok &= not nine and not re.fullmatch(r"\d{3}([-. ])\d{2}\1\d{4}", m[0])
                    if not has:
                        score, ok = o.scoring.account_no_context_score, ok and len(digits) >= o.scoring.account_min_digits
                if label == "PHONE_NUMBER":
                    ok &= not text[s - 1 : s].isdigit() and not text[e : e + 1].isdigit()
                if label == "SSN":
                    ok &= not nine or has
                if label == "ADDRESS" and re.fullmatch(r"\d{5}(-\d{4})?|\d{4}", m[0]):
                    ok &= any(k in near for k in options.ZIP_WORDS)
                if has:
                    score = min(0.99, score + 0.1)
                if label == "DATE":
                    ok &= any(k in text[max(0, s - 20) : s].lower() for k in options.BIRTH_WORDS)
                    kind, score = "BIRTHDATE", min(0.99, score + 0.1)
                if ok:
                    out.append((kind, m[0], s, e, round(score, 2)))
    return sorted(out)


def test_patterns(spark):
    rng = random.Random(2)
    bits = ["ssn", "phone", "born", "zip", "id:", "passport", "123-45-6789", "123456789", "(555) 123-4567", "12345", "1234567890123", "2001-02-03", "a@b.co",
            "12 Main Street Apt 4", "account", "AB1234567890", "and", "é", "4539148803436467", ",", "May 5, 1990", "+44 20 7946 0958"]
    texts = [" ".join(rng.choice(bits) for _ in range(rng.randint(1, 12))) for _ in range(150)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    import dataclasses

    for name in ("constants", "config"):
        o = dataclasses.replace(options.profile(name), passes=("raw",))
        got = {}
        for r in regex_detect.detect(rows, o).collect():
            got.setdefault(r["id"], []).append((r["type"], r["text"], r["start"], r["end"], r["score"]))
        for i, t in enumerate(texts):
            assert sorted(got.get(i, [])) == brute_regex(t, o), t


def test_whole_plan(spark):
    text = "Contact: call (555) 123-\n4567 or mail  jo@ex.org. SSN 123-45-6789, account checking 987654321."
    rows = spark.createDataFrame([(1, text), (2, None), (3, "")], "doc_id long, text string")
    names = dictionary.dictionary(spark.createDataFrame([("Jo",), ("mary ann",), ("x",)], "name string"))
    got = plan.detect_entities(rows, options.profile("constants"), names).collect()
    # the SSN is retyped: an account word stands near
    assert {r["type"] for r in got} >= {"EMAIL", "ACCOUNT_NUMBER", "PERSON"} and {r["id"] for r in got} == {1}
    for r in got:
        if r["type"] == "EMAIL":
            assert text[r["start"] : r["end"]] == "jo@ex.org"
    gated = plan.detect_with_gateway(spark.createDataFrame([(1, "no signs"), (2, "call 5551234567 now")], "doc_id long, text string"), options.DetectOptions(detectors=("regex",))).collect()
    assert {(r["trigger"], r["trigger_match"]) for r in gated} == {("digits", "5551234567")}


def test_boost_trim_filter(spark):
    rows = [("d", "m1", "PERSON", 0, 5, 0.8, 0), ("d", "m2", "PERSON", 3, 8, 0.95, 1), ("d", "m1", "PERSON", 7, 9, 0.5, 2), ("d", "m1", "EMAIL", 0, 5, 0.5, 3)]
    got = spans.agreement_boost(spark.createDataFrame(rows, "id string, model string, type string, start int, end int, score double, seq int"))
    assert {(r["seq"], round(r["score"], 2)) for r in got.collect()} == {(0, 0.9), (1, 0.99), (2, 0.5), (3, 0.5)}
    t = "x  (123-45-6789).  y"
    s = spark.createDataFrame([("d", t, "SSN", t[1:18], 1, 18), ("d", t, "PERSON", "  ", 1, 3)], "id string, t string, type string, text string, start int, end int")
    assert {(r["type"], r["text"]) for r in spans.trim(s, F.col("t")).collect()} == {("SSN", "123-45-6789"), ("PERSON", "  ")}
    a = spark.createDataFrame([("Thu", "ner"), ("A1", "ner"), ("Thu", "regex"), ("Main Road", "ner"), (" ", "ner")], "text string, source string").withColumn("type", F.lit("ADDRESS"))
    assert sorted((r["text"], r["source"]) for r in spans.filter_addresses(a, options.AddressFilter()).collect()) == [("A1", "ner"), ("Main Road", "ner"), ("Thu", "regex")]


def test_names(spark):
    names = dictionary.dictionary(spark.createDataFrame([("John",), ("john smith",), ("Smith",), ("Ann",), ("the",)], "name string"), spark.createDataFrame([("The",)], "s string"))
    rows = spark.createDataFrame([(1, "John, Smith met Ann-Marie and ANN; john"), (2, "")], "doc_id long, text string")
    assert [r["text"] for r in dictionary.detect(rows, names).orderBy("start").collect()] == ["John, Smith", "ANN", "john"]


def test_gateway_and_scan(spark):
    s = gateway.AddressSignals()
    row = s.scored(spark.createDataFrame([("12 Oak St, PO Box 9, 90210 in town",)], "t string"), "t").select(F.col("address_score").alias("n"), F.col("address_signals").alias("s")).first()
    assert row["s"] == ["suffix", "zip_us", "po_box", "number_word", "state"] and row["n"] == 10
    m = scan.first_match(F.col("t"), 0.6)
    got = spark.createDataFrame([("on 01/02/2003",), ("Name: Jo Li x",), ("a@b.cc 123-45-6789",)], "t string").select(m.alias("m")).collect()
    assert [r["m"] and (r["m"]["type"], r["m"]["text"]) for r in got] == [None, ("PERSON_CTX", "Jo Li"), ("SSN", "123-45-6789")]


def test_allocation():
    assert sampling.allocate({"a": 90, "b": 9, "c": 1}, 10) == {"a": 8, "b": 1, "c": 1}
    assert sampling.allocate({"a": 1, "b": 1, "c": 1}, 2, ["c", "a", "b"]) == {"c": 1, "a": 1}
    assert sum(sampling.allocate({k: k * 3 + 1 for k in range(20)}, 50).values()) == 50
    assert sampling.quota(10, 0.35) == (3, 7)


def test_split_repair():
    files = [("a", 10, {"X": 5}, 2.0), ("b", 10, {"Y": 1}, 1.0), ("c", 80, {"Y": 9}, 0.5)]
    dev, test, warnings = split.balanced_split(files, 0.2, ["X", "Z"], 1)
    assert "a" in test and sorted(dev + test) == ["a", "b", "c"] and len(warnings) == 1


def brute_match(g, p, least=1):
    c = []
    for gi, (gs, ge) in enumerate(g):
        for pi, (ps, pe) in enumerate(p):
            o = min(ge, pe) - max(gs, ps)
            if o >= least:
                c.append((o, ge - gs, -gs, -gi, -pi))
    used_g, used_p, out = set(), set(), set()
    for o, _, _, gi, pi in sorted(c, reverse=True):
        if -gi not in used_g and -pi not in used_p and o:
            used_g.add(-gi), used_p.add(-pi), out.add((-gi, -pi))
    return out


def test_matching(spark):
    rng = random.Random(3)
    docs = {}
    for d in range(60):
        make = lambda: [(s := rng.randint(0, 30), s + rng.randint(1, 9)) for _ in range(rng.randint(0, 6))]
        docs[str(d)] = (make(), make())
    frame = lambda k: spark.createDataFrame([(d, i, "EMAIL", s, e, "t") for d, x in docs.items() for i, (s, e) in enumerate(x[k])], "id string, idx int, type string, start int, end int, text string")
    g, p = frame(0), frame(1)
    m = evaluate.match(g, p)
    got = {}
    for r in m.collect():
        got.setdefault(r["id"], set()).add((r["g_idx"], r["p_idx"]))
    assert {d: got.get(d, set()) for d in docs} == {d: brute_match(*x) for d, x in docs.items()}
    row = evaluate.metrics(g, p, m).where("type = 'micro'").first()
    assert row["tp"] + row["fn"] == g.count() and row["tp"] + row["fp"] == p.count()
    fn, _ = evaluate.outcomes(g, p, m)
    assert set(evaluate.miss_tables(evaluate.misses(fn, p), m)) == {"category", "length", "text", "documents"}


def test_one_address_takes_several(spark):
    g = spark.createDataFrame([("d", i, "ADDRESS", s, e, "t") for i, (s, e) in enumerate([(0, 10), (12, 20), (60, 70)])], "id string, idx int, type string, start int, end int, text string")
    p = spark.createDataFrame([("d", 0, "ADDRESS", 0, 65, "t")], g.schema)
    got = {(r["g_idx"], r["primary"]) for r in evaluate.match(g, p).collect()}
    assert got == {(0, True), (1, False)}


def test_gold(spark):
    rows = [("a", " John x", [("PERSON", 0, 5, None), ("PERSON", 1, 5, "Jon"), ("NOPE", 1, 3, None), ("PERSON", 1, 5, None), ("PERSON", 5, 99, None), ("PERSON", None, 2, None)]), ("", "t", []), ("c", None, None)]
    g = spark.createDataFrame(rows, "id string, text string, entities array<struct<type:string,start:int,end:int,text:string>>")
    got = sorted((r["id"], r["code"], r["entity_index"]) for r in gold.validate(g, ["PERSON"]).collect() if r["id"] is not None)
    want = [("", "MISSING_ID", None), ("a", "BAD_OFFSETS", 4), ("a", "DUPLICATE_ENTITY", 3), ("a", "INVALID_OFFSETS", 5), ("a", "INVALID_TYPE", 2), ("a", "TEXT_MISMATCH", 1),
            ("a", "WHITESPACE_SPAN", 0), ("c", "MISSING_ENTITIES", None), ("c", "MISSING_TEXT", None)]
    assert got == want
    fixed = gold.fix(g).where("id = 'a'").first()["entities"]
    assert [(e["type"], e["start"], e["end"], e["text"]) for e in fixed] == [("PERSON", None, 2, None), ("NOPE", 1, 3, "Jo"), ("PERSON", 1, 5, "John"), ("PERSON", 5, 99, None)]
    assert gold.exit_code(gold.validate(g, ["PERSON"]), 100) == 1


def test_models_and_answers(spark):
    def good():
        return lambda texts: [[("PERSON", 0, 2, 0.5)] for _ in texts]

    def broken():
        def run(texts):
            raise RuntimeError("no")

        return run

    rows = spark.createDataFrame([(1, "Jo x")], "doc_id long, text string")
    assert [r["text"] for r in ner.detect(rows, {"a": good, "b": broken}).collect()] == ["Jo"]
    a = spark.createDataFrame([(1, "Jo x", 'Sure: [{"type":"person","text":"Jo"},{"type":"ALIEN","text":"x"},{"type":"EMAIL","text":"zz"}] done'), (2, "t", "none")], "id long, text string, answer string")
    assert [(r["type"], r["start"], r["end"]) for r in ner.parse_answers(a).collect()] == [("PERSON", 0, 2)]
    assert ner.chunks(1000) == [(0, 450), (400, 850), (800, 1000)] and ner.chunks(5) == [(0, 5)]


def test_labeling(spark):
    e = [("p", 1, "add", "A", 0, 1), ("p", 2, "add", "B", 2, 3), ("p", 3, "undo", None, None, None), ("p", 4, "remove", "A", 0, 1), ("q", 1, "accept", "A", 0, 1)]
    events = spark.createDataFrame(e, "path string, at int, action string, type string, start int, end int")
    assert [(r["path"], r["type"]) for r in labeling.entities(labeling.undone(events)).collect()] == [("q", "A")]
    one = lambda *x: spark.createDataFrame([(i,) for i in x] or [], "x string")
    s = labeling.status(one("f/a", "f/b", "g/a").withColumnRenamed("x", "path"), one("f/a"), one(), one("g"), one("f/b"))
    assert {(r["path"], r["done"], r["skipped"]) for r in s.collect()} == {("f/a", True, False), ("f/b", False, True), ("g/a", True, False)}
    assert labeling.progress(s).first().asDict() == {"pdfs": 2, "done": 2, "todo": 0, "skipped": 1}


def test_readers_and_writers(spark, tmp_path):
    (tmp_path / "d/PAGE=0001").mkdir(parents=True)
    (tmp_path / "d/PAGE=0001/PAR=0002.txt").write_text("hello there")
    (tmp_path / "d/page3").mkdir()
    (tmp_path / "d/page3/p0.txt").write_text("more")
    rows = {(r["doc"], r["page"], r["paragraph"], r["text"]) for r in readers.paragraph_tree(spark, str(tmp_path)).collect()}
    assert rows == {("d", 1, 2, "hello there"), ("d", 3, 0, "more")}
    (tmp_path / "x.jsonl").write_text('{"id":"a"}\n\nnope\n{"id":"b"}\n')
    got = [(r["n"], r["row"] and r["row"]["id"]) for r in readers.json_lines_checked(spark, str(tmp_path / "x.jsonl"), "id string").collect()]
    assert got == [(1, "a"), (3, None), (4, "b")]
    assert readers.json_lines(spark, str(tmp_path / "x.jsonl"), "id string").count() == 2
    (tmp_path / "a.pdf").write_bytes(b"%PDF 1")
    row = readers.file_corpus(spark, str(tmp_path), lambda b: {"page_count": 2, "has_text_ops": True}).first()
    assert (row["bytes"], row["page_count"], row["scan_score"], row["size_bucket"]) == (6, 2, 0.0, "tiny")
    p = spark.createDataFrame([("f/PAGE=3/PAR=2.txt",), ("f/x.txt",)], "path string")
    assert {r["dst"] for r in writers.annotation_paths(p).collect()} == {"f/page3/p1.txt", "f/x.txt"}


def test_options(tmp_path):
    o = options.override(options.DetectOptions(), context_keywords={"SSN": ["x"]}, min_digits_threshold=7, scores=None)
    assert o.keywords["SSN"] == ("x",) and o.gateway[0].threshold == 7 and options.DetectOptions().gateway[0].threshold == 5
    (tmp_path / "k.txt").write_text("# c\nfoo\n\nbar\n")
    assert options.from_mapping({"context_keywords": {"SSN": {"source": "k.txt"}}}, str(tmp_path)).keywords["SSN"] == ("foo", "bar")
    with pytest.raises(ValueError):
        options.DetectOptions(detectors=("magic",))
    assert "SSN" in options.entity_types(options.DetectOptions())
