"""Whole runs by their options, readers that number lines, ledgers, dumps over batches, and benches."""

import json

import pytest
from pyspark.sql import functions as F

from veilsift import options as O
from veilsift.operators import dictionary, evaluate, scan
from veilsift.plans import bench, runs
from veilsift.sources import ledger, readers, writers

RECORD = "id string, text string, entities array<struct<type:string,start:int,end:int,text:string>>"


def record(i, text, *entities):
    return {"id": f"r{i}", "text": text, "entities": [{"type": t, "start": s, "end": e, "text": None} for t, s, e in entities]}


@pytest.fixture(scope="module")
def gold_file(tmp_path_factory):
    path = tmp_path_factory.mktemp("gold") / "gold.jsonl"
    rows = [record(9 - i, f"Ann Lee {i} mails a{i}@b.co and Bob", ("PERSON", 0, 7), ("EMAIL", 16, 23), ("PERSON", 28, 31)) for i in range(10)]
    path.write_text("\n".join([json.dumps(rows[0]), "", "no json", *map(json.dumps, rows[1:])]) + "\n")
    return str(path)


def test_lines_are_numbered_across_splits(spark, tmp_path):
    # lines of many lengths, some longer than a split, some with other line ends in them
    lines = [str(i) + "x" * (i * 37 % 300) + ("\r" if i % 7 == 0 else "") + "é" * (i % 5) + ("y" * 9000 if i % 211 == 0 else "") for i in range(3000)]
    (tmp_path / "a.txt").write_bytes("\n".join(lines).encode())
    (tmp_path / "b.txt").write_bytes(("\n".join(lines[:50]) + "\n").encode())
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "16")
    try:
        rows = readers.lines(spark, str(tmp_path))
        assert rows.select(F.spark_partition_id()).distinct().count() > 1 and spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 20
        got = sorted((r["file"][-5:], r["n"], r["value"]) for r in rows.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == sorted([("a.txt", i, x) for i, x in enumerate(lines, 1)] + [("b.txt", i, x) for i, x in enumerate(lines[:50], 1)])


def test_json_lines_with_places(spark, gold_file):
    rows = readers.json_lines(spark, gold_file, RECORD, places=True)
    assert [(r["n"], r["id"]) for r in rows.orderBy("n").collect()] == [(1, "r9"), *((i + 3, f"r{9 - i}") for i in range(1, 10))]
    checked = {r["n"]: r["row"] is None for r in readers.json_lines_checked(spark, gold_file, RECORD).collect()}
    assert checked[3] and not checked[1] and 2 not in checked
    ids = spark.createDataFrame([(f"r{i}",) for i in range(10)], "id string")
    first = evaluate.select_records(rows, ids, limit=3)
    assert sorted(r["id"] for r in first.collect()) == ["r7", "r8", "r9"]  # the first of the file
    assert sorted(r["id"] for r in evaluate.select_records(rows.drop("file", "n"), ids, limit=3).collect()) == ["r0", "r1", "r2"]


def test_evaluation_run(spark, gold_file, tmp_path):
    records = readers.json_lines(spark, gold_file, RECORD, places=True)
    found = [(f"r{i}", "PERSON", 0, 7, "x") for i in range(10)] + [(f"r{i}", "SSN", 16, 20, "x") for i in range(4)] + [(f"r{i}", "PERSON", 9, 10, "x") for i in range(10)] + [("other", "PERSON", 0, 7, "x")]
    pred = spark.createDataFrame(found, "id string, type string, start int, end int, text string")
    options = O.EvalOptions(types=("PERSON", "EMAIL", "SSN"), max_records=8, max_errors=5, context=4, max_examples=2)
    ids = records.select("id")
    fixes = spark.createDataFrame([("r9", "EMAIL", 16, 23)], "id string, type string, start int, end int")
    out = runs.evaluation(records, pred, options, ids, corrections=fixes, meta={"gold": "g"})
    report = out.report()
    assert report["meta"] == {"gold": "g", "records": 8, "match": "hybrid"}
    assert (report["by_type"]["PERSON"]["tp"], report["by_type"]["PERSON"]["fn"], report["by_type"]["PERSON"]["fp"]) == (8, 8, 8)
    assert report["by_type"]["EMAIL"]["fn"] == 7 and report["by_type"]["SSN"]["fp"] == 2 and report["micro"]["tp"] == 8
    misses = out.miss_report()
    assert misses["by_category"]["wrong_type"]["EMAIL"] == 2 and sum(sum(v.values()) for v in misses["by_category"].values()) == 15
    assert len(misses["examples"]) <= 2 * 5 and all("[[" in x["context"] for x in misses["examples"])
    assert misses["common_texts"]["PERSON"] == {"bob": 8}
    assert "## Metrics" in out.markdown() and "<h2>Misses by category</h2>" in out.html()
    out.write(str(tmp_path / "dumps"), write_fp=True)
    dumped = spark.read.json(str(tmp_path / "dumps/fn/rows"))
    assert {r["type"]: r["count"] for r in dumped.groupBy("type").count().collect()} == {"PERSON": 5, "EMAIL": 5}
    assert {r["place"] for r in dumped.where("type = 'PERSON'").collect()} == {0, 1, 2, 3, 4}
    assert json.loads(runs.report_row(spark, report).first()["value"]) == report


@pytest.mark.parametrize("whole", [False, True])
def test_caps_go_on_over_batches(spark, tmp_path, whole):
    rows = [("A" if i % 3 else "B", i // 4, i, i + 1) for i in range(120)]
    frame = spark.createDataFrame(rows, "type string, place long, start int, end int")

    def dumped(path):
        return sorted((r["type"], r["place"], r["start"]) for r in spark.read.json(f"{path}/rows").collect())

    def plain(rows, most):
        out, n = [], {}
        for place in sorted({r[1] for r in rows}):
            before = dict(n)
            for t, p, s, _ in sorted(r for r in rows if r[1] == place):
                if (before if whole else n).get(t, 0) < most:
                    out.append((t, p, s))
                    n[t] = n.get(t, 0) + 1
        return sorted(out)

    writers.append_dumps(frame, f"{tmp_path}/one", 17, whole_records=whole)
    for b, part in enumerate((frame.where("place < 5"), frame.where("place >= 5 and place < 7"), frame.where("place >= 7"))):
        for _ in range(2):  # a batch that is written again changes nothing
            writers.append_dumps(part, f"{tmp_path}/parts", 17, b, whole_records=whole)
    assert dumped(f"{tmp_path}/one") == plain(rows, 17) == dumped(f"{tmp_path}/parts")
    writers.append_dumps(frame, f"{tmp_path}/every", 3, every=10, whole_records=whole)
    assert dumped(f"{tmp_path}/every") == sorted(x for a in range(0, 30, 10) for x in plain([r for r in rows if a <= r[1] < a + 10], 3))


def test_ledger(spark, tmp_path):
    folder, log = f"file://{tmp_path}/ledger", tmp_path / "calls"
    log.mkdir()

    def read(doc):
        import pathlib
        import uuid

        (pathlib.Path(str(log)) / f"{doc}-{uuid.uuid4().hex}").touch()
        if doc == "bad":
            raise ValueError("x" * 3000 + "end")
        return [f"{doc} one", "call 123-45-6789"]

    docs = spark.createDataFrame([(f"d{i}",) for i in range(20)] + [("bad",)], "doc string")
    first = ledger.extract(docs.where("doc < 'd3'"), read, folder, every=2)
    assert first.count() == docs.where("doc < 'd3'").count()
    # as if a task had been lost after it had written, and another had left half a file
    one = next(p for p in (tmp_path / "ledger").glob("*.json"))
    (tmp_path / "ledger" / "zz.json").write_text(one.read_text())
    (tmp_path / "ledger" / ".half").write_text('{"doc": "d7", "sta')
    done = ledger.extract(docs, read, folder, every=2)
    assert done.count() == 21 and len(list(log.iterdir())) == 21  # none twice, none lost
    bad = ledger.failures(done).collect()
    assert len(bad) == 1 and len(bad[0]["error"]) == 1000 and bad[0]["error"].endswith("end")
    assert ledger.left(docs, folder).count() == 0 and [r["doc"] for r in ledger.left(docs, folder, again=True).collect()] == ["bad"]
    scans = scan.scan_documents(ledger.paragraphs(done))
    rows = scan.report(scans, ledger.failures(done)).collect()
    assert sum(r["status"] == "ok" and r["contains_pii"] for r in rows) == 20 and sum(r["status"] == "extract_error" for r in rows) == 1


def test_sample_run(spark):
    sizes = ["tiny", "normal", "huge"]
    rows = [(i, f"/p{i}", f"id{i // 2 if i < 20 else i}", 1000 + i, 1 + i % 30, sizes[i % 3], "Word" if i % 2 else "Acrobat", None, i % 5 == 0, i % 4 != 0) for i in range(300)]
    index = spark.createDataFrame(rows, "line long, path string, pdf_id string, bytes long, page_count int, size_bucket string, producer string, creator string, likely_scanned boolean, has_text_ops boolean")
    options = O.SampleOptions(n=40, prefer_text=True, scanned_share=0.25, size_buckets=("tiny", "normal"), min_pages=2, max_pages=25)
    exclude = spark.createDataFrame([("/p41",)], "x string")
    chosen, report = runs.sample(index, options, exclude)
    got = chosen.collect()
    assert report["n_selected"] == len(got) == 40 and sum(r["likely_scanned"] for r in got) == 10
    assert all(2 <= r["page_count"] <= 25 and r["size_bucket"] != "huge" and (r["likely_scanned"] or r["has_text_ops"]) for r in got)
    assert sum(report["by_size"].values()) == report["total_kept"] and sum(report["marginals"]["page_bucket"].values()) == 40
    assert sum(x["selected"] for x in report["bucket_counts"].values()) == 40
    assert runs.sample_list(chosen, O.SampleOptions(n=40, output_field="pdf_id")).count() == 40
    assert runs.sample(index, O.SampleOptions(n=1000))[1]["n_selected"] == 290  # one of each pdf_id


def test_split_and_validate_runs(spark, tmp_path):
    rows = [(f"FILE=f{i % 12}/{i}", "text of it", [("SSN" if i % 12 == 3 else "EMAIL", 0, 4, None)]) for i in range(60)]
    records = spark.createDataFrame(rows, RECORD)
    for balanced in (True, False):
        files, report = runs.split_gold(records, ["SSN", "EMAIL"], O.SplitOptions(dev_ratio=0.5, rare_types=("SSN",)), balanced)
        assert files.count() == report["meta"]["total_files"] == 12 and report["meta"]["total_records"] == 60
        assert report["splits"]["dev"]["records"] + report["splits"]["test"]["records"] == 60
        assert sum(r["n"] for r in files.where("split = 'dev'").collect()) == report["splits"]["dev"]["records"]
    path = tmp_path / "lines.jsonl"
    path.write_text('{"id": "a", "text": "ab cd", "entities": [{"type": "EMAIL", "start": 0, "end": 2}]}\nbroken\n{"id": "b", "text": "ab", "entities": [{"type": "NONE", "start": 0, "end": 9}]}\n')
    issues, report = runs.validate(readers.lines(spark, str(path)), O.ValidateOptions(types=("EMAIL",)))
    assert report["exit_code"] == 1 and report["summary"]["total_entities"] == 2 and report["summary"]["records_with_errors"] == 1
    assert {r["id"] for r in issues.where("code = 'JSON_PARSE_ERROR'").collect()} == {"LINE_2"} and report["summary"]["error_counts"]["INVALID_TYPE"] == 1


def test_name_lists(spark, tmp_path):
    (tmp_path / "first.txt").write_text("# names\nAnn\nＢｏｂ\n\nThe\n")
    (tmp_path / "last.json").write_text('["Lee", "van Dyke"]')
    (tmp_path / "stop.json").write_text('["the"]')
    made = O.from_mapping({"name_lists": {"first_names": {"source": "first.txt"}, "last_names": "last.json", "stopwords": {"source": "stop.json"}}}, str(tmp_path))
    names = dictionary.from_lists(spark, made.name_lists)
    assert sorted(tuple(r) for r in names.collect()) == [("ann", 1), ("bob", 1), ("lee", 1), ("van dyke", 2)]
    assert dictionary.from_lists(spark, O.NameLists()) is None
    assert O.list_file(str(tmp_path / "none.txt"), missing_ok=True) == []
    with pytest.raises(FileNotFoundError):
        O.list_file(str(tmp_path / "none.txt"))
    kept, removed = dictionary.filter_names(spark.createDataFrame([("Ｚｅｄ",), ("O'",), ("Bo",), (None,), (" Ann ",)], "name string"), spark.createDataFrame([("ann", 6.0)], "name string, zipf double"), 5.0)
    assert [r["name"] for r in kept.collect()] == ["Bo", "Zed"] and [r["name"] for r in removed.collect()] == ["Ann"]


def test_bench(spark, tmp_path):
    for i in range(12):
        (tmp_path / f"p{i:02}.txt").write_text(f"Ann called 123-45-6789 on page {i} " * 5)
    names = dictionary.dictionary(spark.createDataFrame([("ann",)], "name string"))
    got = bench.run(spark, str(tmp_path), O.BenchOptions(runs=2, warmup=3, max_pages=10), names=names, profile=True)
    assert got["meta"]["pages"] == 17 and len(got["profile"]) == 17 and got["throughput"]["pages_per_sec"] > 0
    assert got["stages"]["total_ms"]["max"] >= got["stages"]["regex_ms"]["max"] > 0 and all(r["entities"] >= 10 for r in got["profile"])
    with pytest.raises(ValueError):
        bench.run(spark, str(tmp_path), O.BenchOptions(runs=1, warmup=99))
