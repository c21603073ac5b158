"""Queries of readers, writers, ledgers, dumps and runs: what the driver's tables give is written to the shared folder, read back and compared."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import text as T
from .operators import dictionary, evaluate, spans
from .options import DetectOptions, EvalOptions, LuhnRetype, NameLists, SampleOptions, SplitOptions, ValidateOptions
from .plans import runs
from .sources import ledger, readers, writers
from .sources.shared import own_folder

CAP = 300


def _documents(spark, d) -> DataFrame:
    return readers.table(spark, f"{d}/documents.parquet")


def _written(spark, d, compression: str) -> str:
    """JSON lines of all documents, with a broken and a blank line after some."""
    path = f"{own_folder(spark, 'lines')}/documents"
    n = F.col("doc_id")
    good = F.to_json(F.struct(n.alias("id"), "text", "lang"))
    rows = _documents(spark, d).select(F.explode(F.array_compact(F.array(good, F.when(n % 7 == 0, F.lit('{"id": 1, ')), F.when(n % 11 == 0, F.lit("  "))))).alias("value"))
    rows.write.option("compression", compression).text(path)
    return path


def json_lines_gzip(spark, d):
    """Records that come back from compressed JSON lines."""
    rows = readers.json_lines(spark, _written(spark, d, "gzip"), "id long, text string, lang string")
    return rows.select("id", F.md5("text").alias("digest"), "lang")


def json_lines_errors(spark, d):
    """How many lines there are, are numbered, and are no JSON."""
    path = _written(spark, d, "none")
    lines = readers.lines(spark, path)
    each = lines.groupBy("file").agg(F.max("n").alias("last"), F.count("*").alias("n"), F.countDistinct("n").alias("numbers"))
    whole = each.agg(F.sum("last").alias("last"), F.sum("n").alias("lines"), F.sum("numbers").alias("numbers"))
    checked = readers.json_lines_checked(spark, path, "id long, text string, lang string").agg(F.count("*").alias("filled"), F.count_if(F.col("row").isNull()).alias("broken"))
    return whole.withColumn("k", F.lit(1)).join(checked.withColumn("k", F.lit(1)), "k").drop("k")


def json_lines_places(spark, d):
    """Records told apart by file and line: as many as there are, each once."""
    rows = readers.json_lines(spark, _written(spark, d, "none"), "id long, text string, lang string", places=True)
    return rows.groupBy("lang").agg(F.count("*").alias("n"), F.countDistinct("file", "n").alias("places"), F.sum("id").alias("ids"))


def id_lists(spark, d):
    """Documents whose id is in a list with comments and blank lines."""
    path = f"{own_folder(spark, 'list')}/ids"
    n = F.col("doc_id")
    line = F.when(n % 3 == 0, F.concat(F.lit("  "), n.cast("string"))).when(n % 3 == 1, F.concat(F.lit("# "), n.cast("string"))).otherwise(F.lit(" "))
    writers.append_list(_documents(spark, d).select(line.alias("line")), "line", path)
    wanted = readers.id_list(spark, path, comments=True).select(F.col("value").cast("long").alias("doc_id"))
    return _documents(spark, d).select("doc_id").join(wanted, "doc_id", "left_semi")


def result_documents(spark, d):
    """Entities that come back from one JSON result for each order."""
    x = readers.table(spark, f"{d}/lineitem.parquet")
    start = (F.col("l_partkey") % 97).cast("int")
    found = x.select(
        F.col("l_orderkey").alias("id"), start.alias("start"), (start + 5).alias("end"), F.lit("SSN").alias("type"), F.lit("t").alias("text"), F.lit(0.5).alias("score"),
        F.array(F.lit("regex")).alias("sources"),
    )
    fields = "struct<meta:struct<profile:string>,entities:array<struct<start:int,end:int,type:string>>>"
    rows = writers.json_result(found, {"profile": "p"}).select("id", F.from_json("value", fields).alias("r"))
    total = F.aggregate("r.entities", F.lit(0).cast("long"), lambda a, e: a + e["start"] + e["end"])
    return rows.select("id", "r.meta.profile", F.size("r.entities").cast("long").alias("n"), total.alias("places"))


def _errors(spark, d) -> DataFrame:
    x = readers.table(spark, f"{d}/lineitem.parquet")
    start = (F.col("l_partkey") % 97).cast("int")
    return x.select(F.col("l_returnflag").alias("type"), F.col("l_orderkey").alias("place"), start.alias("start"), (start + F.col("l_linenumber")).cast("int").alias("end"))


def _dumped(spark, d, whole: bool) -> DataFrame:
    """Dumps in two batches, the second written twice as by a run that was broken off."""
    folder = own_folder(spark, "dumps")
    rows = _errors(spark, d)
    for batch, part in enumerate((rows.where("place <= 100"), rows.where("place > 100"), rows.where("place > 100"))):
        writers.append_dumps(part, folder, CAP, min(batch, 1), whole_records=whole)
    return spark.read.schema("type string, place long, start int, end int").json(f"{folder}/rows").select("type", "place", F.col("start").alias("start_"), F.col("end").alias("end_"))


def dump_caps(spark, d):
    return _dumped(spark, d, False)


def dump_whole_records(spark, d):
    return _dumped(spark, d, True)


def extraction_ledger(spark, d):
    """Documents extracted in two runs, the second taking up what the first left; every eleventh fails."""

    def paragraphs(doc: str) -> list[str]:
        number, text = doc.split(":", 1)
        if int(number) % 11 == 0:
            raise ValueError(f"no text in {number}")
        return text.split("\n")

    docs = _documents(spark, d).select(F.concat_ws(":", F.col("doc_id").cast("string"), F.coalesce("text", F.lit(""))).alias("doc"), "doc_id")
    folder = own_folder(spark, "ledger")
    ledger.extract(docs.where("doc_id % 2 = 0").select("doc"), paragraphs, folder)
    done = ledger.extract(docs.select("doc"), paragraphs, folder)
    return done.select(F.substring_index("doc", ":", 1).cast("long").alias("doc_id"), "status", "error", F.coalesce(F.size("paragraphs"), F.lit(-1)).cast("long").alias("n"))


def autosave_store(spark, d):
    """Annotations that come back from autosave files of about fifty documents."""
    folder = f"{own_folder(spark, 'autosave')}/store"
    x = _documents(spark, d)
    n = F.col("doc_id")
    entity = F.struct(F.lit("PERSON").alias("type"), (n % 7).cast("int").alias("start"), (n % 7 + 3).cast("int").alias("end"), F.lit("abc").alias("text"))
    doc = F.struct(F.left("text", F.lit(200)).alias("text"), F.when(n % 3 != 0, F.array(entity)).alias("entities"))
    part = F.floor(n / 50).alias("g")
    rows = x.groupBy(part).agg(F.map_from_entries(F.collect_list(F.struct(F.concat(F.lit("p"), n.cast("string")).alias("k"), doc.alias("v")))).alias("documents"))
    rows.select("g", F.to_json(F.struct("documents")).alias("value")).write.partitionBy("g").text(folder)
    return readers.annotation_store(spark, folder).select("path", F.md5("text").alias("digest"), F.size("entities").cast("long").alias("n"))


def retype_numbers(spark, d):
    """Numbers and dates that change their type, or go, by what stands before them and by their checksum."""
    n = F.col("o_orderkey")
    card = F.lpad((n * 7919 + F.col("o_custkey") * 104729).cast("string"), 16, "4")
    nine = F.lpad((n % 899_999_999 + 100_000_000).cast("string"), 9, "1")
    text = F.when(n % 3 == 0, card).when(n % 3 == 1, nine).otherwise(F.lit("1990-01-02"))
    kind = F.when(n % 3 == 0, "ACCOUNT_NUMBER").when((n % 3 == 1) & (n % 2 == 0), "ACCOUNT_NUMBER").when(n % 3 == 1, "SSN").otherwise("BIRTHDATE")
    pre = F.element_at(F.array(*[F.lit(x) for x in ("ssn ", "account ", "plain ", "born ")]), (n % 4 + 1).cast("int"))
    rows = readers.table(spark, f"{d}/orders.parquet").select(
        n.alias("id"), kind.alias("type"), text.alias("text"), text.alias("raw_text"), pre.alias("pre"), F.lit(" end").alias("post"), F.lit(0.5).alias("score")
    )
    options = DetectOptions(luhn=LuhnRetype(min_length=16, max_length=16))
    return spans.disambiguate(rows, options).select("id", "type", "score")


def evaluation_report(spark, d):
    """An evaluation run by its options: two entities a document, of which some are predicted exactly."""
    x = _documents(spark, d)
    n = F.col("doc_id")
    one = lambda kind, s: F.struct(F.lit(kind).alias("type"), s.cast("int").alias("start"), (s + 4).cast("int").alias("end"), F.lit(None).cast("string").alias("text"))
    records = x.select(n.cast("string").alias("id"), "text", F.array(one("PERSON", n % 11), one("EMAIL", n % 13)).alias("entities"))
    found = [x.where("doc_id % 3 = 0").select(n.cast("string").alias("id"), one("PERSON", n % 11).alias("e")), x.where("doc_id % 4 = 0").select(n.cast("string").alias("id"), one("EMAIL", n % 13 + 1).alias("e"))]
    pred = found[0].unionByName(found[1]).select("id", "e.type", "e.start", "e.end", F.lit("t").alias("text"))
    out = runs.evaluation(records, pred, EvalOptions(match="exact", types=("PERSON", "EMAIL")), ids=x.where("doc_id % 5 <> 0").select(n.cast("string").alias("id")))
    return out.metrics.select("type", "tp", "fn", "fp")


def external_rows(spark, d):
    """The first rows of one locale of an outside data set."""
    n = F.col("doc_id")
    locale = F.element_at(F.array(F.lit("US"), F.lit("GB"), F.lit("AU")), (n % 3 + 1).cast("int"))
    rows = _documents(spark, d).select(n.alias("id"), F.col("lang").alias("language"), locale.alias("locale"), F.md5("text").alias("digest"))
    return readers.external_dataset(rows, "GB", 50).select("id", "locale", "digest")


def appended_rows(spark, d):
    """Rows that two runs append to one file of JSON lines."""
    path = f"{own_folder(spark, 'append')}/rows"
    rows = _documents(spark, d).select("doc_id", "lang")
    for part in (rows.where("doc_id % 2 = 0"), rows.where("doc_id % 2 = 1")):
        writers.append_json_lines(part, path)
    return readers.json_lines(spark, path, "doc_id long, lang string")


def first_records(spark, d):
    """The first selected records in the order of their files, which is neither that of ids nor of the table."""
    path = f"{own_folder(spark, 'gold')}/records"
    rows = _documents(spark, d).select(F.col("doc_id").cast("string").alias("id"), "lang", "doc_id")
    dealt = rows.repartitionByRange(4, F.desc("doc_id")).sortWithinPartitions(F.desc("doc_id"))
    dealt.select("id", "lang").write.json(path)
    records = readers.json_lines(spark, path, "id string, lang string", places=True)
    ids = rows.where("doc_id % 3 <> 1").select("id")
    return evaluate.select_records(records, ids, limit=25).select("id", "lang")


def name_list_files(spark, d):
    """The dictionary of name lists that come as files."""
    folder = own_folder(spark, "names")
    words = readers.table(spark, f"{d}/benchmark.parquet").select(F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z]{3,}"), F.lit(0))).alias("w"))
    words.select(F.explode(F.array(F.col("w"), F.concat(F.lit("# "), F.col("w")), F.lit(""))).alias("value")).write.text(f"{folder}/first.txt")
    stop = words.where(F.lower(F.left("w", F.lit(1))) == "b").select(F.lower("w").alias("w")).distinct().groupBy().agg(F.to_json(F.collect_list("w")).alias("value"))
    stop.write.text(f"{folder}/stop.json")
    return dictionary.from_lists(spark, NameLists(first_names=f"{folder}/first.txt", stopwords=f"{folder}/stop.json"))


def _counted(spark, table: dict[str, int]) -> DataFrame:
    return spark.createDataFrame(list(table.items()), "what string, n long")


def sample_report(spark, d):
    """Counts of a sampling run by its options: what is kept by size, and how many are chosen."""
    n = F.col("doc_id")
    index = _documents(spark, d).select(
        n.alias("line"), F.concat(F.lit("/c/"), n.cast("string")).alias("path"), (F.col("n_chars") * 400).alias("bytes"), F.md5("text").alias("pdf_id"),
        F.when(n % 23 != 0, (n % 30).cast("int")).alias("page_count"), T.size_bucket(F.col("n_chars") * 400).alias("size_bucket"), F.lit("Word").alias("producer"),
        F.lit(None).cast("string").alias("creator"), (n % 4 == 0).alias("likely_scanned"), (n % 5 != 0).alias("has_text_ops"),
    )
    _, report = runs.sample(index, SampleOptions(n=40, min_pages=2, max_pages=25, size_buckets=("tiny", "normal")))
    return _counted(spark, {"kept": report["total_kept"], "chosen": report["n_selected"]} | {f"size {k}": v for k, v in report["by_size"].items()} | {f"scanned {k}": v for k, v in report["by_scanned"].items()})


def _annotated(spark, d) -> DataFrame:
    n = F.col("doc_id")
    one = lambda kind, a, b: F.struct(F.lit(kind).alias("type"), a.cast("int").alias("start"), b.cast("int").alias("end"))
    ents = F.array(one("PERSON", n % 11, n % 11 + n % 3), one("PLACE", n % 2, n % 2 + 1))
    return _documents(spark, d).select(F.concat(F.lit("FILE="), (n % 40).cast("string"), F.lit("/"), n.cast("string")).alias("id"), F.lit("abcdefghijklmnop").alias("text"), ents.alias("entities"), "doc_id")


def split_report(spark, d):
    """Counts of a random split by its options."""
    _, report = runs.split_gold(_annotated(spark, d), ["PERSON", "PLACE"], SplitOptions(dev_ratio=0.3, seed=5), balanced=False)
    out = {"files": report["meta"]["total_files"], "records": report["meta"]["total_records"]}
    for s, part in report["splits"].items():
        out |= {f"{s} files": part["files"], f"{s} records": part["records"], **{f"{s} {k}": v for k, v in part["counts"].items()}}
    return _counted(spark, out)


def validate_report(spark, d):
    """Counts of a validation run over JSON lines of which some are broken."""
    path = f"{own_folder(spark, 'check')}/records"
    good = F.to_json(F.struct("id", "text", "entities"))
    rows = _annotated(spark, d).select(F.explode(F.array_compact(F.array(good, F.when(F.col("doc_id") % 9 == 0, F.lit("{broken"))))).alias("value"))
    rows.write.text(path)
    _, report = runs.validate(readers.lines(spark, path), ValidateOptions(types=("PERSON",)))
    s = report["summary"]
    return _counted(spark, {"records": s["total_records"], "entities": s["total_entities"], "with issues": s["records_with_errors"], "exit code": report["exit_code"]} | s["error_counts"])


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    each = [
        json_lines_gzip, json_lines_errors, json_lines_places, id_lists, result_documents, dump_caps, dump_whole_records, extraction_ledger, autosave_store, retype_numbers, evaluation_report,
        external_rows, appended_rows, first_records, name_list_files, sample_report, split_report, validate_report,
    ]
    return {q.__name__: q for q in each}


_ERRORS = "SELECT l_returnflag AS type, l_orderkey AS place, (l_partkey % 97)::INT AS start_, (l_partkey % 97 + l_linenumber)::INT AS end_ FROM lineitem"


def oracle_sql() -> dict[str, str]:
    lines = "count(*) + count_if(doc_id % 7 = 0) + count_if(doc_id % 11 = 0)"
    words = lambda text, kind: "(" + " OR ".join(f"contains({text}, '{w}')" for w in DetectOptions().keywords[kind]) + ")"
    return {
        "json_lines_gzip": "SELECT doc_id AS id, md5(text) AS digest, lang FROM documents",
        "json_lines_errors": f"""
            SELECT ({lines})::BIGINT AS last, ({lines})::BIGINT AS lines, ({lines})::BIGINT AS numbers, (count(*) + count_if(doc_id % 7 = 0))::BIGINT AS filled,
              count_if(doc_id % 7 = 0)::BIGINT AS broken FROM documents""",
        "json_lines_places": "SELECT lang, count(*) AS n, count(*) AS places, sum(doc_id)::BIGINT AS ids FROM documents GROUP BY lang",
        "external_rows": "SELECT doc_id AS id, 'GB' AS locale, md5(text) AS digest FROM documents WHERE lang = 'en' AND doc_id % 3 = 1 ORDER BY doc_id LIMIT 50",
        "appended_rows": "SELECT doc_id, lang FROM documents",
        "first_records": "SELECT doc_id::VARCHAR AS id, lang FROM documents WHERE doc_id % 3 <> 1 ORDER BY doc_id DESC LIMIT 25",
        "name_list_files": """
            SELECT DISTINCT lower(w) AS name, 1::INT AS n_words FROM (SELECT unnest(regexp_extract_all(text, '[A-Za-z]{3,}')) AS w FROM benchmark) WHERE NOT starts_with(lower(w), 'b')""",
        "sample_report": """
            WITH i AS (SELECT doc_id, n_chars * 400 AS bytes, CASE WHEN doc_id % 23 <> 0 THEN doc_id % 30 END AS pages,
              CASE WHEN n_chars * 400 < 204800 THEN 'tiny' WHEN n_chars * 400 < 5242880 THEN 'normal' ELSE 'huge' END AS size,
              row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) AS k FROM documents WHERE n_chars > 0),
            f AS (SELECT *, CASE WHEN doc_id % 4 = 0 THEN 'true' ELSE 'false' END AS scanned FROM i WHERE k = 1 AND pages BETWEEN 2 AND 25 AND size <> 'huge')
            SELECT 'kept' AS what, count(*) AS n FROM f UNION ALL SELECT 'chosen', least(count(*), 40) FROM f UNION ALL SELECT 'size ' || size, count(*) FROM f GROUP BY size
            UNION ALL SELECT 'scanned ' || scanned, count(*) FROM f GROUP BY scanned""",
        "split_report": """
            WITH f AS (SELECT (doc_id % 40)::VARCHAR AS file, count(*) AS n FROM documents GROUP BY 1),
            s AS (SELECT file, n, CASE WHEN coalesce(sum(n) OVER (ORDER BY md5('5:' || file), file ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
              < (SELECT sum(n) FROM f) * 0.3 THEN 'dev' ELSE 'test' END AS split FROM f)
            SELECT 'files' AS what, count(*) AS n FROM s UNION ALL SELECT 'records', sum(n)::BIGINT FROM s
            UNION ALL SELECT split || ' files', count(*) FROM s GROUP BY split UNION ALL SELECT split || k, sum(n)::BIGINT FROM s, (VALUES (' records'), (' PERSON'), (' PLACE')) AS v(k) GROUP BY split, k""",
        "validate_report": """
            WITH x AS (SELECT doc_id, doc_id % 3 AS size FROM documents),
            c AS (SELECT 'INVALID_TYPE' AS what, count(*) AS n FROM x UNION ALL SELECT 'BAD_OFFSETS', count_if(size = 0) FROM x UNION ALL SELECT 'SHORT_SPAN', count_if(size = 1) FROM x
              UNION ALL SELECT 'JSON_PARSE_ERROR', count_if(doc_id % 9 = 0) FROM x)
            SELECT what, n::BIGINT AS n FROM c WHERE n > 0 UNION ALL SELECT 'records', count(*) FROM x UNION ALL SELECT 'entities', 2 * count(*) FROM x
            UNION ALL SELECT 'with issues', count(*) FROM x UNION ALL SELECT 'exit code', 1""",
        "id_lists": "SELECT doc_id FROM documents WHERE doc_id % 3 = 0",
        "result_documents": "SELECT l_orderkey AS id, 'p' AS profile, count(*) AS n, sum(2 * (l_partkey % 97) + 5)::BIGINT AS places FROM lineitem GROUP BY l_orderkey",
        "dump_caps": f"SELECT * FROM ({_ERRORS}) QUALIFY row_number() OVER (PARTITION BY type ORDER BY place, start_, end_) <= {CAP}",
        "dump_whole_records": f"""
            SELECT type, place, start_, end_ FROM (SELECT *, count(*) OVER (PARTITION BY type ORDER BY place RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM ({_ERRORS}))
            WHERE before < {CAP}""",
        "extraction_ledger": """
            SELECT doc_id, CASE WHEN doc_id % 11 = 0 THEN 'extract_error' ELSE 'ok' END AS status, CASE WHEN doc_id % 11 = 0 THEN 'no text in ' || doc_id END AS error,
              CASE WHEN doc_id % 11 = 0 THEN -1 ELSE len(string_split(coalesce(text, ''), chr(10))) END::BIGINT AS n FROM documents""",
        "autosave_store": "SELECT 'p' || doc_id AS path, md5(left(text, 200)) AS digest, CASE WHEN doc_id % 3 = 0 THEN 0 ELSE 1 END::BIGINT AS n FROM documents",
        "retype_numbers": f"""
            WITH x AS (SELECT o_orderkey AS id, lpad((o_orderkey * 7919 + o_custkey * 104729)::VARCHAR, 16, '4') AS card, ['ssn ', 'account ', 'plain ', 'born '][o_orderkey % 4 + 1] AS pre FROM orders),
            y AS (SELECT *, list_sum(list_transform(range(1, 17), lambda i: CASE WHEN i % 2 = 0 THEN card[i]::INT ELSE (card[i]::INT * 2) // 10 + (card[i]::INT * 2) % 10 END)) % 10 = 0 AS valid,
              {words("pre", "ACCOUNT_NUMBER")} AS account, {words("pre", "SSN")} AS ssn, {words("pre", "BIRTHDATE")} AS birth FROM x)
            SELECT id, CASE WHEN id % 3 = 0 THEN CASE WHEN valid AND NOT account THEN 'CREDIT_CARD_NUMBER' ELSE 'ACCOUNT_NUMBER' END WHEN id % 3 = 2 THEN 'BIRTHDATE'
                WHEN id % 2 = 0 THEN CASE WHEN ssn THEN 'SSN' ELSE 'ACCOUNT_NUMBER' END ELSE CASE WHEN account THEN 'ACCOUNT_NUMBER' ELSE 'SSN' END END AS type,
              CASE WHEN id % 3 = 0 AND valid AND NOT account THEN 0.95 WHEN id % 3 = 1 AND id % 2 = 0 AND ssn THEN 0.95
                WHEN id % 3 = 1 AND id % 2 = 1 AND account THEN 0.8 ELSE 0.5 END::DOUBLE AS score FROM y WHERE id % 3 <> 2 OR birth""",
        "evaluation_report": """
            WITH d AS (SELECT doc_id AS n FROM documents WHERE doc_id % 5 <> 0),
            c AS (SELECT 'PERSON' AS type, count_if(n % 3 = 0) AS tp, count_if(n % 3 <> 0) AS fn, 0 AS fp FROM d UNION ALL SELECT 'EMAIL', 0, count(*), count_if(n % 4 = 0) FROM d)
            SELECT type, tp::BIGINT AS tp, fn::BIGINT AS fn, fp::BIGINT AS fp FROM c UNION ALL SELECT 'micro', sum(tp)::BIGINT, sum(fn)::BIGINT, sum(fp)::BIGINT FROM c
            UNION ALL SELECT 'person_location_micro', tp::BIGINT, fn::BIGINT, fp::BIGINT FROM c WHERE type = 'PERSON'""",
    }
