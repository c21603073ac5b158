"""Registered queries of the detection and curation operators, and SQL that gives the same rows.

The driver's tables have no annotations, so spans, records and indexes are derived from them by
arithmetic on keys; derivations are the same in both languages.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import io_queries, rule_queries
from .functions import text as T
from .keyword_lists import LISTS as KEYWORD_LISTS
from .operators import dictionary, evaluate, gateway, gold, keywords, regex_detect, sampling, scan, spans, split
from .options import BIRTH_WORDS, NEGATIVE_WORDS, ZIP_WORDS, DetectOptions, profile
from .plans import detect as plan
from .sources import readers


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return readers.table(spark, f"{d}/{name}.parquet")


def _spans(spark, d, shift: int = 0, step: int = 1) -> DataFrame:
    """(id, idx, seq, type, start, end, score, text) from lineitem; ``shift`` moves ends, ``step`` thins."""
    x = _t(spark, d, "lineitem")
    # the count is read from the files' footers; each order's lines lie in one part from here to the merges
    x = readers.by_key(x.where(F.col("l_linenumber") % step == 0).withColumn("id", F.col("l_orderkey").cast("string")), x.count(), "id")
    start = (F.col("l_partkey") % 97 * 3 + F.when(F.lit(shift > 0), F.col("l_suppkey") % 3).otherwise(0)).cast("int")
    kind = F.when(F.col("l_returnflag") == "A", "SSN").when(F.col("l_returnflag") == "N", "PERSON").otherwise("EMAIL")
    order = Window.partitionBy("id").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    n = F.row_number().over(order).cast("int")
    return x.select(
        "id", n.alias("idx"), n.alias("seq"),
        kind.alias("type"), start.alias("start"), (start + 4 + (F.col("l_quantity").cast("int") % 9)).cast("int").alias("end"),
        F.lit(0.5).alias("score"), F.concat(F.lit("w"), F.col("l_linenumber").cast("string")).alias("text"),
    )


def _spans_sql(shift: int = 0, step: int = 1) -> str:
    return f"""SELECT *, start_ + 4 + q % 9 AS end_ FROM (
      SELECT l_orderkey::VARCHAR AS id, trunc(l_quantity)::INT AS q, (row_number() OVER (
          PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice))::INT AS idx, idx AS seq,
        CASE l_returnflag WHEN 'A' THEN 'SSN' WHEN 'N' THEN 'PERSON' ELSE 'EMAIL' END AS type,
        (l_partkey % 97 * 3 + {"l_suppkey % 3" if shift else "0"})::INT AS start_, 'w' || l_linenumber AS text
      FROM lineitem WHERE l_linenumber % {step} = 0)"""


def _records(spark, d) -> DataFrame:
    """Annotated records from documents: two entities each, some of them faulty."""
    x = _t(spark, d, "documents")
    n = F.col("doc_id")
    ent = lambda kind, a, b: F.struct(F.lit(kind).alias("type"), a.cast("int").alias("start"), b.cast("int").alias("end"), F.lit(None).cast("string").alias("text"))
    first = ent("PERSON", n % 11, n % 11 + n % 7)
    second = F.when(n % 5 == 0, first).when(n % 5 == 1, ent("PLACE", n % 13, n % 13 + 5)).otherwise(ent("EMAIL", n % 17, F.when(n % 19 != 0, n % 17 + 6)))
    return x.select(F.concat(F.lit("FILE="), (n % 40).cast("string"), F.lit("/"), n.cast("string")).alias("id"), "text", F.array(first, second).alias("entities"))


_RECORDS_SQL = """r AS (SELECT doc_id AS n, 'FILE=' || (doc_id % 40) || '/' || doc_id AS id, text, length(text) AS len FROM documents),
e AS (
  SELECT id, text, len, n, 0 AS i, 'PERSON' AS type, n % 11 AS s, n % 11 + n % 7 AS e FROM r
  UNION ALL SELECT id, text, len, n, 1, CASE WHEN n % 5 = 0 THEN 'PERSON' WHEN n % 5 = 1 THEN 'PLACE' ELSE 'EMAIL' END,
    CASE WHEN n % 5 = 0 THEN n % 11 WHEN n % 5 = 1 THEN n % 13 ELSE n % 17 END,
    CASE WHEN n % 5 = 0 THEN n % 11 + n % 7 WHEN n % 5 = 1 THEN n % 13 + 5 WHEN n % 19 <> 0 THEN n % 17 + 6 END FROM r
)"""


def _names(spark, d) -> DataFrame:
    """A dictionary of names of one to three words, from the words of ``benchmark``."""
    words = _t(spark, d, "benchmark").select(F.regexp_extract_all("text", F.lit("[A-Za-z]{3,}"), F.lit(0)).alias("w")).where("size(w) > 4")
    names = words.select(F.explode(F.array(F.col("w")[0], F.array_join(F.slice("w", 2, 2), " "), F.array_join(F.slice("w", 2, 3), " "))).alias("name"))
    return dictionary.dictionary(names)


def detect_entities(spark, d):
    """Patterns in both passes and names, through all filters and merges."""
    return plan.detect_entities(_t(spark, d, "documents"), DetectOptions(detectors=("regex", "dict")), _names(spark, d))


def detect_entities_constants(spark, d):
    return plan.detect_entities(_t(spark, d, "documents"), dataclasses.replace(profile("constants"), detectors=("regex", "dict")), _names(spark, d))


def gateway_detect(spark, d):
    return plan.detect_with_gateway(_t(spark, d, "documents"), DetectOptions(detectors=("regex", "dict")), _names(spark, d))


def _patterns(name: str):
    def query(spark, d):
        options = dataclasses.replace(profile(name), passes=("raw",))
        return regex_detect.detect(_t(spark, d, "documents"), options).select("id", "type", "text", F.col("start").alias("start_"), F.col("end").alias("end_"), "score")

    return query


#: A text whose word boundaries an ASCII engine sees where a Unicode engine sees them.
_ASCII = r"regexp_replace(text, '[^\x00-\x7F]', '_', 'g')"


_TOKEN = T.TOKEN.replace("'", "''")


def _any_sql(text: str, words) -> str:
    quote = lambda w: "'" + w.replace("'", "''") + "'"
    return "(" + " OR ".join(f"contains({text}, {quote(w)})" for w in words) + ")" if words else "FALSE"


def _patterns_sql(name: str) -> str:
    """The pattern pass in SQL: matches and pieces between them give offsets, then the rules."""
    o = profile(name)
    scans = []
    for label, patterns in o.patterns.items():
        for p in patterns:
            q = "'" + p.replace("'", "''") + "'"
            scans.append(
                f"SELECT doc_id AS id, text AS t, '{label}' AS label, regexp_extract_all(a, {q}) AS m, string_split_regex(a, {q}) AS b "
                f"FROM d WHERE regexp_matches(a, {q})"
            )
    words = lambda kind: _any_sql("ctx", o.keywords.get(kind, ()))
    pos = "CASE label " + " ".join(f"WHEN '{x}' THEN {words(x)}" for x in o.patterns) + " ELSE FALSE END"
    neg = "CASE label " + " ".join(f"WHEN '{x}' THEN {_any_sql('lower(right(pre, 25))', k)}" for x, k in NEGATIVE_WORDS.items()) + " ELSE FALSE END"
    base = "CASE label " + " ".join(f"WHEN '{x}' THEN {o.scores[x]}" for x in o.patterns) + " END"
    s = o.scoring
    return f"""
WITH d AS (SELECT doc_id, text, {_ASCII} AS a FROM documents),
x AS ({" UNION ALL ".join(scans)}),
y AS (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM x),
z AS (
  SELECT id, t, label, m[i] AS ascii_text,
    (list_sum(list_transform(b[1:i], lambda v: length(v))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda v: length(v))), 0))::INT AS start_ FROM y
),
w AS (SELECT *, substr(t, start_ + 1, length(ascii_text)) AS text, (start_ + length(ascii_text))::INT AS end_,
  substr(t, greatest(start_ - 40, 0) + 1, least(start_, 40)) AS pre, substr(t, start_ + length(ascii_text) + 1, 40) AS post FROM z),
c AS (SELECT *, lower(pre || ' ' || post) AS ctx, length(regexp_replace(text, '\\D', '', 'g')) AS digits FROM w),
p AS (SELECT *, {pos} AS positive, {neg} AS negative FROM c),
v AS (
  SELECT * FROM p WHERE CASE label
    WHEN 'ACCOUNT_NUMBER' THEN NOT negative AND NOT regexp_full_match(text, '\\d{{3}}-\\d{{2}}-\\d{{4}}|\\d{{9}}') AND (positive OR digits >= {s.account_min_digits})
    WHEN 'PHONE_NUMBER' THEN NOT negative AND NOT regexp_matches(right(pre, 1), '\\d') AND NOT regexp_matches(left(post, 1), '\\d')
    WHEN 'SSN' THEN NOT negative AND (positive OR NOT regexp_full_match(text, '\\d{{9}}'))
    WHEN 'ADDRESS' THEN NOT regexp_full_match(text, '\\d{{5}}(-\\d{{4}})?|\\d{{4}}') OR {_any_sql("ctx", ZIP_WORDS)}
    WHEN 'DATE' THEN {_any_sql("lower(right(pre, 20))", BIRTH_WORDS)}
    ELSE TRUE END
),
g AS (SELECT *, (CASE WHEN label = 'ACCOUNT_NUMBER' AND NOT positive THEN {s.account_no_context_score} ELSE {base} END)::DOUBLE AS base FROM v),
h AS (SELECT *, CASE WHEN positive THEN least({s.max_score}::DOUBLE, base + {s.context_boost}::DOUBLE) ELSE base END AS boosted FROM g)
SELECT id, CASE label WHEN 'DATE' THEN 'BIRTHDATE' ELSE label END AS type, text, start_, end_,
  round(CASE WHEN label = 'DATE' THEN least({s.max_score}::DOUBLE, boosted + {s.context_boost}::DOUBLE) ELSE boosted END, 2) AS score
FROM h
"""


def document_keywords(spark, d):
    """Types whose context words a document holds."""
    rows = keywords.present(_t(spark, d, "documents"), KEYWORD_LISTS)
    return rows.select("id", F.array_join("types", ",").alias("types"))


def text_normalize(spark, d):
    n = T.normalize_text(F.col("text"))
    return _t(spark, d, "documents").select("doc_id", F.length(n).cast("long").alias("n"), F.md5(n).alias("digest"))


def luhn_numbers(spark, d):
    number = F.lpad((F.col("o_orderkey") * 7919 + F.col("o_custkey") * 104729).cast("string"), 16, "4")
    return _t(spark, d, "orders").select("o_orderkey", number.alias("number"), T.is_luhn_valid(number).alias("valid"))


def address_score(spark, d):
    rows = gateway.AddressSignals().scored(_t(spark, d, "documents").select("doc_id", "text"))
    return rows.select("doc_id", F.col("address_score").alias("score"), F.array_join("address_signals", ",").alias("signals"))


def consecutive_digits(spark, d):
    return _t(spark, d, "documents").select(
        "doc_id", T.has_consecutive_digits(F.col("text"), 5).alias("hit"), F.size(T.find_consecutive_digits(F.col("text"), 5)).cast("int").alias("runs")
    )


def first_match_scan(spark, d):
    return _t(spark, d, "documents").withColumn("m", scan.first_match(F.col("text"))).where("m is not null").select("doc_id", "m.type", "m.score", "m.text")


def document_scan(spark, d):
    rows = _t(spark, d, "documents").select((F.col("doc_id") % 50).cast("string").alias("doc"), F.lpad(F.col("doc_id").cast("string"), 12, "0").alias("path"), "text")
    return scan.scan_documents(rows).select("doc", "contains_pii", F.col("match.type").alias("type"), "paragraph", "total_paragraphs")


def merge_overlapping(spark, d):
    rows = _spans(spark, d).withColumn("sources", F.array(F.lit("regex")))
    return spans.merge_overlapping(rows).select("id", "type", F.col("start").alias("start_"), F.col("end").alias("end_"), "score")


def merge_adjacent(spark, d):
    rows = _spans(spark, d).withColumn("sources", F.array(F.lit("regex"))).withColumn("pre", F.lit("  "))
    return spans.merge_adjacent(rows, 2).select("id", "seq", "type", "text", F.col("start").alias("start_"), F.col("end").alias("end_"))


def eval_pairs(spark, d):
    return evaluate.pairs(_spans(spark, d), _spans(spark, d, 1, 2)).select("id", "type", F.col("g.idx").alias("g_idx"), F.col("p.idx").alias("p_idx"), F.col("overlap").cast("int").alias("overlap"))


def eval_matches(spark, d):
    return evaluate.match(_spans(spark, d), _spans(spark, d, 1, 2))


def eval_metrics(spark, d):
    g, p = _spans(spark, d).dropDuplicates(["id", "type", "start", "end"]), _spans(spark, d, 1, 2).dropDuplicates(["id", "type", "start", "end"])
    m = evaluate.match(g, p, "exact")
    return evaluate.metrics(g, p, m)


def eval_misses(spark, d):
    g, p = _spans(spark, d, 0, 3), _spans(spark, d, 1, 2)
    return evaluate.misses(g, p, "overlap", 3).select("id", "idx", "category", "predicted_type", F.col("nearest").cast("int").alias("nearest"))


def latency_quantiles(spark, d):
    q = evaluate.quantiles(_t(spark, d, "orders"), "o_totalprice")
    return q.select(*[F.round(c, 4).alias(c) for c in q.columns])


def _index(spark, d) -> DataFrame:
    n = F.col("doc_id")
    return _t(spark, d, "documents").select(
        n.alias("line"), F.concat(F.lit("/c/"), n.cast("string")).alias("path"), (F.col("n_chars") * 400).alias("bytes"), F.md5("text").alias("pdf_id"),
        F.when(n % 23 != 0, (n % 30).cast("int")).alias("page_count"), T.size_bucket(F.col("n_chars") * 400).alias("size_bucket"), F.col("lang").alias("producer"),
    )


def index_filter(spark, d):
    x = _t(spark, d, "documents").where("doc_id % 31 = 0").select(F.concat(F.lit("/c/"), F.col("doc_id").cast("string")).alias("x"))
    return sampling.index_filter(_index(spark, d), 2, 25, ("tiny", "normal"), x).select("line", "page_count", "size_bucket")


def page_buckets(spark, d):
    b = T.page_bucket(F.col("page_count"), "1,2-5,6-20,21+,x")
    return _index(spark, d).groupBy(b.alias("bucket"), "size_bucket").agg(F.count("*").alias("n"))


def index_marginals(spark, d):
    return sampling.marginals(_index(spark, d), ["producer", "size_bucket"])


def stratified_sample(spark, d):
    return sampling.stratified_sample(_index(spark, d), ["producer", "size_bucket"], 100, "line").select("line", "producer", "size_bucket")


def random_split(spark, d):
    files = _records(spark, d).groupBy(T.file_id(F.col("id")).alias("file")).agg(F.count("*").alias("n"))
    return split.random_split(files, 0.3, 5)


def split_rarity(spark, d):
    stats = split.file_stats(_records(spark, d), ["PERSON", "EMAIL", "PLACE"])
    return split.rarity(stats, ["PLACE"]).select("file", F.round("rarity", 9).alias("rarity"))


def split_balanced(spark, d):
    stats = split.file_stats(_records(spark, d), ["PERSON", "EMAIL", "PLACE"])
    wide = stats.groupBy("file").agg(
        F.sum(F.when(F.col("type").isNull(), F.col("n"))).alias("n"), F.map_from_entries(F.collect_list(F.when(F.col("type").isNotNull(), F.struct("type", "n")))).alias("c")
    )
    rows = wide.join(split.rarity(stats, ["PLACE"]), "file").orderBy("file").collect()  # a row a file
    dev, test, _ = split.balanced_split([(r["file"], r["n"], dict(r["c"]), round(r["rarity"], 9)) for r in rows], 0.3, ["PLACE"], 5)
    return spark.createDataFrame([(f, "dev") for f in dev] + [(f, "test") for f in test], "file string, split string")


def gold_validate(spark, d):
    return gold.validate(_records(spark, d), ["PERSON", "EMAIL"]).groupBy("code", "level").agg(F.count("*").alias("n"), F.countDistinct("id").alias("records"))


def gold_fix(spark, d):
    return gold.unnest(gold.fix(_records(spark, d))).groupBy("type").agg(F.count("*").alias("n"), F.sum("start").alias("starts"), F.sum(F.length("text")).alias("chars"))


def gold_corrections(spark, d):
    s = _spans(spark, d)
    return gold.correct(s, s.where("idx % 2 = 1")).select("id", "idx", "type")


def label_map(spark, d):
    labels = F.element_at(F.array(*[F.lit(x) for x in [*gold.LABELS, "OTHER"]]), (F.col("l_linenumber") + F.col("l_suppkey") % 6).cast("int"))
    return gold.map_labels(_t(spark, d, "lineitem").select("l_orderkey", labels.alias("label"))).groupBy("type").agg(F.count("*").alias("n"))


def dictionary_words(spark, d):
    docs = _t(spark, d, "documents")
    names = dictionary.dictionary(_t(spark, d, "benchmark").select(F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z]{7,}"), F.lit(0))).alias("name")), ascii_only=True)
    return dictionary.detect(docs, names, 1).groupBy("id").agg(F.count("*").alias("n"), F.sum("start").alias("starts"))


def dictionary_names(spark, d):
    """Longest n-grams first, over names of one to three words."""
    found = dictionary.detect(_t(spark, d, "documents"), _names(spark, d), 3)
    return found.select("id", "type", "text", F.col("start").alias("start_"), F.col("end").alias("end_"), "score", "source")


def context_snippets(spark, d):
    x = _t(spark, d, "documents").where("length(text) > 30")
    return x.select("doc_id", T.snippet(F.col("text"), (F.col("doc_id") % 20).cast("int"), (F.col("doc_id") % 20 + 6).cast("int"), 8).alias("snippet"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    each = [
        detect_entities, detect_entities_constants, gateway_detect, text_normalize, luhn_numbers, address_score, consecutive_digits, first_match_scan, document_scan, document_keywords,
        merge_overlapping, merge_adjacent, eval_pairs, eval_matches, eval_metrics, eval_misses, latency_quantiles, index_filter, page_buckets,
        index_marginals, stratified_sample, random_split, split_rarity, split_balanced, gold_validate, gold_fix, gold_corrections, label_map,
        dictionary_words, dictionary_names, context_snippets,
    ]
    return {q.__name__: q for q in each} | rule_queries.queries() | io_queries.queries() | {"patterns_constants": _patterns("constants"), "patterns_config": _patterns("config"), "patterns_lists": _patterns("lists")}


_INDEX_SQL = """i AS (
  SELECT doc_id AS line, '/c/' || doc_id AS path, n_chars * 400 AS bytes, md5(text) AS pdf_id, lang AS producer,
    CASE WHEN doc_id % 23 <> 0 THEN (doc_id % 30)::INT END AS page_count,
    CASE WHEN n_chars * 400 < 204800 THEN 'tiny' WHEN n_chars * 400 < 5242880 THEN 'normal' ELSE 'huge' END AS size_bucket
  FROM documents
)"""


def oracle_sql() -> dict[str, str]:
    signal = gateway.AddressSignals().rules()
    # the same words, with the case flag as SQL engines write it
    cases = [(n, w, f"regexp_matches(text, '{p}')") for n, w, p in signal if p]
    score = " + ".join(f"CASE WHEN {c} THEN {w} ELSE 0 END" for _, w, c in cases)
    names = "array_to_string(list_filter([" + ", ".join(f"CASE WHEN {c} THEN '{n}' END" for n, _, c in cases) + "], lambda v: v IS NOT NULL), ',')"
    first = "CASE " + " ".join(f"WHEN regexp_matches(text, '{p}') THEN {{'type': '{k}', 'score': {s}::DOUBLE, 'text': regexp_extract(text, '{p}', {g})}}" for k, s, p, g in scan.RULES) + " END"
    g, p, p3 = _spans_sql(), _spans_sql(1, 2), _spans_sql(0, 3)
    island = "sum(CASE WHEN start_ >= coalesce(reach, -1) THEN 1 ELSE 0 END) OVER (PARTITION BY id, type ORDER BY start_, end_, seq)"
    labels = ", ".join(f"'{x}'" for x in [*gold.LABELS, "OTHER"])
    label_cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in gold.LABELS.items())
    return rule_queries.oracle_sql() | io_queries.oracle_sql() | {
        "patterns_constants": _patterns_sql("constants"),
        "patterns_config": _patterns_sql("config"),
        "patterns_lists": _patterns_sql("lists"),
        "document_keywords": "SELECT doc_id AS id, array_to_string(list_filter(["
        + ", ".join(f"CASE WHEN {_any_sql('t', w)} THEN '{k}' END" for k, w in KEYWORD_LISTS.items())
        + "], lambda v: v IS NOT NULL), ',') AS types FROM (SELECT doc_id, lower(text) AS t FROM documents)",
        "text_normalize": r"""
            SELECT doc_id, length(n)::BIGINT AS n, md5(n) AS digest FROM (SELECT doc_id, regexp_replace(
              CASE WHEN ends_with(text, '-' || chr(10)) THEN replace(left(text, length(text) - 2), '-' || chr(10), '') || '-' || chr(10)
              ELSE replace(text, '-' || chr(10), '') END, '[\s\v]+', ' ', 'g') AS n FROM documents)""",
        "luhn_numbers": """
            SELECT o_orderkey, number, list_sum(list_transform(range(1, 17), lambda i: CASE WHEN i % 2 = 0 THEN number[i]::INT
              ELSE (number[i]::INT * 2) // 10 + (number[i]::INT * 2) % 10 END)) % 10 = 0 AS valid
            FROM (SELECT o_orderkey, lpad((o_orderkey * 7919 + o_custkey * 104729)::VARCHAR, 16, '4') AS number FROM orders)""",
        "address_score": f"SELECT doc_id, ({score})::INT AS score, {names} AS signals FROM (SELECT doc_id, {_ASCII} AS text FROM documents)",
        "consecutive_digits": r"""
            SELECT doc_id, len(r) > 0 AS hit, len(r)::INT AS runs FROM (
              SELECT doc_id, regexp_extract_all(regexp_replace(text, '[\s\v\-.()]', '', 'g'), '\d{5,}') AS r FROM documents)""",
        "first_match_scan": f"SELECT doc_id, m.type AS type, m.score AS score, m.text AS text FROM (SELECT doc_id, {first} AS m FROM documents) WHERE m IS NOT NULL",
        "document_scan": f"""
            WITH x AS (SELECT (doc_id % 50)::VARCHAR AS doc, row_number() OVER (PARTITION BY doc_id % 50 ORDER BY doc_id) AS n, {first} AS m FROM documents)
            SELECT doc, count(m) > 0 AS contains_pii, min_by(m.type, n) FILTER (m IS NOT NULL) AS type, (min(n) FILTER (m IS NOT NULL))::INT AS paragraph,
              count(*) AS total_paragraphs FROM x GROUP BY doc""",
        "merge_overlapping": f"""
            WITH s AS ({g}), r AS (SELECT *, max(end_) OVER (PARTITION BY id, type ORDER BY start_, end_, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM s),
            k AS (SELECT *, {island} AS island FROM r)
            SELECT id, type, min(start_) AS start_, max(end_) AS end_, 0.5::DOUBLE AS score FROM k GROUP BY id, type, island""",
        "merge_adjacent": f"""
            WITH s AS ({g}), r AS (SELECT *, lag(type) OVER w AS t, lag(end_) OVER w AS e FROM s WINDOW w AS (PARTITION BY id ORDER BY start_, seq)),
            k AS (SELECT *, sum(CASE WHEN t = type AND start_ - e <= 2 THEN 0 ELSE 1 END) OVER (PARTITION BY id ORDER BY start_, seq) AS island FROM r)
            SELECT id, min_by(seq, (start_, seq)) AS seq, min(type) AS type, min_by(text, (start_, seq)) AS text, min(start_) AS start_, max_by(end_, (start_, seq)) AS end_
            FROM k GROUP BY id, island""",
        "eval_pairs": f"""
            SELECT g.id, g.type, g.idx AS g_idx, p.idx AS p_idx,
              CASE WHEN g.type = 'SSN' THEN 1000000000 ELSE least(g.end_, p.end_) - greatest(g.start_, p.start_) END AS overlap
            FROM ({g}) g JOIN ({p}) p USING (id, type)
            WHERE CASE WHEN g.type = 'SSN' THEN g.start_ = p.start_ AND g.end_ = p.end_ ELSE least(g.end_, p.end_) > greatest(g.start_, p.start_) END""",
        "eval_matches": f"""
            WITH RECURSIVE c AS (
              SELECT g.id, g.type, g.idx AS g, p.idx AS p, row_number() OVER (PARTITION BY g.id, g.type ORDER BY CASE WHEN g.type = 'SSN' THEN 0
                ELSE greatest(g.start_, p.start_) - least(g.end_, p.end_) END, g.start_ - g.end_, g.start_, g.idx, p.idx) AS n
              FROM ({g}) g JOIN ({p}) p USING (id, type)
              WHERE CASE WHEN g.type = 'SSN' THEN g.start_ = p.start_ AND g.end_ = p.end_ ELSE least(g.end_, p.end_) > greatest(g.start_, p.start_) END),
            f AS (
              SELECT id, type, n, [g] AS gs, [p] AS ps, g, p, TRUE AS took FROM c WHERE n = 1
              UNION ALL SELECT c.id, c.type, c.n, CASE WHEN t THEN list_append(gs, c.g) ELSE gs END, CASE WHEN t THEN list_append(ps, c.p) ELSE ps END, c.g, c.p, t
              FROM (SELECT f.id, f.type, f.n, gs, ps, NOT list_contains(gs, c.g) AND NOT list_contains(ps, c.p) AS t FROM f JOIN c ON c.id = f.id AND c.type = f.type AND c.n = f.n + 1) s
              JOIN c ON c.id = s.id AND c.type = s.type AND c.n = s.n + 1)
            SELECT id, type, g AS g_idx, p AS p_idx, took AS "primary" FROM f WHERE took""",
        "eval_metrics": f"""
            WITH g AS (SELECT DISTINCT id, type, start_, end_ FROM ({g})), p AS (SELECT DISTINCT id, type, start_, end_ FROM ({p})),
            x AS (SELECT type, CASE WHEN a AND b THEN 'tp' WHEN a THEN 'fn' ELSE 'fp' END AS what FROM (
              SELECT coalesce(g.type, p.type) AS type, g.id IS NOT NULL AS a, p.id IS NOT NULL AS b
              FROM g FULL JOIN p ON g.id = p.id AND g.type = p.type AND g.start_ = p.start_ AND g.end_ = p.end_)),
            y AS (SELECT type, what FROM x UNION ALL SELECT 'micro', what FROM x UNION ALL SELECT 'person_location_micro', what FROM x WHERE type IN ('PERSON', 'LOCATION')),
            c AS (SELECT type, count(*) FILTER (what = 'tp') AS tp, count(*) FILTER (what = 'fn') AS fn, count(*) FILTER (what = 'fp') AS fp FROM y GROUP BY type),
            m AS (SELECT *, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS r, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS q FROM c)
            SELECT type, tp, fn, fp, round(r, 4) AS recall, round(q, 4) AS precision, round(CASE WHEN r + q > 0 THEN 2 * r * q / (r + q) ELSE 0 END, 4) AS f1 FROM m""",
        "eval_misses": f"""
            WITH j AS (
              SELECT g.id, g.idx, g.type = p.type AS same, p.type AS pt, greatest(least(g.end_, p.end_) - greatest(g.start_, p.start_), 0) AS shared,
                CASE WHEN p.id IS NULL THEN NULL WHEN p.end_ <= g.start_ THEN g.start_ - p.end_ WHEN p.start_ >= g.end_ THEN p.start_ - g.end_ ELSE 0 END AS gap
              FROM ({p3}) g LEFT JOIN ({p}) p ON g.id = p.id),
            a AS (SELECT id, idx, min(pt) FILTER (NOT same AND shared > 0) AS predicted_type, coalesce(bool_or(same AND shared > 0 AND shared < 3), FALSE) AS little, min(gap) AS nearest
              FROM j GROUP BY id, idx)
            SELECT id, idx, CASE WHEN predicted_type IS NOT NULL THEN 'wrong_type' WHEN little THEN 'partial_overlap'
              WHEN nearest BETWEEN 1 AND 50 THEN 'near_miss' ELSE 'no_prediction' END AS category, predicted_type, nearest::INT AS nearest FROM a""",
        "latency_quantiles": """
            SELECT round(quantile_cont(x, 0.5), 4) AS p50, round(quantile_cont(x, 0.9), 4) AS p90, round(quantile_cont(x, 0.95), 4) AS p95,
              round(quantile_cont(x, 0.99), 4) AS p99, round(avg(x), 4) AS mean, round(min(x), 4) AS min, round(max(x), 4) AS max FROM (SELECT o_totalprice::DOUBLE AS x FROM orders)""",
        "index_filter": f"""
            WITH {_INDEX_SQL}, k AS (SELECT *, row_number() OVER (PARTITION BY pdf_id ORDER BY line) AS n FROM i WHERE line % 31 <> 0 AND bytes > 0)
            SELECT line, page_count, size_bucket FROM k WHERE n = 1 AND page_count BETWEEN 2 AND 25 AND size_bucket IN ('tiny', 'normal')""",
        "page_buckets": f"""
            WITH {_INDEX_SQL} SELECT CASE WHEN page_count IS NULL THEN 'unknown' WHEN page_count = 1 THEN '1' WHEN page_count BETWEEN 2 AND 5 THEN '2-5'
              WHEN page_count BETWEEN 6 AND 20 THEN '6-20' WHEN page_count >= 21 THEN '21+' ELSE 'other' END AS bucket, size_bucket, count(*) AS n FROM i GROUP BY 1, 2""",
        "index_marginals": f"""
            WITH {_INDEX_SQL} SELECT 'producer' AS "column", producer AS value, count(*) AS n FROM i GROUP BY producer
            UNION ALL SELECT 'size_bucket', size_bucket, count(*) FROM i GROUP BY size_bucket""",
        "stratified_sample": f"""
            WITH RECURSIVE {_INDEX_SQL}, c AS (SELECT producer, size_bucket, count(*) AS n FROM i GROUP BY ALL),
            o AS (SELECT *, row_number() OVER (ORDER BY producer NULLS FIRST, size_bucket) AS place, count(*) OVER () AS strata, sum(n) OVER () AS total FROM c),
            s AS (SELECT *, row_number() OVER (ORDER BY n DESC, place) - 1 AS turn, greatest(1, round_even(n::DOUBLE / total::DOUBLE * 100, 0))::BIGINT AS share FROM o),
            l AS (SELECT *, 100 - sum(share) OVER () AS lack FROM s),
            a AS (SELECT *, share + CASE WHEN lack > turn THEN least((lack - turn - 1) // strata + 1, n - share) ELSE 0 END AS up FROM l),
            f AS (SELECT list(up ORDER BY place) AS shares, greatest(max(-lack), 0) AS over_ FROM a
              UNION ALL SELECT list_transform(shares, lambda x, k: CASE WHEN k = list_position(shares, list_max(shares)) THEN x - 1 ELSE x END), over_ - 1 FROM f WHERE over_ > 0 AND list_max(shares) > 1),
            t AS (SELECT shares FROM f ORDER BY over_ LIMIT 1),
            r AS (SELECT i.line, i.producer, i.size_bucket, row_number() OVER (PARTITION BY i.producer, i.size_bucket ORDER BY md5('0:' || i.line), i.line) AS k, least(t.shares[a.place], a.n) AS take, a.total
              FROM i JOIN a ON i.producer IS NOT DISTINCT FROM a.producer AND i.size_bucket IS NOT DISTINCT FROM a.size_bucket, t)
            SELECT line, producer, size_bucket FROM r WHERE k <= take OR total <= 100""",
        "dictionary_names": rf"""
            WITH RECURSIVE w AS (SELECT regexp_extract_all(text, '[A-Za-z]{{3,}}') AS w FROM benchmark),
            n AS (SELECT DISTINCT lower(unnest([w[1], array_to_string(w[2:3], ' '), array_to_string(w[2:4], ' ')])) AS name FROM w WHERE len(w) > 4),
            x AS (SELECT doc_id AS id, text AS t, regexp_extract_all(text, '{_TOKEN}') AS m, string_split_regex(text, '{_TOKEN}') AS b FROM documents),
            y AS (SELECT id, t, list_transform(m, lambda v: lower(v)) AS m, list_transform(m, lambda v: length(v)) AS len, list_transform(b, lambda v: length(v)) AS gap, unnest(range(1, len(m) + 1)) AS i FROM x),
            g AS (SELECT *, unnest([3, 2, 1]) AS k FROM y),
            h AS (SELECT id, t, i, k, coalesce(list_sum(gap[1:i]), 0) + coalesce(list_sum(len[1:i - 1]), 0) AS s, coalesce(list_sum(gap[i + 1:i + k - 1]), 0) + list_sum(len[i:i + k - 1]) AS size
              FROM g JOIN n ON n.name = array_to_string(m[i:i + k - 1], ' ') WHERE i + k - 1 <= len(m)),
            c AS (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY id, i ORDER BY k DESC) = 1),
            nx AS (SELECT c.*, d.i AS next FROM c ASOF LEFT JOIN (SELECT id, i FROM c) d ON c.id = d.id AND c.i + c.k <= d.i),
            f AS (SELECT * FROM nx QUALIFY row_number() OVER (PARTITION BY id ORDER BY i) = 1 UNION ALL SELECT nx.* FROM f JOIN nx ON nx.id = f.id AND nx.i = f.next)
            SELECT id, 'PERSON' AS type, substr(t, s::INT + 1, size::INT) AS text, s::INT AS start_, (s + size)::INT AS end_, 0.85::DOUBLE AS score, 'dictionary' AS source FROM f""",
        "random_split": """
            WITH f AS (SELECT (doc_id % 40)::VARCHAR AS file, count(*) AS n FROM documents GROUP BY 1)
            SELECT file, n, CASE WHEN coalesce(sum(n) OVER (ORDER BY md5('5:' || file), file ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
              < (SELECT sum(n) FROM f) * 0.3 THEN 'dev' ELSE 'test' END AS split FROM f""",
        "split_rarity": f"""
            WITH {_RECORDS_SQL}, c AS (SELECT (n % 40)::VARCHAR AS file, type, count(*) AS k FROM e GROUP BY 1, 2),
            w AS (SELECT type, 1.0::DOUBLE / (sum(k)::BIGINT + 1) * CASE type WHEN 'PLACE' THEN 5 ELSE 1 END AS w FROM c GROUP BY type)
            SELECT file, round(sum(k * w), 9) AS rarity FROM c JOIN w USING (type) GROUP BY file""",
        "split_balanced": f"""
            WITH RECURSIVE {_RECORDS_SQL}, c AS (SELECT (n % 40)::VARCHAR AS file, type, count(*) AS k FROM e GROUP BY 1, 2),
            w AS (SELECT type, 1.0::DOUBLE / (sum(k)::BIGINT + 1) * CASE type WHEN 'PLACE' THEN 5 ELSE 1 END AS w FROM c GROUP BY type),
            q AS (SELECT file, round(sum(k * w), 9) AS rarity FROM c JOIN w USING (type) GROUP BY file),
            o AS (SELECT f.file, f.n, coalesce(c.k, 0) AS k, row_number() OVER (ORDER BY coalesce(rarity, 0) DESC, f.file DESC) AS i
              FROM (SELECT (n % 40)::VARCHAR AS file, count(*) AS n FROM r GROUP BY 1) f LEFT JOIN q ON q.file = f.file LEFT JOIN c ON c.file = f.file AND c.type = 'PLACE'),
            s AS (SELECT 0::BIGINT AS i, 0::BIGINT AS dn, 0::BIGINT AS tn, 0::BIGINT AS dk, 0::BIGINT AS tk, NULL::VARCHAR AS file, FALSE AS dev, 0::BIGINT AS n, 0::BIGINT AS k
              UNION ALL SELECT i, CASE WHEN d THEN dn + n ELSE dn END, CASE WHEN d THEN tn ELSE tn + n END, CASE WHEN d THEN dk + k ELSE dk END, CASE WHEN d THEN tk ELSE tk + k END, file, d, n, k
              FROM (SELECT o.*, dn, tn, dk, tk,
                100 * abs((dn + o.n)::DOUBLE / (dn + tn + o.n) - 0.3::DOUBLE) + CASE WHEN tk < 5 THEN 50 ELSE 0 END + CASE WHEN dk + tk + o.k > 0 THEN 10 * abs((dk + o.k)::DOUBLE / (dk + tk + o.k) - 0.3::DOUBLE) ELSE 0 END
                <= 100 * abs(dn::DOUBLE / (dn + tn + o.n) - 0.3::DOUBLE) + CASE WHEN tk + o.k < 5 THEN 50 ELSE 0 END + CASE WHEN dk + tk + o.k > 0 THEN 10 * abs(dk::DOUBLE / (dk + tk + o.k) - 0.3::DOUBLE) ELSE 0 END AS d
                FROM s JOIN o ON o.i = s.i + 1)),
            moved AS (SELECT file FROM s WHERE dev AND k > 0 AND (SELECT arg_max(tk, i) FROM s) < 5 ORDER BY n, i LIMIT 1)
            SELECT file, CASE WHEN dev AND file NOT IN (SELECT file FROM moved) THEN 'dev' ELSE 'test' END AS split FROM s WHERE file IS NOT NULL""",
        "gold_validate": rf"""
            WITH {_RECORDS_SQL}, k AS (
              SELECT id, unnest([
                CASE WHEN type NOT IN ('PERSON', 'EMAIL') THEN 'INVALID_TYPE' END,
                CASE WHEN e IS NULL THEN 'INVALID_OFFSETS' END,
                CASE WHEN e IS NOT NULL AND NOT (s < e AND e <= len) THEN 'BAD_OFFSETS' END,
                CASE WHEN s < e AND e <= len AND regexp_matches(substr(text, s + 1, e - s), '^\s|\s$') THEN 'WHITESPACE_SPAN' END,
                CASE WHEN s < e AND e <= len AND e - s < 2 AND type = 'PERSON' THEN 'SHORT_SPAN' END,
                CASE WHEN s < e AND e <= len AND contains(substr(text, s + 1, e - s), chr(10)) THEN 'NEWLINE_IN_SPAN' END,
                CASE WHEN i = 1 AND n % 5 = 0 AND e IS NOT NULL THEN 'DUPLICATE_ENTITY' END]) AS code FROM e)
            SELECT code, CASE WHEN code IN ('SHORT_SPAN', 'NEWLINE_IN_SPAN', 'DUPLICATE_ENTITY') THEN 'WARNING' ELSE 'ERROR' END AS level, count(*) AS n, count(DISTINCT id) AS records
            FROM k WHERE code IS NOT NULL GROUP BY code""",
        "gold_fix": rf"""
            WITH {_RECORDS_SQL}, k AS (SELECT *, e IS NOT NULL AND s < e AND e <= len AS ok, substr(text, s + 1, e - s) AS span FROM e),
            h AS (SELECT *, length(regexp_extract(span, '^\s*')) AS head, length(regexp_extract(span, '\s*$')) AS tail FROM k),
            m AS (SELECT *, ok AND s + head < e - tail AS moves FROM h),
            f AS (SELECT id, n, i, type, ok, CASE WHEN moves THEN s + head ELSE s END AS s2, CASE WHEN moves THEN e - tail ELSE e END AS e2 FROM m)
            SELECT type, count(*) AS n, sum(s2)::BIGINT AS starts, (sum(e2 - s2) FILTER (ok))::BIGINT AS chars FROM f WHERE NOT (ok AND i = 1 AND n % 5 = 0) GROUP BY type""",
        "dictionary_words": rf"""
            WITH n AS (SELECT DISTINCT lower(unnest(regexp_extract_all(text, '[A-Za-z]{{7,}}'))) AS name FROM benchmark),
            x AS (SELECT doc_id AS id, regexp_extract_all(text, '{_TOKEN}') AS m, string_split_regex(text, '{_TOKEN}') AS b FROM documents),
            y AS (SELECT id, m, b, unnest(range(1, len(m) + 1)) AS i FROM x),
            z AS (SELECT id, lower(m[i]) AS name, list_sum(list_transform(b[1:i], lambda v: length(v))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda v: length(v))), 0) AS s FROM y)
            SELECT id, count(*) AS n, sum(s)::BIGINT AS starts FROM z JOIN n USING (name) GROUP BY id""",
        "gold_corrections": f"""
            WITH s AS ({g}) SELECT id, idx, type FROM s a WHERE NOT EXISTS (
              SELECT 1 FROM s b WHERE b.idx % 2 = 1 AND a.id = b.id AND a.type = b.type AND a.start_ = b.start_ AND a.end_ = b.end_)""",
        "label_map": f"""
            SELECT type, count(*) AS n FROM (SELECT CASE [{labels}][l_linenumber + l_suppkey % 6] {label_cases} END AS type FROM lineitem) WHERE type IS NOT NULL GROUP BY type""",
        "context_snippets": """
            SELECT doc_id, substr(text, greatest(s - 8, 0) + 1, least(s, 8)) || '[[' || substr(text, s + 1, 6) || ']]' || substr(text, s + 7, 8) AS snippet
            FROM (SELECT doc_id, text, (doc_id % 20)::INT AS s FROM documents WHERE length(text) > 30)""",
    }
