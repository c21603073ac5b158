"""Whole runs of evaluation and curation by their options: what comes out, and a report of counts.

Reports are dicts of aggregates, a few rows a type or stratum each; everything else stays a DataFrame.
"""

from __future__ import annotations

import dataclasses
import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import evaluate, gold, ordering, sampling, split
from ..options import EvalOptions, SampleOptions, SplitOptions, ValidateOptions
from ..sources import shared
from ..sources.writers import append_dumps

MOST_TEXTS, MOST_DOCUMENTS = 20, 20


def counts(rows: DataFrame, *keys: str) -> dict:
    """Nested counts of a small table with columns keys and n."""
    out: dict = {}
    for r in rows.orderBy(*keys).collect():
        at = out
        for k in keys[:-1]:
            at = at.setdefault(str(r[k]), {})
        at[str(r[keys[-1]])] = r["n"]
    return out


# --- evaluation


@dataclass
class Evaluation:
    """Frames of an evaluation run. Spans and misses carry ``place``, their record's number in the order of the run."""

    options: EvalOptions
    records: int
    metrics: DataFrame
    matches: DataFrame
    misses: DataFrame
    false_positives: DataFrame
    meta: dict

    def tables(self) -> dict[str, DataFrame]:
        return evaluate.miss_tables(self.misses, self.matches, MOST_DOCUMENTS)

    def examples(self) -> DataFrame:
        """The first ``max_examples`` misses of each category."""
        order = Window.partitionBy("category").orderBy("place", "start", "end", "idx")
        rows = self.misses.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= self.options.max_examples)
        return rows.drop("_n")

    def report(self) -> dict:
        """{meta, by_type, micro, person_location_micro}."""
        rows = {r["type"]: {k: r[k] for k in ("tp", "fn", "fp", "recall", "precision", "f1")} for r in self.metrics.collect()}
        none = {"tp": 0, "fn": 0, "fp": 0, "recall": 0.0, "precision": 0.0, "f1": 0.0}
        aggregates = {k: rows.pop(k, none) for k in ("micro", "person_location_micro")}
        return {"meta": self.meta | {"records": self.records, "match": self.options.match}, "by_type": {t: rows.get(t, none) for t in sorted(self.options.types)}} | aggregates

    def miss_report(self) -> dict:
        """Counts of misses by category, length and text, the documents with most, and examples."""
        t = self.tables()
        top = Window.partitionBy("type").orderBy(F.desc("n"), "text")
        texts = t["text"].withColumn("_n", F.row_number().over(top)).where(F.col("_n") <= MOST_TEXTS)
        return {
            "by_category": counts(t["category"], "category", "type"), "by_length": counts(t["length"], "length", "type"),
            "common_texts": {k: dict(sorted(v.items(), key=lambda x: -x[1])) for k, v in counts(texts, "type", "text").items()},
            "per_document": [r.asDict() for r in t["documents"].collect()],
            "examples": [r.asDict() for r in self.examples().select("id", "type", "category", "text", "context", "predicted_type", "nearest").collect()],
        }

    def write(self, folder: str, write_fp: bool = False, batch: int = 0, every: int = 0) -> None:
        """Error dumps by type below ``folder``: at most ``max_errors`` a type, over all batches; see ``append_dumps``."""
        append_dumps(self.misses, f"{folder}/fn", self.options.max_errors, batch, every)
        if write_fp:
            append_dumps(self.false_positives, f"{folder}/fp", self.options.max_errors, batch, every, whole_records=True)

    def markdown(self) -> str:
        return "\n".join(evaluate.markdown(table, title) for title, table in self._sections())

    def html(self) -> str:
        body = "".join(evaluate.html_table(table, title) for title, table in self._sections())
        return f"<!doctype html><html><head><meta charset='utf-8'><title>Evaluation</title></head><body>{body}</body></html>"

    def _sections(self) -> list[tuple[str, DataFrame]]:
        t = self.tables()
        return [
            ("Metrics", self.metrics.orderBy("type")), ("Misses by category", t["category"].orderBy("category", "type")), ("Misses by length", t["length"].orderBy("length", "type")),
            ("Common missed texts", t["text"].orderBy(F.desc("n"), "type", "text").limit(MOST_TEXTS)), ("Documents with most misses", t["documents"]),
            ("Examples", self.examples().select("category", "type", "id", "context").orderBy("category", "type", "id", "context")),
        ]


def evaluation(
    records: DataFrame, predictions: DataFrame, options: EvalOptions | None = None, ids: DataFrame | None = None, files: DataFrame | None = None,
    corrections: DataFrame | None = None, meta: dict | None = None,
) -> Evaluation:
    """Evaluates predictions (id, type, start, end, text) against annotated records (id, text, entities) that are selected by id or file.

    Records come in the order of their file where they tell lines (file, n), else by id. Only texts that a
    context is cut from are joined, and only their ids are ordered.
    """
    options = options or EvalOptions()
    chosen = evaluate.select_records(records, ids, files, options.max_records or None)
    order = [F.col("file"), F.col("n")] if {"file", "n"} <= set(records.columns) else [F.col("id")]
    places = ordering.numbered(chosen.select(*dict.fromkeys(["id", *[c for c in ("file", "n") if c in records.columns]])), order, name="place").select("id", "place")
    places = shared.cut(places)
    kept = F.col("type").isin(*options.types)
    g = gold.unnest(chosen.select("id", "entities")).where(kept).select("id", "idx", "type", "start", "end", "text")
    if corrections is not None:
        g = gold.correct(g, corrections).select("id", "idx", "type", "start", "end", "text")
    number = F.row_number().over(Window.partitionBy("id").orderBy("start", "end", "type", "text")) - 1
    p = predictions.select("id", "type", "start", "end", "text").join(places.select("id"), "id", "left_semi").where(kept).withColumn("idx", number)
    g, p = shared.cut(g), shared.cut(p.select("id", "idx", "type", "start", "end", "text"))
    matches = shared.cut(evaluate.match(g, p, options.match, options.overlap_min_chars))
    fn, fp = evaluate.outcomes(g, p, matches)
    missed = evaluate.misses(fn, p, options.match, options.overlap_min_chars, options.proximity)
    texts = chosen.select("id", F.col("text").alias("_text")).dropDuplicates(["id"])

    def shown(rows: DataFrame) -> DataFrame:
        at = rows.join(places, "id").join(texts, "id")
        near = T.snippet(F.col("_text"), F.col("start"), F.col("end"), options.context)
        own = F.substring("_text", F.col("start") + 1, F.col("end") - F.col("start"))
        return shared.cut(at.withColumns({"context": near, "text": F.coalesce("text", own)}).drop("_text"))

    return Evaluation(options, places.count(), shared.cut(evaluate.metrics(g, p, matches)), matches, shown(missed), shown(fp), meta or {})


# --- samples of a corpus index


def sample(index: DataFrame, options: SampleOptions, exclude: DataFrame | None = None, line_col: str = "line") -> tuple[DataFrame, dict]:
    """(chosen records, report) of a corpus index.

    Without a preference for text all usable records are one pool; with it, scanned ones and those with text are, and others are only counted. A
    pool gives its quota over strata of size, pages and family.
    """
    rows = sampling.index_filter(index, options.min_pages, options.max_pages, options.size_buckets, exclude, options.allow_duplicates, line_col)
    rows = rows.withColumns({"page_bucket": T.page_bucket(F.col("page_count"), options.page_buckets), "family": T.family(F.col("producer"), F.col("creator"))})
    rows = shared.cut(rows.withColumn("pool", sampling.pool(options.prefer_text)))
    strata = ["size_bucket", "page_bucket", "family"]
    scanned, text = sampling.quota(options.n, options.scanned_share)
    wanted = {"scanned": scanned, "text": text} if options.prefer_text else {"all": options.n}
    parts = [sampling.stratified_sample(rows.where(F.col("pool") == k), strata, n, line_col, options.seed) for k, n in wanted.items() if n > 0]
    chosen = rows.where("false")
    for part in parts:
        chosen = chosen.unionByName(part)
    chosen = shared.cut(chosen)
    tally = lambda df, c: counts(df.groupBy(F.col(c).cast("string").alias(c)).agg(F.count("*").alias("n")), c)
    named = {"producer_family": "family", "size_bucket": "size_bucket", "page_bucket": "page_bucket", "likely_scanned": "likely_scanned"}
    both = rows.groupBy(*strata, "pool").agg(F.count("*").alias("available")).join(chosen.groupBy(*strata, "pool").agg(F.count("*").alias("selected")), [*strata, "pool"])
    report = {
        "total_kept": rows.count(), **{f"by_{k}": tally(rows, c) for k, c in (("family", "family"), ("size", "size_bucket"), ("page", "page_bucket"), ("scanned", "likely_scanned"))},
        "n_selected": chosen.count(),
        "bucket_counts": {"|".join([*(str(r[s]) for s in strata), str(r["pool"] == "scanned")]): {"available": r["available"], "selected": r["selected"]} for r in both.collect()},
        "marginals": {k: tally(chosen, c) for k, c in named.items()},
    }
    return chosen, report


def sample_list(chosen: DataFrame, options: SampleOptions) -> DataFrame:
    """(value): the wanted field of chosen records, those without it left out, in an order that mixes strata."""
    field = F.col(options.output_field).cast("string")
    return chosen.where(field.isNotNull() & (field != "")).orderBy(sampling.order_key(options.output_field, seed=options.seed)).select(field.alias("value"))


# --- split of annotated records


def split_gold(records: DataFrame, types: list[str], options: SplitOptions | None = None, balanced: bool = True) -> tuple[DataFrame, dict]:
    """((file, n, split), report): files of annotated records (id, entities) to dev and test, by costs or at random."""
    options = options or SplitOptions()
    stats = shared.cut(split.file_stats(records, types))
    files = stats.where("type is null").select("file", "n")
    warnings: list[str] = []
    if balanced:
        typed = stats.where("type is not null").groupBy("file").agg(F.map_from_entries(F.collect_list(F.struct("type", "n"))).alias("c"))
        rows = files.join(typed, "file", "left").join(split.rarity(stats, list(options.rare_types)), "file").collect()  # a row a file: the rule is sequential
        each = [(r["file"], r["n"], dict(r["c"] or {}), r["rarity"]) for r in rows]
        dev, _, warnings = split.balanced_split(each, options.dev_ratio, list(options.rare_types), options.min_positives)
        chosen = files.join(records.sparkSession.createDataFrame([(f,) for f in dev], "file string").withColumn("split", F.lit("dev")), "file", "left")
        chosen = chosen.withColumn("split", F.coalesce("split", F.lit("test")))
    else:
        chosen = split.random_split(files, options.dev_ratio, options.seed)
    chosen = shared.cut(chosen)
    table = counts(split.coverage(stats, chosen), "split", "type")
    part = lambda s: {
        "files": table.get(s, {}).get("_files", 0), "records": table.get(s, {}).get("_records", 0),
        "counts": {k: v for k, v in table.get(s, {}).items() if not k.startswith("_")},
    }
    dev, test = part("dev"), part("test")
    test["rare_coverage"] = {t: test["counts"].get(t, 0) for t in options.rare_types}
    meta = {"seed": options.seed, "mode": "balanced" if balanced else "random", "dev_ratio": options.dev_ratio}
    meta |= {"total_files": dev["files"] + test["files"], "total_records": dev["records"] + test["records"]}
    return chosen, {"meta": meta, "splits": {"dev": dev, "test": test}, "warnings": warnings}


# --- checks of annotated lines


def validate(lines: DataFrame, options: ValidateOptions | None = None) -> tuple[DataFrame, dict]:
    """(issues, report) of JSON lines (n, value); ``report["exit_code"]`` is 1 where the options say that the file is not good."""
    options = options or ValidateOptions()
    issues = shared.cut(gold.validate_lines(lines, list(options.types), options.require_text))
    records = gold.typed(lines)
    summary = {r["code"]: r["n"] for r in gold.summary(issues).where("code is not null").collect()}
    of_records = issues.where("code <> 'JSON_PARSE_ERROR'")
    found = {
        "total_records": records.count(), "total_entities": records.agg(F.sum(F.coalesce(F.size("entities"), F.lit(0)))).first()[0] or 0,
        "records_with_errors": of_records.select("id").distinct().count(), "error_counts": summary,
    }
    return issues, {"summary": found, "exit_code": gold.exit_code(issues, options.max_errors, options.strict), "options": dataclasses.asdict(options)}


def report_row(spark, report: dict) -> DataFrame:
    """(value): a report as one JSON document, to be written as text."""
    return spark.createDataFrame([(json.dumps(report, ensure_ascii=False),)], "value string")
