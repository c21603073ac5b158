"""First-match scan of paragraphs for personal data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import FLAGS

# The scan's patterns, in order of priority: type, score, pattern, group.
STREETS = "St|Street|Rd|Road|Ave|Avenue|Blvd|Boulevard|Lane|Ln|Drive|Dr|Way|Court|Ct|Place|Pl|Circle|Cir"
RULES = (
    ("SSN", 1.0, r"\b\d{3}-\d{2}-\d{4}\b", 0),
    ("EMAIL", 1.0, r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b", 0),
    ("PHONE", 0.8, r"(?:\b\d{3}[-.]?\d{3}[-.]?\d{4}\b)|(?:\(\d{3}\)\s*\d{3}[-.]?\d{4})", 0),
    ("PERSON_CTX", 0.8, r"\b(Name|Employee|Beneficiary|Customer)\s*:\s*([A-Z][a-z]+(?:\s+[A-Z][a-z]+)+)", 2),
    ("ADDRESS_CTX", 0.8, rf"(?i)\b(Address|Residing at)\s*:\s*(\d+\s+[A-Za-z0-9. ]+(?:{STREETS})\b|[^,\n]{{5,50}}\d{{5}}(?:-\d{{4}})?)", 2),
    (
        "DATE", 0.5,
        r"\b(?:0[1-9]|1[0-2])/(?:0[1-9]|[12]\d|3[01])/(?:19|20)\d{2}\b|\b(?:19|20)\d{2}-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12]\d|3[01])\b", 0,
    ),
)
# End of the fixed values.


def first_match(text: Column, threshold: float = 0.0) -> Column:
    """struct<type,score,text> of the first rule that hits, else null; the threshold can only keep dates out."""
    out = None
    for kind, score, pattern, group in RULES:
        if kind == "DATE" and score < threshold:
            continue
        p = FLAGS + pattern
        hit = F.struct(F.lit(kind).alias("type"), F.lit(score).alias("score"), F.regexp_extract(text, p, group).alias("text"))
        out = F.when(text.rlike(p), hit) if out is None else out.when(text.rlike(p), hit)
    return out


def scan_documents(paragraphs: DataFrame, threshold: float = 0.0, max_paragraphs: int | None = None) -> DataFrame:
    """doc, contains_pii, match, paragraph (1-based, in path order), total_paragraphs of (doc, path, text) rows."""
    # the text is matched where it is read; only the match goes on
    rows = paragraphs.select("doc", "path", first_match(F.col("text"), threshold).alias("m"))
    rows = rows.withColumn("n", F.row_number().over(Window.partitionBy("doc").orderBy("path")))
    if max_paragraphs:
        rows = rows.where(F.col("n") <= max_paragraphs)
    hit = F.struct("n", "path", "m")
    return rows.groupBy("doc").agg(
        F.count("*").alias("total_paragraphs"), F.min_by(hit, F.when(F.col("m").isNotNull(), F.col("n"))).alias("first"),
        F.max(F.col("m").isNotNull()).alias("contains_pii"),
    ).select(
        "doc", "contains_pii", F.when(F.col("contains_pii"), F.col("first.m")).alias("match"),
        F.when(F.col("contains_pii"), F.col("first.n")).alias("paragraph"), "total_paragraphs",
    )


def report(scans: DataFrame, failures: DataFrame | None = None) -> DataFrame:
    """Scan rows as report records; ``failures`` (doc, error) become extract_error rows."""
    ok = scans.select(
        F.col("doc").alias("pdf"), F.lit("ok").alias("status"), "contains_pii", "match",
        F.struct(F.col("total_paragraphs")).alias("stats"), F.lit(None).cast("string").alias("error"),
    )
    if failures is None:
        return ok
    bad = failures.select(F.col("doc").alias("pdf"), F.lit("extract_error").alias("status"), F.right("error", F.lit(1000)).alias("error"))
    return ok.unionByName(bad, allowMissingColumns=True)


def resume(documents: DataFrame, report_rows: DataFrame, key: str = "pdf") -> DataFrame:
    """Documents that the report does not have yet."""
    return documents.join(report_rows.select(key).distinct(), key, "left_anti")
