"""Quality rules as a bitmask ledger.

Every rule is evaluated once for a document. The ledger keeps the measurements and a mask of failed
rules (bit r for rule r). A policy is a versioned set of rules, so applying one is one bitwise test on
the ledger, and what each rule costs (ablation) is a count over the distinct masks.
"""

from __future__ import annotations

from collections import Counter
from operator import eq

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_rows

SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\v\f\r"
#: Bytes that are no part of a letter: all of ASCII but A-Z and a-z.
NO_LETTER = bytes(i for i in range(128) if not chr(i).isalpha())

#: Rules in bit order: name, SQL condition over the measurements that means failure.
RULES: list[tuple[str, str]] = [
    ("few_words", "n_words < 10"),
    ("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    ("symbols", "10 * n_symbols > 3 * n_words"),
    ("duplicate_lines", "2 * n_dup_lines > n_lines"),
    ("word_length", "word_chars < 2 * n_words or word_chars > 14 * n_words"),
    ("few_letters", "2 * n_letter_bytes < n_word_bytes"),
    ("echoes", "10 * n_echo_words > 3 * n_words"),
]
BIT = {name: i for i, (name, _) in enumerate(RULES)}
#: Versions of the policy: which rules reject. A version is never changed, only added.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_windows"),
    "v1": ("few_words", "repeated_windows", "symbols", "duplicate_lines", "word_length", "few_letters", "echoes"),
}
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_word_bytes", "n_letter_bytes", "n_echo_words"]


def mask(version: str) -> int:
    return sum(1 << BIT[r] for r in POLICIES[version])


def repeated_words(words: list[bytes], width: int = 5) -> int:
    """Words that lie in a window of ``width`` words found twice or more, the first one included."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    windows = list(zip(*(words[i:] for i in range(width)), strict=False))
    if len(set(windows)) == n:
        return 0
    count = Counter(windows)
    hit = np.fromiter((count[w] > 1 for w in windows), np.int64, n)
    edge = np.zeros(len(words) + 1, np.int64)
    edge[:n] += hit
    edge[width : width + n] -= hit
    return int((np.cumsum(edge) > 0).sum())


def measure(text: str | None) -> tuple[int, ...]:
    """The measurements of a whole text, in the order of MEASURES; null counts as empty."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    blank = sum(raw.count(bytes((c,))) for c in BLANKS)
    return (
        len(words),
        len(text) - blank,
        sum(raw.count(bytes((c,))) for c in SYMBOLS),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        len(raw) - blank,
        len(raw.translate(None, NO_LETTER)),
        sum(map(eq, words, words[1:])),
    )


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """id, the columns of ``keep``, measurements and the mask ``failed`` of every row.

    Null, empty and blank texts measure 0 everywhere, so they fail few_words alone. Ids may be null
    or repeated. Columns that are not named are not read; an empty table gives an empty ledger.
    """
    keep = keep or []

    def run(batches):
        for b in batches:
            found = np.array([measure(t) for t in b[text_col]], np.int64).reshape(-1, len(MEASURES))
            yield {c: b[c] for c in dict.fromkeys([id_col, *keep])} | {m: found[:, i] for i, m in enumerate(MEASURES)}

    columns = list(dict.fromkeys([id_col, *keep]))
    if clash := set(columns) & {*MEASURES, "failed"}:
        raise ValueError(f"columns {sorted(clash)} would clash with the ledger's own")
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns)
    schema = kinds + ", " + ", ".join(f"{m} long" for m in MEASURES)
    out = map_rows(docs, list(dict.fromkeys([*columns, text_col])), schema, run)
    bits = [F.when(F.expr(rule), F.lit(1 << i)).otherwise(F.lit(0)) for i, (_, rule) in enumerate(RULES)]
    failed = bits[0]
    for bit in bits[1:]:
        failed = failed.bitwiseOR(bit)
    return out.withColumn("failed", failed.cast("long"))


def passes(version: str) -> Column:
    """Whether a ledger row passes a policy."""
    return F.col("failed").bitwiseAND(F.lit(mask(version)).cast("long")) == 0


def ablation(rows: DataFrame, version: str) -> DataFrame:
    """By rule of a policy: rows that fail it, that fail nothing else, and that stay rejected without it."""
    m = mask(version)
    seen = rows.groupBy(F.col("failed").bitwiseAND(F.lit(m).cast("long")).alias("bits")).count()
    parts = F.explode(
        F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(1 << BIT[r]).cast("long").alias("bit")) for r in POLICIES[version]])
    )
    n = F.col("count")
    hit = F.col("bits").bitwiseAND(F.col("p.bit")) != 0
    rest = F.col("bits").bitwiseAND(F.bitwise_not("p.bit")) != 0
    return (
        seen.select("bits", "count", parts.alias("p"))
        .groupBy(F.col("p.rule").alias("rule"))
        .agg(
            F.coalesce(F.sum(F.when(hit, n)), F.lit(0)).alias("failed"),
            F.coalesce(F.sum(F.when(hit & ~rest, n)), F.lit(0)).alias("failed_alone"),
            F.coalesce(F.sum(F.when(rest, n)), F.lit(0)).alias("rejected_without"),
        )
    )


def report(docs: DataFrame, version: str = "v1") -> DataFrame:
    """doc_id, n_words, the four base measurements, base_failed, kept, and the mask."""
    return ledger(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~passes("base")).alias("base_failed"),
        (passes("base") & passes(version)).alias("kept"),
        "failed",
    )


#: The report in SQL.
REPORT_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
win AS (SELECT r, i, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)),
dup AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM win) WHERE n > 1),
cov AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest([i, i + 1, i + 2, i + 3, i + 4]) AS j FROM dup) GROUP BY r),
lines AS (SELECT r, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
m AS (
  SELECT doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(cov.n, 0) AS n_repeat_words, len(l) AS n_lines,
    coalesce(list_sum(list_transform(w, lambda x: strlen(x))), 0)::BIGINT AS n_word_bytes,
    strlen(regexp_replace(text, '[\x00-\x40\x5B-\x60\x7B-\x7F]', '', 'g')) AS n_letter_bytes,
    len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS n_echo_words
  FROM d JOIN lines USING (r) LEFT JOIN cov USING (r)
),
f AS (
  SELECT *, (CASE WHEN n_words < 10 THEN 1 ELSE 0 END) + (CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END)
    + (CASE WHEN 10 * n_symbols > 3 * n_words THEN 4 ELSE 0 END) + (CASE WHEN 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END)
    + (CASE WHEN word_chars < 2 * n_words OR word_chars > 14 * n_words THEN 16 ELSE 0 END)
    + (CASE WHEN 2 * n_letter_bytes < n_word_bytes THEN 32 ELSE 0 END)
    + (CASE WHEN 10 * n_echo_words > 3 * n_words THEN 64 ELSE 0 END) AS failed FROM m
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
  n_repeat_words::BIGINT AS n_repeat_words, failed & 3 <> 0 AS base_failed, failed = 0 AS kept, failed::BIGINT AS failed
FROM f
"""
