"""Scalar text functions as column expressions. Offsets are code points, as ``length`` counts them."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as ``str.isspace`` has it.
SPACE = r"[\s\x1c-\x1f\x85\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
#: Unicode classes, and a dot that stops at \n alone.
FLAGS = "(?Ud)"


def normalize_text(text: Column) -> Column:
    """Drops ``-\\n`` before a further character, turns white space runs into one space; no trim."""
    return F.regexp_replace(F.regexp_replace(text, r"-\n(?=[\s\S])", ""), f"{FLAGS}{SPACE}+", " ")


def is_zip_like(text: Column) -> Column:
    return text.rlike(r"\A\d{5}(?:-\d{4})?\z")


def is_postal_4(text: Column) -> Column:
    return text.rlike(r"\A\d{4}\z")


def is_ssn_format(text: Column) -> Column:
    return text.rlike(r"\A(?:\d{3}-\d{2}-\d{4}|\d{3} \d{2} \d{4}|\d{3}\.\d{2}\.\d{4})\z")


def digits_joined(text: Column) -> Column:
    return F.regexp_replace(text, FLAGS + r"[\s\-.()]", "")


def has_consecutive_digits(text: Column, least: int = 5) -> Column:
    return digits_joined(text).rlike(rf"{FLAGS}\d{{{least},}}")


def find_consecutive_digits(text: Column, least: int = 5) -> Column:
    return F.regexp_extract_all(digits_joined(text), F.lit(rf"{FLAGS}\d{{{least},}}"), F.lit(0))


def is_luhn_valid(text: Column, least: int = 13, most: int = 19) -> Column:
    digits = F.regexp_replace(text, r"\D", "")
    return F.length(digits).between(least, most) & F.coalesce(F.call_function("luhn_check", digits), F.lit(False))


def contains_any(text: Column, words: tuple[str, ...] | list[str]) -> Column:
    """Whether any of the words is a substring: one alternation, which keeps generated code small."""
    if not words:
        return F.lit(False)
    return text.rlike("|".join(rf"\Q{w}\E" for w in words))


# Fixed value: marks that are taken off the ends of a name.
EDGE = "\"'.,;:!?()[]{}<>"
# End of the fixed value.


def normalized_name(name: str) -> str:
    """A name in plain Python: NFKC, casefold, white space runs to one space, marks off the ends."""
    if name.isascii():
        return " ".join(name.lower().split()).strip(EDGE)
    import unicodedata

    return " ".join(unicodedata.normalize("NFKC", name).casefold().split()).strip(EDGE)


def _normalize_any(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in batches:
        yield s.map(lambda x: None if x is None else normalized_name(x))


def normalize_name(name: Column, ascii_only: bool = False) -> Column:
    """NFKC, casefold, white space runs to one space, marks off the ends.

    With ``ascii_only`` as an expression of built-in functions, right for ASCII names; else by an
    Arrow UDF, since Spark has neither NFKC nor casefold.
    """
    if not ascii_only:
        return F.pandas_udf(_normalize_any, "string")(name)
    return F.btrim(F.btrim(F.regexp_replace(F.lower(name), r"\s+", " "), F.lit(" ")), F.lit(EDGE))


# Fixed value: a token of a name.
TOKEN = r"[A-Za-z0-9À-ɏ]+(?:[-'][A-Za-z0-9À-ɏ]+)*"
# End of the fixed value.


def clean_label_text(text: Column) -> Column:
    return F.btrim(F.regexp_replace(text, f"{FLAGS}{SPACE}+", " "))


def family(producer: Column, creator: Column) -> Column:
    """Family of the program that made a file; the first that fits."""
    both = F.lower(F.concat(F.coalesce(producer, F.lit("")), F.lit(" "), F.coalesce(creator, F.lit(""))))
    return (
        F.when(F.btrim(both) == "", "UNKNOWN")
        .when(contains_any(both, ("acrobat", "distiller", "adobe", "pdf library")), "ACROBAT")
        .when(contains_any(both, ("word", "microsoft", "office")), "WORD")
        .when(contains_any(both, ("indesign",)), "INDESIGN")
        .when(contains_any(both, ("scan", "canon", "epson", "fujitsu", "image capture")), "SCANNER")
        .otherwise("OTHER")
    )


def size_bucket(size: Column) -> Column:
    return F.when(size < 200 * 1024, "tiny").when(size < 5 * 1024 * 1024, "normal").otherwise("huge")


def page_buckets(spec: str) -> list[tuple[str, int, int | None]]:
    """``1,2-5,6-20,21+`` as (name, first, last); parts that are no range are passed over."""
    out = []
    for part in (p.strip() for p in spec.split(",")):
        try:
            if part.endswith("+"):
                out.append((part, int(part[:-1]), None))
            elif "-" in part:
                first, last = part.split("-", 1)
                out.append((part, int(first), int(last)))
            elif part:
                out.append((part, int(part), int(part)))
        except ValueError:
            continue
    return out


def page_bucket(pages: Column, spec: str, missing: str = "unknown", missing_below_one: bool = False) -> Column:
    """Name of the first range that holds the page count, ``missing`` for null, else "other"."""
    none = pages.isNull() | (pages <= 0) if missing_below_one else pages.isNull()
    out = F.when(none, missing)
    for name, first, last in page_buckets(spec):
        out = out.when(pages >= first if last is None else pages.between(first, last), name)
    return out.otherwise("other")


def scan_score(has_text: Column, images: Column, large_images: Column, size: Column, pages: Column) -> Column:
    score = (
        F.lit(0.6)
        + F.when(images > 0, 0.3).otherwise(0.0)
        + F.when(large_images > 0, 0.1).otherwise(0.0)
        + F.when((pages > 0) & (size / pages > 500_000), 0.1).otherwise(0.0)
    )
    return F.when(has_text, 0.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), score)))


def file_hash(content: Column) -> Column:
    return F.sha1(content)


def stat_hash(path: Column, size: Column, mtime: Column) -> Column:
    """Stands in for a file's hash where its content can't be read."""
    return F.sha1(F.concat(path, size.cast("string"), mtime.cast("string")))


def length_bucket(n: Column) -> Column:
    return F.when(n <= 3, "1-3").when(n <= 10, "4-10").when(n <= 20, "11-20").otherwise("21+")


def file_id(record_id: Column, prefixed_only: bool = False) -> Column:
    """File of a record id; null if there is none."""
    found = F.regexp_extract(record_id, r"FILE=([^/]+)" if prefixed_only else r"^(?:FILE=)?([^/]+)", 1)
    return F.nullif(found, F.lit(""))


def snippet(text: Column, start: Column, end: Column, around: int) -> Column:
    before = F.substring(text, F.greatest(start - around, F.lit(0)) + 1, start - F.greatest(start - around, F.lit(0)))
    return F.concat(before, F.lit("[["), F.substring(text, start + 1, end - start), F.lit("]]"), F.substring(text, end + 1, F.lit(around)))


def safe_div(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def f1(precision: Column, recall: Column) -> Column:
    return safe_div(2 * precision * recall, precision + recall)
