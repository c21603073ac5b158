"""Pattern detection with context rules.

One Arrow function finds the matches of all patterns in both passes, each text scanned once a pattern
and only for patterns that the text can hold (a digit, an at sign), and looks for context words of all lists
by one scan of a match's surroundings; rows after it carry short strings and flags and not the text,
and the context rules are column expressions over them.
"""

from __future__ import annotations

import dataclasses
import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..functions import tasks
from ..functions import text as T
from ..options import BIRTH_WORDS, NEGATIVE_WORDS, ZIP_WORDS, DetectOptions
from .keywords import Words

SPAN = "id, h, pass, seq, type, text, raw_text, start, end, score, source, pre, post"


def labels(options: DetectOptions) -> list[str]:
    """Labels to run; DATE also serves BIRTHDATE."""
    wanted = options.entity_types
    return [x for x in options.patterns if not wanted or x in wanted or (x == "DATE" and "BIRTHDATE" in wanted)]


def around(text: Column, start: Column, end: Column, window: int) -> tuple[Column, Column]:
    first = F.greatest(start - window, F.lit(0))
    return F.substring(text, first + 1, start - first), F.substring(text, end + 1, F.lit(window))


class Normalized:
    """A text with ``-\\n`` before a further character dropped and white space runs as one space, and the way back."""

    SPACES = re.compile(r"\s+")
    #: What normalisation changes: dropped line ends, and white space other than one space.
    CHANGED = re.compile(r"(?:\s|-\n(?=[\s\S]))+")

    def __init__(self, text: str):
        self.raw = text
        joined = text.replace("-\n", "") if not text.endswith("-\n") else text[:-2].replace("-\n", "") + "-\n"
        self.text = self.SPACES.sub(" ", joined)
        self.starts: list[int] | None = None

    def _map(self) -> None:
        """Pieces that lie in both texts: where each starts here and there; the space of a run is a piece."""
        self.starts, self.there = [0], [0]
        lost = 0
        for m in self.CHANGED.finditer(self.raw):
            run = m[0]
            if run == " ":
                continue
            # a space's place is its first white space character that is not part of a dropped line end
            kept = next((i for i, c in enumerate(run) if c != "-" and not (c == "\n" and i and run[i - 1] == "-")), None)
            s, e = m.span()
            if kept is not None:
                self.starts.append(s - lost)
                self.there.append(s + kept)
            lost += e - s - (kept is not None)
            self.starts.append(e - lost)
            self.there.append(e)

    def original(self, at: int) -> int:
        """Offset in the raw text of the character at ``at``."""
        if self.starts is None:
            self._map()
        i = bisect_right(self.starts, at) - 1
        return self.there[i] + at - self.starts[i]


class Context:
    """Words around a match: whether its label's own, those against it, those of ZIP codes and of births are near."""

    #: Characters around, or before, a match.
    ZIP, NEGATIVE, BORN = 40, 25, 20

    def __init__(self, options: DetectOptions):
        self.window = options.context_window
        self.labels = labels(options)
        n = len(self.labels)
        lists = [options.keywords.get(x, ()) for x in self.labels] + [NEGATIVE_WORDS.get(x, ()) for x in self.labels] + [ZIP_WORDS, BIRTH_WORDS]
        self.words = Words(lists)
        self.bits = {x: (1 << i, 1 << n + i, 1 << 2 * n, 1 << 2 * n + 1) for i, x in enumerate(self.labels)}

    def _parts(self, pre: str, post: str) -> tuple[str, str, str, str]:
        """The text that each of the four is sought in."""
        w = self.window
        last = lambda k: pre[-k:] if k else ""
        return last(w) + " " + post[:w], last(self.NEGATIVE), last(self.ZIP) + " " + post[: self.ZIP], last(self.BORN)

    def __call__(self, label: str, pre: str, post: str) -> int:
        """Four bits: positive, negative, ZIP, born; ``pre`` and ``post`` hold what any of them may see."""
        mine = self.bits[label]
        text = f"{pre} {post}"
        low = text.lower()
        out = sum(1 << i for i, b in enumerate(mine) if self.words.always & b)
        if len(low) != len(text):  # a letter that is longer in lower case: places don't tell
            return out | sum(1 << i for i, (b, part) in enumerate(zip(mine, self._parts(pre, post), strict=True)) if self.words.mask(part.lower()) & b)
        at, w = len(pre), self.window
        for start, end, bits in self.words.hits(low):
            if bits & mine[0] and start >= at - w and end <= at + 1 + w:
                out |= 1
            if bits & mine[1] and start >= at - self.NEGATIVE and end <= at:
                out |= 2
            if bits & mine[2] and start >= at - self.ZIP and end <= at + 1 + self.ZIP:
                out |= 4
            if bits & mine[3] and start >= at - self.BORN and end <= at:
                out |= 8
        return out


class Finder:
    """Matches of all patterns of the options in a text, by pass."""

    DIGIT = re.compile(r"\d")

    def __init__(self, options: DetectOptions):
        self.context = Context(options)
        self.window = max(40, options.context_window)
        self.passes = options.passes
        self.patterns = [(i, label, j, re.compile(p), self._needs(p)) for i, label in enumerate(labels(options)) for j, p in enumerate(options.patterns[label])]

    @staticmethod
    def _needs(pattern: str) -> str | None:
        """What every match holds: "@" or "digit" by the parts that a pattern can't do without; None if these tell nothing."""

        def parts(sequence):
            for op, value in sequence:
                op = str(op)
                if op == "LITERAL" and value == ord("@"):
                    yield "@"
                elif op == "IN" and all(str(o) == "CATEGORY" and str(v) == "CATEGORY_DIGIT" for o, v in value):
                    yield "digit"
                elif op in ("MAX_REPEAT", "MIN_REPEAT") and value[0] >= 1:
                    yield from parts(value[2])
                elif op == "SUBPATTERN":
                    yield from parts(value[-1])

        found = set(parts(re._parser.parse(pattern)))
        return "@" if "@" in found else "digit" if found else None

    def holds(self, text: str) -> dict:
        return {"digit": self.DIGIT.search(text) is not None, "@": "@" in text, None: True}

    def matches(self, text: str, has: dict) -> Iterator[tuple]:
        return ((i, label, j, k, m) for i, label, j, p, needs in self.patterns if has[needs] for k, m in enumerate(p.finditer(text)))

    def __call__(self, text: str) -> Iterator[tuple]:
        """(pass, seq, label, text, raw_text, start, end, pre, post, before, after, near) of each match; before and after are one character."""
        w = self.window
        has = self.holds(text)  # normalisation adds no digit or sign
        if not any(has[needs] for *_, needs in self.patterns):
            return
        known = Normalized(text) if "normalized" in self.passes else None
        for name in self.passes:
            if name == "normalized" and known.text == text and "raw" in self.passes:
                continue  # it finds the same spans
            scanned = text if name == "raw" else known.text
            for i, label, j, k, m in self.matches(scanned, has):
                s, e = m.span()
                start, end = (s, e) if name == "raw" else (known.original(s), known.original(e - 1) + 1)
                yield (
                    name, [i, j, k], label, m[0], text[start:end], start, end, text[max(0, start - w) : start], text[end : end + w],
                    scanned[s - 1 : s] if s else "", scanned[e : e + 1], self.context(label, scanned[max(0, s - w) : s], scanned[e : e + w]),
                )


def keyed(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """(id, h, t): a row is told by its id and a hash of its text, so rows with one id and other texts stay apart."""
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("h"), F.col(text_col).alias("t"), *more)


def _found(rows: DataFrame, options: DetectOptions) -> DataFrame:
    """Matches of (id, h, t, raw_only) rows; where raw_only holds, on the raw text alone."""
    kind = rows.schema["id"].dataType.simpleString()
    names = ["pass", "seq", "label", "text", "raw_text", "start", "end", "pre", "post", "before", "after", "near"]
    types = {"seq": "array<int>", "start": "int", "end": "int", "near": "int"}
    ddl = f"id {kind}, h long, " + ", ".join(f"`{n}` {types.get(n, 'string')}" for n in names)
    schema = to_arrow_schema(StructType.fromDDL(ddl))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finders = {False: Finder(options), True: Finder(dataclasses.replace(options, passes=("raw",)))}
        return tasks.results(batches, lambda text, raw_only: finders[raw_only](text), schema)

    return rows.mapInArrow(run, ddl)


def by_label(values: dict[str, Column], default: Column) -> Column:
    out = reduce(lambda c, kv: c.when(F.col("label") == kv[0], kv[1]), values.items(), F)
    return out.otherwise(default) if values else default


def rules(found: DataFrame, options: DetectOptions) -> DataFrame:
    """Context rules over rows with label, text, before, after and near (bits of Context): type and score, or no row."""
    near = lambda bit: F.col("near").bitwiseAND(bit) != 0
    rows = found.withColumn("positive", near(1)).withColumn("negative", near(2))
    text, positive = F.col("text"), F.col("positive")
    nine = text.rlike(T.FLAGS + r"\A\d{9}\z")
    digits = F.length(F.regexp_replace(text, T.FLAGS + r"\D", ""))
    digit = r"\p{Nd}|[²³¹⁰⁴-⁹₀-₉]"
    by_digit = F.col("before").rlike(digit) | F.col("after").rlike(digit)
    s = options.scoring
    valid = by_label(
        {
            "ACCOUNT_NUMBER": ~F.col("negative") & ~T.is_ssn_format(text) & ~nine & (positive | (digits >= s.account_min_digits)),
            "PHONE_NUMBER": ~F.col("negative") & ~by_digit,
            "SSN": ~F.col("negative") & (positive | ~nine),
            "ADDRESS": ~(T.is_zip_like(text) | T.is_postal_4(text)) | near(4),
            "DATE": near(8),
        },
        F.lit(True),
    )
    base = by_label({x: F.lit(options.scores.get(x, 0.5)) for x in labels(options)}, F.lit(0.5))
    base = F.when((F.col("label") == "ACCOUNT_NUMBER") & ~positive, F.lit(s.account_no_context_score)).otherwise(base)
    most = F.lit(s.max_score)
    score = F.when(positive, F.least(most, base + s.context_boost)).otherwise(base)
    score = F.when(F.col("label") == "DATE", F.least(most, score + s.context_boost)).otherwise(score)
    return rows.where(valid).withColumn("type", F.when(F.col("label") == "DATE", "BIRTHDATE").otherwise(F.col("label"))).withColumn(
        "score", F.round(score, 2)
    )


def detect(docs: DataFrame, options: DetectOptions, id_col: str = "doc_id", text_col: str = "text", raw_only: Column | None = None) -> DataFrame:
    """Spans of all passes, one row each, offsets in the original text (columns of SPAN); rows for which ``raw_only`` holds get the raw pass alone.

    The normalised pass runs on texts that normalisation changes; on others it finds the same spans.
    A null or empty text has no span.
    """
    if not labels(options):
        raise ValueError("no label to detect")
    only = F.lit(False) if raw_only is None else raw_only
    rows = keyed(docs, id_col, text_col, only.alias("raw_only")).where(F.length("t") > 0)
    return rules(_found(rows, options), options).withColumn("source", F.lit("regex")).select(*SPAN.split(", "))
