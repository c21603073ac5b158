"""Cheap tests that decide which rows deserve the models."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import tasks
from ..functions import text as T
from ..options import DetectOptions, GatewayTest

# What counts as a sign of an address.
SUFFIXES = (
    "St", "Street", "Ave", "Avenue", "Rd", "Road", "Blvd", "Boulevard", "Dr", "Drive", "Ln", "Lane", "Ct", "Court", "Pl", "Place",
    "Way", "Cir", "Circle", "Pkwy", "Parkway", "Hwy", "Highway", "Ter", "Terrace", "Trl", "Trail", "Loop", "Run", "Path",
    "Sq", "Square", "Pt", "Point", "Aly", "Alley",
)
STATES = (
    "AL", "AK", "AZ", "AR", "CA", "CO", "CT", "DE", "FL", "GA", "HI", "ID", "IL", "IN", "IA", "KS", "KY", "LA", "ME", "MD",
    "MA", "MI", "MN", "MS", "MO", "MT", "NE", "NV", "NH", "NJ", "NM", "NY", "NC", "ND", "OH", "OK", "OR", "PA", "RI", "SC",
    "SD", "TN", "TX", "UT", "VT", "VA", "WA", "WV", "WI", "WY", "DC", "PR", "VI", "GU", "AS", "MP",
)
# End of the fixed values.


# Signals, their weights and patterns, in order; the words of suffixes and states go in.
SIGNALS = (
    ("suffix", 2, r"(?i)\b(?:{suffixes})\.?\b"),
    ("zip_us", 3, r"\b\d{5}(?:-\d{4})?\b"),
    ("zip_uk", 3, r"(?i)\b[A-Z]{1,2}\d{1,2}[A-Z]?\s*\d[A-Z]{2}\b"),
    ("zip_ca", 3, r"(?i)\b[A-Z]\d[A-Z]\s*\d[A-Z]\d\b"),
    ("po_box", 3, r"(?i)\bP\.?O\.?\s*Box\b"),
    ("unit", 2, r"(?i)\b(?:Apt|Suite|Ste|Unit|#)\s*[A-Z0-9-]+\b"),
    ("number_word", 1, r"\b\d{1,5}\s+[a-zA-Z]"),
    ("directional", 1, r"(?i)\b(?:N|S|E|W|North|South|East|West|NE|NW|SE|SW)\s+[A-Za-z]"),
    ("state", 1, r"(?i)\b(?:{states})\b"),
    ("city", 2, None),
)
# End of the fixed values.


@dataclass(frozen=True)
class AddressSignals:
    suffixes: tuple[str, ...] = SUFFIXES
    states: tuple[str, ...] = STATES
    cities: tuple[str, ...] = ()

    def rules(self) -> list[tuple[str, int, str | None]]:
        """Signal, weight and pattern, in order; the city signal has none."""
        words = {"suffix": ("{suffixes}", self.suffixes), "state": ("{states}", self.states)}
        return [(n, w, p.replace(words[n][0], "|".join(words[n][1])) if n in words else p) for n, w, p in SIGNALS]

    def finder(self):
        """A function from a text to its signals and their score, by Python's patterns: texts that lack what a pattern needs cost no scan."""
        import re

        rules = self.rules()
        fold = str.maketrans({"\u017f": "s", "\u0131": "i"})  # letters that patterns take for s and i when case does not count
        known = {"suffix": {w.lower() for w in self.suffixes}, "state": {w.lower() for w in self.states}}
        cities = [c.lower() for c in self.cities]
        patterns = {n: re.compile(p) for n, _, p in rules if p and n not in known}
        words, digit = re.compile(r"\w+"), re.compile(r"\d")

        def run(text: str) -> tuple[int, list[str]]:
            low = text.lower()
            has_digit = digit.search(text) is not None
            seen = set(words.findall(low.translate(fold)))

            def hit(name):
                if name in known:
                    return not seen.isdisjoint(known[name])
                if name == "city":
                    return any(c in low for c in cities)
                if name in ("zip_us", "zip_uk", "zip_ca", "number_word") and not has_digit:
                    return False
                if name == "po_box" and "box" not in low:
                    return False
                return patterns[name].search(text) is not None

            found = [(n, w) for n, w, _ in rules if hit(n)]
            return sum(w for _, w in found), [n for n, _ in found]

        return run

    def scored(self, docs: DataFrame, text_col: str = "text", where: Column | None = None) -> DataFrame:
        """``docs`` plus address_score and address_signals; a null text has none, nor one for which ``where`` doesn't hold."""
        signals = self

        def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            find = signals.finder()
            for texts in batches:
                yield pd.DataFrame([find(t or "") for t in texts], columns=["score", "signals"])
            tasks.give_back()

        run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
        udf = F.pandas_udf("struct<score:int,signals:array<string>>")(run).asNondeterministic()  # no filter on it runs it again
        text = F.col(text_col) if where is None else F.when(where, F.col(text_col))
        rows = docs.withColumn("_address", udf(text))
        return rows.withColumns({"address_score": F.col("_address.score"), "address_signals": F.col("_address.signals")}).drop("_address")


#: Names of tests in options, and of the triggers that they leave.
TRIGGERS = {"consecutive_digits": "digits", "name_dictionary": "name", "address_signals": "address"}


def tests_of(options: DetectOptions) -> tuple[GatewayTest, ...]:
    """The tests to run; without any, digits and then names."""
    return options.gateway or (GatewayTest("consecutive_digits", True, 5), GatewayTest("name_dictionary"))


def decide(docs: DataFrame, options: DetectOptions, named: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` plus trigger (of the first test that hits: digits, name or address; null if none) and trigger_match.

    ``named``: (id, h, text, start) of dictionary hits; without it that test never hits, unless ``docs`` bring the first
    name as a column _named (dictionary.with_first). The match is the first run of digits, the first name as it stands in the text, or the address score and its signals.
    """
    rows = docs
    tests = [t for t in tests_of(options) if t.enabled]
    for t in tests:
        if t.name not in TRIGGERS:
            raise ValueError(f"no gateway test {t.name!r}")
    text = F.col(text_col)
    if named is not None and any(t.name == "name_dictionary" for t in tests):
        hits = named.groupBy(F.col("id").alias("_id"), F.col("h").alias("_h")).agg(F.min_by("text", "start").alias("_named"))
        on = rows[id_col].eqNullSafe(hits["_id"]) & (F.xxhash64(rows[text_col]) == hits["_h"])
        rows = rows.join(hits, on, "left").drop("_id", "_h")
    elif "_named" not in docs.columns:
        rows = rows.withColumn("_named", F.lit(None).cast("string"))
    trigger, match = F.lit(None).cast("string"), F.lit(None).cast("string")
    # tests in order; a row that one has stopped is not looked at by those after it
    rows = rows.withColumns({"_trigger": trigger, "_match": match})
    for test in tests:
        still = F.col("_trigger").isNull()
        if test.name == "consecutive_digits":
            least = test.threshold or 5
            hit, what = T.has_consecutive_digits(text, least), F.try_element_at(T.find_consecutive_digits(text, least), F.lit(1))
        elif test.name == "name_dictionary":
            hit, what = F.col("_named").isNotNull(), F.col("_named")
        else:
            rows = AddressSignals().scored(rows, text_col, still)
            hit = F.col("address_score") >= (test.threshold or 4)
            what = F.concat(F.lit("address_signals("), F.col("address_score").cast("string"), F.lit("): "), F.array_join("address_signals", ","))
        rows = rows.withColumn("_hit", still & F.coalesce(hit, F.lit(False)))
        rows = rows.withColumns({"_trigger": F.when(F.col("_hit"), F.lit(TRIGGERS[test.name])).otherwise(F.col("_trigger")), "_match": F.when(F.col("_hit"), what).otherwise(F.col("_match"))})
        rows = rows.drop("address_score", "address_signals")
    return rows.withColumnsRenamed({"_trigger": "trigger", "_match": "trigger_match"}).drop("_named", "_hit")
