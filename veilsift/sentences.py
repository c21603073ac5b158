"""Sentences made from the keys of ``customer``, each to show one rule, and what the rules should find in them.

The driver's documents hold next to no personal data, so rules are tried on these. A sentence is a list of
pieces, words or slots of fixed length that a key fills; the text is one expression that Spark SQL and
other engines read alike. What should be found is told piece by piece, by hand from the rules, so
the SQL of a query knows nothing of patterns.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .sources import readers

#: Slots: an expression of the key n, and its length.
SLOTS = {
    "ssn": ("concat(lpad(concat('', 100 + n % 800), 3, '0'), '-', lpad(concat('', 10 + n % 80), 2, '0'), '-', lpad(concat('', 1000 + n % 9000), 4, '0'))", 11),
    "nine": ("concat('', 100000000 + n % 800000)", 9),
    "phone": ("concat('(555) ', 100 + n % 800, '-', 1000 + n % 9000)", 14),
    "wide": ("concat('(555)  ', 100 + n % 800, '-', 1000 + n % 9000)", 15),
    "email": ("concat('user', 10000 + n % 80000, '@ex.org')", 16),
    "split": ("concat('user-', chr(10), 10000 + n % 80000, '@ex.org')", 18),
    "date": ("concat('19', 50 + n % 40, '-0', 1 + n % 9, '-1', n % 10)", 10),
    "acct": ("concat('', 1000000000 + n % 900000)", 10),
    "card": ("concat('4539148803436', '467')", 16),
    "street": ("concat(100 + n % 800, ' Oak Street')", 14),
    "zip": ("concat('', 10000 + n % 80000)", 5),
    "gap": ("concat(' ', chr(10))", 2),
    "break": ("concat('-', chr(10))", 2),
}


@dataclass(frozen=True)
class Sentence:
    """Pieces ("<slot>" or words), and for each profile the (type, first piece, last piece, score) to be found."""

    pieces: tuple[str, ...]
    constants: tuple[tuple[str, int, int, float], ...] = ()
    config: tuple[tuple[str, int, int, float], ...] | None = None
    #: The gateway's trigger and what it matched, if that is words.
    trigger: str | None = "digits"

    def lengths(self) -> list[int]:
        return [SLOTS[p[1:-1]][1] if p[0] == "<" else len(p) for p in self.pieces]

    def expression(self) -> str:
        return "concat('', " + ", ".join(SLOTS[p[1:-1]][0] if p[0] == "<" else f"'{p}'" for p in self.pieces) + ")"

    def found(self, profile: str) -> list[tuple[str, int, int, float]]:
        """(type, start, end, score)."""
        said = self.constants if profile == "constants" or self.config is None else self.config
        ends = [sum(self.lengths()[: i + 1]) for i in range(len(self.pieces))]
        return [(kind, ends[a] - self.lengths()[a], ends[b], score) for kind, a, b, score in said]


S = Sentence
SENTENCES = (
    S(("Her SSN: ", "<ssn>", "."), (("SSN", 1, 1, 0.99),)),
    S(("The code ", "<ssn>", " was noted"), (("SSN", 1, 1, 0.95),)),
    S(("Number ", "<nine>", " here")),  # nine digits without a word for them
    S(("Social security ", "<nine>", " on hand"), (("SSN", 1, 1, 0.99),)),
    S(("Passport ", "<ssn>", " seen")),  # a word against it
    S(("Checking deposit ", "<ssn>", " opened"), (("ACCOUNT_NUMBER", 1, 1, 0.80),)),  # retyped
    S(("Call me at ", "<phone>", " please"), (("PHONE_NUMBER", 1, 1, 0.85),)),
    S(("Phone ", "<phone>", " now"), (("PHONE_NUMBER", 1, 1, 0.95),)),
    S(("Payment ref ", "<phone>", " sent")),
    S(("Born ", "<date>", " in town"), (("BIRTHDATE", 1, 1, 0.85),)),
    S(("Seen on ", "<date>", " there")),
    S(("Account ", "<acct>", " open"), (("ACCOUNT_NUMBER", 1, 1, 0.90),)),
    S(("Value ", "<acct>", " there"), (("ACCOUNT_NUMBER", 1, 1, 0.40),), (("PHONE_NUMBER", 1, 1, 0.85), ("ACCOUNT_NUMBER", 1, 1, 0.60))),
    S(("Number ", "<card>", " here"), (("CREDIT_CARD_NUMBER", 1, 1, 0.95),)),  # by its check digit
    S(("Account ", "<card>", " here"), (("ACCOUNT_NUMBER", 1, 1, 0.90),)),  # the word says otherwise
    S(("Visa ", "<card>", " here")),
    S(("We met near ", "<street>", " today"), (("ADDRESS", 1, 2, 0.70),), trigger=None),  # the pattern takes up to 30 more characters
    S(("zip ", "<zip>", " area"), (("ADDRESS", 1, 1, 0.80),), ()),  # a pattern of one profile
    S(("Total ", "<zip>", " things")),
    S(("Mail ", "<email>", " now"), (("EMAIL", 1, 1, 0.90),)),
    S(("Phone ", "<wide>", " now"), (("PHONE_NUMBER", 1, 1, 0.95),)),  # found on the normalised text alone
    S(("Mail ", "<split>", " ok"), (("EMAIL", 1, 1, 0.90),)),  # both passes find a part
    S(("Mail ", "<email>", "<gap>", "<email>", " now"), (("EMAIL", 1, 3, 0.90),)),  # white space of two: one span
    S(("Mail ", "<email>", ", ", "<email>", " now"), (("EMAIL", 1, 1, 0.90), ("EMAIL", 3, 3, 0.90))),
    S(("Nothing of note in here",), trigger=None),
    S(("We met Anna Kowalski there",), trigger="name"),
    S(("Go to ", "12 Elm Ave Apt 4 TX"), (("ADDRESS", 1, 1, 0.70),), trigger="address"),
)


def text_sql() -> str:
    """The sentence of key n as one expression."""
    return f"CASE n % {len(SENTENCES)} " + " ".join(f"WHEN {i} THEN {s.expression()}" for i, s in enumerate(SENTENCES)) + " END"


def view_sql() -> str:
    return f"(SELECT n AS doc_id, n % {len(SENTENCES)} AS k, {text_sql()} AS text FROM (SELECT c_custkey AS n FROM customer))"


def view(spark: SparkSession, d: str) -> DataFrame:
    """(doc_id, k, text)."""
    rows = readers.dealt(spark.read.parquet(f"{d}/customer.parquet").select(F.col("c_custkey").alias("n")))
    return rows.select(F.col("n").alias("doc_id"), F.expr(f"n % {len(SENTENCES)}").alias("k"), F.expr(text_sql()).alias("text"))


def found_sql(profile: str) -> str:
    """A table of what each sentence holds: k, type, start_, end_, score."""
    rows = [(k, *f) for k, s in enumerate(SENTENCES) for f in s.found(profile)]
    values = ", ".join(f"({k}, '{t}', {a}, {b}, {p}::DOUBLE)" for k, t, a, b, p in rows)
    return f"(SELECT * FROM (VALUES {values}) AS x(k, type, start_, end_, score))"


def triggers_sql() -> str:
    values = ", ".join(f"({k}, {repr(s.trigger) if s.trigger else 'NULL'})" for k, s in enumerate(SENTENCES))
    return f"(SELECT * FROM (VALUES {values}) AS x(k, trigger))"
