"""Names by dictionary: longest n-gram first, from left to right.

A dictionary of bounded size goes to every task, which reads each text once: a token that begins no
name costs one look-up. A larger one is joined with n-grams that begin with a known first word.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from itertools import accumulate, islice

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..functions import tasks
from ..functions import text as T
from ..options import NameLists
from ..sources import readers
from .regex_detect import around, keyed

#: A dictionary is broadcast up to this many names and bytes; beyond it the join is shuffled.
BROADCAST_NAMES, BROADCAST_BYTES = 2_000_000, 64 << 20
#: Bits of the sketch of first words: so many a word, and blocks of 64 in all at most (8 MB), beyond which it denies less.
WORD_BITS, MOST_BLOCKS = 16, 1 << 20
SCORE = 0.85
#: Tokens that are looked at before a text is read whole for its first name.
HEAD = 128
#: Normalised tokens that a task remembers.
MEMO_TOKENS = 200_000


def dictionary(names: DataFrame, stopwords: DataFrame | None = None, column: str = "name", ascii_only: bool = False) -> DataFrame:
    """(name, n_words) of distinct normalised names of two characters at least, without stop words."""
    out = names.select(T.normalize_name(F.col(column), ascii_only).alias("name")).where(F.length("name") >= 2).distinct()
    if stopwords is not None:
        stop = stopwords.select(T.normalize_name(F.col(stopwords.columns[0]), ascii_only).alias("name"))
        out = out.join(stop, "name", "left_anti")
    return out.select("name", F.size(F.split("name", " ")).alias("n_words"))


def from_lists(spark: SparkSession, lists: NameLists) -> DataFrame | None:
    """The dictionary of the options' name lists; None if they name no names. Lists are read by Spark, whatever their size."""
    paths = [p for p in (lists.first_names, lists.last_names) if p]
    if not paths:
        return None
    rows = union_of([_words(spark, p) for p in paths])
    return dictionary(rows, _words(spark, lists.stopwords) if lists.stopwords else None)


def _words(spark: SparkSession, path: str) -> DataFrame:
    """(name) of a list file: an array of a ``.json``, else lines that are neither blank nor begin with #."""
    if path.endswith(".json"):
        whole = spark.read.format("text").option("wholetext", True).load(path)
        return whole.select(F.explode(F.from_json("value", "array<string>")).alias("name"))
    return readers.id_list(spark, path, comments=True).select(F.col("value").alias("name"))


def longest(names: DataFrame) -> int:
    """Words of the longest name."""
    return names.agg(F.max("n_words")).first()[0] or 1


class Matcher:
    """Greedy matching of normalised names in a text."""

    TOKEN = re.compile(T.TOKEN)
    PARTS = re.compile(f"({T.TOKEN})")

    def __init__(self, names, max_words: int):
        self.names = names
        self.first: dict[str, int] = {}  # first words, and the words of the longest name that they begin
        for name in names:
            words = name.split(" ")
            if len(words) <= max_words:
                self.first[words[0]] = max(self.first.get(words[0], 0), len(words))
        self.most = max(self.first.values(), default=1)
        self.memo: dict[str, str] = {}

    def _norm(self, token: str) -> str:
        known = self.memo.get(token)
        if known is None:
            if len(self.memo) > MEMO_TOKENS:
                self.memo.clear()
            known = T.normalized_name(token)
            known = self.memo[token] = token if known == token else known  # one string for most
        return known

    def first_place(self, text: str) -> tuple[int, int] | None:
        """(start, end) of the first name; a text that has one early is not read further."""
        head = list(islice(self.TOKEN.finditer(text), HEAD + self.most - 1))
        words = [self._norm(m[0]) for m in head]
        for i, w in enumerate(words[:HEAD]):
            for n in range(min(self.first.get(w, 0), len(words) - i), 0, -1):
                if " ".join(words[i : i + n]) in self.names:
                    return head[i].start(), head[i + n - 1].end()
        hit = next(self(text), None) if len(head) > HEAD else None
        return hit and hit[2:]

    def __call__(self, text: str) -> Iterator[tuple[int, int, int, int]]:
        """(position, words, start, end) of names, the longest at each place, none within another."""
        memo, norm, first = self.memo, self._norm, self.first
        # what lies between tokens and the tokens themselves, in turn: their lengths tell places without a second scan
        parts = self.PARTS.split(text)
        words = [memo[t] if t in memo else norm(t) for t in parts[1::2]]
        places = [i for i, w in enumerate(words) if w in first]
        if not places:
            return
        ends, free = None, 0
        for i in places:
            if i < free:
                continue
            most = min(first[words[i]], len(words) - i)
            n = next((n for n in range(most, 0, -1) if " ".join(words[i : i + n]) in self.names), 0)
            if n:
                ends = ends or list(accumulate(map(len, parts)))
                yield i, n, ends[2 * i], ends[2 * (i + n) - 1]
                free = i + n


def _shared(rows: DataFrame, names: DataFrame):
    """A dictionary that goes to every task."""
    return rows.sparkSession.sparkContext.broadcast(frozenset(r["name"] for r in names.select("name").collect()))


def _broadcast_matches(rows: DataFrame, names: DataFrame, max_words: int, window: int) -> DataFrame:
    """(id, h, start, end, text, pre, post) of (id, h, t) rows by a dictionary that goes to every task."""
    shared = _shared(rows, names)
    kind = rows.schema["id"].dataType.simpleString()
    ddl = f"id {kind}, h long, start int, end int, text string, pre string, post string"
    schema = to_arrow_schema(StructType.fromDDL(ddl))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        match = Matcher(shared.value, max_words)

        def found(text: str | None) -> Iterator[tuple]:
            for _, _, start, end in match(text or ""):
                yield start, end, text[start:end], text[max(0, start - window) : start], text[end : end + window]

        return tasks.results(batches, found, schema)

    return rows.mapInArrow(run, ddl)


class FirstWords:
    """A sketch of words in 64-bit blocks: a word has three bits in one block. It denies no word that was put in."""

    BITS = 3

    def __init__(self, blocks: np.ndarray):
        self.blocks = blocks

    @classmethod
    def of(cls, words: DataFrame, column: str) -> FirstWords:
        """From a column of words, blocks being made by partial aggregation: only they come to the driver, at most MOST_BLOCKS."""
        n = 1 << max(4, min((words.count() * WORD_BITS // 64).bit_length(), MOST_BLOCKS.bit_length() - 1))
        h = F.xxhash64(column)
        bits = [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, 40 + 6 * i).bitwiseAND(63).cast("int")) for i in range(cls.BITS)]
        each = words.select(h.bitwiseAND(n - 1).alias("block"), reduce(lambda a, b: a.bitwiseOR(b), bits).alias("mask"))
        blocks = np.zeros(n, np.uint64)
        for r in each.groupBy("block").agg(F.bit_or("mask").alias("mask")).collect():
            blocks[r["block"]] = r["mask"] & 0xFFFFFFFFFFFFFFFF
        return cls(blocks)

    def holds(self, word: str) -> bool:
        h = xxhash.xxh64_intdigest(word.encode(), 42)  # what Spark's xxhash64 gives
        mask = 0
        for i in range(self.BITS):
            mask |= 1 << (h >> 40 + 6 * i & 63)
        return int(self.blocks[h & len(self.blocks) - 1]) & mask == mask


def candidates(rows: DataFrame, names: DataFrame, max_words: int) -> DataFrame:
    """(id, h, pos, n, start, end) of (id, h, t) rows: every n-gram of tokens that is a name, the longest one at each position.

    For dictionaries that fit no task: a sketch of first words goes to every task in their place, and only tokens that it does not
    deny leave it, with the words after them. What it lets by wrongly falls in the join with the first words.
    """
    begin = names.where(F.col("n_words") <= max_words).groupBy(F.substring_index("name", " ", 1).alias("word")).agg(F.max("n_words").alias("most"))
    sent = rows.sparkSession.sparkContext.broadcast(FirstWords.of(begin, "word").blocks)
    kind = rows.schema["id"].dataType.simpleString()
    ddl = f"id {kind}, h long, pos int, start int, words array<string>, ends array<int>"
    schema = to_arrow_schema(StructType.fromDDL(ddl))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch, token, memo = FirstWords(sent.value), re.compile(T.TOKEN), {}

        def known(raw: str) -> tuple[str, bool]:
            if raw not in memo:
                if len(memo) > MEMO_TOKENS:
                    memo.clear()
                word = T.normalized_name(raw)
                memo[raw] = word, sketch.holds(word)
            return memo[raw]

        def grams(text: str | None) -> Iterator[tuple]:
            found = [known(x) for x in token.findall(text or "")]
            if not any(hit for _, hit in found):
                return
            spans = [m.span() for m in token.finditer(text)]
            for pos, (_, hit) in enumerate(found):
                if hit:
                    yield pos, spans[pos][0], [w for w, _ in found[pos : pos + max_words]], [e for _, e in spans[pos : pos + max_words]]

        return tasks.results(batches, grams, schema)

    each = rows.select("id", "h", "t").mapInArrow(run, ddl)
    each = each.withColumn("word", F.col("words")[0]).join(begin, "word")
    grams = each.select("id", "h", "pos", "start", "words", "ends", F.explode(F.sequence(F.lit(1), F.least("most", F.size("words")))).alias("n"))
    grams = grams.select(
        "id", "h", "pos", "n", "start", F.element_at("ends", F.col("n")).alias("end"), F.array_join(F.slice("words", F.lit(1), F.col("n")), " ").alias("name")
    )
    hit = grams.join(names.select("name"), "name", "left_semi")
    return hit.groupBy("id", "h", "pos").agg(F.max_by(F.struct("n", "start", "end"), "n").alias("m")).select("id", "h", "pos", "m.*")


def greedy(found: DataFrame) -> DataFrame:
    """Takes candidates from the left and passes over those that begin inside of one taken.

    Candidates that do not reach each other are apart, so the fold runs over runs of overlapping
    ones, which have few members.
    """
    order = Window.partitionBy("id", "h").orderBy("pos")
    reach = F.max(F.col("pos") + F.col("n")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    rows = found.withColumn("new", (F.col("pos") >= F.coalesce(reach, F.lit(0))).cast("int"))
    rows = rows.withColumn("run", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    lone = rows.groupBy("id", "h", "run").agg(F.sort_array(F.collect_list(F.struct("pos", "n", "start", "end"))).alias("c"))
    empty = F.array().cast("array<struct<pos:int,n:int,start:int,end:int>>")
    taken = F.aggregate(
        "c",
        F.struct(empty.alias("out"), F.lit(0).alias("free")),
        lambda acc, x: F.when(
            x["pos"] >= acc["free"], F.struct(F.array_append(acc["out"], x).alias("out"), (x["pos"] + x["n"]).alias("free"))
        ).otherwise(acc),
    )["out"]
    return lone.select("id", "h", F.explode(taken).alias("t")).select("id", "h", "t.*")


def _bounds(names: DataFrame, max_words: int | None) -> tuple[bool, int]:
    """Whether the dictionary can go to every task, and the most words that a name may have (by default the longest's)."""
    size = names.agg(F.count("*").alias("n"), F.sum(F.octet_length("name")).alias("bytes"), F.max("n_words").alias("words")).first()
    return size["n"] <= BROADCAST_NAMES and (size["bytes"] or 0) <= BROADCAST_BYTES, max_words or size["words"] or 1


def matches(rows: DataFrame, names: DataFrame, max_words: int | None = None, window: int = 0) -> DataFrame:
    """(id, h, start, end, text, pre, post) of names in (id, h, t) rows, with ``window`` characters before and after; ``max_words`` is by default the longest name's."""
    few, most = _bounds(names, max_words)
    if few:
        return _broadcast_matches(rows, names, most, window)
    taken = greedy(candidates(rows, names, most))
    pre, post = around(F.col("t"), F.col("start"), F.col("end"), window)
    text = F.substring("t", F.col("start") + 1, F.col("end") - F.col("start"))
    return taken.join(rows.distinct(), ["id", "h"]).select("id", "h", "start", "end", text.alias("text"), pre.alias("pre"), post.alias("post"))


def detect(docs: DataFrame, names: DataFrame, max_words: int | None = None, id_col: str = "doc_id", text_col: str = "text", window: int | None = None) -> DataFrame:
    """PERSON spans (id, h, type, text, start, end, score, source); the text is the original's slice.

    With ``window`` also pre and post, so many characters before and after, cut where the text is read.
    """
    found = matches(keyed(docs, id_col, text_col), names, max_words, window or 0)
    context = ["pre", "post"] if window else []
    return found.select("id", "h", F.lit("PERSON").alias("type"), "text", "start", "end", F.lit(SCORE).alias("score"), F.lit("dictionary").alias("source"), *context)


def with_first(docs: DataFrame, names: DataFrame, max_words: int | None = None, id_col: str = "doc_id", text_col: str = "text", name: str = "_named") -> DataFrame:
    """``docs`` and the first name of each text as it stands there (null if it has none); a dictionary that fits a task is looked up in place.

    The function is called nondeterministic, so that no filter on what it gives runs it a second time.
    """
    few, most = _bounds(names, max_words)
    if not few:
        hits = detect(docs, names, max_words, id_col, text_col)
        hits = hits.groupBy(F.col("id").alias("_id"), F.col("h").alias("_h")).agg(F.min_by("text", "start").alias(name))
        return docs.join(hits, docs[id_col].eqNullSafe(hits["_id"]) & (F.xxhash64(docs[text_col]) == hits["_h"]), "left").drop("_id", "_h")
    shared = _shared(docs, names)

    def firsts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        match = Matcher(shared.value, most)
        for texts in batches:
            first = []
            for at, n in tasks.cuts(texts):
                for t in texts.slice(at, n).to_pylist():
                    hit = match.first_place(t or "")
                    first.append(t[hit[0] : hit[1]] if hit else None)
            yield pa.array(first, pa.string())
            tasks.give_back()

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return tasks.given_back(firsts(batches))

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return docs.withColumn(name, F.arrow_udf("string")(run).asNondeterministic()(F.col(text_col)))


def checksum(paths: list[str]) -> str:
    """SHA-256 over the files' bytes, a zero byte after each."""
    import hashlib

    h = hashlib.sha256()
    for p in paths:
        with open(p, "rb") as f:
            h.update(f.read())
        h.update(b"\0")
    return h.hexdigest()


def _nfkc(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    import unicodedata

    for s in batches:
        yield s.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x).strip())


def filter_names(names: DataFrame, frequencies: DataFrame, cutoff: float) -> tuple[DataFrame, DataFrame]:
    """(kept, removed) of valid names by their largest word frequency over languages.

    ``frequencies``: (name, zipf). Kept: distinct, sorted, below the cutoff or unknown. Removed: by
    frequency downward, unknown last.
    """
    names = names.select(F.pandas_udf(_nfkc, "string")("name").alias("name"))
    valid = names.where(F.col("name").rlike(r"^[A-Za-z][A-Za-z'-]*[A-Za-z]\z") & F.length("name").between(2, 25)).distinct()
    top = frequencies.groupBy(F.lower("name").alias("low")).agg(F.max("zipf").alias("zipf"))
    rows = valid.join(top, F.lower("name") == F.col("low"), "left").select("name", "zipf")
    common = F.coalesce(F.col("zipf") >= cutoff, F.lit(False))
    return rows.where(~common).select("name").orderBy("name"), rows.where(common).orderBy(F.desc_nulls_last("zipf"), "name")


def union_of(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
