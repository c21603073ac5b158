"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A text's features are its words (ASCII-lower-cased, marks at the ends taken off), pairs of neighbours
and pairs with one word between, hashed into 2**BITS places, each counted once. Training takes a
bounded, hash-chosen sample of labelled rows in one task with per-coordinate rates; L1 leaves few
weights, which come to the driver and go to every task as index and value.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, held_out, map_rows, top_hash

BITS = 20
#: Labelled rows that are expected in the training sample at most.
TRAIN_ROWS = 24_000
#: Characters of the sample's texts that are expected at most: fewer rows are taken where texts are long, so the
#: one task that learns holds about as many features, four bytes each.
TRAIN_CHARS = 96_000_000
MEMO_WORDS = 1_000_000
EDGE = b"""!"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~0123456789"""


class Hasher:
    """Feature indices of texts; a word's hash is remembered in a dictionary of bounded size."""

    def __init__(self, bits: int = BITS, memo_words: int = MEMO_WORDS):
        self.mask = np.uint64((1 << bits) - 1)
        self.shift = np.uint64(64 - bits)
        self.memo: dict[bytes, int] = {}
        self.memo_words = memo_words

    def words(self, text: str | None) -> np.ndarray:
        """64-bit hash of each word of the whole text."""
        import xxhash

        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        memo = self.memo
        try:
            return np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
        except KeyError:
            if len(memo) > self.memo_words:
                memo.clear()
            for w in set(words).difference(memo):
                memo[w] = xxhash.xxh64_intdigest(w.strip(EDGE) or w, 1)
            return np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))

    def __call__(self, text: str | None) -> np.ndarray:
        """Indices of words, neighbours and skip-grams, repeats included."""
        h = self.words(text)
        a, b, c = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
        two = (h[:-1] * a) ^ (h[1:] * b)
        skip = (h[:-2] * a) ^ (h[2:] * c)
        return (np.concatenate((h, two, skip)) * a >> self.shift).astype(np.int64)


def train_ftrl(examples, bits: int, alpha=1.0, beta=1.0, l1=2.0, l2=0.1, epochs: int = 4, positive=1.0) -> tuple[np.ndarray, np.ndarray, float]:
    """Index and value of the weights that are not zero, and the intercept.

    ``examples``: (indices without repeats, label), in a fixed order.
    """
    z, n = np.zeros(1 << bits), np.zeros(1 << bits)
    bias, bias_n = 0.0, 0.0

    def weight(i):
        s = z[i]
        return np.where(np.abs(s) <= l1, 0.0, -(s - np.sign(s) * l1) / ((beta + np.sqrt(n[i])) / alpha + l2))

    for _ in range(epochs):
        for i, y in examples:
            w = weight(i)
            p = 1 / (1 + np.exp(-np.clip(bias + w.sum(), -35, 35)))
            g = (p - y) * (positive if y else 1.0)
            sigma = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / alpha
            z[i] += g - sigma * w
            n[i] += g * g
            bias_n += g * g
            bias -= alpha * g / (beta + np.sqrt(bias_n))
    w = weight(np.arange(1 << bits))
    at = np.flatnonzero(w)
    return at, w[at], bias


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", usable: Column | None = None, bits: int = BITS, train_rows: int = TRAIN_ROWS, train_chars: int = TRAIN_CHARS, **options):
    """Weights (indices, values, intercept) from the labelled rows for which ``usable`` holds.

    ``docs`` has doc_id and text, ``labels`` doc_id and the label; null labels and ids are passed
    over, of repeated label rows the largest counts; each of a repeated document's rows is learnt from.
    About ``train_rows`` rows are taken, by md5 of the id, and fewer if their whole texts have more than
    ``train_chars`` characters. Rows are learnt from in the order of that md5, ties in the order of
    their features, so a run is repeatable. Without a labelled row (and so for empty tables) all weights
    are zero and the intercept is far below.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    known = known.where(usable) if usable is not None else known
    known = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    n = known.count()
    u = top_hash(F.lit("ftrl"), F.col("doc_id").cast("string"))
    share = min(1.0, train_rows / max(n, 1))
    drawn = cut(known.withColumn("u", u).where(F.col("u") < int(share * 2**52)))
    # about train_rows rows of 20 bytes: the size of the broadcast is bounded by the parameter
    rows = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id").select("u", "label", "text")
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    if chars > train_chars:
        rows = rows.where(F.col("u") < int(share * train_chars / chars * 2**52))

    def features(batches):
        hasher = Hasher(bits)
        for b in batches:
            yield {"u": b["u"], "label": b["label"], "i": [np.unique(hasher(t)).astype("<u4").tobytes() for t in b["text"]]}

    def learn(batches):
        examples = []
        for b in batches:
            examples += [(np.frombuffer(i, "<u4"), y) for i, y in zip(b["i"], b["label"], strict=True)]
        if examples:
            at, w, bias = train_ftrl(examples, bits, **options)
            yield {"at": np.append(at, -1), "w": np.append(w, bias)}

    found = map_rows(rows, ["u", "label", "text"], "u long, label int, i binary", features)
    # one task: the sample is bounded
    model = map_rows(found.repartition(1).sortWithinPartitions("u", "i"), ["u", "label", "i"], "at long, w double", learn)
    got = model.collect()
    at = np.array([r["at"] for r in got if r["at"] >= 0], np.int64)
    w = np.array([r["w"] for r in got if r["at"] >= 0])
    bias = next((r["w"] for r in got if r["at"] < 0), -5.0)
    return at, w, bias


def score(docs: DataFrame, model, bits: int = BITS, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """id, the columns of ``keep`` and score (0 to 1) of every whole text; null counts as empty.

    Rows in are rows out, with null and repeated ids and equal texts like any others; columns that are
    not kept are not read; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    columns = list(dict.fromkeys([id_col, *(keep or [])]))
    if "score" in columns:
        raise ValueError("a kept column is named score")

    def run(batches):
        at, w, bias = shared.value
        table = np.zeros(1 << bits)
        table[at] = w
        hasher = Hasher(bits)
        for b in batches:
            out = []
            for text in b[text_col]:
                i = hasher(text)
                hit = np.unique(i[table[i] != 0])
                out.append(float(1 / (1 + np.exp(-np.clip(bias + table[hit].sum(), -35, 35)))))
            yield {c: b[c] for c in columns} | {"score": out}

    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns)
    return map_rows(docs, list(dict.fromkeys([*columns, text_col])), f"{kinds}, score double", run)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document.

    Rows in are rows out, whatever their ids; a null id is not held out, and equal texts score alike. Only doc_id and text are
    read of ``docs``, doc_id and toxic of ``labels``, so further columns clash with nothing; an empty table gives none.
    """
    model = fit(docs, labels, usable=~held_out())
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
