"""Hard negatives by a vector-approximation file.

Components become integers, and each dimension is quantised into cells, a byte a component. The table of an
anchor holds what each cell of each dimension adds to the inner product at least and at most, so a row's
score is bounded by looking up its bytes. Only rows whose bounds reach into the window asked for, and whose upper
bound is no less than the lower bound of the k-th row that is surely in it, are scored exactly.

All rows lie in blocks of bounded size, dealt by row; the anchors go to every block, which answers with its k
best, and the best of all blocks are the answer. Cells are quantiles of the block, and a cell's bounds
are its least and greatest member, so bounds hold for every row and nothing is fit or sent beforehand.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut
from .vptree import _blocks

CELLS = 256
#: Rows of a block at least, if there are enough cores for smaller ones; components of a block at most.
BLOCK_ROWS, BLOCK_COMPONENTS = 2_048, 1 << 23
SCALE = 256
POSITIVES, NEGATIVES = 5, 10
#: A negative's score lies between these hundredths of the positive's.
WINDOW = (30, 90)
_LONG = (1 << 63) - 1


def integers(vectors: np.ndarray) -> np.ndarray:
    """floor(SCALE * x) as floats without a fraction; what overflows is the greatest double."""
    with np.errstate(over="ignore"):
        return np.clip(np.floor(vectors * SCALE), -np.finfo(float).max, np.finfo(float).max)


def exact(values: np.ndarray, wide: bool) -> np.ndarray:
    """Integers that can be multiplied and added without loss: int64, or if ``wide`` Python's own."""
    if not wide:
        return values.astype(np.int64)
    return np.array([int(x) for x in values.ravel().tolist()], object).reshape(values.shape)


def _long(score: np.ndarray) -> np.ndarray:
    """Python's integers beyond a long become the end of its range; so scores are compared as they are returned."""
    return np.minimum(np.maximum(score, -_LONG - 1), _LONG) if score.dtype == object and len(score) else score


class Approximation:
    """Rows of one length (integers) in cells; ``scored`` counts rows scored exactly, ``seen`` all that were asked about."""

    def __init__(self, rows: np.ndarray, cells: int = CELLS):
        self.rows = rows
        n, d = rows.shape
        self.codes = np.empty((d, n), np.uint8 if cells <= 256 else np.uint16)
        self.low, self.high = (np.zeros((d, cells), rows.dtype) for _ in range(2))
        for j in range(d):
            column = rows[:, j]
            ordered = np.sort(column)
            cuts = np.unique(ordered[np.arange(1, cells) * n // cells])
            self.codes[j] = np.searchsorted(cuts, column, "right")
            ends = np.append(np.searchsorted(ordered, cuts, "left"), n)
            starts = np.append(0, ends[:-1])
            full = np.flatnonzero(ends > starts)
            self.low[j, full], self.high[j, full] = ordered[starts[full]], ordered[ends[full] - 1]
        self.scored = self.seen = 0

    def bounds(self, anchor: np.ndarray, part: slice) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest possible score of each row of ``part``."""
        a, b = anchor[:, None] * self.low, anchor[:, None] * self.high
        table = np.stack((np.minimum(a, b), np.maximum(a, b)), axis=2)
        codes = self.codes[:, part]
        total = np.zeros((codes.shape[1], 2), table.dtype)
        for j in range(len(codes)):
            total += table[j].take(codes[j], axis=0)
        return _long(total[:, 0]), _long(total[:, 1])

    def best(self, anchor: np.ndarray, low: np.ndarray, high: np.ndarray, first: int, order: tuple, k: int, window: tuple) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the ``k`` best rows with a score within ``window``, of those from ``first`` on that ``low`` and
        ``high`` bound; ties by ``order``, keys from the last to the first."""
        least, most = window
        maybe = (high >= least) & (low <= most)
        sure = low[maybe & (low >= least) & (high <= most)]
        if len(sure) >= k:
            maybe &= high >= np.sort(sure)[len(sure) - k]
        at = np.flatnonzero(maybe) + first
        self.seen += len(low)
        self.scored += len(at)
        score = _long(self.rows[at] @ anchor)
        inside = (score >= least) & (score <= most)
        at, score = at[inside], score[inside]
        pick = np.lexsort((*[o[at] for o in order], -score))[:k]
        return at[pick], score[pick]


class Block:
    """The rows of one block and length, those of one label together."""

    def __init__(self, row: np.ndarray, values: np.ndarray, ids: np.ndarray, known: np.ndarray, label: np.ndarray):
        order = np.argsort(label, kind="stable")
        self.row, self.values, self.ids, self.known, self.label = row[order], values[order], ids[order], known[order], label[order]
        self.order = (self.ids, ~self.known)  # by id, rows without one last
        self.top = np.abs(values).max() if values.size else 0.0
        self.made: dict[bool, Approximation] = {}

    def approximation(self, anchor: np.ndarray) -> tuple[Approximation, np.ndarray]:
        """Cells and the anchor in integers that hold their products."""
        wide = bool(len(anchor) * max(self.top, 1.0) * max(np.abs(anchor).max(initial=0.0), 1.0) >= 2.0**53)
        if wide not in self.made:
            self.made[wide] = Approximation(exact(self.values, wide))
        return self.made[wide], exact(anchor, wide)

    def positives(self, anchor: np.ndarray, own: int, label: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` best other rows of the label."""
        cells, a = self.approximation(anchor)
        start, end = np.searchsorted(self.label, [label, label + 1]) if label < _LONG else (np.searchsorted(self.label, label), len(self.label))
        if start == end:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        low, high = cells.bounds(a, slice(start, end))
        other = self.row[start:end] != own
        # one more than asked for, as the own row may be among them
        at, score = cells.best(a, low, high, start, self.order, k + (not other.all()), (low.min(), high.max()))
        keep = np.flatnonzero(self.row[at] != own)[:k]
        return at[keep], score[keep]

    def negatives(self, anchor: np.ndarray, label: int, windows: list[tuple], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each window the ``k`` best rows of other labels in it."""
        cells, a = self.approximation(anchor)
        start, end = np.searchsorted(self.label, label, "left"), np.searchsorted(self.label, label, "right")
        sides = [(s, *cells.bounds(a, slice(s, e))) for s, e in ((0, start), (end, len(self.label))) if s < e]
        out = []
        for window in windows:
            found = [cells.best(a, low, high, s, self.order, k, window) for s, low, high in sides] if window[0] <= window[1] else []
            at, score = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.empty(0, np.int64), np.empty(0, np.int64))
            pick = np.lexsort((*[o[at] for o in self.order], -score))[:k]
            out.append((at[pick], score[pick]))
        return out


def usable(rows: DataFrame, id_col: str, label: Column, vec_col: str) -> DataFrame:
    """row, id, label, vec of rows with a label and a vector whose components are all finite; ``row`` tells equal rows apart."""
    took = rows.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), F.col(vec_col).alias("vec")).where("label is not null and vec is not null")
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return cut(took.where(finite).withColumn("row", F.monotonically_increasing_id()))


def hard_negatives(
    rows: DataFrame,
    anchors: Column,
    label: Column,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    window: tuple[int, int] = WINDOW,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score, exact over all rows.

    Anchors are the usable rows for which the condition ``anchors`` on ``id`` holds. Each row stands for itself: repeated rows
    are candidates, and anchors, as often as they come. A null id sorts last among equal scores. Rows of
    another length than the anchor's are no candidates. Scores are exact integers; one beyond a
    long counts as the end of its range. A positive score below zero has no negatives.
    Without anchors, positives or rows there is nothing to return.
    """
    spark = rows.sparkSession
    all_rows = usable(rows, id_col, label, vec_col)
    n, dim = all_rows.agg(F.count("*"), F.max(F.size("vec"))).first()
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(-(-n * max(dim or 1, 1) // BLOCK_COMPONENTS), min(-(-n // BLOCK_ROWS), partitions), 1)
    point = ["dim", "block", "kind", "row", "vec", "id", "known", "label", "scores"]
    known = [F.coalesce("id", F.lit(0)).alias("id"), F.col("id").isNotNull().alias("known")]
    placed = all_rows.select(
        F.size("vec").alias("dim"), F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int").alias("block"), F.lit(0).alias("kind"), "row", "vec", *known, "label",
        F.lit(None).cast("array<long>").alias("scores"),
    )
    asking = all_rows.where(anchors)
    first_k, last_k, (low, high) = positives, negatives, window

    def answers(batches):
        """Rows of a block, points before anchors, to (row, place, id, score): its best for each anchor."""
        key, held, block = None, [], None
        for (dim, number, kind), row, vec, (ids, is_known, labels, scores) in _blocks(batches, 3):
            if (dim, number) != key:
                key, held, block = (dim, number), [], None
            values = integers(vec)
            if not kind:
                held.append((row, values, ids, is_known.astype(bool), labels))
                continue
            if held:
                block, held = Block(*(np.concatenate(x) for x in zip(*held, strict=True))), []
            if block is None:  # no rows of this length here
                continue
            out = []
            for i in range(len(row)):
                if scores[i] is None:
                    found = [block.positives(values[i], row[i], int(labels[i]), first_k)]
                else:
                    spans = [(-(-low * p // 100), high * p // 100) for p in scores[i].tolist()]
                    found = block.negatives(values[i], int(labels[i]), spans, last_k)
                out += [(row[i], place, at, score) for place, (at, score) in enumerate(found) if len(at)]
            if out:
                at = np.concatenate([x[2] for x in out])
                size = [len(x[2]) for x in out]
                score = [int(s) for x in out for s in x[3].tolist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(np.array([x[0] for x in out], np.int64), size)), pa.array(np.repeat(np.array([x[1] for x in out], np.int32), size)),
                        pa.array(block.ids[at], pa.int64(), mask=~block.known[at]), pa.array(score, pa.int64()),
                    ],
                    ["row", "place", "id", "score"],
                )

    def best(asked: DataFrame, k: int) -> DataFrame:
        """(row, place, id, score, rank): the k best of all blocks for each anchor and place."""
        sent = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).select(
            F.size("vec").alias("dim"), "block", F.lit(1).alias("kind"), "row", "vec", *known, "label", "scores"
        )
        dealt = placed.unionByName(sent).repartition(max(blocks, partitions), "block")
        found = dealt.sortWithinPartitions("dim", "block", "kind", "row").select(*point).mapInArrow(answers, "row long, place int, id long, score long")
        order = Window.partitionBy("row", "place").orderBy(F.desc("score"), F.asc_nulls_last("id"))
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    chosen = cut(best(asking.withColumn("scores", F.lit(None).cast("array<long>")), positives))
    each = chosen.groupBy("row").agg(F.transform(F.sort_array(F.collect_list(F.struct("rank", "score"))), lambda x: x["score"]).alias("scores"))
    found = best(asking.join(each, "row"), negatives)
    named = chosen.select("row", (F.col("rank") - 1).alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    out = found.join(named, ["row", "place"]).join(asking.select("row", F.col("id").alias("anchor_id")), "row")
    return out.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def report(embeddings: DataFrame) -> DataFrame:
    """Hard negatives of every row whose vec_id is divisible by 100; where 7 divides vec_id the label moves on by one of ten."""
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives(embeddings, F.col("id") % 100 == 0, moved)


REPORT_SQL = """
WITH e AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS MATERIALIZED (
  SELECT a.r AS ar, a.vec_id AS anchor_id, b.r, b.vec_id, a.label = b.label AS same,
    coalesce(list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])), 0)::BIGINT AS score
  FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.r <> b.r AND len(a.v) = len(b.v)
),
p AS (
  SELECT ar, anchor_id, vec_id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY ar ORDER BY score DESC, vec_id NULLS LAST) AS place FROM s WHERE same QUALIFY place <= 5
)
SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.ar, place ORDER BY s.score DESC, s.vec_id NULLS LAST)::INT AS rank, s.vec_id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s ON p.ar = s.ar AND NOT s.same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score QUALIFY rank <= 10
"""
