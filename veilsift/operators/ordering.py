"""Places and running totals over a whole table in order, without putting it into one task.

Rows are dealt by ranges of their order and sorted within them, so a row's place is its place in its
range after all that ranges before it hold: a prefix sum in two passes. Only one count for each range
(and group) goes through the driver, or through a window where there are very many groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import cut

#: monotonically_increasing_id keeps the number of the range above this bit.
RANGE_BIT = 33
#: Counts of ranges and groups that go to every task; more of them are joined by a shuffle.
MOST_COUNTS = 50_000


def _placed(rows: DataFrame, order: list[Column]) -> DataFrame:
    """``rows`` with _at: the number of its range above bit 33, and the place in it below.

    Equal rows are told apart by where they were read, so that a hot key is cut into ranges too. The
    ranges are drawn from a sample, so they are written before anything counts on them.
    """
    keys = [*order, F.col("_tie")]
    dealt = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie")
    return cut(dealt.withColumn("_at", F.monotonically_increasing_id()).withColumn("_range", F.shiftright("_at", RANGE_BIT)))


def _offsets(parts: DataFrame, by: str | None = None) -> DataFrame | None:
    """``parts`` (_range, n, ...) with ``before``, the sum of n over ranges before, and ``total``, of the same ``by``; None if they are too many for the driver."""
    found = parts.limit(MOST_COUNTS + 1).collect() if by else parts.collect()  # without groups there is one row a range
    if len(found) > MOST_COUNTS and by:
        return None
    sums, so_far = [], {}
    for r in sorted(found, key=lambda r: r["_range"]):
        key = r[by] if by else None
        sums.append((*r, so_far.get(key, 0)))
        so_far[key] = so_far.get(key, 0) + r["n"]
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in parts.schema.fields)
    return parts.sparkSession.createDataFrame([(*x, so_far[x[parts.columns.index(by)] if by else None]) for x in sums], f"{fields}, before long, total long")


def numbered(rows: DataFrame, order: list[Column], group: str | None = None, name: str = "place", total: str | None = None) -> DataFrame:
    """``rows`` and ``name``: how many rows (of the same ``group``, which holds no nulls) come before in ``order``.

    ``total`` names a column for the number of rows of the group. Ties are numbered in any order; a null
    sorts as ``order`` says. An empty table stays empty. Columns named _at, _range and _tie are not kept.
    ``rows`` is read twice, for a sample and to be dealt, so what is dear to make should be cut before.
    """
    by = [group] if group else []
    placed = _placed(rows, [*map(F.col, by), *order])
    parts = placed.groupBy(*by, "_range").agg(F.count("*").alias("n"), F.min("_at").alias("_first"))
    counts = _offsets(parts, group)
    few = counts is not None
    if not few:
        of_group = Window.partitionBy(group)
        before = F.sum("n").over(of_group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
        counts = parts.withColumns({"before": F.coalesce(before, F.lit(0)), "total": F.sum("n").over(of_group)})
    counts = counts.select(*by, "_range", "_first", "before", F.col("total").alias("_total"))
    joined = placed.join(F.broadcast(counts) if few else counts, [*by, "_range"])
    place = (F.col("before") + F.col("_at") - F.col("_first")).cast("long").alias(name)
    more = [F.col("_total").cast("long").alias(total)] if total else []
    return joined.select(*rows.columns, place, *more)


def running_total(rows: DataFrame, value: str, order: list[Column], name: str = "before", total: str | None = None) -> DataFrame:
    """``rows`` and ``name``: the sum of ``value`` (null: 0) over all rows before in ``order``, and the sum of all as ``total``."""
    placed = _placed(rows, order)
    counts = _offsets(placed.groupBy("_range").agg(F.sum(F.coalesce(value, F.lit(0))).cast("long").alias("n")))
    within = Window.partitionBy("_range").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    summed = placed.withColumn("_within", F.coalesce(F.sum(F.coalesce(value, F.lit(0))).over(within), F.lit(0)))
    joined = summed.join(F.broadcast(counts.select("_range", F.col("before").alias("_before"), F.col("total").alias("_total"))), "_range")
    more = [F.col("_total").alias(total)] if total else []
    return joined.select(*rows.columns, (F.col("_before") + F.col("_within")).alias(name), *more)
