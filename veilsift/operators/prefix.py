"""Joins of texts with prefixes of them, as equi-joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def prefix_pairs(texts: DataFrame, text: str, prefixes: DataFrame, prefix: str) -> DataFrame:
    """Rows of ``texts`` and ``prefixes`` (other columns under other names) whose ``text`` begins with ``prefix``.

    Each text is exploded into its own beginnings of the lengths that prefixes have, and these are joined by equality; the
    lengths, at most as many as the longest prefix has characters, are all that comes to the driver. Null begins nothing, an empty
    prefix everything.
    """
    lengths = sorted(r["n"] for r in prefixes.select(F.length(prefix).alias("n")).where("n is not null").distinct().collect())
    known = F.array(*[F.lit(n) for n in lengths]).cast("array<int>")
    starts = F.transform(F.filter(known, lambda n: n <= F.length(text)), lambda n: F.left(F.col(text), n))
    return texts.withColumn("_start", F.explode(starts)).join(prefixes, F.col("_start") == F.col(prefix)).drop("_start")
