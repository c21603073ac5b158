"""Mixing sources to target weights by Pareto order sampling.

Targets: sources in code point order (null last) weigh by a repeating pattern and share a budget of
words; a source's target stops at a number of copies of it, and the excess is shared again by weight
among the others until none is above. A document then gets ``floor(target / size of source)`` certain
whole copies, and at most one more, with an inclusion probability of its own:

    p = r + r * (1 - r) * (g - mean of g)

where r is the part of the source's words that is still wanted, g in [0, 1) grows with the
document's size (or is a preference that the caller gives), and the mean is over the source's words. So
p lies between 0 and 1, longer documents are likelier, and the words expected are the words wanted.
Documents are ranked by random odds u/(1-u) divided by their inclusion odds p/(1-p), and the head of
this order whose words come nearest to the words wanted is taken.

The order is never sorted as a whole. Ranks are cut into BINS bins, words are summed by source and
bin, the bin in which a source's head ends is cut into BINS bins again, and only documents of the
last such bin (one in 16 million) are ordered among each other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordering import RANGE_BIT, numbered
from .common import WORD, cut, top_hash

BINS = 4096
#: How often the bin where a head ends is cut again.
LEVELS = 2
#: Size at which g is a half, and the whole number that stands for a g of one: sums of it are exact.
HALF, UNIT = 256, 1024
#: Most rows of the table of sources that are broadcast; beyond it the join is salted.
BROADCAST_SOURCES = 20_000
SALTS = 64


def _by_source(docs: DataFrame, sources: DataFrame) -> DataFrame:
    """Join on the null-safe source: a broadcast of checked size, else each source on SALTS keys."""
    if sources.count() <= BROADCAST_SOURCES:
        return docs.join(F.broadcast(sources), docs["source"].eqNullSafe(sources["source"]), "left").drop(sources["source"])
    salted = sources.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).select(
        "*", F.concat_ws(":", F.col("source").isNull().cast("int"), F.coalesce("source", F.lit(""))).alias("key")
    ).drop("source")
    keyed = docs.withColumn("salt", F.pmod(F.col("u"), F.lit(SALTS)).cast("int")).withColumn(
        "key", F.concat_ws(":", F.col("source").isNull().cast("int"), F.coalesce("source", F.lit("")))
    )
    return keyed.join(salted, ["key", "salt"], "left").drop("key", "salt")


def targets(sizes: DataFrame, pattern: tuple[int, ...], share: float, most: int) -> DataFrame:
    """(source, source_size, weight, target) from (source, source_size), one row a source.

    Water-filling: the level is where sources below their limit take weight times level and others
    their limit. Each round saturates all sources whose limit is under the level; two numbers come
    to the driver, and rounds end when none is added.
    """
    order = [F.col("source").isNull(), F.col("source")]
    if sizes.count() <= BROADCAST_SOURCES:
        placed = sizes.withColumn("position", F.row_number().over(Window.orderBy(*order)) - 1)
    else:
        placed = numbered(sizes, order, name="position")
    weights = F.array(*[F.lit(w) for w in pattern])
    s = cut(
        placed.withColumn("weight", F.element_at(weights, (F.col("position") % len(pattern) + 1).cast("int")))
        .withColumn("most", F.col("source_size") * most).drop("position")
    )
    total = s.agg(F.sum("source_size")).first()[0] or 0
    budget = min(share, most) * total
    level = 0.0
    full = F.lit(False)
    taken, weight, n = 0, s.agg(F.sum("weight")).first()[0] or 0, 0
    while weight:
        level = (budget - taken) / weight
        full = F.col("most") <= F.lit(level) * F.col("weight")
        row = s.agg(
            F.sum(F.when(full, F.col("most")).otherwise(0)), F.sum(F.when(full, 0).otherwise(F.col("weight"))), F.count_if(full)
        ).first()
        if row[2] == n:
            break
        taken, weight, n = row
    target = F.when(full, F.col("most").cast("double")).otherwise(F.lit(level) * F.col("weight"))
    return s.select("source", "source_size", "weight", target.alias("target"))


def preference(size: Column) -> Column:
    """g of a document by its size: 0 to 1 as a whole number of UNIT."""
    return F.floor(size * UNIT / (size + HALF)).cast("long")


def _ranked(docs: DataFrame, size: Column, id_col: str, source_col: str, text_col: str, prefer: Column | None, seed: int) -> DataFrame:
    """``docs`` plus one struct ``_mix`` with id, source, size, u and g."""
    size = size.cast("long")
    # rows without an id are told by their text
    key = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("null:"), F.md5(F.coalesce(F.col(text_col), F.lit("")))))
    return docs.withColumn(
        "_mix",
        F.struct(
            F.col(id_col).alias("id"),
            F.col(source_col).alias("source"),
            size.alias("size"),
            top_hash(F.lit(str(seed)), key).alias("u"),
            (preference(size) if prefer is None else F.least(F.greatest(prefer.cast("long"), F.lit(0)), F.lit(UNIT))).alias("g"),
        ),
    )


def _placed(rows: DataFrame) -> DataFrame:
    """Adds p, rank and the place of the rank in 0 to 1 to rows with u, g and the source's r and mean."""
    r = F.col("r")
    p = r + r * (F.lit(1.0) - r) * (F.col("g") / F.lit(float(UNIT)) - F.col("mean"))
    p = F.least(F.greatest(p, F.lit(1e-12)), F.lit(1 - 1e-12))
    u = (F.col("u") + F.lit(0.5)) / F.lit(float(2**52))
    rank = (u / (F.lit(1.0) - u)) / (F.col("p") / (F.lit(1.0) - F.col("p")))
    at = F.col("rank") / (F.lit(1.0) + F.col("rank")) * float(BINS**LEVELS)
    return rows.withColumn("p", p).withColumn("rank", rank).withColumn("at", F.least(F.floor(at), F.lit(BINS**LEVELS - 1)).cast("long"))


def plan_mix(slim: DataFrame, pattern: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: int = 2) -> DataFrame:
    """One row a source: target, certain copies, and where its head of the Pareto order ends.

    ``slim`` has id, source, size, u and g of every document; it is read once for each level and once more.
    """
    sizes = slim.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum(F.col("size") * F.col("g")).alias("liked"))
    sizes = cut(sizes)
    plan = targets(sizes.select("source", "source_size"), pattern, share, most)
    full = F.col("source_size") > 0
    plan = _extend(plan, sizes.select("source", F.when(full, F.col("liked") / F.col("source_size") / F.lit(float(UNIT))).otherwise(F.lit(0.0)).alias("mean")))
    whole = F.when(full, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(most))).otherwise(F.lit(0))
    plan = plan.withColumn("whole", whole.cast("long"))
    plan = plan.withColumn("need", F.col("target") - F.col("whole") * F.col("source_size"))
    r = F.when(full, F.col("need") / F.col("source_size")).otherwise(F.lit(0.0))
    # the edge: places from edge_first on, edge_width of them, before which edge_before words lie
    plan = cut(plan.withColumns({"r": r, "edge_first": F.lit(0).cast("long"), "edge_before": F.lit(0).cast("long")}))

    for level in range(LEVELS):
        width = BINS ** (LEVELS - 1 - level)
        inside = F.col("at").between(F.col("edge_first"), F.col("edge_first") + (width * BINS - 1))
        rows = _placed(_by_source(slim, plan)).where(inside).withColumn("bin", F.floor((F.col("at") - F.col("edge_first")) / width).cast("int"))
        bins = rows.groupBy("source", "bin").agg(
            F.sum("size").alias("bin_size"), F.first("need").alias("need"), F.first("edge_first").alias("first"), F.first("edge_before").alias("before")
        )
        # at most BINS rows a source
        upto = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        bins = bins.withColumn("before", F.col("before") + F.sum("bin_size").over(upto) - F.col("bin_size"))
        # the bin where the head ends: the last one that begins before the words needed are reached
        edge = bins.where(F.col("before") < F.col("need")).groupBy("source").agg(
            F.max_by(F.col("first") + F.col("bin").cast("long") * width, "bin").alias("edge_first"), F.max_by("before", "bin").alias("edge_before")
        )
        plan = _extend(plan.drop("edge_first", "edge_before"), edge)

    # rows that rank, size and id don't tell apart are one row here, however many they are
    rows = _placed(_by_source(slim, plan)).where((F.col("at") == F.col("edge_first")) & (F.col("size") > 0))
    ties = rows.groupBy("source", "rank", "size", "id").agg(F.count("*").alias("n"), F.first("need").alias("need"), F.first("edge_before").alias("before"))
    order = Window.partitionBy("source").orderBy("rank", "size", "id").rowsBetween(Window.unboundedPreceding, -1)
    ties = ties.withColumn("head", F.coalesce(F.sum(F.col("size") * F.col("n")).over(order), F.lit(0)) + F.col("before"))
    # a document is in the head if its middle word is: the head then ends as near as can be
    fits = lambda k: 2 * (F.col("head") + k * F.col("size")) + F.col("size") <= 2 * F.col("need")  # noqa: E731  after k of the ties
    guess = F.floor((F.col("need") - F.col("head")) / F.col("size") + 0.5).cast("long")
    some = F.when(fits(guess), guess + 1).when(fits(guess - 1), guess).otherwise(guess - 1)
    ties = ties.withColumn("took", F.least(F.greatest(some, F.lit(0)), F.col("n"))).where("took > 0")
    last = ties.groupBy("source").agg(F.max(F.struct("rank", "size", "id", "took", "n")).alias("last"))
    return _extend(plan, last.select("source", F.struct("last.rank", "last.size", "last.id").alias("last"), "last.took", F.col("last.n").alias("tied")))


def _extend(plan: DataFrame, more: DataFrame) -> DataFrame:
    more = more.withColumnRenamed("source", "_source")
    return cut(plan.join(more, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source"))


def allot(
    docs: DataFrame,
    size: Column,
    id_col: str = "doc_id",
    source_col: str = "source",
    prefer: Column | None = None,
    pattern: tuple[int, ...] = (3, 1, 2),
    share: float = 1.5,
    most: int = 2,
    seed: int = 7,
    out: str = "mix",
    text_col: str = "text",
) -> DataFrame:
    """``docs`` plus a struct named ``out``: size, source_size, target, copies, taken (copies times size).

    Two passes over ``docs``: one writes id, source, size, random number and g, the other applies the
    plan (a row a source) in place, so texts are never shuffled. Deterministic: the random number is
    md5 of seed and id, or of the text where the id is null. Ties of rank are broken by size, then
    id; of rows equal in all three as many are taken as the head has room for. Null source is a source of its own,
    ordered last. Documents without words are never taken. An empty table gives an empty result. ``prefer`` (0 to
    UNIT) takes the place of g.
    """
    ranked = _ranked(docs, size, id_col, source_col, text_col, prefer, seed)
    plan = plan_mix(cut(ranked.select("_mix.*")), pattern, share, most)
    names = docs.columns
    rows = ranked.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), "_mix.*")
    rows = _placed(_by_source(rows, plan))
    key = F.struct("rank", "size", "id")
    inside = (F.col("at") == F.col("edge_first")) & (key <= F.col("last"))
    more = F.coalesce((F.col("at") < F.col("edge_first")) | inside, F.lit(False))
    rows = rows.withColumn("more", more.cast("long"))
    if not plan.where("took < tied").isEmpty():
        rows = _first_ties(rows, F.coalesce(inside & key.eqNullSafe(F.col("last")) & F.expr("took < tied"), F.lit(False)))
    copies = F.when(F.col("size") > 0, F.col("whole") + F.col("more")).otherwise(F.lit(0)).cast("long")
    rows = rows.withColumn("copies", copies)
    mix = F.struct("size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))
    return rows.select("_row.*", mix.alias(out))


def _first_ties(rows: DataFrame, tied: Column) -> DataFrame:
    """``rows`` with ``more`` set to 0 for those ``tied`` rows of a source that come after the first ``took`` of them.

    They are numbered where they are read: their place in their partition after all that partitions before it
    hold of their source. So texts stay where they are; the table must come in the same partitions each time it is
    read, as files do, or else a few rows more or less are taken.
    """
    some = rows.where(tied).sortWithinPartitions("source").withColumn("_at", F.monotonically_increasing_id())
    some = some.withColumn("_part", F.shiftright("_at", RANGE_BIT))
    before = Window.partitionBy("source").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = some.groupBy("source", "_part").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    parts = cut(parts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))))
    parts = parts.select(F.col("source").alias("_source"), F.col("_part").alias("_of"), "_first", "_before")
    parts = F.broadcast(parts) if parts.count() <= BROADCAST_SOURCES else parts
    placed = some.join(parts, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_part") == F.col("_of")))
    late = F.col("_before") + F.col("_at") - F.col("_first") >= F.col("took")
    placed = placed.withColumn("more", F.when(late, F.lit(0)).otherwise(F.col("more")).cast("long"))
    return rows.where(~tied).unionByName(placed.select(*rows.columns))


def mixed(docs: DataFrame, size: Column, **options) -> DataFrame:
    """The mix itself: every document as many times as the plan takes it, with the columns of ``docs``."""
    rows = allot(docs, size, out="_mixed", **options).where("_mixed.copies > 0")
    each = F.explode(F.sequence(F.lit(1).cast("long"), "_mixed.copies"))
    return rows.withColumn("_mixed", each).select([F.col(f"`{c}`") for c in docs.columns])


def words(text: str = "text") -> Column:
    """Number of words; null has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target and taken of every document."""
    return allot(docs.select("doc_id", "source", "text"), words()).select(
        "doc_id", "mix.size", "mix.source_size", "mix.target", "mix.taken"
    )


#: The report in SQL: the level is found by ordering sources by limit per weight.
REPORT_SQL = r"""
WITH w0 AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    (('0x' || substr(md5('7:' || coalesce(doc_id::VARCHAR, 'null:' || md5(coalesce(text, '')))), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u
  FROM documents
),
d AS (SELECT *, floor(size * 1024::DOUBLE / (size + 256))::BIGINT AS g FROM w0),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, 2 * source_size AS most,
    [3, 1, 2][1 + (row_number() OVER (ORDER BY (source IS NULL), source) - 1) % 3] AS weight FROM s
),
o AS (
  SELECT *, row_number() OVER (ORDER BY most::DOUBLE / weight, source NULLS LAST) AS k,
    coalesce(sum(most) OVER (ORDER BY most::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below,
    sum(weight) OVER (ORDER BY most::DOUBLE / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS above
  FROM w
),
level AS (
  SELECT min_by((1.5::DOUBLE * (SELECT sum(source_size) FROM s)::BIGINT - below::BIGINT) / above::BIGINT, k) AS level
  FROM o WHERE most > (1.5::DOUBLE * (SELECT sum(source_size) FROM s)::BIGINT - below::BIGINT) / above::BIGINT * weight
),
t AS (
  SELECT source, source_size, CASE WHEN most <= level * weight THEN most::DOUBLE ELSE level * weight END AS target FROM w, level
),
p AS (
  SELECT *, least(CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END, 2) AS whole,
    target - whole * source_size AS need, CASE WHEN source_size > 0 THEN need / source_size ELSE 0 END AS r,
    CASE WHEN source_size > 0 THEN liked::DOUBLE / source_size / 1024::DOUBLE ELSE 0 END AS mean
  FROM t JOIN (SELECT source AS s, sum(size * g)::BIGINT AS liked FROM d GROUP BY source) ON source IS NOT DISTINCT FROM s
),
i AS (
  SELECT doc_id, size, d.source, source_size, target, whole, need, u,
    least(greatest(r + r * (1::DOUBLE - r) * (g / 1024::DOUBLE - mean), 1e-12::DOUBLE), (1 - 1e-12)::DOUBLE) AS p
  FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source
),
k AS (SELECT *, (u / (1::DOUBLE - u)) / (p / (1::DOUBLE - p)) AS rank FROM i),
q AS (
  SELECT doc_id, size, source_size, target, whole, need,
    coalesce(sum(size) OVER (PARTITION BY source ORDER BY rank, size, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS head
  FROM k
)
SELECT doc_id, size, source_size, target,
  (CASE WHEN size > 0 THEN whole + CASE WHEN head < need AND 2 * head + size <= 2 * need THEN 1 ELSE 0 END ELSE 0 END * size)::BIGINT AS taken
FROM q
"""
