"""Corpus index filters, pools, allocation over strata, and stratified samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .prefix import prefix_pairs


#: Strata whose shares are broadcast.
BROADCAST_STRATA = 100_000


def order_key(*cols: Column | str, seed: int = 0) -> Column:
    """A reproducible pseudo-random order: md5 over seed and columns."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string") if isinstance(c, str) else c, F.lit("")) for c in cols]))


def index_filter(
    index: DataFrame, min_pages: int = 0, max_pages: int = 0, sizes: tuple[str, ...] | None = None, exclude: DataFrame | None = None,
    allow_duplicates: bool = False, line_col: str = "line",
) -> DataFrame:
    """Usable records of a corpus index: excluded ones out, first of each pdf_id kept, then the page and size filters.

    ``exclude``: one column of paths or pdf_ids. Null pdf_ids are never duplicates.
    """
    rows = index.where((F.coalesce("path", F.lit("")) != "") & (F.coalesce("bytes", F.lit(0)) > 0))
    if exclude is not None:
        out = exclude.select(F.col(exclude.columns[0]).alias("_x")).distinct()
        rows = rows.join(out, rows["path"] == out["_x"], "left_anti")
        rows = rows.join(out, rows["pdf_id"] == out["_x"], "left_anti")
    if not allow_duplicates:
        first = F.row_number().over(Window.partitionBy("pdf_id").orderBy(line_col))
        known = rows.where(F.col("pdf_id").isNotNull()).withColumn("_n", first).where("_n = 1").drop("_n")
        rows = known.unionByName(rows.where(F.col("pdf_id").isNull()))
    keep = F.col("page_count").isNotNull() & (F.col("page_count") >= min_pages)
    if max_pages:
        keep = keep & (F.col("page_count") <= max_pages)
    if sizes:
        keep = keep & F.col("size_bucket").isin(*sizes)
    return rows.where(keep)


def pool(prefer_text: bool) -> Column:
    """scanned, text, or null (counted, but in no pool); a single pool without preference."""
    if not prefer_text:
        return F.lit("all")
    return F.when(F.col("likely_scanned"), "scanned").when(F.col("has_text_ops"), "text")


def quota(n: int, scanned_share: float) -> tuple[int, int]:
    scanned = int(n * scanned_share)
    return scanned, n - scanned


def allocate(counts: dict, n: int, keep: list | None = None) -> dict:
    """How many of n each stratum gives.

    More strata than n: one each of ``keep`` (n strata chosen by the caller). Else the proportional
    share, rounded half to even, one at least; then the sum is set right: a lack is added in turn to
    the largest strata (a full one loses its turn), a surplus is taken from the largest share above one.
    """
    if not counts or n <= 0:
        return {}
    if len(counts) > n:
        return dict.fromkeys((keep or sorted(counts, key=str))[:n], 1)
    if len(counts) == n:
        return dict.fromkeys(counts, 1)
    total = sum(counts.values())
    share = {k: max(1, round(c / total * n)) for k, c in counts.items()}
    lack = n - sum(share.values())
    largest = sorted(counts, key=counts.get, reverse=True)
    for i in range(max(0, lack)):
        k = largest[i % len(largest)]
        share[k] += share[k] < counts[k]
    for _ in range(max(0, -lack)):
        above = [k for k in share if share[k] > 1]
        if not above:
            break
        share[max(above, key=share.get)] -= 1
    return {k: min(v, counts[k]) for k, v in share.items()}


def stratified_sample(rows: DataFrame, strata: list[str], n: int, id_col: str, seed: int = 0) -> DataFrame:
    """About n rows over strata by ``allocate``; all rows if there are no more than n.

    Only a count for each stratum comes to the driver. Which rows of a stratum are taken follows
    md5 of seed and id.
    """
    counts = {tuple(r[s] for s in strata): r["count"] for r in rows.groupBy(*strata).count().orderBy(*strata).collect()}
    if sum(counts.values()) <= n:
        return rows
    import hashlib

    shuffled = sorted(counts, key=lambda k: hashlib.md5(f"{seed}:{k}".encode()).hexdigest())
    share = allocate(counts, n, shuffled)
    spark = rows.sparkSession
    schema = ", ".join(f"`_{s}` {rows.schema[s].dataType.simpleString()}" for s in strata) + ", _take int"
    plan = spark.createDataFrame([(*k, v) for k, v in share.items()], schema)
    on = [rows[s].eqNullSafe(plan[f"_{s}"]) for s in strata]
    ranked = rows.join(F.broadcast(plan) if len(share) <= BROADCAST_STRATA else plan, on).withColumn(
        "_n", F.row_number().over(Window.partitionBy(*strata).orderBy(order_key(id_col, seed=seed), id_col))
    )
    return ranked.where("_n <= _take").select(*rows.columns)


def marginals(rows: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, n) counts of each column on its own, in one pass."""
    return (
        rows.groupingSets([[F.col(c)] for c in columns], *[F.col(c) for c in columns])
        .agg(F.grouping_id().alias("g"), F.count("*").alias("n"), *[F.grouping(c).alias(f"_{c}") for c in columns])
        .select(
            F.coalesce(*[F.when(F.col(f"_{c}") == 0, F.lit(c)) for c in columns]).alias("column"),
            F.coalesce(*[F.when(F.col(f"_{c}") == 0, F.col(c).cast("string")) for c in columns]).alias("value"),
            "n",
        )
    )


def partition_report(report: DataFrame, bucket: Column) -> DataFrame:
    """Counts of a scan report by personal data and page bucket; errors and missing page counts apart."""
    ok = F.col("status") == "ok"
    return report.groupBy(F.when(ok, F.col("contains_pii")).alias("contains_pii"), F.when(ok, bucket).alias("bucket")).agg(
        F.count("*").alias("n"), F.count_if(~ok).alias("errors"), F.count_if(ok & (F.coalesce("page_count", F.lit(0)) == 0)).alias("missing_pages")
    )


def paragraph_folder(documents: DataFrame, folders: DataFrame) -> DataFrame:
    """(doc, folder): the folder of just the document's name, else the first one that begins with it."""
    pairs = prefix_pairs(folders.select("folder"), "folder", documents.select("doc").distinct(), "doc")
    best = F.min_by("folder", F.struct((F.col("folder") != F.col("doc")).alias("other"), F.col("folder")))
    return documents.join(pairs.groupBy("doc").agg(best.alias("folder")), "doc", "left")
