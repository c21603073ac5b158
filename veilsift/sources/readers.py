"""Readers: text files, JSON lines, lists, paragraph trees, file corpora, annotation stores."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

GOLD = "id string, path string, text string, entities array<struct<type:string,start:int,end:int,text:string>>"
INDEX = (
    "path string, bytes long, mtime_epoch double, size_bucket string, page_count int, producer string, creator string, has_text_ops boolean, "
    "image_xobject_count int, large_image_count int, likely_scanned boolean, scan_score double, errors array<string>, processing_time_seconds double, pdf_id string"
)

#: Splits whose counts are broadcast by the reader of numbered lines.
BROADCAST_SPLITS = 50_000
#: Keys in a task, where rows are made from keys.
KEYS_A_TASK = 8192
#: Rows in a task, where rows of one key are sorted and merged together.
ROWS_A_TASK = 200_000


def table(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table; one that lies in fewer row groups than there are cores is dealt out to all of them.

    A task reads whole row groups, so a small table in one of them would keep one core busy. Tables
    with a row group for each core or more, which is all but small ones, are read as they are.
    """
    rows = spark.read.parquet(path)
    cores = spark.sparkContext.defaultParallelism
    if rows._jdf.queryExecution().toRdd().getNumPartitions() >= cores:
        return rows
    files = rows.inputFiles()
    if len(files) >= cores or not all(f.startswith("file:") for f in files):
        return rows
    from urllib.parse import unquote, urlsplit

    import pyarrow.parquet as pq

    groups = sum(pq.ParquetFile(unquote(urlsplit(f).path)).num_row_groups for f in files)
    return rows if groups >= cores else rows.repartition(cores)


def dealt(keys: DataFrame, most: int | None = None) -> DataFrame:
    """``keys`` in parts of about ``most`` rows at most, and in as many as there are cores at least, wherever they lie.

    For narrow rows from which far larger ones are made: a file of keys is so small that one task would read it, and so make all of them.
    """
    parts = -(-keys.count() // (most or KEYS_A_TASK))
    return keys.repartition(max(keys.sparkSession.sparkContext.defaultParallelism, parts))


def by_key(rows: DataFrame, count: int, *keys: str, most: int | None = None) -> DataFrame:
    """``rows`` by ``keys`` in parts of about ``most`` rows; there are ``count`` of them at most.

    For steps that sort: what a task holds stays the same however many rows there are, while a fixed number of parts
    grows with them. Windows and groups over these keys and more take the rows as they lie.
    """
    parts = -(-count // (most or ROWS_A_TASK))
    return rows.repartition(max(rows.sparkSession.sparkContext.defaultParallelism, parts), *keys)


def text_files(spark: SparkSession, path: str, glob: str = "*.txt", max_chars: int | None = None) -> DataFrame:
    """(path, text) of all files below a folder, each as one text, cut at ``max_chars`` where given."""
    rows = spark.read.format("text").option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    text = F.left("value", F.lit(max_chars)) if max_chars else F.col("value")
    return rows.select(F.col("_metadata.file_path").alias("path"), text.alias("text"))


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, n, value): the lines of text files between \\n, numbered from 1 in each file.

    Files are read in splits. A line's place in its split, which one task reads from front to end, and the number of lines
    in the splits before it give its number, so only one count a split is gathered and no file is read as a whole.
    """
    rows = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_block"), "value", F.monotonically_increasing_id().alias("_at")
    )
    splits = rows.groupBy("file", "_block").agg(F.count("*").alias("_lines"), F.min("_at").alias("_first"))
    before = F.sum("_lines").over(Window.partitionBy("file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))
    splits = splits.select(F.col("file").alias("_file"), F.col("_block").alias("_start"), "_first", F.coalesce(before, F.lit(0)).alias("_before"))
    # there are no more splits than files and tasks
    few = len(rows.inputFiles()) + rows._jdf.queryExecution().toRdd().getNumPartitions() <= BROADCAST_SPLITS
    placed = rows.join(F.broadcast(splits) if few else splits, (F.col("file") == F.col("_file")) & (F.col("_block") == F.col("_start")))
    return placed.select("file", (F.col("_before") + F.col("_at") - F.col("_first") + 1).alias("n"), "value")


def json_lines(spark: SparkSession, path: str, schema: str, places: bool = False) -> DataFrame:
    """Rows of JSON lines (gzip by suffix); blank and broken lines are passed over.

    With ``places`` also ``file`` and ``n``, the file and the line's number in it: an order that outlives any shuffle.
    """
    if not places:
        return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)
    return _parsed(lines(spark, path), schema).where("row is not null").select("row.*", "file", "n")


def json_lines_checked(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """(n, value, row, file): numbered lines that are not blank; ``row`` is null where the line is no JSON of the schema."""
    return _parsed(lines(spark, path), schema).select("n", "value", "row", "file")


def _parsed(numbered: DataFrame, schema: str) -> DataFrame:
    kept = numbered.withColumn("value", F.rtrim("value")).where(F.btrim("value") != "")
    row = F.from_json("value", f"{schema}, _bad string", {"columnNameOfCorruptRecord": "_bad"})
    return kept.withColumn("row", row).withColumn("row", F.when(F.col("row._bad").isNull(), F.col("row").dropFields("_bad")))


def id_list(spark: SparkSession, path: str, comments: bool = False) -> DataFrame:
    """(value) one a line, trimmed, without blank lines and, with ``comments``, without those that begin with #."""
    rows = spark.read.text(path).select(F.btrim("value").alias("value")).where("value <> ''")
    return rows.where(~F.startswith("value", F.lit("#"))) if comments else rows


def paragraph_tree(spark: SparkSession, path: str, max_chars: int = 200_000) -> DataFrame:
    """(doc, path, page, paragraph, text) of ``<doc>/PAGE=n/PAR=n.txt`` or ``<doc>/pageN/pN.txt`` files."""
    rows = text_files(spark, path, "*.txt", max_chars)
    name = F.col("path")
    return rows.select(
        F.nullif(F.regexp_extract(name, r"([^/]+)/(?:PAGE=\d+|page\d+)/[^/]+$", 1), F.lit("")).alias("doc"), "path",
        F.regexp_extract(name, r"(?:PAGE=|/page)(\d+)/", 1).try_cast("int").alias("page"),
        F.regexp_extract(name, r"(?:PAR=|/p)(\d+)\.txt$", 1).try_cast("int").alias("paragraph"), "text",
    )


def page_counts(paragraphs: DataFrame) -> DataFrame:
    """(doc, pages, paragraphs): distinct page folders and files."""
    return paragraphs.groupBy("doc").agg(F.countDistinct("page").alias("pages"), F.count("*").alias("paragraphs"))


def natural_key(path: Column) -> Column:
    """Sort key in which numbers count as numbers and case does not count."""
    parts = F.regexp_extract_all(F.lower(path), F.lit(r"\d+|\D+"), F.lit(0))
    return F.transform(parts, lambda x: F.when(x.rlike(r"^\d"), F.concat(F.lit("0"), F.lpad(F.ltrim(x, F.lit("0")), 20, "0"))).otherwise(F.concat(F.lit("1"), x)))


def file_corpus(spark: SparkSession, path: str, probe: Callable[[bytes], dict] | None = None, glob: str = "*.[pP][dD][fF]") -> DataFrame:
    """Index records of a corpus of files: size, hash, buckets, and what ``probe`` tells of the content.

    ``probe(content)`` returns page_count, producer, creator, has_text_ops, image_xobject_count and
    large_image_count, or raises; its error is kept in ``errors``. Without a probe these are null.
    """
    from ..functions import text as T

    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    known = "page_count int, producer string, creator string, has_text_ops boolean, image_xobject_count int, large_image_count int, errors array<string>"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [x.strip().split(" ")[0] for x in known.split(", ")]
        for b in batches:
            out = []
            for content in b["content"]:
                try:
                    got = (probe(bytes(content)) if probe else {}) | {"errors": []}
                except Exception as e:  # a broken file is a row with an error
                    got = {"errors": [f"{type(e).__name__}: {e}"]}
                out.append([got.get(n) for n in names])
            yield pd.concat([b[["path", "bytes", "mtime_epoch", "pdf_id"]].reset_index(drop=True), pd.DataFrame(out, columns=names).astype(object)], axis=1)

    base = rows.select("path", F.col("length").alias("bytes"), F.col("modificationTime").cast("double").alias("mtime_epoch"), "content")
    # a file whose content can't be read is told by its path, size and time
    told = T.stat_hash(F.col("path"), F.col("bytes"), F.col("mtime_epoch"))
    base = base.withColumn("pdf_id", F.coalesce(T.file_hash(F.col("content")), told))
    probed = base.mapInPandas(run, f"path string, bytes long, mtime_epoch double, pdf_id string, {known}")
    score = T.scan_score(
        F.coalesce("has_text_ops", F.lit(False)), F.coalesce("image_xobject_count", F.lit(0)), F.coalesce("large_image_count", F.lit(0)), F.col("bytes"), F.col("page_count")
    )
    return probed.withColumn("size_bucket", T.size_bucket(F.col("bytes"))).withColumn("scan_score", score).withColumn("likely_scanned", F.col("scan_score") >= 0.7)


def external_dataset(rows: DataFrame, locale: str, most: int | None = None, order: str = "id") -> DataFrame:
    """English rows of a locale, the first ``most`` of them."""
    out = rows.where((F.col("language") == "en") & (F.col("locale") == locale))
    return out.orderBy(order).limit(most) if most else out


def annotation_store(spark: SparkSession, path: str) -> DataFrame:
    """(path, text, entities) of an autosave file, in the present layout (``documents``) or the old one (paths at the top)."""
    entity = "array<struct<type:string,start:int,end:int,text:string>>"
    doc = f"struct<text:string,entities:{entity},suggestions:{entity}>"
    raw = spark.read.format("text").option("wholetext", True).load(path)
    new = F.from_json("value", f"struct<documents:map<string,{doc}>>")["documents"]
    old = F.from_json("value", f"map<string,{doc}>")
    rows = raw.select(F.explode(F.coalesce(new, old)).alias("path", "d"))
    return rows.where("d is not null").select("path", "d.text", F.coalesce("d.entities", F.array().cast(entity)).alias("entities"))


def extracted(spark: SparkSession, documents: DataFrame, extract: Callable[[str], list[str]]) -> DataFrame:
    """(doc, paragraph, text, error) by an extractor run in the tasks; its failure is a row with the error's last 1000 characters."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for doc in b["doc"]:
                try:
                    out += [(doc, i, t, None) for i, t in enumerate(extract(doc), 1)]
                except Exception as e:
                    out.append((doc, None, None, str(e)[-1000:]))
            yield pd.DataFrame(out, columns=["doc", "paragraph", "text", "error"]).astype(object)

    return documents.select("doc").mapInPandas(run, "doc string, paragraph int, text string, error string")
