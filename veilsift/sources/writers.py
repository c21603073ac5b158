"""Writers of results, lists, reports and exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def json_result(entities: DataFrame, meta: dict, pretty: bool = False) -> DataFrame:
    """(value): one JSON document ``{meta, entities}`` for each id."""
    e = F.struct("start", "end", "type", "text", "score", "sources")
    packed = entities.groupBy("id").agg(F.sort_array(F.collect_list(e)).alias("entities"))
    head = F.struct(*[F.lit(v).alias(k) for k, v in meta.items()]) if meta else F.struct(F.lit(None).alias("none"))
    return packed.select("id", F.to_json(F.struct(head.alias("meta"), "entities"), {"pretty": str(pretty).lower()}).alias("value"))


def append_json_lines(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").json(path)


def append_list(rows: DataFrame, column: str, path: str) -> None:
    rows.select(F.col(column).cast("string")).write.mode("append").text(path)


def error_dumps(rows: DataFrame, path: str, most: int, kind: str) -> None:
    """Per type at most ``most`` rows, below ``path/kind/type=T``."""
    from ..operators.evaluate import capped

    capped(rows, "type", most).write.mode("overwrite").partitionBy("type").json(f"{path}/{kind}")


def append_dumps(rows: DataFrame, path: str, most: int, batch: int = 0, every: int = 0, whole_records: bool = False) -> None:
    """Rows (type, place, start, end, ...) of one batch below ``path/rows/batch=B/of=T``, at most ``most`` a type over all batches so far.

    Counts by type lie beside the rows, so a later batch goes on where the last one stopped, and a batch that is written again
    takes its own place. With ``whole_records`` a record is taken whole as long as the cap was not reached before it, so the
    last one can go over it. With ``every`` the cap begins anew after so many records (places) and nothing is carried over.
    """
    spark = rows.sparkSession
    fields = "type string, n long"
    window = F.floor(F.col("place") / every) if every else F.lit(0)
    before = None
    if batch and not every:
        known = spark.read.schema(f"{fields}, batch int").parquet(f"{path}/counts").where(F.col("batch") < batch)
        before = known.groupBy("type").agg(F.sum("n").alias("_before"))
    left = F.lit(most)
    rows = rows.withColumn("_window", window)
    if before is not None:
        rows = rows.join(before, "type", "left")
        left = F.lit(most) - F.coalesce("_before", F.lit(0))
    order = Window.partitionBy("type", "_window").orderBy("place", "start", "end")
    ranked = rows.withColumn("_left", left).withColumn("_n", F.row_number().over(order))
    # the first rows of a type are enough to know where the cap is reached
    head = ranked.where(F.col("_n") <= most)
    if whole_records:
        last = head.where(F.col("_n") == F.col("_left")).select("type", "_window", F.col("place").alias("_last"))
        ranked = rows.withColumn("_left", left).join(last, ["type", "_window"], "left")
        kept = ranked.where((F.col("_left") > 0) & (F.col("_last").isNull() | (F.col("place") <= F.col("_last"))))
    else:
        kept = head.where(F.col("_n") <= F.col("_left"))
    out = kept.drop("_n", "_left", "_last", "_window", "_before")
    target = f"{path}/rows/batch={batch}"
    out.withColumn("of", F.col("type")).write.mode("overwrite").partitionBy("of").json(target)
    written = spark.read.schema("type string").json(target)
    written.groupBy("type").agg(F.count("*").alias("n")).write.mode("overwrite").parquet(f"{path}/counts/batch={batch}")


def gold_export(store: DataFrame, path: str | None = None, plain: bool = False) -> DataFrame:
    """Annotated records, path-sorted: those with entities, or all of them with ``plain``; suggestions stay out."""
    rows = store if plain else store.where(F.size("entities") > 0)
    out = rows.select(F.col("path").alias("id"), "path", "text", "entities").orderBy("path")
    if path:
        out.write.mode("overwrite").json(path)
    return out


def split_lists(splits: DataFrame, records: DataFrame, path: str) -> None:
    """dev_files, test_files, dev_ids and test_ids, one name a line."""
    from ..functions.text import file_id

    ids = records.select("id", file_id(F.col("id")).alias("file")).join(splits.select("file", "split"), "file")
    for s in ("dev", "test"):
        splits.where(F.col("split") == s).select("file").orderBy("file").write.mode("overwrite").text(f"{path}/{s}_files")
        ids.where(F.col("split") == s).select("id").orderBy("id").write.mode("overwrite").text(f"{path}/{s}_ids")


def annotation_paths(paths: DataFrame, column: str = "path") -> DataFrame:
    """(src, dst) of an annotation folder: ``PAGE=k/PAR=j.txt`` becomes ``page{k}/p{j-1}.txt``, other names stay."""
    page, par = F.regexp_extract(column, r"PAGE=(\d+)/PAR=(\d+)\.txt$", 1), F.regexp_extract(column, r"PAGE=(\d+)/PAR=(\d+)\.txt$", 2)
    head = F.regexp_replace(column, r"PAGE=\d+/PAR=\d+\.txt$", "")
    new = F.concat(head, F.lit("page"), page.try_cast("int").cast("string"), F.lit("/p"), (par.try_cast("int") - 1).cast("string"), F.lit(".txt"))
    return paths.select(F.col(column).alias("src"), F.when(page != "", new).otherwise(F.col(column)).alias("dst"))


def copy_files(mapping: DataFrame) -> None:
    """Copies (src, dst) in the tasks."""

    def run(rows):
        import os
        import shutil

        for r in rows:
            os.makedirs(os.path.dirname(r["dst"]), exist_ok=True)
            shutil.copyfile(r["src"].removeprefix("file:"), r["dst"].removeprefix("file:"))

    mapping.foreachPartition(run)
