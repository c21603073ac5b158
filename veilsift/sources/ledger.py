"""Extraction that can be killed and gone on with: tasks write what they have done, and a listing tells what is left."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

FIELDS = "doc string, status string, error string, paragraphs array<string>"
#: Characters of an error that are kept, from its end.
ERROR_CHARS = 1_000


def entries(spark: SparkSession, folder: str) -> DataFrame:
    """(doc, status, error, paragraphs) of every document that is done, ok or extract_error, each once.

    A task that was lost after it had written, or ran twice, leaves a document in two files; the first by name counts.
    """
    rows = spark.read.schema(FIELDS).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").json(folder)
    rows = rows.withColumn("_file", F.col("_metadata.file_path"))
    first = F.row_number().over(Window.partitionBy("doc").orderBy("_file", "status"))
    return rows.withColumn("_n", first).where("_n = 1").drop("_n", "_file")


def left(documents: DataFrame, folder: str, again: bool = False) -> DataFrame:
    """Documents (doc) that are neither extracted nor marked as failed; with ``again`` failed ones are tried once more."""
    done = entries(documents.sparkSession, folder)
    done = done.where("status = 'ok'") if again else done
    return documents.join(done.select("doc"), "doc", "left_anti")


def extract(documents: DataFrame, extract: Callable[[str], list[str]], folder: str, every: int = 64) -> DataFrame:
    """Extracts what is left of ``documents`` (doc) into ``folder`` and gives the entries of all.

    ``extract(doc)`` gives a document's paragraphs; if it raises, the document is marked as failed with the end of the error.
    A task writes a file for each ``every`` documents, under a name of its own that is complete once it is there: a run that is
    killed loses at most what was in the hands of its tasks, and the next one takes up those documents and no others.
    """
    spark = documents.sparkSession
    prepare(spark, folder)
    most = ERROR_CHARS

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import json
        import uuid

        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder)
        held: list[dict] = []

        def put():
            if held:
                name = uuid.uuid4().hex
                with store.open_output_stream(f"{base}/.{name}") as out:
                    out.write("".join(json.dumps(x, ensure_ascii=False) + "\n" for x in held).encode("utf-8", "surrogatepass"))
                store.move(f"{base}/.{name}", f"{base}/{name}.json")
                held.clear()

        n = 0
        for b in batches:
            for doc in b["doc"]:
                try:
                    held.append({"doc": doc, "status": "ok", "error": None, "paragraphs": list(extract(doc))})
                except Exception as e:  # a document that can't be read is a result, too
                    held.append({"doc": doc, "status": "extract_error", "error": (str(e) or "Unknown error (no output)")[-most:], "paragraphs": None})
                n += 1
                if len(held) >= every:
                    put()
        put()
        yield pd.DataFrame({"n": [n]})

    left(documents.select("doc").distinct(), folder).mapInPandas(run, "n long").agg(F.sum("n")).collect()
    return entries(spark, folder)


def prepare(spark: SparkSession, folder: str) -> None:
    """Makes the folder, so that a listing of nothing is no error."""
    from pyarrow import fs

    store, base = fs.FileSystem.from_uri(folder)
    store.create_dir(base, recursive=True)


def paragraphs(done: DataFrame) -> DataFrame:
    """(doc, path, text) of the paragraphs of extracted documents; ``path`` sorts as they stand."""
    each = done.where("status = 'ok'").select("doc", F.posexplode("paragraphs").alias("i", "text"))
    return each.select("doc", F.format_string("%012d", F.col("i") + 1).alias("path"), "text")


def failures(done: DataFrame) -> DataFrame:
    """(doc, error) of documents that were not extracted."""
    return done.where("status <> 'ok'").select("doc", "error")
