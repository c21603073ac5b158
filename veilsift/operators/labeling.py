"""State of an annotation project: entities, undo, suggestions, status, lists and progress.

Edits are an event log (path, at, action, type, start, end); states are folds over it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .prefix import prefix_pairs

UNDO_LEVELS = 50
KEY = ["path", "type", "start", "end"]


def undone(events: DataFrame) -> DataFrame:
    """The log without undo events and what they take back (each the last edit before it, 50 deep)."""
    packed = events.groupBy("path").agg(F.sort_array(F.collect_list(F.struct("at", "action", "type", "start", "end"))).alias("e"))
    empty = F.array().cast(packed.schema["e"].dataType.simpleString())
    base = F.struct(empty.alias("done"), F.lit(0).alias("depth"))

    def step(acc, x):
        n = F.size(acc["done"])
        back = (x["action"] == "undo") & (n > 0) & (acc["depth"] > 0)
        return (
            F.when(back, F.struct(F.slice(acc["done"], F.lit(1), n - 1).alias("done"), (acc["depth"] - 1).alias("depth")))
            .when(x["action"] == "undo", acc)
            .otherwise(F.struct(F.array_append(acc["done"], x).alias("done"), F.least(acc["depth"] + 1, F.lit(UNDO_LEVELS)).alias("depth")))
        )

    return packed.select("path", F.explode(F.aggregate("e", base, step)["done"]).alias("x")).select("path", "x.*")


def entities(events: DataFrame) -> DataFrame:
    """Entities that stand after all events (add, accept, remove): (path, type, start, end), each once."""
    order = Window.partitionBy(*KEY).orderBy(F.desc("at"))
    rows = events.where(F.col("action").isin("add", "accept", "remove")).withColumn("_n", F.row_number().over(order))
    return rows.where((F.col("_n") == 1) & (F.col("action") != "remove")).select(*KEY)


def accept_all(suggestions: DataFrame, at) -> DataFrame:
    """Events that accept suggestions (path, type, start, end)."""
    return suggestions.select("path", F.lit(at).alias("at"), F.lit("accept").alias("action"), "type", "start", "end")


def status(paths: DataFrame, with_entities: DataFrame, processed: DataFrame, reviewed: DataFrame, skipped: DataFrame) -> DataFrame:
    """(path, pdf, done, skipped): done has entities, was processed, or lies in a reviewed PDF; skipped lies below a skipped prefix."""
    rows = paths.withColumn("pdf", F.regexp_extract("path", r"^([^/]+)", 1))
    for name, table, on in (("e", with_entities, "path"), ("p", processed, "path"), ("r", reviewed, "pdf")):
        rows = rows.join(table.select(F.col(table.columns[0]).alias(on)).distinct().withColumn(f"_{name}", F.lit(True)), on, "left")
    prefix = skipped.select(F.col(skipped.columns[0]).alias("prefix")).distinct()
    out = prefix_pairs(paths.select("path").distinct(), "path", prefix, "prefix").select("path").distinct().withColumn("_s", F.lit(True))
    rows = rows.join(out, "path", "left")
    done = F.coalesce(F.col("_e"), F.col("_p"), F.col("_r"), F.lit(False))
    return rows.select("path", "pdf", done.alias("done"), F.coalesce("_s", F.lit(False)).alias("skipped"))


def listed(states: DataFrame, which: str = "All") -> DataFrame:
    cond = {"All": F.lit(True), "Labeled": F.col("done"), "Unlabeled": ~F.col("done"), "Skipped": F.col("skipped"), "Unskipped": ~F.col("skipped")}
    return states.where(cond[which])


def progress(states: DataFrame) -> DataFrame:
    return states.agg(
        F.countDistinct("pdf").alias("pdfs"), F.count_if(F.col("done")).alias("done"),
        F.count_if(~F.col("done") & ~F.col("skipped")).alias("todo"), F.count_if(F.col("skipped")).alias("skipped"),
    )


def validate_all(store: DataFrame) -> DataFrame:
    """(path, type, start, end, text_length) of entities in a store (path, text, entities) that lie out of bounds or are empty."""
    e = store.select("path", F.length("text").alias("text_length"), F.explode("entities").alias("e"))
    inside = (F.col("start") >= 0) & (F.col("start") < F.col("end")) & (F.col("end") <= F.col("text_length"))
    return e.select("path", "e.type", "e.start", "e.end", "text_length").where(~F.coalesce(inside, F.lit(False)))


def trimmed(selections: DataFrame) -> DataFrame:
    """Selections (text, start, end) without the white space at their ends; those of nothing else are left out."""
    from ..functions.text import FLAGS, SPACE

    cut = F.substring("text", F.col("start") + 1, F.col("end") - F.col("start"))
    head = F.length(F.regexp_extract(cut, f"{FLAGS}\\A{SPACE}*", 0))
    tail = F.length(F.regexp_extract(cut, f"{FLAGS}{SPACE}*\\z", 0))
    rows = selections.withColumn("_s", F.col("start") + head).withColumn("_e", F.col("end") - tail).where("_s < _e")
    return rows.withColumn("start", F.col("_s")).withColumn("end", F.col("_e")).drop("_s", "_e")
