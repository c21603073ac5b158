"""How long the stages of detection take on pages of text: quantiles in milliseconds, and pages a second."""

from __future__ import annotations

import time
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import dictionary, evaluate, ordering, sampling
from ..operators.regex_detect import Finder, Normalized
from ..options import BenchOptions, DetectOptions
from ..sources import readers, shared

STAGES = ("read_ms", "normalize_ms", "regex_ms", "dict_ms", "total_ms")


def pages(spark: SparkSession, path: str, options: BenchOptions) -> DataFrame:
    """(path, text, at): text files below a folder in the order of the bench, the first ``max_pages`` of them."""
    rows = readers.text_files(spark, path, options.glob)
    order = [sampling.order_key("path", seed=options.seed)] if options.shuffle else []
    placed = ordering.numbered(rows.select("path"), [*order, F.col("path")], name="at")
    if options.max_pages:
        placed = placed.where(F.col("at") < options.max_pages)
    return rows.join(placed, "path")


def timings(texts: DataFrame, options: BenchOptions, detect: DetectOptions, names: DataFrame | None = None) -> DataFrame:
    """(at, run, path, chars, entities, stages...) of each page and run but the first ``warmup`` ones of all.

    Pages are timed in the tasks that hold them; reading is the time to take a page up. ``names`` must fit in a task.
    """
    known = frozenset(r["name"] for r in names.select("name").limit(dictionary.BROADCAST_NAMES + 1).collect()) if names is not None else frozenset()
    if len(known) > dictionary.BROADCAST_NAMES:
        raise ValueError("too many names for a task")
    sent = texts.sparkSession.sparkContext.broadcast(known)
    runs, words = options.runs, detect.max_name_words

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        find = Finder(detect)
        match = dictionary.Matcher(sent.value, words or max((len(n.split(" ")) for n in sent.value), default=1))
        clock = time.perf_counter
        for b in batches:
            out = []
            for path, text, at in zip(b["path"], b["text"], b["at"], strict=True):
                for i in range(runs):
                    marks = [clock()]
                    page = str(text or "")
                    marks.append(clock())
                    Normalized(page)
                    marks.append(clock())
                    found = len(list(find(page)))
                    marks.append(clock())
                    found += len(list(match(page))) if sent.value else 0
                    marks.append(clock())
                    took = [1000 * (y - x) for x, y in zip(marks, marks[1:], strict=False)]
                    out.append((at, i, path, len(page), found, *took, sum(took)))
            yield pd.DataFrame(out, columns=["at", "run", "path", "chars", "entities", *STAGES])

    fields = "at long, run int, path string, chars int, entities int, " + ", ".join(f"{s} double" for s in STAGES)
    rows = texts.select("path", "text", "at").mapInPandas(run, fields)
    # warm-up pages are the first of the first run, and of the next ones if it has too few
    if not options.warmup:
        return rows
    nth = F.col("at") + F.col("run") * F.count("*").over(Window.partitionBy("run"))
    return rows.withColumn("_nth", nth).where(F.col("_nth") >= options.warmup).drop("_nth")


def run(spark: SparkSession, path: str, options: BenchOptions | None = None, detect: DetectOptions | None = None, names: DataFrame | None = None, profile: bool = False) -> dict:
    """{meta, throughput, stages} of a bench, and with ``profile`` a row a page; an error where no page is left to time."""
    options, detect = options or BenchOptions(), detect or DetectOptions(detectors=("regex", "dict"))
    began = time.monotonic()
    rows = shared.cut(timings(pages(spark, path, options), options, detect, names))
    wall = 1000 * (time.monotonic() - began)
    n = rows.count()
    if not n:
        raise ValueError(f"no page below {path} is left after {options.warmup} to warm up")
    out = {
        "meta": {"path": path, "runs": options.runs, "warmup": options.warmup, "pages": n, "profile": profile},
        "throughput": {"pages_per_sec": round(1000 * n / wall, 2), "wall_ms": round(wall, 1)},
        "stages": {s: evaluate.quantiles(rows, s).first().asDict() for s in STAGES},
    }
    if profile:
        each = rows.orderBy("run", "at").select(F.element_at(F.split("path", "/"), -1).alias("filename"), "chars", "entities", *STAGES)
        out["profile"] = [r.asDict() for r in each.collect()]
    return out
