"""Detection over streams: each row by itself, so batches are independent."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import regex_detect, scan
from ..options import DetectOptions
from ..plans.detect import detect_entities


def stream_entities(docs: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, options: DetectOptions | None = None, **more) -> StreamingQuery:
    """The whole plan on each micro-batch; ``sink(entities, batch_id)`` should be idempotent by batch id."""

    def batch(df: DataFrame, batch_id: int) -> None:
        sink(detect_entities(df, options, **more), batch_id)

    return docs.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_patterns(docs: DataFrame, options: DetectOptions, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pattern spans as a streaming frame: projections and explodes only, so it runs in append mode."""
    return regex_detect.detect(docs, options, id_col, text_col)


def stream_scan(docs: DataFrame, threshold: float = 0.0, text_col: str = "text") -> DataFrame:
    """First match of each row as a streaming frame."""
    return docs.withColumn("match", scan.first_match(F.col(text_col), threshold)).where("match is not null")
