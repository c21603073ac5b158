"""Shared plumbing of the training-data operators."""

from __future__ import annotations

import contextlib
import gc
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.shared import UNKNOWN_SIZE, cut, own_folder, shared_dir  # noqa: F401

#: A word is a run of characters that are neither the space nor one of \t \n \v \f \r.
WORD = r"[^\x20\x09-\x0D]+"


def release(spark: SparkSession) -> None:
    """Have Spark drop the shuffle files of what is written already; it does so when the driver's heap is swept."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def give_back() -> None:
    """Hand memory that a task has freed back to the system: a worker lives on after it, and would keep the most it ever held."""
    import ctypes

    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not with every C library
        ctypes.CDLL(None).malloc_trim(0)


def map_rows(
    df: DataFrame,
    columns: list[str],
    schema: str,
    function: Callable[[Iterator[dict[str, list]]], Iterable[dict[str, list]]],
    batch_rows: int = 256,
    arrays: tuple[str, ...] = (),
) -> DataFrame:
    """mapInArrow over ``columns`` as dicts of lists; a task holds about ``batch_rows`` rows at once.

    Columns named in ``arrays``, numbers without nulls, come as numpy arrays without a copy.

    ``function`` gets an iterator, so a task can keep bounded state between batches.
    """
    fields = T.StructType.fromDDL(schema) if hasattr(T.StructType, "fromDDL") else schema
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pieces():
            for batch in batches:
                for at in range(0, batch.num_rows, batch_rows):
                    part = batch.slice(at, batch_rows)
                    yield {name: part.column(i).to_numpy() if name in arrays else part.column(i).to_pylist() for i, name in enumerate(columns)}

        out = None
        try:
            for out in function(pieces()):
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], type=f.type) for f in arrow], schema=arrow)
        finally:
            del out
            give_back()

    return df.select(*columns).mapInArrow(run, schema)


def top_hash(*cols: Column | str) -> Column:
    """A uniform integer below 2**52 from md5, the same in Spark and in SQL engines."""
    text = F.concat_ws(":", *[c if isinstance(c, Column) else F.lit(c) for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")


def held_out(doc_id: str = "doc_id") -> Column:
    """Remainder 1 of crc32(id as text) by 3; a null id is never held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))
