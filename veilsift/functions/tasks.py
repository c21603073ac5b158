"""What Arrow functions share: batches in small pieces, results in small batches, and freed memory given back."""

from __future__ import annotations

import contextlib
import gc
from collections.abc import Callable, Iterable, Iterator
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Rows, and bytes of text, that a task turns into Python objects at once; a longer text is alone.
PIECE, PIECE_BYTES = 256, 1 << 20
#: Results that a task gathers before they go on.
RESULTS = 4096


def cuts(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """(first, rows) of pieces of PIECE rows and PIECE_BYTES at most."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = done = 0
    while at < len(ends):
        n = max(1, min(PIECE, int(np.searchsorted(ends, done + PIECE_BYTES, "right")) - at))
        yield at, n
        at, done = at + n, int(ends[at + n - 1])


def results(batches: Iterator[pa.RecordBatch], each: Callable[..., Iterable[tuple]], schema: pa.Schema, keys: int = 2) -> Iterator[pa.RecordBatch]:
    """Batches of ``schema``: a row's first ``keys`` columns beside each of the tuples that ``each`` gives of its others, of which the first is a text.

    So a task holds few texts and few results as Python objects, however long the texts are. To be returned by the function that
    Spark calls: one that runs on keeps what ``each`` remembers when memory is given back.
    """
    return given_back(_results(batches, each, schema, keys))


def _results(batches: Iterator[pa.RecordBatch], each: Callable[..., Iterable[tuple]], schema: pa.Schema, keys: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for first, n in cuts(b.column(keys)):
            piece = b.slice(first, n)
            at, out = [], []
            for i, row in enumerate(zip(*(c.to_pylist() for c in piece.columns[keys:]), strict=True)):
                found = iter(each(*row))
                while True:
                    out.extend(islice(found, RESULTS - len(out)))
                    at.extend(repeat(i, len(out) - len(at)))
                    if len(out) < RESULTS:
                        break
                    yield _batch(piece, at, out, schema, keys)
                    at, out = [], []
            if out:
                yield _batch(piece, at, out, schema, keys)
        row = found = out = None
        give_back()  # before the next batch comes, while this one is still held


def _batch(piece: pa.RecordBatch, at: list[int], out: list[tuple], schema: pa.Schema, keys: int) -> pa.RecordBatch:
    rows = pa.array(at)
    own = [piece.column(i).take(rows).cast(schema.field(i).type) for i in range(keys)]
    return pa.RecordBatch.from_arrays([*own, *(pa.array(c, type=f.type) for c, f in zip(zip(*out, strict=True), list(schema)[keys:], strict=True))], schema=schema)


def given_back(made: Iterator) -> Iterator:
    """``made``; when it is at its end, and has dropped what it held, freed memory goes back to the system."""
    try:
        yield from made
    finally:
        del made
        give_back()


def give_back() -> None:
    """Hand freed memory back: a worker lives on after its task, and would keep the most that it ever held."""
    import ctypes

    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not with every C library
        ctypes.CDLL(None).malloc_trim(0)
