"""Which words of many lists a text holds, by one automaton over all of them: a text is read once, however many words there are."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..functions import tasks


class Words:
    """An automaton over lists of lower-case words; a word of several lists has all their bits."""

    def __init__(self, lists: Iterable[Iterable[str]]):
        bits: dict[str, int] = {}
        self.always = 0  # lists with an empty word, which every text holds
        for i, words in enumerate(lists):
            for w in words:
                if w:
                    bits[w] = bits.get(w, 0) | 1 << i
                else:
                    self.always |= 1 << i
        self.automaton = ahocorasick.Automaton()
        for w, b in bits.items():
            self.automaton.add_word(w, (len(w), b))
        self.empty = not bits
        if bits:
            self.automaton.make_automaton()

    def hits(self, text: str) -> Iterator[tuple[int, int, int]]:
        """(start, end, bits of the lists) of every word in a lower-case text."""
        if not self.empty:
            for last, (n, b) in self.automaton.iter(text):
                yield last + 1 - n, last + 1, b

    def mask(self, text: str) -> int:
        """Bits of the lists that have a word in a lower-case text."""
        out = self.always
        for _, _, b in self.hits(text):
            out |= b
        return out


def present(docs: DataFrame, lists: dict[str, tuple[str, ...]], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, types): names of the lists, in their order, that have a word in the text, whatever its case.

    Words are sought as they stand, within other words too. A null or empty text has none; each row gives one.
    """
    names = list(lists)

    kind = docs.schema[id_col].dataType.simpleString()
    ddl = f"id {kind}, types array<string>"
    schema = to_arrow_schema(StructType.fromDDL(ddl))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words([[w.lower() for w in lists[n]] for n in names])

        def held(text: str | None) -> Iterator[tuple]:
            mask = words.mask(text.lower()) if text else 0
            yield ([n for i, n in enumerate(names) if mask >> i & 1],)

        return tasks.results(batches, held, schema, keys=1)

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).mapInArrow(run, ddl)
