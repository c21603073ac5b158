"""Line dedup that can be undone: exact references of lines by document, and sharded cuckoo filters in front.

A line's key is the line without white space at both ends, A-Z in lower case; keys of fewer than LEAST_CHARS
code points are never dropped. The index lies in a folder as batches that are only ever added:

* ``references``: (id, k1, k2, sign), one row for each document and key; a deleted document's rows
  come again with the sign turned, so counts are sums and every step can be taken back;
* ``shared``: (k1, k2, n, top) of the keys that enough documents hold, exact, made from the references;
* ``filters``: a cuckoo filter for each shard of the keys that are shared. A batch adds what has become
  shared and removes what no longer is; a shard whose filter has no room is made anew.

Cleaning looks up every line in the filters where the text is read. Texts with no line that may be shared
are finished there. For the others the held keys, not the lines, are joined to the exact table, so what
the filters take for held wrongly does no harm, and only their texts are shuffled.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import own_folder
from .cuckoo import CuckooFilter

LEAST_DOCS = 3
LEAST_CHARS = 20
SHARDS = 64
#: Filters of more bytes are not broadcast; every text then goes on to the exact join.
FILTER_BYTES = 64 << 20
_SPACE = b" \t\n\v\f\r"


def split_lines(text: bytes | None) -> list[bytes]:
    """Lines between \\n; null and empty texts are one empty line."""
    return text.split(b"\n") if text else [b""]


def line_key(line: bytes, least_chars: int = LEAST_CHARS) -> bytes | None:
    """16 bytes that stand for the line's key; None if the key is too short to be dropped."""
    key = line.strip(_SPACE)
    # a code point takes one byte to four
    if len(key) < least_chars or (len(key) < 4 * least_chars and sum(b & 0xC0 != 0x80 for b in key) < least_chars):
        return None
    return xxhash.xxh3_128_digest(key.lower())


def _longs(keys: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(keys), "<i8").reshape(-1, 2).astype(np.int64)


def _held(keys: np.ndarray, filters: dict[int, bytes], shards: int) -> np.ndarray:
    """Which keys may be shared."""
    out = np.zeros(len(keys), bool)
    shard = keys[:, 1] % shards
    for s in np.unique(shard).tolist():
        if s in filters:
            at = np.flatnonzero(shard == s)
            out[at] = CuckooFilter.from_bytes(filters[s]).holds(keys[at, 0])
    return out


class LineIndex:
    """References, shared keys and filters in ``folder`` (a new one below the shared folder by default).

    An index that is there already goes on after its last whole batch; what a broken run has left of
    the next one is written over. ``shards`` must be what the index was made with. Every row is a document: repeated
    rows count as often as they come, a null id is below all others, a null text is one empty line.
    """

    def __init__(
        self, spark: SparkSession, folder: str | None = None, least_docs: int = LEAST_DOCS, least_chars: int = LEAST_CHARS, shards: int = SHARDS,
        filter_bytes: int = FILTER_BYTES, id_col: str = "doc_id", text_col: str = "text",
    ):
        self.spark, self.folder = spark, folder or own_folder(spark, "lines")
        self.least_docs, self.least_chars, self.shards, self.filter_bytes = least_docs, least_chars, shards, filter_bytes
        self.id_col, self.text_col = id_col, text_col
        self.batch = 0
        try:  # filters come last in a batch
            self.batch = spark.read.parquet(f"{self.folder}/filters").agg(F.max("batch")).first()[0] or 0
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise

    def _path(self, kind: str, batch: int) -> str:
        return f"{self.folder}/{kind}/batch={batch}"

    def _texts(self, docs: DataFrame) -> DataFrame:
        return docs.select(F.col(self.id_col).alias("id"), F.col(self.text_col).cast("binary").alias("text"))

    def references(self, upto: int | None = None) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/references").where(F.col("batch") <= (self.batch if upto is None else upto)).drop("batch")

    def shared(self) -> DataFrame:
        """(k1, k2, n, top): keys of at least ``least_docs`` documents, and the largest id that holds each."""
        return self.spark.read.parquet(self._path("shared", self.batch))

    def insert(self, docs: DataFrame) -> LineIndex:
        """Add the keys of ``docs``."""
        least = self.least_chars

        def keys(batches):
            for b in batches:
                found = [{line_key(x, least) for x in split_lines(t)} - {None} for t in b.column(1).to_pylist()]
                n = [len(x) for x in found]
                k = _longs([y for x in found for y in x])
                ids = b.column(0).take(pa.array(np.repeat(np.arange(b.num_rows), n)))
                yield pa.RecordBatch.from_arrays([ids, pa.array(k[:, 0]), pa.array(k[:, 1])], ["id", "k1", "k2"])

        kind = docs.schema[self.id_col].dataType.simpleString()
        self._add(self._texts(docs).mapInArrow(keys, f"id {kind}, k1 long, k2 long").withColumn("sign", F.lit(1).cast("long")))
        return self

    def delete(self, ids: DataFrame) -> LineIndex:
        """Take back all documents whose id is in the first column of ``ids``; an id that is not there changes nothing."""
        if self.batch:
            gone = ids.select(F.col(ids.columns[0]).alias("_id")).distinct()
            mine = self.references().join(gone, F.col("id").eqNullSafe(F.col("_id")), "left_semi")
            self._add(mine.groupBy("id", "k1", "k2").agg((-F.sum("sign")).alias("sign")).where("sign <> 0"))
        return self

    def _add(self, references: DataFrame) -> None:
        b = self.batch + 1
        references.write.mode("overwrite").parquet(self._path("references", b))
        rows = self.references(b)
        if not rows.where("sign < 0").isEmpty():  # a document counts while its own sum is left
            rows = rows.groupBy("k1", "k2", "id").agg(F.sum("sign").alias("sign")).where("sign > 0")
        counts = rows.groupBy("k1", "k2").agg(F.sum("sign").alias("n"), F.max("id").alias("top")).where(F.col("n") >= self.least_docs)
        counts.write.mode("overwrite").parquet(self._path("shared", b))
        self._filter(b)
        self.batch = b

    def _filter(self, b: int) -> None:
        """Filters of the shards after batch ``b``: those before it, less what is no longer shared, and what is new."""
        keys = ["k1", "k2"]
        now = self.spark.read.parquet(self._path("shared", b)).select(*keys)
        shard = F.pmod("k2", F.lit(self.shards)).cast("int").alias("shard")
        if self.batch:
            was = self.shared().select(*keys)
            added, removed = now.join(was, keys, "left_anti"), was.join(now, keys, "left_anti")
            old = self.spark.read.parquet(self._path("filters", self.batch)).select("shard", "bits")
        else:
            added, removed, old = now, now.where("false"), self.spark.createDataFrame([], "shard int, bits binary")
        changes = added.select(shard, "k1", F.lit(True).alias("new")).unionByName(removed.select(shard, "k1", F.lit(False).alias("new")))

        def update(key: tuple, held: pd.DataFrame, change: pd.DataFrame) -> pd.DataFrame:
            new = change["k1"].to_numpy()[change["new"].to_numpy(bool)]
            if len(held):
                f = CuckooFilter.from_bytes(held["bits"].iloc[0])
                f.table = f.table.copy()
                f.remove(change["k1"].to_numpy()[~change["new"].to_numpy(bool)])
                bits = f.to_bytes() if f.add(new) else None
            else:
                bits = CuckooFilter.of(new).to_bytes()
            return pd.DataFrame({"shard": [key[0]], "bits": [bits]})

        def anew(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"shard": [key[0]], "bits": [CuckooFilter.of(rows["k1"].to_numpy()).to_bytes()]})

        fields = "shard int, bits binary"
        path = self._path("filters", b)
        first = old.groupBy("shard").cogroup(changes.groupBy("shard")).applyInPandas(update, fields)
        if not self.batch:
            first.write.mode("overwrite").parquet(path)
            return
        aside = f"{self.folder}/aside-{b}"
        first.write.mode("overwrite").parquet(aside)
        first = self.spark.read.parquet(aside)
        full = first.where("bits is null").select("shard")
        again = now.select(shard, "k1").join(F.broadcast(full), "shard", "left_semi").groupBy("shard").applyInPandas(anew, fields)  # at most one row a shard
        first.where("bits is not null").unionByName(again).write.mode("overwrite").parquet(path)

    def _filters(self) -> dict[int, bytes] | None:
        """Filters by shard, if they fit in a broadcast."""
        rows = self.spark.read.parquet(self._path("filters", self.batch))
        if (rows.agg(F.sum(F.length("bits"))).first()[0] or 0) > self.filter_bytes:
            return None
        return {r["shard"]: bytes(r["bits"]) for r in rows.collect()}

    def clean(self, docs: DataFrame) -> DataFrame:
        """id, n_lines, n_dropped and kept (text) of every row of ``docs``.

        The lines of a shared key go, but for those of the largest id that holds it; documents that are
        not in the index lose all of them but where the id is that one. An index without a batch drops nothing.
        """
        filters = self._filters() if self.batch else {}
        sent = self.spark.sparkContext.broadcast(filters)
        least, shards = self.least_chars, self.shards
        kind = docs.schema[self.id_col].dataType.simpleString()
        row = [F.xxhash64("id", "text").alias("r1"), F.xxhash64(F.lit(1), "id", "text").alias("r2")]  # rows of one id and text fare alike
        texts = self._texts(docs)

        def maybe(column) -> tuple[np.ndarray, np.ndarray]:
            """(row, key) of what may be shared, each once."""
            found = [{line_key(x, least) for x in split_lines(t)} - {None} for t in column.to_pylist()]
            keys = _longs([y for x in found for y in x])
            at = np.repeat(np.arange(len(found)), [len(x) for x in found])
            if sent.value is None or not len(keys):
                return at, keys
            hit = _held(keys, sent.value, shards)
            return at[hit], keys[hit]

        def whole(batches):  # id, text
            for b in batches:
                b = b.filter(pa.array(~np.isin(np.arange(b.num_rows), maybe(b.column(1))[0])))
                lines = [t.count(b"\n") + 1 if t else 1 for t in b.column(1).to_pylist()]
                kept = b.column(1).fill_null(b"").cast(pa.string())
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(lines, pa.int64()), pa.array(np.zeros(len(lines), np.int64)), kept], ["id", "n_lines", "n_dropped", "kept"])

        def asked(batches):  # r1, r2, id, text
            for b in batches:
                at, keys = maybe(b.column(3))
                mine = b.take(pa.array(at))
                yield pa.RecordBatch.from_arrays([*mine.columns[:3], pa.array(keys[:, 0]), pa.array(keys[:, 1])], ["r1", "r2", "id", "k1", "k2"])

        def open_(batches):
            for b in batches:
                yield b.take(pa.array(np.unique(maybe(b.column(3))[0])))

        def finish(batches):  # id, text, drops
            for b in batches:
                n, dropped, kept = [], [], []
                for text, drops in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                    lines = split_lines(text)
                    gone = set(_as_bytes(drops)) if drops else ()
                    rest = [x for x in lines if line_key(x, least) not in gone]
                    n.append(len(lines)), dropped.append(len(lines) - len(rest)), kept.append(b"\n".join(rest))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], ["id", "n_lines", "n_dropped", "kept"])

        fields = f"id {kind}, n_lines long, n_dropped long, kept string"
        done = texts.mapInArrow(whole, fields)
        if filters == {}:
            return done.withColumnRenamed("id", self.id_col)
        told = texts.select(*row, "id", "text")
        keys = told.mapInArrow(asked, f"r1 long, r2 long, id {kind}, k1 long, k2 long")
        lost = keys.join(self.shared().select("k1", "k2", "top"), ["k1", "k2"]).where(~F.col("id").eqNullSafe(F.col("top")))
        # a written table has no partitioning of its own, so a hot document's rows can be split in the join below
        aside = f"{self.folder}/drops-{uuid.uuid4().hex}"
        lost.groupBy("r1", "r2").agg(F.collect_set(F.struct("k1", "k2")).alias("drops")).write.parquet(aside)
        drops = self.spark.read.schema("r1 long, r2 long, drops array<struct<k1:long,k2:long>>").parquet(aside)
        left = told.mapInArrow(open_, f"r1 long, r2 long, id {kind}, text binary").join(drops, ["r1", "r2"], "left").select("id", "text", "drops")
        return done.unionByName(left.mapInArrow(finish, fields)).withColumnRenamed("id", self.id_col)


def _as_bytes(drops: list[dict]) -> list[bytes]:
    return [x.tobytes() for x in np.array([(d["k1"], d["k2"]) for d in drops], "<i8")]


def dedup_lines(docs: DataFrame, **settings) -> DataFrame:
    """All documents put into a new index, and cleaned by it."""
    return LineIndex(docs.sparkSession, **settings).insert(docs).clean(docs)


def report(documents: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 of every document."""
    return dedup_lines(documents).select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


_TRIMMED = r"trim(x, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
REPORT_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
x AS (SELECT r, doc_id, unnest(lines) AS x, generate_subscripts(lines, 1) AS i FROM d),
k AS (SELECT r, doc_id, i, x, translate({_TRIMMED}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM x),
shared AS (SELECT key, max(doc_id) AS top FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT r) >= 3),
z AS (SELECT k.r, k.i, k.x, s.key IS NOT NULL AND k.doc_id IS DISTINCT FROM s.top AS dropped FROM k LEFT JOIN shared s ON s.key = k.key)
SELECT doc_id, n_lines, n_dropped, sha256(kept) AS kept_sha256 FROM (
  SELECT r, count(*) AS n_lines, count_if(dropped)::BIGINT AS n_dropped, coalesce(string_agg(x, chr(10) ORDER BY i) FILTER (NOT dropped), '') AS kept FROM z GROUP BY r
) JOIN d USING (r)
"""
