"""A training-data pipeline of five operators: quality rules, toxicity, near-dedup, mixing, packing.

Every stage reads what its predecessor kept, written as Parquet. All but the last return the columns
of ``documents`` and leave out others; the last returns the packed pieces. Each stage gives an empty
result for an empty table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilsift.llm import mixing, near_copies, packing, quality, toxicity
from veilsift.llm.common import cut, own_folder
from veilsift.sources.shared import remove

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
POLICY = "v1"
TOXIC_FROM = 0.7
#: Near copies share this much of their five-word shingles.
SHINGLE, SIMILARITY = 5, 0.8
MIX = {"pattern": (3, 1, 2), "share": 1.5, "most": 2}
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the policy.

    Null, empty and blank texts have no words and go. Each row is judged on its own, so repeated rows share
    their fate and null ids are no matter; texts are measured whole, however long.
    """
    keep = [c for c in COLUMNS if c != "doc_id"]
    return quality.ledger(docs, keep=keep).where(quality.passes(POLICY)).select(COLUMNS)


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below TOXIC_FROM under a model learnt from the labelled ones among them.

    Null and empty texts score by the intercept alone. Rows with a null or repeated id are scored like
    others. Without a label nothing is learnt, and all documents stay.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(docs, labels)
    scored = toxicity.score(docs, model, keep=[c for c in COLUMNS if c != "doc_id"])
    return scored.where(F.col("score") < TOXIC_FROM).select(COLUMNS)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the row with the least id (null last; then by fingerprint and text).

    Candidates come from an index of byte positions of wide SimHash fingerprints, less the pairs that share fewer
    positions than near ones must; links come from the shingles of both whole texts. All texts without words (null, empty, blank) are one group. Rows with a null id or
    one id and other texts are told apart by their texts; rows equal in both are copies.
    """
    first = cut(near_copies.firsts(docs, SIMILARITY, shingle=SHINGLE).select(F.col("doc_id").alias("_first"), F.col("h").alias("_text")))
    rows = docs.withColumn("_h", F.xxhash64("text"))
    kept = rows.join(first, F.col("doc_id").eqNullSafe(F.col("_first")) & (F.col("_h") == F.col("_text")), "left_semi")
    # rows of one id and one text are copies
    return kept.dropDuplicates(["doc_id", "_h"]).select(COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: none, once or twice.

    Documents without words are never taken. Null source is a source of its own; rows without an id are
    told by their text; of rows equal in id and size as many are taken as are wanted.
    """
    return mixing.mixed(docs.select(COLUMNS), mixing.words(), **MIX)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 1024 tokens.

    Null text is empty: the end id alone. Repeated rows and null ids are packed like others.
    """
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("toxicity", not_toxic),
    ("near_duplicates", one_of_each),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is written to the shared folder and read again, and goes once the next one is written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = own_folder(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{k}-{name}")
            docs = spark.read.parquet(f"{folder}/{k}-{name}")
            if k:
                remove(f"{folder}/{k - 1}-{STAGES[k - 1][0]}")
    return docs
