"""The queries of the training-data operators, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources import readers
from . import html_extract, langid, lines, merkle, mixing, packing, quality, simhash, token_count, toxicity, va_file, vptree, warc


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return readers.table(spark, f"{sf_dir}/{name}.parquet")


def op1_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(_table(spark, sf_dir, "documents"))


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.report(_table(spark, sf_dir, "pages"))


def op3_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(_table(spark, sf_dir, "documents"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op6_vp_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vptree.report(_table(spark, sf_dir, "embeddings"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(_table(spark, sf_dir, "documents"), _tokenizer("piece_bpe_32k.model"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.report(_table(spark, sf_dir, "pages"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_language_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.report(_table(spark, sf_dir, "documents"))


def op11_va_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return va_file.report(_table(spark, sf_dir, "embeddings"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.report(_table(spark, sf_dir, "documents"))


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.report(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    each = [
        op1_pareto_mix, op2_main_text, op3_rule_ledger, op4_packing, op5_simhash,
        op6_vp_trees, op7_token_counts, op8_warc, op9_toxicity, op10_language_spans,
        op11_va_file, op12_merkle, op13_line_dedup,
    ]
    return {q.__name__: q for q in each}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_pareto_mix": mixing.REPORT_SQL, "op3_rule_ledger": quality.REPORT_SQL, "op8_warc": warc.REPORT_SQL, "op11_va_file": va_file.REPORT_SQL,
        "op12_merkle": merkle.REPORT_SQL, "op13_line_dedup": lines.REPORT_SQL,
    }
