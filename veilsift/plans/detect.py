"""The whole detection plan: detectors over passes, filters, retyping, merges; with or without the gateway."""

from __future__ import annotations

import dataclasses
import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import dictionary, gateway, ner, regex_detect, spans
from ..options import DETECTORS, DetectOptions

LOG = logging.getLogger(__name__)
OUT = ["id", "type", "text", "start", "end", "score", "sources"]
#: White space that may lie between adjacent spans.
GAP = 2


def detectors(
    docs: DataFrame, options: DetectOptions, names: DataFrame | None = None, models: dict | None = None, id_col: str = "doc_id", text_col: str = "text", raw_only: Column | None = None
) -> dict[str, DataFrame]:
    """The spans of each detector (ner, regex, dict) before filters and merges (columns of regex_detect.SPAN).

    A detector that is asked for by name but lacks its names or models is an error, unless ``options``
    leave the detectors at their default: then those that can run do, and a line of the log names the others.
    Rows for which ``raw_only`` holds get patterns on the raw text and nothing else, even where patterns are not asked for.
    """
    parts = {}
    asked = ["dict" if d == "dictionary" else d for d in options.detectors]
    lacking = [d for d, given in (("ner", models), ("dict", names)) if d in asked and not given]
    if lacking and tuple(options.detectors) != DETECTORS:
        raise ValueError(f"no models or names for {lacking}")
    if lacking:
        LOG.info("detectors without models or names do not run: %s", ", ".join(lacking))
    wanted = options.entity_types
    window = max(40, options.context_window)
    whole = docs if raw_only is None else docs.where(~raw_only)
    if "ner" in asked and models:
        parts["ner"] = _modelled(whole, models, options, window, id_col, text_col)
    if "regex" in asked:
        parts["regex"] = regex_detect.detect(docs, options, id_col, text_col, raw_only)
    elif raw_only is not None:
        parts["regex"] = regex_detect.detect(docs.where(raw_only), dataclasses.replace(options, passes=("raw",)), id_col, text_col)
    if "dict" in asked and names is not None and (not wanted or "PERSON" in wanted):
        found = dictionary.detect(whole, names, options.max_name_words, id_col, text_col, window)
        parts["dict"] = _framed(found.withColumn("raw_text", F.col("text")), "start")
    if not parts:
        raise ValueError("no detector can run")
    return parts


def _modelled(docs: DataFrame, models: dict, options: DetectOptions, window: int, id_col: str, text_col: str) -> DataFrame:
    """Spans of models, trimmed and with their context where the text is read, so no text goes along; several models raise what they agree on by the places that they gave."""
    found = ner.detect(docs, models, id_col, text_col, {"t": F.col("t"), "_start": F.col("start"), "_end": F.col("end"), "source": F.lit("ner")})
    found = spans.trim(found, F.col("t"))
    pre, post = regex_detect.around(F.col("t"), F.col("start"), F.col("end"), window)
    raw = F.substring("t", F.col("start") + 1, F.col("end") - F.col("start"))
    found = found.withColumns({"raw_text": raw, "pre": pre, "post": post}).drop("t")
    if len(models) > 1:
        keep = ("at", "to", "text", "raw_text", "source", "pre", "post")
        rows = found.withColumnsRenamed({"start": "at", "end": "to"}).withColumnsRenamed({"_start": "start", "_end": "end"})
        rows = rows.withColumn("id", F.struct("id", "h")).withColumn("seq", F.struct("model", "seq"))
        found = spans.agreement_boost(rows, options.scoring, keep).select("id.id", "id.h", "seq.seq", "type", F.col("at").alias("start"), F.col("to").alias("end"), "score", *keep[2:])
    return _framed(spans.filter_addresses(found, options.address_filter), "seq")


def detected(
    docs: DataFrame, options: DetectOptions, names: DataFrame | None = None, models: dict | None = None, id_col: str = "doc_id", text_col: str = "text", raw_only: Column | None = None
) -> DataFrame:
    """Spans of all detectors before filters and merges (columns of regex_detect.SPAN)."""
    return dictionary.union_of(list(detectors(docs, options, names, models, id_col, text_col, raw_only).values()))


def _framed(found: DataFrame, order: str) -> DataFrame:
    """Spans with raw_text, pre and post to the common columns."""
    seq = F.array(F.lit(0), F.lit(0), F.col(order).cast("int"))
    return found.select("id", "h", F.lit("raw").alias("pass"), seq.alias("seq"), "type", "text", "raw_text", "start", "end", F.col("score").cast("double").alias("score"), "source", "pre", "post")


def finish(found: DataFrame, options: DetectOptions, apart: Column | None = None) -> DataFrame:
    """Score filter, retyping, adjacent merge, overlap merge, type filter: one row each entity of each (id, h), with ``h``.

    Spans for which ``apart`` holds are filtered and retyped but not merged.
    """
    kept = spans.disambiguate(found.where(F.col("score") >= options.scoring.min_score), options)
    detector = F.when(F.col("source") == "ner", 0).when(F.col("source") == "regex", 1).otherwise(2)
    rank = F.struct((F.col("pass") != "raw").alias("p"), detector.alias("d"), F.col("seq"))
    # a span that is merged with none is alone under its key
    lone = [] if apart is None else [F.when(apart, F.monotonically_increasing_id()).alias("lone")]
    # the hash comes first: a sort by a number compares few rows in full
    keys = ("h", "id", *(["lone"] if lone else []))
    pre = F.right("pre", F.lit(GAP)).alias("pre")
    kept = kept.select("id", "h", *lone, rank.alias("seq"), "type", "text", "start", "end", "score", F.array("source").alias("sources"), pre)
    merged = spans.merge_overlapping(spans.merge_adjacent(kept, GAP, keys), keys)
    out = merged.select(*OUT, "h")
    return out.where(F.col("type").isin(*options.entity_types)) if options.entity_types else out


def detect_entities(docs: DataFrame, options: DetectOptions | None = None, names: DataFrame | None = None, models: dict | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Entities (id, type, text, start, end, score, sources) of every document.

    Rows with one id and other texts keep their own entities; rows equal in both count once. Null and
    empty texts have none.
    """
    options = options or DetectOptions()
    if options.max_chars:
        docs = docs.withColumn(text_col, F.left(text_col, F.lit(options.max_chars)))
    return finish(detected(docs, options, names, models, id_col, text_col), options).select(*OUT)


def detect_with_gateway(docs: DataFrame, options: DetectOptions | None = None, names: DataFrame | None = None, models: dict | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As detect_entities, but rows that no gateway test stops get patterns on the raw text only, filtered and retyped but not merged; plus trigger and trigger_match.

    With the gateway switched off every row gets the whole plan, and trigger is null.
    """
    options = options or DetectOptions()
    if not options.gateway_enabled:
        none = F.lit(None).cast("string")
        return detect_entities(docs, options, names, models, id_col, text_col).withColumns({"trigger": none, "trigger_match": none})
    if options.max_chars:
        docs = docs.withColumn(text_col, F.left(text_col, F.lit(options.max_chars)))
    # the trigger goes along with the id, so rows never meet their texts again
    rows = decided(docs, options, names, id_col, text_col)
    rows = rows.select(F.struct(F.col(id_col).alias("id"), "trigger", "trigger_match").alias("id"), F.col(text_col).alias("text"))
    found = detected(rows, options, names, models, "id", "text", F.col("id.trigger").isNull())
    return finish(found, options, F.col("id.trigger").isNull()).select("id.id", *OUT[1:], "id.trigger", "id.trigger_match")


def decided(docs: DataFrame, options: DetectOptions, names: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` plus trigger and trigger_match: what the gateway decides of each row."""
    if names is not None and any(t.enabled and t.name == "name_dictionary" for t in gateway.tests_of(options)):
        docs = dictionary.with_first(docs, names, options.max_name_words, id_col, text_col)
    return gateway.decide(docs, options, None, id_col, text_col)


def quick(docs: DataFrame, options: DetectOptions, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """What rows get that the gateway lets pass: patterns on the raw text, filtered and retyped but not merged (columns of ``finish``)."""
    cheap = dataclasses.replace(options, passes=("raw",), detectors=("regex",))
    found = regex_detect.detect(docs, cheap, id_col, text_col)
    found = spans.disambiguate(found.where(F.col("score") >= options.scoring.min_score), options)
    found = found.select("id", "type", "text", "start", "end", "score", F.array("source").alias("sources"), "h")
    return found.where(F.col("type").isin(*options.entity_types)) if options.entity_types else found


def documents(entities: DataFrame, docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row a document with ``entities`` nested, in order of start and end."""
    e = F.struct("start", "end", "type", "text", "score", "sources")
    packed = entities.groupBy("id").agg(F.sort_array(F.collect_list(e)).alias("entities"))
    return docs.select(F.col(id_col).alias("id")).join(packed, "id", "left")


def normalized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), T.normalize_text(F.col(text_col)).alias("text"))
