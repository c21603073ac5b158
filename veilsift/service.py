"""Detection as a service call: a request is checked, run, and answered with entities, a summary and stage times."""

from __future__ import annotations

import dataclasses
import time
from collections import Counter
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Row, SparkSession

from .operators.dictionary import union_of
from .options import DETECTORS, DetectOptions, entity_types, override
from .plans import detect as plan

MOST_CHARS = 500_000
STAGES = ("gateway_ms", "normalize_ms", "ner_ms", "regex_ms", "dict_ms", "merge_ms", "total_ms")


def _held(rows: DataFrame) -> DataFrame:
    """The spans of one text, computed now."""
    rows = rows.cache()
    rows.count()
    return rows


class RequestError(ValueError):
    """What is wrong with a request, and the status code that says so."""

    def __init__(self, status: int, detail: str):
        super().__init__(detail)
        self.status = status


@dataclass(frozen=True)
class DetectRequest:
    text: str
    min_score: float | None = None
    include_stats: bool = False
    gateway: bool | None = None
    entity_types: tuple[str, ...] | None = None
    detectors: tuple[str, ...] | None = None
    config_override: dict = field(default_factory=dict)


@dataclass
class Service:
    """A service over one session; ``names`` and ``models`` are what the detectors need beside the options."""

    spark: SparkSession
    options: DetectOptions | None = None
    names: DataFrame | None = None
    models: dict | None = None
    profile: str = "none"
    most_chars: int = MOST_CHARS

    def checked(self, request: DetectRequest) -> DetectOptions:
        """The options of a valid request; what it leaves open comes from the service's."""
        if self.options is None:
            raise RequestError(503, "not ready")
        base = self.options
        if len(request.text) > self.most_chars:
            raise RequestError(413, f"more than {self.most_chars} characters")
        if not request.text:
            raise RequestError(422, "no text")
        if request.min_score is not None and not 0 <= request.min_score <= 1:
            raise RequestError(422, "min_score lies outside of 0 to 1")
        if unknown := set(request.entity_types or ()) - set(entity_types(base)):
            raise RequestError(422, f"unknown types {sorted(unknown)}")
        if unknown := set(request.detectors or ()) - set(DETECTORS):
            raise RequestError(422, f"unknown detectors {sorted(unknown)}")
        try:
            options = override(base, **request.config_override)
        except ValueError as e:
            raise RequestError(422, str(e)) from e
        changes: dict = {}
        if request.gateway is not None:
            changes["gateway_enabled"] = request.gateway
        if request.min_score is not None:
            changes["scoring"] = dataclasses.replace(options.scoring, min_score=request.min_score)
        if request.entity_types:
            changes["entity_types"] = tuple(request.entity_types)
        if request.detectors:
            changes["detectors"] = tuple(request.detectors)
        return dataclasses.replace(options, **changes)

    def detect(self, request: DetectRequest) -> dict:
        """{entities, meta, stats}; a request that can't be served raises RequestError with its status.

        ``meta`` counts entities by type and says what the gateway decided; ``stats``, if asked for, are milliseconds of
        each stage, of which those that did not run are 0.
        """
        options = self.checked(request)
        docs = self.spark.createDataFrame([(0, request.text)], "doc_id long, text string")
        try:
            rows, decision, took = self._run(docs, options)
        except Exception as e:
            raise RequestError(500, str(e)) from e
        found = [{"type": r["type"], "text": r["text"], "start": r["start"], "end": r["end"], "score": r["score"], "source": r["sources"]} for r in rows]
        meta = {
            "model_profile": self.profile, "chars": len(request.text), "entity_count": len(found), "gateway_mode": options.gateway_enabled,
            "gateway_skipped": decision is not None and decision["trigger"] is None,
            "gateway_trigger": decision and decision["trigger"], "gateway_match": decision and decision["trigger_match"],
            "by_type": dict(sorted(Counter(x["type"] for x in found).items())),
        }
        return {"entities": found, "meta": meta, "stats": took if request.include_stats else None}

    def _run(self, docs: DataFrame, options: DetectOptions) -> tuple[list, Row | None, dict[str, float]]:
        """Entities of the one row, what the gateway decided (None if it is off), and milliseconds by stage."""
        took = dict.fromkeys(STAGES, 0.0)
        began = time.monotonic()

        def timed(stage: str, work):
            start = time.monotonic()
            out = work()
            took[f"{stage}_ms"] = round(1000 * (time.monotonic() - start), 1)
            return out

        decision = timed("gateway", lambda: plan.decided(docs, options, self.names).first()) if options.gateway_enabled else None
        if decision is not None and decision["trigger"] is None:
            rows = timed("regex", lambda: plan.quick(docs, options).orderBy("start", "end").collect())
        else:
            if "normalized" in options.passes:
                timed("normalize", lambda: plan.normalized(docs).collect())
            parts = {k: timed(k, lambda x=x: _held(x)) for k, x in plan.detectors(docs, options, self.names, self.models).items()}
            rows = timed("merge", lambda: plan.finish(union_of(list(parts.values())), options).orderBy("start", "end").collect())
            for part in parts.values():
                part.unpersist()
        took["total_ms"] = round(1000 * (time.monotonic() - began), 1)
        return rows, decision, took

    def health(self) -> dict:
        return {"status": "ok"}

    def ready(self) -> bool:
        return self.options is not None

    def info(self) -> dict:
        """What the service runs with."""
        o = self.options or DetectOptions()
        return {"model_profile": self.profile, "detectors": list(o.detectors), "entity_types": entity_types(o), "max_text_length": self.most_chars}
