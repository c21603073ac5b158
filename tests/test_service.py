"""Detection as a call, and the gateway by rows."""

import dataclasses

import pytest

from veilsift import options as O
from veilsift.plans import detect as plan
from veilsift.service import DetectRequest, RequestError, Service

REGEX = O.DetectOptions(detectors=("regex",))


def status(service, **request):
    with pytest.raises(RequestError) as e:
        service.detect(DetectRequest(**request))
    return e.value.status


def test_triggers_belong_to_rows(spark):
    rows = [(1, "Call 12345 now, a@b.co"), (1, "mail c@d.co please"), (None, "x@y.co"), (None, "99999 z@y.co"), (2, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["id"], r["text"]): (r["trigger"], r["trigger_match"]) for r in plan.detect_with_gateway(docs, REGEX).where("type = 'EMAIL'").collect()}
    assert got == {(1, "a@b.co"): ("digits", "12345"), (1, "c@d.co"): (None, None), (None, "x@y.co"): (None, None), (None, "z@y.co"): ("digits", "99999")}
    cut = plan.detect_with_gateway(docs, dataclasses.replace(REGEX, max_chars=8)).collect()
    assert cut == [r for r in cut if r["end"] <= 8]


def test_meta_and_stages(spark):
    s = Service(spark, REGEX, profile="p")
    got = s.detect(DetectRequest("code 12345 is all", include_stats=True))
    assert got["entities"] == [] and not got["meta"]["gateway_skipped"] and got["meta"]["gateway_trigger"] == "digits" and got["meta"]["gateway_match"] == "12345"
    assert got["stats"]["total_ms"] >= got["stats"]["merge_ms"] > 0 and got["stats"]["ner_ms"] == 0 and got["stats"]["regex_ms"] > 0
    got = s.detect(DetectRequest("mail a@b.co and c@d.co", include_stats=True))
    assert got["meta"]["gateway_skipped"] and got["meta"]["by_type"] == {"EMAIL": 2} and got["meta"]["entity_count"] == 2
    assert got["stats"]["merge_ms"] == 0 and got["entities"][0]["text"] == "a@b.co"
    got = s.detect(DetectRequest("mail a@b.co", gateway=False))
    assert got["meta"]["gateway_mode"] is False and not got["meta"]["gateway_skipped"] and got["stats"] is None
    assert s.detect(DetectRequest("mail a@b.co 12345", min_score=1.0))["entities"] == []
    assert s.detect(DetectRequest("mail a@b.co 12345", entity_types=("SSN",)))["entities"] == []


def test_names_of_the_dictionary_trigger(spark):
    names = spark.createDataFrame([("anna", 1), ("anna maria b c", 4)], "name string, n_words int")
    s = Service(spark, O.DetectOptions(detectors=("regex", "dict")), names=names)
    got = s.detect(DetectRequest("hello Anna Maria B C here"))
    assert got["meta"]["gateway_trigger"] == "name" and [x["text"] for x in got["entities"]] == ["Anna"]  # three words at most
    assert O.DetectOptions().max_name_words == 3


def test_errors(spark):
    s = Service(spark, REGEX, most_chars=50)
    assert status(Service(spark), text="x") == 503
    assert status(s, text="x" * 51) == 413
    assert status(s, text="") == 422 and status(s, text="x", min_score=1.5) == 422
    assert status(s, text="x", entity_types=("NONE",)) == 422 and status(s, text="x", detectors=("none",)) == 422
    assert status(s, text="x", config_override={"none": 1}) == 422
    assert status(s, text="x", config_override={"patterns": {"SSN": ["("]}}, gateway=False) == 500
    assert status(s, text="x", detectors=("ner",), gateway=False) == 500  # no models


def test_states(spark):
    s = Service(spark, REGEX, profile="p")
    assert s.health() == {"status": "ok"} and s.ready() and not Service(spark).ready()
    assert s.info()["entity_types"] == O.entity_types(REGEX) and s.info()["detectors"] == ["regex"] and s.info()["max_text_length"] == 500_000
