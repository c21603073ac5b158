"""Language models behind local servers, model profiles, and file corpora."""

import json
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest

from veilsift import options as O
from veilsift.operators import ner
from veilsift.plans import detect as plan
from veilsift.sources import readers


@pytest.mark.parametrize(
    ("answer", "want"),
    [
        ('[{"type": "PERSON", "text": "Ann", "start": 0, "end": 3}]', [("PERSON", 0, 3, O.SCORES["PERSON"])]),
        ('Sure:\n```json\n[{"type": "EMAIL", "text": "a@b.co"}]\n``` [1]', [("EMAIL", 10, 16, O.SCORES["EMAIL"])]),
        ('[{"type": "PERSON", "text": "Nobody"}, {"type": "NONE", "start": 0, "end": 1}, 7, {"type": "SSN", "start": 3, "end": 3}]', []),
        ('[{"type": "SSN", "start": "0", "end": 2}, {"type": "SSN", "start": 0, "end": 99}, {"type": "SSN", "start": true, "end": 2}]', []),
        ("no array", []), ("[broken", []), ("[broken]", []), ("", []), (None, []),
    ],
)
def test_answers(answer, want):
    assert ner.answered(answer, "Ann mails a@b.co") == want
    assert ner.answered(answer, "Ann mails a@b.co", ("DATE",)) == []


class Server(BaseHTTPRequestHandler):
    seen: list = []

    def do_POST(self):
        body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
        Server.seen.append((self.path, self.headers.get("Authorization"), body))
        prompt = body.get("prompt") or body["messages"][1]["content"]
        if "too many" in prompt:
            self.send_response(429)
            self.end_headers()
            return
        answer = '[{"type": "PERSON", "text": "Ann"}]'
        reply = {"response": answer} if self.path == "/api/generate" else {"choices": [{"message": {"content": answer}}]}
        self.send_response(200)
        self.end_headers()
        self.wfile.write(json.dumps(reply).encode())

    def log_message(self, *_):
        pass


@pytest.fixture(scope="module")
def url():
    server = HTTPServer(("127.0.0.1", 0), Server)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}"
    server.shutdown()


def test_language_models_in_tasks(spark, url):
    docs = spark.createDataFrame([(1, "hello Ann"), (2, "too many calls, Ann"), (3, None), (4, "nobody")], "doc_id long, text string")
    for name, make in (("local", ner.local_language_model(url, "m")), ("hosted", ner.hosted_language_model(url + "/", "m", "key", ("PERSON",)))):
        got = ner.detect(docs, {name: make}).collect()
        assert [(r["id"], r["type"], r["start"], r["end"], r["text"]) for r in got] == [(1, "PERSON", 6, 9, "Ann")]
    found = plan.detect_entities(docs, O.DetectOptions(detectors=("ner", "regex")), models={"hosted": ner.hosted_language_model(url, "m", "key")})
    assert [(r["id"], r["text"], r["sources"]) for r in found.collect()] == [(1, "Ann", ["ner"])]
    paths = {(p, a) for p, a, _ in Server.seen}
    assert paths == {("/api/generate", None), ("/chat/completions", "Bearer key")}
    assert ner.detect(docs, {"gone": ner.local_language_model("http://127.0.0.1:9", "m")}).count() == 0


def test_profiles():
    known = dict(ner._PROVIDERS)
    try:
        for name in ("spacy-fast", "spacy-accurate", "other"):
            ner.register(name, lambda name=name: name)
        assert list(ner.models("fast, other,accurate")) == ["spacy-fast", "other", "spacy-accurate"]
        assert list(ner.models("unknown")) == ["spacy-fast"] and ner.models("")  == {}
        assert ner.provider("other")() == "other"
        with pytest.raises(KeyError):
            ner.provider("nothing")
    finally:
        ner._PROVIDERS.clear()
        ner._PROVIDERS.update(known)


def test_file_corpus(spark, tmp_path):
    import hashlib

    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "a.PDF").write_bytes(b"abc")
    (tmp_path / "b.pdf").write_bytes(b"broken")
    (tmp_path / "c.txt").write_bytes(b"no pdf")

    def probe(content):
        if content == b"broken":
            raise ValueError("no pdf")
        return {"page_count": 3, "producer": "Word", "has_text_ops": True, "image_xobject_count": 0, "large_image_count": 0}

    rows = {r["path"][-5:]: r for r in readers.file_corpus(spark, str(tmp_path), probe).collect()}
    assert set(rows) == {"a.PDF", "b.pdf"} and rows["a.PDF"]["pdf_id"] == hashlib.sha1(b"abc").hexdigest()
    assert rows["a.PDF"]["page_count"] == 3 and rows["a.PDF"]["size_bucket"] == "tiny" and rows["b.pdf"]["errors"] == ["ValueError: no pdf"]
