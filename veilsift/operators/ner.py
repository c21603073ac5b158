"""Named-entity models behind one interface: a function from texts to spans, run by Arrow batches."""

from __future__ import annotations

import json
import logging
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..options import ENTITY_TYPES, SCORES

log = logging.getLogger(__name__)
SPANS = "array<struct<type:string,start:int,end:int,score:double>>"

#: Texts that a model gets at once.
PIECE = 1024

# Labels of known models and the types they stand for.
GENERAL_LABELS = {"PERSON": ("PERSON", 0.80), "GPE": ("LOCATION", 0.75), "LOC": ("LOCATION", 0.75), "FAC": ("LOCATION", 0.75)}
TOKEN_LABELS = {
    "GIVENNAME": "PERSON", "SURNAME": "PERSON", "STREET": "ADDRESS", "CITY": "ADDRESS", "BUILDINGNUM": "ADDRESS", "ZIPCODE": "ZIPCODE",
    "SOCIALNUM": "SSN", "TELEPHONENUM": "PHONE_NUMBER", "DATEOFBIRTH": "BIRTHDATE", "EMAIL": "EMAIL", "ACCOUNTNUM": "ACCOUNT_NUMBER",
    "CREDITCARDNUMBER": "CREDIT_CARD_NUMBER", "DRIVERLICENSENUM": "DRIVERS_LICENSE", "IDCARDNUM": "ID_CARD", "TAXNUM": "TAX_NUMBER",
    "USERNAME": "USERNAME", "PASSWORD": "PASSWORD",
}
CHUNK_TOKENS, CHUNK_OVERLAP, MODEL_TOKENS = 450, 50, 512
# End of the fixed values.

Provider = Callable[[], Callable[[list[str]], list[list[tuple[str, int, int, float]]]]]
_PROVIDERS: dict[str, Provider] = {}


def register(name: str, provider: Provider) -> None:
    """``provider()`` loads a model once in each worker and returns texts -> spans (type, start, end, score)."""
    _PROVIDERS[name] = provider


def provider(name: str) -> Provider:
    if name not in _PROVIDERS:
        raise KeyError(f"no model {name!r}; registered: {sorted(_PROVIDERS)}")
    return _PROVIDERS[name]


def detect(docs: DataFrame, models: dict[str, Provider], id_col: str = "doc_id", text_col: str = "text", more: dict[str, Column] | None = None) -> DataFrame:
    """(id, h, model, seq, type, start, end, score, text); a model that fails on a text yields no span there.

    ``more``: further columns of a span, told by start, end and the whole text t, so that texts need not go along.

    A model gets PIECE texts at once, equal ones once; only where that fails it gets them one by one.
    """
    from .regex_detect import keyed

    base = keyed(docs, id_col, text_col)
    parts = []
    for name, make in models.items():

        def run(batches: Iterator[pd.Series], make=make, name=name) -> Iterator[pd.Series]:
            model = make()
            for batch in batches:
                for at in range(0, len(batch), PIECE):
                    texts = [t or "" for t in batch.iloc[at : at + PIECE]]
                    each = list(dict.fromkeys(texts))
                    found = dict(zip(each, called(model, name, each), strict=True))
                    yield pd.Series([[{"type": k, "start": s, "end": e, "score": float(p)} for k, s, e, p in found[t]] for t in texts])

        spans = F.pandas_udf(SPANS)(_typed(run))(F.col("t"))
        parts.append(base.select("id", "h", "t", F.lit(name).alias("model"), F.posexplode(spans).alias("seq", "s")))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    return rows.select(
        "id", "h", "model", "seq", "s.type", "s.start", "s.end", "s.score", F.substring("t", F.col("s.start") + 1, F.col("s.end") - F.col("s.start")).alias("text"), "t"
    ).select("id", "h", "model", "seq", "type", "start", "end", "score", "text", *[c.alias(k) for k, c in (more or {}).items()])


def called(model, name: str, texts: list[str]) -> list[list[tuple]]:
    """A model's spans of a batch; if that fails, of each text on its own, and none where it fails again."""
    try:
        found = model(texts)
        if len(found) == len(texts):
            return found
    except Exception:  # some text of the batch
        log.info("model %s failed on a batch of %d", name, len(texts))
    out, failed = [], 0
    for t in texts:
        try:
            out.append(model([t])[0])
        except Exception:  # one text's failure is no other's
            failed += 1
            out.append([])
    if failed:
        log.warning("model %s failed on %d of %d texts", name, failed, len(texts))
    return out


def _typed(run):
    def iterate(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        yield from run(batches)

    iterate.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return iterate


def from_table(spans: DataFrame) -> DataFrame:
    """Spans that another system found, as the result of a model."""
    return spans.select("id", "model", "seq", "type", "start", "end", "score", "text")


def general_label(label: str) -> tuple[str, float] | None:
    return GENERAL_LABELS.get(label)


def chunks(n_tokens: int) -> list[tuple[int, int]]:
    """Token ranges of a long text: 450 tokens each, 50 shared with the one before."""
    if n_tokens <= MODEL_TOKENS:
        return [(0, n_tokens)]
    step = CHUNK_TOKENS - CHUNK_OVERLAP
    return [(s, min(n_tokens, s + CHUNK_TOKENS)) for s in range(0, n_tokens, step)]


def general_model(load: Callable[[], Callable[[list[str]], list[list[tuple[str, int, int]]]]]) -> Provider:
    """A model with general labels (label, start, end) as a provider: labels without a type are dropped, scores come from the table."""

    def make():
        model = load()
        return lambda texts: [[(*known[:1], s, e, known[1]) for label, s, e in found if (known := general_label(label))] for found in model(texts)]

    return make


def token_model(load: Callable[[], tuple[Callable, Callable]]) -> Provider:
    """A token classifier as a provider. ``load()`` gives (tokenize, classify).

    ``tokenize(text)`` returns the (start, end) of each token, ``classify(text)`` the (label, start, end,
    score) of a text of bounded length. Long texts are classified in chunks that share tokens with the
    one before; offsets are moved to the whole text, and a span that two chunks find counts once, with
    the score of the first. Unknown labels are dropped, scores rounded to two places; a chunk that fails
    is passed over.
    """

    def make():
        tokenize, classify = load()

        def run(text: str) -> list[tuple[str, int, int, float]]:
            places = tokenize(text)
            out = {}
            for a, b in chunks(len(places)) if places else []:
                first = places[a][0] if a else 0
                last = len(text) if b == len(places) else places[b - 1][1]
                try:
                    found = classify(text[first:last])
                except Exception:
                    if (a, b) == (0, len(places)):
                        raise
                    log.info("a chunk failed")
                    continue
                for label, s, e, p in found:
                    if label in TOKEN_LABELS:
                        out.setdefault((s + first, e + first, TOKEN_LABELS[label]), round(float(p), 2))
            return [(kind, s, e, p) for (s, e, kind), p in out.items()]

        return lambda texts: [run(t) for t in texts]

    return make


# The types that a language model is asked for, those that its answer may hold, and the score of a type without one.
ASKED_TYPES = ("PERSON", "SSN", "PHONE_NUMBER", "EMAIL", "ADDRESS", "DATE", "ACCOUNT_NUMBER", "LOCATION")
ANSWERED_TYPES = (*ASKED_TYPES, "BIRTHDATE")
ANSWER_SCORE, ANSWER_SECONDS, ANSWER_TOKENS, TEMPERATURE = 0.75, 120, 2048, 0.1
# End of the fixed values.


def question(types: tuple[str, ...] | None = None) -> str:
    """What a language model is told to do with a text."""
    wanted = [t for t in ASKED_TYPES if not types or t in types]
    return (
        "List the personal data in the text that follows. Answer with one JSON array and nothing else. Its objects have the keys "
        f'"type" (one of {", ".join(wanted)}), "text" (the words as they stand in the text), "start" and "end" (offsets in characters from 0, '
        "the end not included). Answer [] if there is none."
    )


def answered(answer: str, text: str, types: tuple[str, ...] | None = None) -> list[tuple[str, int, int, float]]:
    """Spans of the first JSON array in an answer; what has no known type, no usable offsets or lies out of bounds is passed over."""
    found = re.search(r"(?s)\[.*?\]", answer or "")
    try:
        items = json.loads(found[0]) if found else []
    except ValueError:
        return []
    out = []
    for x in items:
        if not isinstance(x, dict) or x.get("type") not in ANSWERED_TYPES or (types and x["type"] not in types):
            continue
        start, end = x.get("start"), x.get("end")
        if start is None or end is None:
            words = x.get("text")
            start = text.find(words) if isinstance(words, str) else -1
            end = start + len(words or "")
        if all(isinstance(i, int) and not isinstance(i, bool) for i in (start, end)) and 0 <= start < end <= len(text):
            out.append((x["type"], start, end, round(SCORES.get(x["type"], ANSWER_SCORE), 2)))
    return out


def _posted(url: str, body: dict, headers: dict[str, str]) -> dict:
    from urllib.request import Request, urlopen

    request = Request(url, json.dumps(body).encode(), {"Content-Type": "application/json"} | headers)
    with urlopen(request, timeout=ANSWER_SECONDS) as reply:
        return json.loads(reply.read())


def _asking(ask: Callable[[str], str], types: tuple[str, ...] | None) -> Provider:
    def make():
        def run(text: str) -> list[tuple[str, int, int, float]]:
            try:
                return answered(ask(text), text, types)
            except Exception as e:  # no answer, a refusal, or too many calls: the text has no span
                log.warning("a language model gave no answer: %s", e)
                return []

        return lambda texts: [run(t) if t else [] for t in texts]

    return make


def local_language_model(url: str, model: str, types: tuple[str, ...] | None = None) -> Provider:
    """A model behind a local server that completes prompts (``/api/generate``); texts are asked about one by one, from the tasks."""

    def ask(text: str) -> str:
        body = {"model": model, "prompt": f"{question(types)}\n\n{text}\n\nJSON array:", "stream": False, "options": {"temperature": TEMPERATURE, "num_predict": ANSWER_TOKENS}}
        return _posted(f"{url.rstrip('/')}/api/generate", body, {}).get("response", "")

    return _asking(ask, types)


def hosted_language_model(url: str, model: str, key: str, types: tuple[str, ...] | None = None) -> Provider:
    """A model behind a chat service (``/chat/completions``) with a key."""

    def ask(text: str) -> str:
        messages = [{"role": "system", "content": question(types)}, {"role": "user", "content": text}]
        body = {"model": model, "messages": messages, "temperature": TEMPERATURE, "max_tokens": ANSWER_TOKENS}
        choices = _posted(f"{url.rstrip('/')}/chat/completions", body, {"Authorization": f"Bearer {key}"}).get("choices") or [{}]
        return choices[0].get("message", {}).get("content", "")

    return _asking(ask, types)


# Names of profiles, old names among them, and the profile that an unknown name gets.
PROFILES = {"fast": "spacy-fast", "accurate": "spacy-accurate"}
DEFAULT_PROFILE = "spacy-fast"
# End of the fixed values.


def models(names: str) -> dict[str, Provider]:
    """The registered providers of a comma list of profiles; old names are known, an unknown one gets the default profile."""
    wanted = [PROFILES.get(n, n) for n in (x.strip() for x in names.split(",")) if n]
    return {n: provider(n) for n in (x if x in _PROVIDERS else DEFAULT_PROFILE for x in wanted)}


def parse_answers(answers: DataFrame, id_col: str = "id", text_col: str = "text", answer_col: str = "answer") -> DataFrame:
    """Spans from answers of language models: the first JSON array in each.

    Types must be known; a span without usable offsets is looked up in the text; what lies out of
    bounds is dropped; scores come from the table. A broken answer yields none.
    """
    array = F.regexp_extract(answer_col, r"(?s)\[.*?\]", 0)
    items = F.from_json(array, "array<struct<type:string,text:string,start:int,end:int>>")
    rows = answers.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"), F.posexplode(items).alias("seq", "x"))
    rows = rows.select("id", "t", "seq", F.upper("x.type").alias("type"), F.col("x.text").alias("text"), F.col("x.start").alias("s"), F.col("x.end").alias("e"))
    given = F.col("s").isNotNull() & F.col("e").isNotNull()
    at = F.instr(F.col("t"), F.col("text")) - 1
    start = F.when(given, F.col("s")).otherwise(at)
    end = F.when(given, F.col("e")).otherwise(at + F.length("text"))
    rows = rows.where(F.col("type").isin(*ENTITY_TYPES)).withColumn("start", start).withColumn("end", end)
    rows = rows.where((F.col("start") >= 0) & (F.col("start") < F.col("end")) & (F.col("end") <= F.length("t")))
    base = F.create_map(*[F.lit(x) for kv in SCORES.items() for x in kv])
    return rows.select("id", "seq", "type", "start", "end", F.element_at(base, F.col("type")).alias("score"), F.substring("t", F.col("start") + 1, F.col("end") - F.col("start")).alias("text"))
