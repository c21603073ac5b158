"""The whole plan against plain Python, text by text: passes, context rules, names, retyping, merges, gateway."""

import dataclasses
import random
import re

import pytest

from veilsift import options as O
from veilsift import queries
from veilsift.functions import text as T
from veilsift.operators import regex_detect
from veilsift.plans import detect as plan

D = "/root/testdata/sf0.001"


def normalized(text):
    """The normalised text and the offset of each of its characters."""
    kept, i = [], 0
    while i < len(text):
        if text[i] == "-" and text[i + 1 : i + 2] == "\n" and i + 2 < len(text):
            i += 2
        else:
            kept.append((text[i], i))
            i += 1
    out = [(" " if c.isspace() else c, at) for c, at in kept]
    out = [x for j, x in enumerate(out) if x[0] != " " or j == 0 or out[j - 1][0] != " "]
    return "".join(c for c, _ in out), [at for _, at in out]


def holds(text, words):
    return any(w in text for w in words)


def luhn(text, least, most):
    digits = [int(c) for c in text if c in "0123456789"]
    if not least <= len(digits) <= most:
        return False
    return sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(reversed(digits))) % 10 == 0


def ruled(label, match, pre, post, o):
    """(type, score) of a match by the rules of its label, or None; ``pre`` and ``post`` are what was scanned around it."""
    w = o.context_window
    around = lambda n: ((pre[-n:] if n else "") + " " + post[:n]).lower()
    positive, negative = holds(around(w), o.keywords.get(label, ())), holds(pre[-25:].lower(), O.NEGATIVE_WORDS.get(label, ()))
    nine, formed = re.fullmatch(r"\d{9}", match), re.fullmatch(r"\d{3}-\d{2}-\d{4}|\d{9}", match)
    digits = sum(c.isdigit() for c in match)
    score = o.scores.get(label, 0.5)
    if label == "ACCOUNT_NUMBER":
        if negative or formed or not (positive or digits >= o.scoring.account_min_digits):
            return None
        score = score if positive else o.scoring.account_no_context_score
    elif label == "PHONE_NUMBER" and (negative or pre[-1:].isdigit() or post[:1].isdigit()):
        return None
    elif label == "SSN" and (negative or (nine and not positive)):
        return None
    elif label == "ADDRESS" and re.fullmatch(r"\d{5}(-\d{4})?|\d{4}", match) and not holds(around(40), O.ZIP_WORDS):
        return None
    elif label == "DATE" and not holds(pre[-20:].lower(), O.BIRTH_WORDS):
        return None
    if positive:
        score = min(o.scoring.max_score, score + o.scoring.context_boost)
    if label == "DATE":
        return "BIRTHDATE", round(min(o.scoring.max_score, score + o.scoring.context_boost), 2)
    return label, round(score, 2)


def retyped(kind, score, match, raw, pre, post, o):
    w = o.context_window
    left, right = pre[-w:] if w else "", post[:w]
    digits = sum(c.isdigit() for c in match)
    near = f"{left} {right}".lower()
    if kind == "BIRTHDATE" and not holds(near, o.keywords.get("BIRTHDATE", ())):
        return None
    if kind == "SSN" and digits == 9 and holds((left + raw + right).lower(), (*o.keywords.get("ACCOUNT_NUMBER", ()), *O.RETYPE_ACCOUNT_WORDS)):
        return "ACCOUNT_NUMBER", o.scores["ACCOUNT_NUMBER"]
    if kind == "ACCOUNT_NUMBER":
        if digits == 9 and re.fullmatch(r"\d{3}-\d{2}-\d{4}|\d{3}\.\d{2}\.\d{4}|\d{3} \d{2} \d{4}|\d{9}", match) and holds(near, o.keywords.get("SSN", ())):
            return "SSN", 0.95
        if o.luhn.enabled and luhn(match, o.luhn.min_length, o.luhn.max_length) and not (o.luhn.require_no_account_context and holds(near, o.keywords.get("ACCOUNT_NUMBER", ()))):
            return o.luhn.target_type, o.scores.get(o.luhn.target_type, score)
    return kind, score


def named(text, names):
    """(start, end) of names, the longest at each place."""
    found = [(m.start(), m.end(), T.normalized_name(m[0])) for m in re.finditer(T.TOKEN, text)]
    i = 0
    while i < len(found):
        n = next((n for n in (3, 2, 1) if i + n <= len(found) and " ".join(w for *_, w in found[i : i + n]) in names), 0)
        if n:
            yield found[i][0], found[i + n - 1][1]
        i += max(n, 1)


def spans_of(text, o, names, passes, detectors=("regex", "dict")):
    """(rank, type, text, start, end, score, source, pre) after the rules and retyping."""
    out, most = [], max(40, o.context_window)
    for p in passes if "regex" in detectors else ():
        scanned, back = (text, range(len(text))) if p == "raw" else normalized(text)
        if p != "raw" and scanned == text and "raw" in passes:
            continue
        for i, label in enumerate(regex_detect.labels(o)):
            for j, pattern in enumerate(o.patterns[label]):
                for k, m in enumerate(re.finditer(pattern, scanned)):
                    kept = ruled(label, m[0], scanned[max(0, m.start() - most) : m.start()], scanned[m.end() : m.end() + most], o)
                    if kept:
                        s, e = back[m.start()], back[m.end() - 1] + 1
                        out.append(((p != "raw", 1, [i, j, k]), kept[0], m[0], s, e, kept[1], "regex"))
    if "dict" in detectors:
        out += [((False, 2, [0, 0, s]), "PERSON", text[s:e], s, e, 0.85, "dictionary") for s, e in named(text, names)]
    kept = []
    for rank, kind, match, s, e, score, source in out:
        pre, post = text[max(0, s - most) : s], text[e : e + most]
        new = retyped(kind, score, match, text[s:e], pre, post, o) if score >= o.scoring.min_score else None
        if new:
            kept.append((rank, new[0], match, s, e, new[1], source, pre))
    return kept


def merged(spans):
    """Adjacent ones of one type first, then overlapping ones of one type."""
    once = []
    for rank, kind, match, s, e, score, source, pre in sorted(spans, key=lambda x: (x[3], x[0])):
        last = once[-1] if once else None
        gap = s - last["stop"] if last else None
        if last and last["type"] == kind and gap <= 2 and (gap <= 0 or pre[-gap:].isspace()):
            last.update(end=e, stop=e, score=max(last["score"], score))
            last["sources"].append(source)
        else:
            once.append({"rank": rank, "type": kind, "text": match, "start": s, "end": e, "stop": e, "score": score, "sources": [source]})
    out = []
    for kind in {x["type"] for x in once}:
        reach = None
        for x in sorted((x for x in once if x["type"] == kind), key=lambda x: (x["start"], x["end"], x["rank"])):
            if reach is not None and x["start"] < reach:
                last = out[-1]
                last.update(end=max(last["end"], x["end"]), score=max(last["score"], x["score"]), sources=last["sources"] + x["sources"])
                reach = max(reach, x["end"])
            else:
                out.append(dict(x))
                reach = x["end"]
    return sorted((x["type"], x["text"], x["start"], x["end"], x["score"], tuple(dict.fromkeys(x["sources"]))) for x in out)


def trigger_of(text, o, names):
    for test in o.gateway or (O.GatewayTest("consecutive_digits", True, 5), O.GatewayTest("name_dictionary")):
        if test.name == "consecutive_digits":
            runs = re.findall(r"\d{%d,}" % (test.threshold or 5), re.sub(r"[\s\-.()]", "", text))
            if runs:
                return "digits", runs[0]
        elif test.name == "name_dictionary":
            first = next(named(text, names), None)
            if first:
                return "name", text[slice(*first)]
    return None, None


def rows_of(frame, more=()):
    return sorted((r["id"], r["type"], r["text"], r["start"], r["end"], r["score"], tuple(r["sources"]), *(r[c] for c in more)) for r in frame.collect())


def made(seed, n=250):
    rng = random.Random(seed)
    parts = [
        "123-45-6789", "123 45 6789", "123456789", "(555) 123-4567", "555-\n123-4567", "user1@ex.org", "us-\ner2@ex.org", "1990-01-02", "Jan 02, 1990", "01/02/1990", "1234567890", "4539148803436467",
        "GB12345678901", "12 Oak Street", "12  Oak\nStreet", "12345", "1234", "ssn", "SSN:", "born", "dob", "account", "acct #", "bank", "phone", "fax", "zip", "postal", "address", "order-", "id:", "Ann", "Ann Lee",
        "ann marie lee", "  ", "\n", " - ", "-\n", ", ", ". ", "é", "words and words",
    ]
    return ["".join(rng.choice(parts) + rng.choice([" ", " ", "", "\n"]) for _ in range(rng.randint(0, 14))) for _ in range(n)] + ["", " ", "word " * 20_000 + "ssn 123-45-6789"]


NAMES = {"ann", "ann lee", "ann marie lee", "bo"}


@pytest.mark.parametrize("name", ["constants", "config", "lists"])
def test_plan_equals_plain_python(spark, name):
    o = dataclasses.replace(O.profile(name), detectors=("regex", "dict"))
    texts = made(name)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    names = spark.createDataFrame([(n, len(n.split())) for n in NAMES], "name string, n_words int")
    want = sorted((i, *x) for i, t in enumerate(texts) for x in merged(spans_of(t, o, NAMES, o.passes)))
    assert len(want) > 300 and rows_of(plan.detect_entities(docs, o, names)) == want
    only = dataclasses.replace(o, entity_types=("SSN", "PERSON"), passes=("normalized",), scoring=dataclasses.replace(o.scoring, min_score=0.8))
    want = sorted((i, *x) for i, t in enumerate(texts) for x in merged(spans_of(t, only, NAMES, only.passes)) if x[0] in only.entity_types)
    assert rows_of(plan.detect_entities(docs, only, names)) == want


def test_gateway_equals_plain_python(spark):
    o = O.DetectOptions(detectors=("regex", "dict"), gateway=())
    texts = made("gateway", 150) + ["only a@b.co here", "a@b.co , c@d.co"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    names = spark.createDataFrame([(n, len(n.split())) for n in NAMES], "name string, n_words int")
    want = []
    for i, t in enumerate(texts):
        trigger = trigger_of(t, o, NAMES)
        if trigger[0]:
            want += [(i, *x, *trigger) for x in merged(spans_of(t, o, NAMES, o.passes))]
        else:
            want += [(i, kind, m, s, e, score, (source,), None, None) for _, kind, m, s, e, score, source, _ in spans_of(t, o, NAMES, ("raw",), ("regex",))]
    got = rows_of(plan.detect_with_gateway(docs, o, names), ("trigger", "trigger_match"))
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(got, key=key) == sorted(want, key=key)


@pytest.mark.parametrize("query", ["detect_entities", "detect_entities_constants"])
def test_queries_equal_plain_python(spark, query):
    o = dataclasses.replace(O.profile("constants" if "constants" in query else "config"), detectors=("regex", "dict"))
    names = {r["name"] for r in queries._names(spark, D).collect()}
    docs = spark.read.parquet(f"{D}/documents.parquet").collect()
    want = sorted((r["doc_id"], *x) for r in docs for x in merged(spans_of(r["text"] or "", o, names, o.passes)))
    assert len(want) > 50 and rows_of(queries.queries()[query](spark, D)) == want
