"""Language spans by Viterbi over per-word scores, with candidates narrowed by script.

Learning counts hashed character n-grams of words by language, and the scripts that a language's
letters use. A word is scored only for languages that use its scripts; words without letters, or in
scripts that no language uses, say nothing. Along the words of a whole text, Viterbi picks the best
sequence of languages, where each change costs SWITCH. The longest labelled share names the text.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import held_out, map_rows, top_hash

BITS = 16
GRAMS = (1, 2, 3, 4)
#: Cost of a change of language, in natural log units of word scores.
SWITCH = 6.0
#: A word's score against the best language is never below this.
FLOOR = -8.0
#: Expected rows of the training sample at most.
TRAIN_ROWS = 8_000
MEMO_WORDS = 600_000
#: First code points of script blocks and their names (fixed values of the Unicode block table).
SCRIPTS = [
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"), (0x0600, "arabic"),
    (0x0780, "thaana"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "gurmukhi"), (0x0A80, "gujarati"), (0x0B00, "oriya"),
    (0x0B80, "tamil"), (0x0C00, "telugu"), (0x0C80, "kannada"), (0x0D00, "malayalam"), (0x0D80, "sinhala"), (0x0E00, "thai"),
    (0x0E80, "lao"), (0x0F00, "tibetan"), (0x1000, "myanmar"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"),
    (0x1780, "khmer"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x2E80, "han"), (0x3040, "kana"), (0x3100, "han"),
    (0x3130, "hangul"), (0x3190, "han"), (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB50, "arabic"), (0xFF00, "latin"),
    (0xFF65, "kana"), (0xFFA0, "hangul"), (0x10000, "other"), (0x20000, "han"),
]
_STARTS = [s for s, _ in SCRIPTS]
NAMES = sorted({n for _, n in SCRIPTS})


_NUMBER = np.array([NAMES.index(n) for _, n in SCRIPTS])


def scripts_of(code: np.ndarray) -> np.ndarray:
    """Numbers in NAMES of the scripts of code points."""
    return _NUMBER[np.searchsorted(_STARTS, code, side="right") - 1]


#: ASCII marks and digits, deleted at once.
_MARKS = {i: None for i in range(128) if not chr(i).isalpha()}


def letters(word: str) -> str:
    """The lower-cased letters of a word, with marks between them kept out."""
    low = word.lower()
    if low.isalpha():
        return low
    low = low.translate(_MARKS)
    return low if not low or low.isalpha() else "".join(c for c in low if c.isalpha())


#: Languages that are learnt at most.
MOST_LANGS = 256


def gram_places(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word number, hashed place) of all n-grams of the words, with one mark before and after each."""
    if not words:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    joined = "".join(f"\n{w}\n" for w in words)
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    owner = np.repeat(np.arange(len(words)), lengths)
    at, place = [], []
    h = np.zeros(len(code), np.uint64)
    for n in range(1, max(GRAMS) + 1):
        h = h[: len(code) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + code[n - 1 :] + np.uint64(n)
        if n in GRAMS:
            ok = owner[: len(h)] == owner[n - 1 :]
            if n == 1:
                ok &= code != 10
            at.append(owner[: len(h)][ok])
            mixed = h[ok] * np.uint64(0xC2B2AE3D27D4EB4F)
            place.append(((mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x165667B19E3779F9) >> np.uint64(64 - BITS)).astype(np.int64))
    return np.concatenate(at), np.concatenate(place)


def fit(docs: DataFrame, usable: Column | None = None, train_rows: int = TRAIN_ROWS):
    """(languages, log scores by place and language, scripts by language) from rows with text and lang.

    Of each language about ``train_rows / number of languages`` rows are taken, by md5 of the id (or of the text where that is null), and all
    rows where it has fewer: so a rare language is learnt at every size of the table. The sample holds the MOST_LANGS most
    frequent languages (ties: the first by name). What comes to the driver is bounded by 2**BITS places for each. Without a row there is no language.
    """
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    rows = rows.where(usable) if usable is not None else rows
    counted = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(MOST_LANGS)
    n = {r["lang"]: r["n"] for r in counted.collect()}
    each = -(-train_rows // max(len(n), 1))
    least = [F.lit(x) for lang, k in sorted(n.items()) for x in (lang, int(min(1.0, each / k) * 2**52))]
    # rows without an id are told by their text
    u = top_hash(F.lit("lang"), F.coalesce(F.col("doc_id").cast("string"), F.md5("text")), "lang")
    rows = rows.where(u < F.element_at(F.create_map(*least), F.col("lang"))) if least else rows
    rows = rows.select("lang", "text")

    def tally(batches):
        for b in batches:
            out = {"lang": [], "place": [], "n": []}
            for lang in dict.fromkeys(b["lang"]):
                texts = [t for t, x in zip(b["text"], b["lang"], strict=True) if x == lang]
                words = [x for t in texts for w in t.split() if (x := letters(w))]
                _, place = gram_places(words)
                places, n = np.unique(place, return_counts=True)
                code = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
                used = {-1 - i: k for i, k in enumerate(np.bincount(scripts_of(code), minlength=len(NAMES)).tolist()) if k}
                out["lang"] += [lang] * (len(places) + len(used))
                out["place"] += places.tolist() + list(used)
                out["n"] += n.tolist() + list(used.values())
            yield out

    got = map_rows(rows, ["lang", "text"], "lang string, place int, n long", tally).groupBy("lang", "place").agg(F.sum("n").alias("n")).collect()
    langs = sorted({r["lang"] for r in got})
    count = np.zeros((1 << BITS, len(langs)))
    used = np.zeros((len(langs), len(NAMES)))
    number = {x: i for i, x in enumerate(langs)}
    for r in got:
        if r["place"] >= 0:
            count[r["place"], number[r["lang"]]] = r["n"]
        else:
            used[number[r["lang"]], -1 - r["place"]] = r["n"]
    total = count.sum(axis=0, keepdims=True) if langs else count
    logs = np.log((count + 0.05) / (total + 0.05 * (1 << BITS))) if langs else count
    uses = used >= 0.01 * used.sum(axis=1, keepdims=True) if langs else used > 0
    return langs, logs.astype(np.float32), uses & (used > 0)


class Labeller:
    """Word scores, Viterbi and spans under a model."""

    def __init__(self, model, switch: float = SWITCH, memo_words: int = MEMO_WORDS):
        self.langs, self.logs, self.uses = model
        self.switch = switch
        self.memo: dict[str, int] = {}
        self.memo_words = memo_words
        self.rows = np.zeros((1, max(1, len(self.langs))), np.float32)
        self.has = np.zeros(1, bool)  # whether a remembered word has letters

    def _learn(self, words: list[str]) -> None:
        low = [letters(w) for w in words]
        owner, place = gram_places(low)
        k = len(self.langs)
        n = np.bincount(owner, minlength=len(words)) if len(owner) else np.zeros(len(words))
        s = np.stack([np.bincount(owner, self.logs[place, j], len(words)) for j in range(k)], axis=1)
        s /= np.maximum(n, 1)[:, None] ** 0.5  # overlapping n-grams are no independent evidence
        # a bit for each script of a word; a language fits if it uses all of them
        size = np.fromiter(map(len, low), np.int64, len(low))
        bit = np.int64(1) << scripts_of(np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), np.uint32))
        used = np.zeros(len(words), np.int64)
        some = np.flatnonzero(size)
        if len(some):
            used[some] = np.bitwise_or.reduceat(bit, np.cumsum(size[some]) - size[some])
        known = (self.uses * (np.int64(1) << np.arange(len(NAMES)))).sum(axis=1)
        fits = (used[:, None] & ~known[None]) == 0
        s[~fits] = -np.inf
        s[~fits.any(axis=1)] = 0
        s = np.maximum(s - s.max(axis=1, keepdims=True), FLOOR)
        first = len(self.memo) + 1
        self.memo.update(zip(words, range(first, first + len(words)), strict=True))
        if len(self.rows) < first + len(words):  # room for as many again
            more = np.zeros((2 * (first + len(words)), k), np.float32)
            more[:first] = self.rows[:first]
            has = np.zeros(len(more), bool)
            has[:first] = self.has[:first]
            self.rows, self.has = more, has
        self.rows[first : first + len(words)] = s
        self.has[first : first + len(words)] = size > 0

    def scores(self, texts: list[str | None]) -> list[np.ndarray]:
        """Row numbers of each text's words in ``rows``."""
        split = [(t or "").split() for t in texts]
        new = set().union(*split).difference(self.memo)
        if len(self.memo) + len(new) > self.memo_words:
            self.memo.clear()
            new = set().union(*split)
        if new:
            self._learn(list(new))
        return [np.fromiter(map(self.memo.__getitem__, w), np.int64, len(w)) for w in split]

    def path(self, s: np.ndarray) -> np.ndarray:
        """The best language of each word: Viterbi with an equal cost for each change.

        Away from the best constant language the path goes only where some run of words gains more by it
        than one change costs; elsewhere leaving it never pays. So the recursion runs over these
        stretches alone, which begin and end in that language.
        """
        n, k = s.shape
        if not n:
            return np.empty(0, np.int64)
        best = int(np.argmax(s.sum(axis=0, dtype=np.float64)))
        out = np.full(n, best, np.int64)
        if k == 1:
            return out
        others = np.delete(s, best, axis=1).max(axis=1) - s[:, best]
        total = np.concatenate(([0.0], np.cumsum(others, dtype=np.float64)))
        low = np.minimum.accumulate(total)[:-1]  # least sum before each word
        high = np.maximum.accumulate(total[::-1])[::-1][1:]  # largest sum after it
        open_ = high - low > self.switch
        if not open_.any():
            return out
        edges = np.flatnonzero(np.diff(np.concatenate(([False], open_, [False])).astype(np.int8)))
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            out[a:b] = self._stretch(s[a:b], best if a else None, best if b < n else None)
        return out

    def _stretch(self, s: np.ndarray, before: int | None, after: int | None) -> np.ndarray:
        n, k = s.shape
        came = np.empty((n, k), np.int32)
        rows, cost, each = s.tolist(), self.switch, range(k)
        v = [x - (cost if before is not None and j != before else 0.0) for j, x in enumerate(rows[0])]
        for t in range(1, n):
            top = max(v)
            arg, change = v.index(top), top - cost
            now = rows[t]
            came[t] = [j if v[j] >= change else arg for j in each]
            v = [(v[j] if v[j] >= change else change) + now[j] for j in each]
        if after is not None:
            v = [x - (cost if j != after else 0.0) for j, x in enumerate(v)]
        out = np.empty(n, np.int64)
        out[-1] = v.index(max(v))
        for t in range(n - 1, 0, -1):
            out[t - 1] = came[t, out[t]]
        return out

    def labelled(self, texts: list[str | None]) -> tuple[list[str], list[float], list[list[dict]]]:
        """For each text the language with most labelled words (ties: the first by name), its share of them, and the spans.

        A span is (first word, end word, language); words without letters join what precedes them.
        """
        langs, share, spans = [], [], []
        if not self.langs:  # nothing learnt, nothing to tell apart
            ends = [len((t or "").split()) for t in texts]
            return ["und"] * len(texts), [0.0] * len(texts), [[{"first": 0, "end": n, "lang": "und"}] if n else [] for n in ends]
        for rows in self.scores(texts):
            known = np.flatnonzero(self.has[rows])
            if not len(known):
                langs.append("und")
                share.append(0.0)
                spans.append([{"first": 0, "end": len(rows), "lang": "und"}] if len(rows) else [])
                continue
            path = self.path(self.rows[rows[known]])
            n = np.bincount(path, minlength=len(self.langs))
            langs.append(self.langs[int(n.argmax())])
            share.append(float(n.max() / n.sum()))
            starts = [0, *(np.flatnonzero(np.diff(path)) + 1).tolist()]
            bounds = [0, *known[starts[1:]].tolist(), len(rows)]
            spans.append([{"first": a, "end": z, "lang": self.langs[int(path[i])]} for a, z, i in zip(bounds, bounds[1:], starts, strict=False)])
        return langs, share, spans


def label(docs: DataFrame, model, id_col: str = "doc_id", text_col: str = "text", with_spans: bool = False) -> DataFrame:
    """id, lang_pred, score and, if asked for, spans of every whole text.

    Null texts and texts without a letter are ``und`` with score 0, and so is every text if no language was learnt. Ids may be null or repeated;
    other columns are not read; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        labeller = Labeller(shared.value)
        for b in batches:
            langs, share, spans = labeller.labelled(b[text_col])
            yield {id_col: b[id_col], "lang_pred": langs, "score": share} | ({"spans": spans} if with_spans else {})

    kind = docs.schema[id_col].dataType.simpleString()
    more = ", spans array<struct<first:int,end:int,lang:string>>" if with_spans else ""
    return map_rows(docs, [id_col, text_col], f"{id_col} {kind}, lang_pred string, score double{more}", run)


def report(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score and the spans of every document.

    Rows in are rows out, whatever their ids; a null id is not held out. Of languages with equally many words the first by
    name is predicted. Only doc_id, text and lang are read, so further columns clash with nothing; an empty table gives none.
    """
    model = fit(docs, usable=~held_out())
    return label(docs, model, with_spans=True).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "spans")
