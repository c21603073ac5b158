"""What happens to spans after detection: boost, trim, filters, retyping, and the two merges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..options import RETYPE_ACCOUNT_WORDS, AddressFilter, DetectOptions, Scoring


def agreement_boost(spans: DataFrame, scoring: Scoring = Scoring(), keep: tuple[str, ...] = ()) -> DataFrame:
    """Spans (id, model, type, start, end, score, seq) that overlap one of another model and the same type score higher, once; columns ``keep`` stay too.

    Spans are taken in the order of ``seq``. A span whose only partners have been boosted already
    stays as it is; so the fold runs over each (id, type) group that overlaps, in its order.
    """
    islands = _islands(spans, ["id", "type"])
    items = F.sort_array(F.collect_list(F.struct("seq", "model", "start", "end", "score", *keep)))
    grouped = islands.groupBy("id", "type", "island").agg(items.alias("x"))
    idx = F.sequence(F.lit(0), F.size("x") - 1)

    def step(done, i):
        a = F.element_at("x", i + 1)
        mates = F.filter(
            idx,
            lambda j: (j > i) & ~F.array_contains(done, j) & (F.element_at("x", j + 1)["model"] != a["model"])
            & (F.element_at("x", j + 1)["start"] < a["end"]) & (a["start"] < F.element_at("x", j + 1)["end"]),
        )
        return F.when(F.array_contains(done, i) | (F.size(mates) == 0), done).otherwise(F.array_union(done, F.array_union(F.array(i), mates)))

    hit = F.aggregate(idx, F.array().cast("array<int>"), step)
    out = grouped.withColumn("hit", hit).select("id", "type", "hit", F.posexplode("x").alias("i", "s"))
    score = F.when(F.array_contains("hit", F.col("i")), F.least(F.lit(scoring.max_score), F.col("s.score") + scoring.multi_model_boost)).otherwise(F.col("s.score"))
    return out.select("id", "s.seq", "s.model", "type", "s.start", "s.end", score.alias("score"), *[f"s.{c}" for c in keep])


def _islands(spans: DataFrame, keys: list[str]) -> DataFrame:
    """Numbers runs of overlapping spans within the keys."""
    return _numbered(spans, keys).drop("new")


def _numbered(spans: DataFrame, keys: list[str]) -> DataFrame:
    """``spans`` with the number of their run of overlapping ones, ``island``, and whether they begin it, ``new``."""
    order = Window.partitionBy(*keys).orderBy("start", "end", "seq")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    return spans.withColumn("new", (F.col("start") >= F.coalesce(reach, F.lit(-1))).cast("int")).withColumn(
        "island", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0))
    )


def trim(spans: DataFrame, text: Column) -> DataFrame:
    """White space off both ends, then marks off numbers; a span that would vanish stays. ``text`` is the document's."""
    inside = (F.col("start") >= 0) & (F.col("end") <= F.length(text)) & (F.col("start") < F.col("end"))
    cut = F.substring(text, F.col("start") + 1, F.col("end") - F.col("start"))
    head = F.length(F.regexp_extract(cut, f"{T.FLAGS}\\A{T.SPACE}*", 0))
    tail = F.length(F.regexp_extract(cut, f"{T.FLAGS}{T.SPACE}*\\z", 0))
    out = _shift(spans, inside, head, tail, text)
    inside = (F.col("start") >= 0) & (F.col("end") <= F.length(text)) & (F.col("start") < F.col("end"))
    cut = F.substring(text, F.col("start") + 1, F.col("end") - F.col("start"))
    number = F.col("type").isin("ACCOUNT_NUMBER", "SSN", "PHONE_NUMBER")
    return _shift(
        out, inside & number, F.length(F.regexp_extract(cut, r"\A[#(\[]*", 0)), F.length(F.regexp_extract(cut, r"[.,)\]:]*\z", 0)), text
    )


def _shift(spans, when, head, tail, text):
    spans = spans.withColumn("_h", F.when(when, head).otherwise(0)).withColumn("_t", F.when(when, tail).otherwise(0))
    moves = (F.col("_h") + F.col("_t") > 0) & (F.col("start") + F.col("_h") < F.col("end") - F.col("_t"))
    spans = spans.withColumn("_s", F.when(moves, F.col("start") + F.col("_h")).otherwise(F.col("start"))).withColumn(
        "_e", F.when(moves, F.col("end") - F.col("_t")).otherwise(F.col("end"))
    )
    spans = spans.withColumn("text", F.when(moves, F.substring(text, F.col("_s") + 1, F.col("_e") - F.col("_s"))).otherwise(F.col("text")))
    return spans.withColumn("start", F.col("_s")).withColumn("end", F.col("_e")).drop("_h", "_t", "_s", "_e")


def filter_addresses(spans: DataFrame, rule: AddressFilter | None) -> DataFrame:
    """Rules for ADDRESS spans of given sources (column ``source``)."""
    if rule is None or not rule.enabled:
        return spans
    low = F.lower(F.btrim(F.coalesce("text", F.lit(""))))
    digit = low.rlike(r"\p{Nd}")
    suffix = F.lit(False)
    if rule.whole_word_suffix and rule.suffixes:
        suffix = low.rlike(r"(?U)\b(?:" + "|".join(rule.suffixes) + r")\b")
    needed = F.lit(True)
    if rule.require_digit or rule.require_suffix:
        needed = (F.lit(rule.require_digit) & digit) | (F.lit(rule.require_suffix) & suffix)
    words = F.size(F.split(low, f"{T.FLAGS}{T.SPACE}+"))
    short = (words == 1) & ~low.isin(*rule.allowed_single_tokens or ("",)) & ~(F.lit(rule.allow_single_token_digits) & digit) & (F.length(low) < rule.min_single_token_length)
    applies = (F.col("type") == "ADDRESS") & (F.lower("source").isin(*[s.lower() for s in rule.sources]) if rule.sources else F.lit(True))
    return spans.where(~applies | ((low != "") & needed & ~short))


def disambiguate(spans: DataFrame, options: DetectOptions) -> DataFrame:
    """Retypes numbers by context and checksum, and drops birth dates without context; needs pre and post."""
    w = options.context_window
    context = F.lower(F.concat(F.right("pre", F.lit(w)), F.lit(" "), F.left("post", F.lit(w))))
    whole = F.lower(F.concat(F.right("pre", F.lit(w)), F.col("raw_text"), F.left("post", F.lit(w))))
    text = F.col("text")
    digits = F.length(F.regexp_replace(text, T.FLAGS + r"\D", ""))
    words = tuple(dict.fromkeys([*options.keywords.get("ACCOUNT_NUMBER", ()), *RETYPE_ACCOUNT_WORDS]))
    to_account = (F.col("type") == "SSN") & (digits == 9) & T.contains_any(whole, words)
    account = F.col("type") == "ACCOUNT_NUMBER"
    shaped = (digits == 9) & (T.is_ssn_format(text) | text.rlike(T.FLAGS + r"\A\d{9}\z"))
    to_ssn = account & shaped & T.contains_any(context, options.keywords.get("SSN", ()))
    luhn = options.luhn
    to_card = account & F.lit(luhn.enabled) & T.is_luhn_valid(text, luhn.min_length, luhn.max_length)
    if luhn.require_no_account_context:
        to_card = to_card & ~T.contains_any(context, options.keywords.get("ACCOUNT_NUMBER", ()))
    unborn = (F.col("type") == "BIRTHDATE") & ~T.contains_any(context, options.keywords.get("BIRTHDATE", ()))
    rows = spans.where(~unborn)
    kind = F.when(to_account, "ACCOUNT_NUMBER").when(to_ssn, "SSN").when(to_card, luhn.target_type).otherwise(F.col("type"))
    card = F.lit(options.scores[luhn.target_type]) if luhn.target_type in options.scores else F.col("score")
    score = (
        F.when(to_account, F.lit(options.scores.get("ACCOUNT_NUMBER", 0.80))).when(to_ssn, F.lit(0.95)).when(to_card, card).otherwise(F.col("score"))
    )
    return rows.select(*[c for c in rows.columns if c not in ("type", "score")], kind.alias("type"), score.alias("score"))


def merge_adjacent(spans: DataFrame, max_gap: int = 2, keys: tuple[str, ...] = ("id",)) -> DataFrame:
    """Joins a span to the one just before it (by start) if types agree and at most ``max_gap`` white space lies between.

    Columns id, seq, type, text, start, end, score, sources and ``pre``, the text before a span. The
    end is the last one's, the text the first's. Spans of a document agree in ``keys``.
    """
    order = Window.partitionBy(*keys).orderBy("start", "seq")
    near = F.col("start") - F.lag("end").over(order)
    blank = F.right(F.col("pre"), near).rlike(f"{T.FLAGS}\\A{T.SPACE}*\\z")
    joined = (F.lag("type").over(order) == F.col("type")) & (near <= max_gap) & ((near <= 0) | blank)
    rows = spans.withColumn("new", (~F.coalesce(joined, F.lit(False))).cast("int"))
    rows = rows.withColumn("island", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return _joined(rows, [*keys, "island"], ["start", "seq"], F.last).select(*keys, "seq", "type", "text", "start", "end", "score", "sources")


def merge_overlapping(spans: DataFrame, keys: tuple[str, ...] = ("id",)) -> DataFrame:
    """Joins overlapping spans of one type (touching is no overlap): largest end and score, all sources. Spans of a document agree in ``keys``."""
    rows = _numbered(spans, [*keys, "type"])
    return _joined(rows, [*keys, "type", "island"], ["start", "end", "seq"], F.max).select(*keys, "type", "text", "start", "end", "score", "sources")


def _joined(rows: DataFrame, island: list[str], place: list[str], end) -> DataFrame:
    """The first row of each island (``new`` is 1), with ``end`` over the ends, the largest score and all sources in their order.

    By windows, which take the rows as they are sorted and hold one island; an aggregate of lists keeps an object a
    group and sorts all rows again on both of its sides.
    """
    whole = Window.partitionBy(*island).orderBy(*place).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumns({"end": end("end").over(whole), "score": F.max("score").over(whole), "sources": F.collect_list("sources").over(whole)})
    return rows.where("new = 1").withColumn("sources", F.array_distinct(F.flatten("sources")))
