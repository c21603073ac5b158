"""Matching of predicted against gold spans, metrics, and why gold spans were missed.

Spans are long rows: gold (id, idx, type, start, end, text), pred (id, idx, type, start, end, text).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import f1, file_id, length_bucket, safe_div
from ..sources import shared

# Fixed values.
EXACT_TYPES = ("SSN", "ACCOUNT_NUMBER")
GROUP_GAP, GROUP_SPAN = 30, 120
# End of the fixed values.

#: Characters of a bin of the interval join.
BIN = 128
#: Rounds of matching without an exchange, and how often they are begun before the rest is folded.
ROUNDS, STAGES = 1, 15


def select_records(gold: DataFrame, ids: DataFrame | None = None, files: DataFrame | None = None, limit: int | None = None) -> DataFrame:
    """Records whose id is listed, or else whose file is; the first ``limit`` of them.

    First in the file where ``gold`` tells lines (file, n, as the JSON lines reader gives them with places), else by id.
    """
    if ids is None and files is None:
        raise ValueError("neither ids nor files are given")
    hit = F.lit(False)
    rows = gold
    if ids is not None:
        listed = ids.select(F.col(ids.columns[0]).alias("_id")).distinct()
        rows = rows.join(listed, rows["id"] == listed["_id"], "left")
        hit = hit | F.col("_id").isNotNull()
    if files is not None:
        listed = files.select(F.col(files.columns[0]).alias("_file")).distinct()
        rows = rows.join(listed, file_id(rows["id"], True) == listed["_file"], "left")
        hit = hit | F.col("_file").isNotNull()
    rows = rows.where(hit).select(*gold.columns)
    order = ["file", "n"] if {"file", "n"} <= set(gold.columns) else ["id"]
    return rows.orderBy(*order).limit(limit) if limit else rows


def mode_of(kind: Column, setting: str = "hybrid") -> Column:
    if setting in ("exact", "overlap"):
        return F.lit(setting)
    return F.when(kind.isin(*EXACT_TYPES), "exact").otherwise("overlap")


def overlap(g: str = "g", p: str = "p") -> Column:
    return F.greatest(F.least(F.col(f"{g}.end"), F.col(f"{p}.end")) - F.greatest(F.col(f"{g}.start"), F.col(f"{p}.start")), F.lit(0))


def _bins(start: str = "start", end: str = "end") -> Column:
    """The bins that a span touches; none if it is empty."""
    first, last = F.floor(F.col(start) / BIN), F.floor((F.col(end) - 1) / BIN)
    return F.when(F.col(end) > F.col(start), F.sequence(first, last))


def touching(g: DataFrame, p: DataFrame, by: list[str], exact: Column | None = None) -> DataFrame:
    """Pairs of ``g`` and ``p`` (structs of those names with start and end) that share characters, ``by`` equal.

    Spans are cut into the bins they touch and joined bin by bin, so no pair is formed beyond a common bin; a
    pair that shares several is kept in the first. Rows for which ``exact`` holds meet only where start and end are equal.
    """
    exact = F.lit(False) if exact is None else exact

    def cut(rows: DataFrame, side: str) -> DataFrame:
        bins = F.when(exact, F.array(F.floor(F.col(f"{side}.start")))).otherwise(_bins(f"{side}.start", f"{side}.end"))
        return rows.withColumn("_bin", F.explode(bins))

    joined = cut(g, "g").join(cut(p, "p"), [*by, "_bin"])
    same = (F.col("g.start") == F.col("p.start")) & (F.col("g.end") == F.col("p.end"))
    first = F.col("_bin") == F.floor(F.greatest("g.start", "p.start") / BIN)
    return joined.where(F.when(exact, same).otherwise(first & (overlap() > 0))).drop("_bin")


def pairs(gold: DataFrame, pred: DataFrame, setting: str = "hybrid", least: int = 1) -> DataFrame:
    """Candidates (id, type, g, p, overlap): an interval join on id and type, with mode by type.

    With ``least`` below 1 every pair of one id and type is a candidate, as the rule says.
    """
    g = gold.select("id", "type", F.struct("start", "end", "idx").alias("g"))
    p = pred.select("id", "type", F.struct("start", "end", "idx").alias("p"))
    exact = mode_of(F.col("type"), setting) == "exact"
    if least < 1:
        same = (F.col("g.start") == F.col("p.start")) & (F.col("g.end") == F.col("p.end"))
        joined = g.join(p, ["id", "type"]).where(~exact | same)
    else:
        joined = touching(g, p, ["id", "type"], exact).where(exact | (overlap() >= least))
    return joined.withColumn("overlap", F.when(exact, F.lit(1_000_000_000)).otherwise(overlap()))


def match(gold: DataFrame, pred: DataFrame, setting: str = "hybrid", least: int = 1, group_addresses: bool = True) -> DataFrame:
    """Matches (id, type, g_idx, p_idx, primary): greedy by overlap, gold length and earlier start.

    A candidate that is the best of its gold span and of its prediction is what the greedy order takes before
    any other of the two, so all such are taken at once, what they touch goes, and the rest is looked at again.
    Afterwards an ADDRESS prediction of at most 120 characters takes further unmatched gold spans around its own.
    Where all types are exact, only spans of equal places meet, and the greedy order pairs the n-th gold span of a place with its n-th prediction.
    """
    if setting == "exact":
        return _exact(gold, pred)
    rank = F.struct(
        (-F.col("overlap")).alias("a"), (F.col("g.start") - F.col("g.end")).alias("b"), F.col("g.start").alias("c"),
        F.col("g.idx").alias("g"), F.col("p.idx").alias("p"),
    )
    cands = pairs(gold, pred, setting, least).select("id", "type", "g", "p", rank.alias("rank")).repartition("id", "type")
    cands = shared.cut(cands)
    ones = _mutual(cands.select("id", "type", F.col("g.idx").alias("g_idx"), F.col("p.idx").alias("p_idx"), "rank"))
    out = ones.select("id", "type", F.col("g_idx").cast("int").alias("g_idx"), F.col("p_idx").cast("int").alias("p_idx"), F.lit(True).alias("primary"))
    if not group_addresses:
        return out
    return out.unionByName(_grouped(cands, ones))


def _exact(gold: DataFrame, pred: DataFrame) -> DataFrame:
    """Matches of spans that are equal in id, type, start and end, the n-th by idx of either side: one exchange of each, nothing written.

    ``idx`` tells the spans of an id and type apart, as everywhere here.
    """
    place = ["id", "type", "start", "end"]
    sides = [rows.select(*place, F.lit(k).alias("_side"), F.col("idx").cast("int").alias("idx")) for k, rows in enumerate((gold, pred))]
    both = sides[0].unionByName(sides[1]).where(" AND ".join(f"`{c}` IS NOT NULL" for c in place)).repartition(*place)
    both = both.withColumn("_n", F.row_number().over(Window.partitionBy(*place, "_side").orderBy("idx")))
    each = both.groupBy(*place, "_n").agg(*[F.max(F.when(F.col("_side") == k, F.col("idx"))).alias(c) for k, c in enumerate(("g_idx", "p_idx"))])
    return each.where("g_idx IS NOT NULL AND p_idx IS NOT NULL").select("id", "type", "g_idx", "p_idx", F.lit(True).alias("primary"))


def _mutual(cands: DataFrame) -> DataFrame:
    """The greedy one-to-one choice of (id, type, g_idx, p_idx, rank), smallest rank first, ``cands`` being dealt by id and type.

    ROUNDS rounds run without an exchange; then what is left is written and counted. Nearly all is
    settled in the first, so the others are small; what forms chains, each link better than the one before, takes a round a
    link, so after STAGES such stages the rest of a type's spans is folded in order, in one row.
    """
    taken = None
    for _ in range(STAGES):
        rows = cands.withColumn("state", F.lit(0))  # 0 open, 1 taken, 2 gone
        for _ in range(ROUNDS):
            open_ = F.when(F.col("state") == 0, F.col("rank"))
            of_g, of_p = (Window.partitionBy("id", "type", c) for c in ("g_idx", "p_idx"))
            rows = rows.withColumn("best_g", F.min(open_).over(of_g)).withColumn("best_p", F.min(open_).over(of_p))
            won = (F.col("state") == 0) & (F.col("rank") == F.col("best_g")) & (F.col("rank") == F.col("best_p"))
            rows = rows.withColumn("won", won)
            lost = F.max("won").over(of_g) | F.max("won").over(of_p)
            rows = rows.withColumn("state", F.when(F.col("won"), 1).when((F.col("state") == 0) & lost, 2).otherwise(F.col("state"))).drop("best_g", "best_p", "won")
        rows = shared.cut(rows)
        new = rows.where("state = 1").drop("state")
        taken = new if taken is None else taken.unionByName(new)
        cands = rows.where("state = 0").drop("state")
        if cands.isEmpty():
            return taken
    folded = F.aggregate(
        F.sort_array(F.collect_list("rank")),
        F.array().cast(cands.select(F.array("rank")).schema[0].dataType),
        lambda acc, x: F.when(F.exists(acc, lambda m: (m["g"] == x["g"]) | (m["p"] == x["p"])), acc).otherwise(F.array_append(acc, x)),
    )
    rest = cands.groupBy("id", "type").agg(folded.alias("r")).select("id", "type", F.explode("r").alias("rank"))
    return taken.unionByName(rest.select("id", "type", F.col("rank.g").alias("g_idx"), F.col("rank.p").alias("p_idx"), "rank"))


def _grouped(cands: DataFrame, ones: DataFrame) -> DataFrame:
    """Further gold spans of ADDRESS predictions.

    Around its own span a prediction takes the unmatched candidates to the left as long as no gap is too wide and none lies
    too far from the own span's end, then those to the right, measured from where the left side ends. Each side is a running
    count of what breaks this rule, zero as far as the island goes. A span that several predictions
    claim goes to the one that was matched first.
    """
    own = ones.where("type = 'ADDRESS'").select("id", "p_idx", F.col("g_idx").alias("own"), F.col("rank").alias("nth"))
    used = ones.where("type = 'ADDRESS'").select("id", "g_idx")
    near = cands.where((F.col("type") == "ADDRESS") & (F.col("p.end") - F.col("p.start") <= GROUP_SPAN))
    near = near.select("id", F.col("g.idx").alias("g_idx"), F.col("p.idx").alias("p_idx"), F.col("g.start").alias("start"), F.col("g.end").alias("end"))
    free = near.join(used, ["id", "g_idx"], "left_anti").join(own, ["id", "p_idx"])
    mine = near.join(own.withColumn("g_idx", F.col("own")), ["id", "p_idx", "g_idx"]).select(*free.columns)
    rows = free.unionByName(mine).withColumn("is_own", F.col("g_idx") == F.col("own"))

    of_p = Window.partitionBy("id", "p_idx")
    up, down = of_p.orderBy("start", "g_idx"), of_p.orderBy(F.desc("start"), F.desc("g_idx"))
    before, after = (w.rowsBetween(Window.unboundedPreceding, Window.currentRow) for w in (up, down))
    rows = rows.withColumns({
        "gap": F.col("start") - F.lag("end").over(up), "next_gap": F.lead("start").over(up) - F.col("end"),
        "own_end": F.max(F.when(F.col("is_own"), F.col("end"))).over(of_p), "right": F.max("is_own").over(before), "left": F.max("is_own").over(after),
    })
    bad = (F.col("next_gap") > GROUP_GAP) | (F.col("own_end") - F.col("start") > GROUP_SPAN)
    rows = rows.withColumn("breaks", F.sum(F.when(~F.col("right") & bad, 1).otherwise(0)).over(after))
    rows = rows.withColumn("in_left", F.col("left") & (F.col("is_own") | (F.col("breaks") == 0)))
    rows = rows.withColumn("first", F.min(F.when(F.col("in_left"), F.col("start"))).over(of_p))
    bad = (F.col("gap") > GROUP_GAP) | (F.col("end") - F.col("first") > GROUP_SPAN)
    rows = rows.withColumn("breaks", F.sum(F.when(F.col("right") & ~F.col("is_own") & bad, 1).otherwise(0)).over(before))
    group = rows.where(~F.col("is_own") & (F.col("in_left") | (F.col("right") & (F.col("breaks") == 0))))
    claim = F.row_number().over(Window.partitionBy("id", "g_idx").orderBy("nth"))
    return group.withColumn("n", claim).where("n = 1").select(
        "id", F.lit("ADDRESS").alias("type"), F.col("g_idx").cast("int").alias("g_idx"), F.col("p_idx").cast("int").alias("p_idx"), F.lit(False).alias("primary")
    )


def outcomes(gold: DataFrame, pred: DataFrame, matches: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(false negatives, false positives): gold without a match and predictions without one."""
    fn = gold.join(matches.select("id", "type", F.col("g_idx").alias("idx")).distinct(), ["id", "type", "idx"], "left_anti")
    fp = pred.join(matches.select("id", "type", F.col("p_idx").alias("idx")).distinct(), ["id", "type", "idx"], "left_anti")
    return fn, fp


def metrics(gold: DataFrame, pred: DataFrame, matches: DataFrame) -> DataFrame:
    """(type, tp, fn, fp, recall, precision, f1) by type, over all ("micro") and over PERSON and LOCATION."""
    fn, fp = outcomes(gold, pred, matches)
    one = [
        matches.select("type", F.lit("tp").alias("what")), fn.select("type", F.lit("fn").alias("what")), fp.select("type", F.lit("fp").alias("what")),
    ]
    counts = one[0].unionByName(one[1]).unionByName(one[2]).groupBy("type").agg(*[F.count_if(F.col("what") == w).alias(w) for w in ("tp", "fn", "fp")])
    names = F.array_compact(F.array(F.col("type"), F.lit("micro"), F.when(F.col("type").isin("PERSON", "LOCATION"), F.lit("person_location_micro"))))
    sums = counts.select(F.explode(names).alias("type"), "tp", "fn", "fp").groupBy("type").agg(*[F.sum(w).alias(w) for w in ("tp", "fn", "fp")])
    recall, precision = safe_div(F.col("tp"), F.col("tp") + F.col("fn")), safe_div(F.col("tp"), F.col("tp") + F.col("fp"))
    return sums.select("type", "tp", "fn", "fp", F.round(recall, 4).alias("recall"), F.round(precision, 4).alias("precision"), F.round(f1(precision, recall), 4).alias("f1"))


def nearest(spans: DataFrame, pred: DataFrame) -> DataFrame:
    """(columns of ``spans``, nearest): the distance to the nearest prediction of the id; 0 if one overlaps, null if there is none.

    An as-of join: ends and starts of both sides are sorted as events of a document, the last end before a span and the
    next start after it are carried to it, and a prediction that has begun before the span's end but not ended before its start overlaps.
    """
    keys = spans.columns
    absent = [F.lit(None).cast(spans.schema[c].dataType).alias(c) for c in keys if c != "id"]
    event = lambda at, k: pred.select("id", *absent, F.col(at).alias("_at"), F.lit(k).alias("_kind"))
    asked = lambda at, k: spans.select(*keys, F.col(at).alias("_at"), F.lit(k).alias("_kind"))
    # at one place an end comes before the span that starts there, and a start after the span that ends there
    events = event("end", 0).unionByName(asked("start", 1)).unionByName(asked("end", 2)).unionByName(event("start", 3))
    forth = Window.partitionBy("id").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    back = Window.partitionBy("id").orderBy(F.desc("_at"), F.desc("_kind")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    is_end, is_start = F.col("_kind") == 0, F.col("_kind") == 3
    rows = events.withColumns({
        "_ended": F.count(F.when(is_end, 1)).over(forth), "_begun": F.count(F.when(is_start, 1)).over(forth),
        "_last": F.max(F.when(is_end, F.col("_at"))).over(forth), "_next": F.min(F.when(is_start, F.col("_at"))).over(back),
    })
    at_start, at_end = F.col("_kind") == 1, F.col("_kind") == 2
    both = rows.where(at_start | at_end).groupBy(*keys).agg(
        F.max(F.when(at_start, F.col("_ended"))).alias("_ended"), F.max(F.when(at_start, F.col("_last"))).alias("_last"),
        F.max(F.when(at_end, F.col("_begun"))).alias("_begun"), F.min(F.when(at_end, F.col("_next"))).alias("_next"),
    )
    away = F.least(F.col("start") - F.col("_last"), F.col("_next") - F.col("end"))
    return both.select(*keys, F.when(F.col("_begun") > F.col("_ended"), F.lit(0)).otherwise(away).alias("nearest"))


def misses(fn: DataFrame, pred: DataFrame, setting: str = "hybrid", least: int = 1, proximity: int = 50, types: list[str] | None = None) -> DataFrame:
    """``fn`` plus category, predicted_type, nearest (distance of the nearest prediction, 0 if it overlaps).

    Overlaps come from the interval join, distances from ``nearest``; gold spans never meet predictions that are neither.
    Rows of ``fn`` that are equal in all columns come out once.
    """
    p = pred.where(F.col("type").isin(*types)) if types else pred
    keys = fn.columns
    g = fn.select("id", F.struct(*keys).alias("g"))
    met = touching(g, p.select("id", F.struct("type", "start", "end").alias("p")), ["id"])
    same = F.col("p.type") == F.col("g.type")
    flags = met.select(
        "g.*", F.when(~same, F.col("p.type")).alias("other"), same.alias("touched"), (same & (overlap() < least)).alias("little"), F.lit(None).cast("int").alias("nearest")
    )
    none = {"other": F.lit(None).cast("string"), "touched": F.lit(False), "little": F.lit(False)}
    far = nearest(fn, p).withColumns(none).withColumn("nearest", F.col("nearest").cast("int"))
    agg = far.unionByName(flags).groupBy(*keys).agg(
        F.min("other").alias("predicted_type"), F.max("touched").alias("touched"), F.max("little").alias("little"), F.max("nearest").alias("nearest")
    )
    mode = mode_of(F.col("type"), setting)
    category = (
        F.when(F.col("predicted_type").isNotNull(), "wrong_type")
        .when((mode == "exact") & F.col("touched"), "boundary_mismatch")
        .when((mode == "overlap") & F.col("little"), "partial_overlap")
        .when((F.col("nearest") > 0) & (F.col("nearest") <= proximity), "near_miss")
        .otherwise("no_prediction")
    )
    return agg.select(*keys, category.alias("category"), "predicted_type", "nearest")


def miss_tables(missed: DataFrame, tp: DataFrame, top: int = 20) -> dict[str, DataFrame]:
    """Counts of misses: category by type, length by type, by text, and the documents with most."""
    size = length_bucket(F.col("end") - F.col("start"))
    docs = missed.groupBy("id").agg(F.count("*").alias("fn")).join(tp.groupBy("id").agg(F.count("*").alias("tp")), "id", "left")
    return {
        "category": missed.groupBy("type", "category").agg(F.count("*").alias("n")),
        "length": missed.groupBy("type", size.alias("length")).agg(F.count("*").alias("n")),
        "text": missed.groupBy("type", F.lower(F.btrim("text")).alias("text")).agg(F.count("*").alias("n")),
        "documents": docs.select("id", "fn", F.coalesce("tp", F.lit(0)).alias("tp")).orderBy(F.desc("fn"), "id").limit(top),
    }


def capped(rows: DataFrame, by: str, most: int) -> DataFrame:
    """The first ``most`` rows of each ``by``, ordered by id and start."""
    order = Window.partitionBy(by).orderBy("id", "start", "end")
    return rows.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= most).drop("_n")


def quantiles(rows: DataFrame, column: str) -> DataFrame:
    """p50, p90, p95, p99, mean, min, max with linear interpolation; zeros for no rows."""
    p = F.percentile(column, F.array(*[F.lit(x) for x in (0.5, 0.9, 0.95, 0.99)]))
    names = ("p50", "p90", "p95", "p99")
    got = rows.agg(p.alias("p"), F.mean(column).alias("mean"), F.min(column).cast("double").alias("min"), F.max(column).cast("double").alias("max"))
    zero = F.lit(0.0)
    return got.select(*[F.coalesce(F.element_at("p", i + 1), zero).alias(n) for i, n in enumerate(names)], *[F.coalesce(c, zero).alias(c) for c in ("mean", "min", "max")])


def markdown(table: DataFrame, title: str) -> str:
    """A small table as markdown; for reports of aggregates."""
    rows = table.collect()
    head = table.columns
    lines = [f"## {title}", "", "| " + " | ".join(head) + " |", "|" + " --- |" * len(head)]
    return "\n".join(lines + ["| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in rows]) + "\n"


def html_table(table: DataFrame, title: str) -> str:
    from html import escape

    rows = table.collect()
    cells = lambda r, tag: "".join(f"<{tag}>{escape('' if v is None else str(v))}</{tag}>" for v in r)
    return f"<h2>{escape(title)}</h2><table><tr>{cells(table.columns, 'th')}</tr>" + "".join(f"<tr>{cells(r, 'td')}</tr>" for r in rows) + "</table>"
