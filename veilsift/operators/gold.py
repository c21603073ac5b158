"""Validation, repair and conversion of annotated records (id, text, entities)."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import FLAGS, SPACE

# Labels of the external data set and the types they stand for.
LABELS = {
    "GIVENNAME": "PERSON", "SURNAME": "PERSON", "TELEPHONENUM": "PHONE_NUMBER", "SOCIALNUM": "SSN", "EMAIL": "EMAIL",
    "ACCOUNTNUM": "ACCOUNT_NUMBER", "DATEOFBIRTH": "BIRTHDATE", "STREET": "ADDRESS", "BUILDINGNUM": "ADDRESS", "CITY": "ADDRESS", "ZIPCODE": "ADDRESS",
}
# End of the fixed values.


def _issue(code: str, level: str, index: Column | None = None) -> Column:
    return F.struct(F.lit(code).alias("code"), F.lit(level).alias("level"), (index if index is not None else F.lit(None).cast("int")).alias("entity_index"))


def _when(cond: Column, issue: Column) -> Column:
    return F.when(cond, issue)


def validate(gold: DataFrame, types: list[str], require_text: bool = True) -> DataFrame:
    """(id, code, level, entity_index) of every problem; indices count from 0.

    A column ``odd`` (array<string>), as ``typed`` leaves it, tells what a typed record can't show: TEXT or
    ENTITIES of a wrong kind, and the indices of entities that are no objects.
    """
    text, ents = F.col("text"), F.col("entities")
    odd = F.col("odd") if "odd" in gold.columns else F.array().cast("array<string>")
    bad_text, bad_entities = F.array_contains(odd, "TEXT"), F.array_contains(odd, "ENTITIES")
    record = F.array(
        _when(F.coalesce("id", F.lit("")) == "", _issue("MISSING_ID", "ERROR")),
        _when(text.isNull() & ~bad_text, _issue("MISSING_TEXT", "ERROR" if require_text else "WARNING")),
        _when(bad_text, _issue("INVALID_TEXT", "ERROR")),
        _when(ents.isNull() & ~bad_entities, _issue("MISSING_ENTITIES", "WARNING")),
        _when(bad_entities, _issue("INVALID_ENTITIES", "ERROR")),
    )
    with_id = F.when(F.coalesce("id", F.lit("")) == "", F.slice(record, 1, 1)).otherwise(record)

    def entity(e, i):
        start, end = e["start"], e["end"]
        whole = start.isNotNull() & end.isNotNull()
        inside = (start >= 0) & (start < end) & (end <= F.length(text))
        span = F.substring(text, start + 1, end - start)
        good = whole & text.isNotNull() & inside
        form = F.array(_issue("INVALID_ENTITY_FORMAT", "ERROR", i))
        checks = F.array(
            _when(~F.coalesce(e["type"].isin(*types), F.lit(False)), _issue("INVALID_TYPE", "ERROR", i)),
            _when(~whole, _issue("INVALID_OFFSETS", "ERROR", i)),
            _when(whole & text.isNotNull() & ~inside, _issue("BAD_OFFSETS", "ERROR", i)),
            _when(good & span.rlike(f"{FLAGS}\\A{SPACE}|{SPACE}\\z"), _issue("WHITESPACE_SPAN", "ERROR", i)),
            _when(good & (F.length(span) < 2) & e["type"].isin("PERSON", "LOCATION", "ADDRESS"), _issue("SHORT_SPAN", "WARNING", i)),
            _when(good & F.contains(span, F.lit("\n")), _issue("NEWLINE_IN_SPAN", "WARNING", i)),
            _when(good & e["text"].isNotNull() & (e["text"] != span), _issue("TEXT_MISMATCH", "WARNING", i)),
            # the same span and type earlier in the record
            _when(
                whole & e["type"].isNotNull()
                & F.exists(F.slice(ents, F.lit(1), i), lambda o: (o["start"] == start) & (o["end"] == end) & (o["type"] == e["type"])),
                _issue("DUPLICATE_ENTITY", "WARNING", i),
            ),
        )
        return F.when(F.array_contains(odd, i.cast("string")), form).otherwise(checks)

    inner = F.when((F.coalesce("id", F.lit("")) != "") & ents.isNotNull(), F.flatten(F.transform(ents, entity)))
    all_issues = F.filter(F.concat(with_id, F.coalesce(inner, F.array().cast("array<struct<code:string,level:string,entity_index:int>>"))), lambda x: x.isNotNull())
    return gold.select("id", F.explode(all_issues).alias("issue")).select("id", "issue.*")


def typed(lines: DataFrame) -> DataFrame:
    """Records (id, text, entities, odd) of JSON lines (n, value), for ``validate``; blank lines and lines that are no JSON are left out.

    Fields of a wrong kind come out null, and ``odd`` tells which.
    """
    v = F.col("v")
    at = lambda x, path: F.try_variant_get(x, path, "variant")
    kind = lambda x, path: F.coalesce(F.schema_of_variant(at(x, path)), F.lit("VOID"))
    word = lambda x, path: F.when(kind(x, path) == "STRING", F.try_variant_get(x, path, "string"))
    whole = lambda x, path: F.when(kind(x, path) == "BIGINT", F.try_variant_get(x, path, "int"))
    rows = lines.where(F.btrim("value") != "").withColumn("v", F.try_parse_json("value")).where("v is not null")
    listed = F.when(F.startswith(kind(v, "$.entities"), F.lit("ARRAY")), F.try_variant_get(v, "$.entities", "array<variant>"))
    rows = rows.withColumn("e", listed)
    ents = F.transform("e", lambda x: F.struct(word(x, "$.type").alias("type"), whole(x, "$.start").alias("start"), whole(x, "$.end").alias("end"), word(x, "$.text").alias("text")))
    no_object = F.filter(F.transform("e", lambda x, i: F.when(~F.coalesce(F.startswith(F.schema_of_variant(x), F.lit("OBJECT")), F.lit(False)), i.cast("string"))), lambda x: x.isNotNull())
    fields = F.array_compact(
        F.array(
            F.when(~kind(v, "$.text").isin("STRING", "VOID"), "TEXT"),
            F.when((kind(v, "$.entities") != "VOID") & ~F.startswith(kind(v, "$.entities"), F.lit("ARRAY")), "ENTITIES"),
        )
    )
    return rows.select(word(v, "$.id").alias("id"), word(v, "$.text").alias("text"), ents.alias("entities"), F.concat(fields, F.coalesce(no_object, F.array().cast("array<string>"))).alias("odd"))


def validate_lines(lines: DataFrame, types: list[str], require_text: bool = True) -> DataFrame:
    """(id, code, level, entity_index) of JSON lines (n, value): what is no JSON, and what is wrong with the records."""
    bad = lines.where((F.btrim("value") != "") & F.try_parse_json("value").isNull()).select(
        F.concat(F.lit("LINE_"), F.col("n").cast("string")).alias("id"), F.lit("JSON_PARSE_ERROR").alias("code"), F.lit("ERROR").alias("level"), F.lit(None).cast("int").alias("entity_index")
    )
    return bad.unionByName(validate(typed(lines), types, require_text))


def merge_adjacent(spans: DataFrame, gap: int = 2) -> DataFrame:
    """Annotated spans (id, idx, type, start, end, pre): joins a span to the one just before it, if types agree and at most ``gap`` white space lies between.

    ``pre`` is the text before a span. Starts are the first's, ends the last's.
    """
    order = Window.partitionBy("id").orderBy("start", "idx")
    near = F.col("start") - F.lag("end").over(order)
    blank = F.right("pre", near).rlike(f"{FLAGS}\\A{SPACE}*\\z")
    joined = (F.lag("type").over(order) == F.col("type")) & (near <= gap) & ((near <= 0) | blank)
    rows = spans.withColumn("new", (~F.coalesce(joined, F.lit(False))).cast("int"))
    rows = rows.withColumn("island", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    place = F.struct("start", "idx")
    return rows.groupBy("id", "island").agg(
        F.min("idx").alias("idx"), F.min_by("type", place).alias("type"), F.min("start").alias("start"), F.max_by("end", place).alias("end")
    ).drop("island")


def parse_errors(lines: DataFrame, schema: str) -> DataFrame:
    """(id LINE_n, code, level) for lines (n, value) that are not blank and no JSON object."""
    bad = F.from_json("value", f"{schema}, _bad string", {"columnNameOfCorruptRecord": "_bad", "mode": "PERMISSIVE"})
    return lines.where(F.btrim("value") != "").where(bad["_bad"].isNotNull()).select(
        F.concat(F.lit("LINE_"), F.col("n").cast("string")).alias("id"), F.lit("JSON_PARSE_ERROR").alias("code"), F.lit("ERROR").alias("level")
    )


def summary(issues: DataFrame) -> DataFrame:
    """(code, n, records) of issues; code null counts all: records with an issue of any level."""
    return issues.groupingSets([[F.col("code")], []], F.col("code")).agg(F.count("*").alias("n"), F.countDistinct("id").alias("records"))


def exit_code(issues: DataFrame, max_errors: int, strict: bool = False) -> int:
    """1 if one of the first ``max_errors`` issues is an error (with ``strict``: or a warning)."""
    rows = issues.orderBy("id", "entity_index", "code").limit(max_errors)
    return int(not rows.where(F.lit(strict) | (F.col("level") == "ERROR")).isEmpty())


def fix(gold: DataFrame) -> DataFrame:
    """Spans trimmed, texts synced, repeats dropped, sorted by start, end, type; spans out of bounds stay as they are."""
    text = F.col("text")

    def mend(e):
        start, end = e["start"], e["end"]
        inside = F.coalesce((start >= 0) & (start < end) & (end <= F.length(text)), F.lit(False))
        span = F.substring(text, start + 1, end - start)
        head = F.length(F.regexp_extract(span, f"{FLAGS}\\A{SPACE}*", 0))
        tail = F.length(F.regexp_extract(span, f"{FLAGS}{SPACE}*\\z", 0))
        moves = inside & (start + head < end - tail)
        s, z = F.when(moves, start + head).otherwise(start), F.when(moves, end - tail).otherwise(end)
        return F.struct(e["type"].alias("type"), s.alias("start"), z.alias("end"), F.when(inside, F.substring(text, s + 1, z - s)).otherwise(e["text"]).alias("text"), inside.alias("ok"))

    mended = F.transform("entities", mend)

    def first(x, i):
        return ~x["ok"] | ~F.exists(
            F.slice(mended, F.lit(1), i), lambda o: o["ok"] & (o["start"] == x["start"]) & (o["end"] == x["end"]) & o["type"].eqNullSafe(x["type"])
        )

    kept = F.array_sort(
        F.transform(
            F.filter(mended, first),
            lambda x: F.struct(
                F.coalesce(x["start"], F.lit(0)).alias("a"), F.coalesce(x["end"], F.lit(0)).alias("b"), F.coalesce(x["type"], F.lit("")).alias("c"), x.alias("x")
            ),
        )
    )
    out = F.transform(kept, lambda k: F.struct(k["x"]["type"].alias("type"), k["x"]["start"].alias("start"), k["x"]["end"].alias("end"), k["x"]["text"].alias("text")))
    return gold.withColumn("entities", F.when((F.coalesce("text", F.lit("")) != "") & F.col("entities").isNotNull(), out).otherwise(F.col("entities")))


def map_labels(spans: DataFrame, labels: dict[str, str] = LABELS) -> DataFrame:
    """Types of an external data set by label; labels without a type are dropped."""
    pairs = F.create_map(*[F.lit(x) for kv in labels.items() for x in kv])
    return spans.withColumn("type", F.element_at(pairs, F.col("label"))).where("type is not null").drop("label")


def count_types(gold: DataFrame) -> DataFrame:
    return gold.select(F.explode("entities.type").alias("type")).groupBy("type").agg(F.count("*").alias("n"))


def corrections_file(spark: SparkSession, path: str) -> DataFrame:
    """(id, type, start, end) of a JSON file's ``remove_entities``; a file that is not there removes nothing."""
    fields = "id string, type string, start int, end int"
    try:
        rows = spark.read.schema(f"remove_entities array<struct<{fields.replace(' ', ':').replace(',:', ', ')}>>").option("multiLine", True).json(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], fields)
    return rows.select(F.inline("remove_entities"))


def correct(spans: DataFrame, removals: DataFrame) -> DataFrame:
    """Spans without those listed exactly (id, type, start, end)."""
    return spans.join(removals.select("id", "type", "start", "end").distinct(), ["id", "type", "start", "end"], "left_anti")


def nest(spans: DataFrame, texts: DataFrame) -> DataFrame:
    """Long spans to records (id, text, entities)."""
    packed = spans.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("start", "end", "type", "text"))).alias("e"))
    ents = F.transform("e", lambda x: F.struct(x["type"].alias("type"), x["start"].alias("start"), x["end"].alias("end"), x["text"].alias("text")))
    return texts.join(packed, "id", "left").select("id", texts["text"], F.coalesce(ents, F.array().cast("array<struct<type:string,start:int,end:int,text:string>>")).alias("entities"))


def unnest(gold: DataFrame) -> DataFrame:
    """Records to long spans with ``idx``."""
    return gold.select("id", F.posexplode("entities").alias("idx", "e")).select("id", "idx", "e.*")


def latest(events: DataFrame, key: list[str], at: str) -> DataFrame:
    """The last event of each key."""
    return events.withColumn("_n", F.row_number().over(Window.partitionBy(*key).orderBy(F.desc(at)))).where("_n = 1").drop("_n")
