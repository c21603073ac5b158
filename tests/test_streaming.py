"""Streams give what batches give."""

from veilsift import options
from veilsift.plans.detect import detect_entities
from veilsift.streaming import detect as streaming

SCHEMA = "doc_id long, text string"


def test_streams(spark, tmp_path):
    rows = [(1, "mail a@b.co"), (2, "nothing"), (3, "Name: Jo Li"), (4, "born 2001-02-03")]
    docs = spark.createDataFrame(rows, SCHEMA)
    docs.write.json(str(tmp_path / "in"))
    stream = spark.readStream.schema(SCHEMA).json(str(tmp_path / "in"))
    o = options.DetectOptions(detectors=("regex",))
    q = streaming.stream_entities(stream, lambda df, i: df.write.mode("overwrite").parquet(str(tmp_path / f"out{i}")), str(tmp_path / "c1"), o)
    q.awaitTermination(120)
    key = lambda r: (r["id"], r["type"], r["start"], r["end"])
    assert sorted(map(key, spark.read.parquet(str(tmp_path / "out0")).collect())) == sorted(map(key, detect_entities(docs, o).collect()))
    for name, frame in (("scan", streaming.stream_scan(stream)), ("patterns", streaming.stream_patterns(stream, o))):
        q = frame.writeStream.format("memory").queryName(name).outputMode("append").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / name)).start()
        q.awaitTermination(120)
    assert {r["doc_id"] for r in spark.table("scan").collect()} == {1, 3, 4}
    assert {(r["id"], r["type"]) for r in spark.table("patterns").collect()} == {(1, "EMAIL"), (4, "BIRTHDATE")}
