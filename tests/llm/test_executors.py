"""Operators on executors that have no package of ours."""

import os
import subprocess
import sys
from pathlib import Path

SCRIPT = """
import sys
from pyspark.sql import SparkSession
spark = (
    SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false").getOrCreate()
)
spark.sparkContext.setLogLevel("ERROR")
def absent(_):
    try:
        import veilsift
        return 1
    except ModuleNotFoundError:
        return 0
assert spark.sparkContext.parallelize([1]).map(absent).sum() == 0
sys.path.insert(0, sys.argv[1])
from veilsift.llm import lines, va_file, vptree
vectors = [(i, [float((i * k) % 17 - 8) for k in range(1, 9)], i % 3) for i in range(300)]
frame = spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int")
print(vptree.nearest(frame, frame.where("vec_id % 20 = 0"), 5, shard_rows=60).count(), va_file.report(frame).count())
docs = spark.createDataFrame([(i, "one line that three documents share\\nand %d" % i) for i in range(5)], "doc_id long, text string")
print([r["n_dropped"] for r in lines.report(docs).orderBy("doc_id").collect()])
"""


def test_without_the_package(tmp_path):
    script = tmp_path / "run.py"
    script.write_text(SCRIPT)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    ran = subprocess.run([sys.executable, str(script), str(Path(__file__).resolve().parents[2])], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert ran.returncode == 0, ran.stderr[-3000:]
    found = ran.stdout.split("\n")
    assert found[0].split()[0] == "75" and int(found[0].split()[1]) > 0 and found[1] == "[1, 1, 1, 1, 0]"
