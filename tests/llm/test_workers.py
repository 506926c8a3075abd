import os
import subprocess
import sys

SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
from annolink.llm import chat, langid, repair, spelling, toxicity

spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
assert not spark.range(1).rdd.map(lambda _: __import__("importlib.util").util.find_spec("annolink") is not None).first()
rows = [(i, "ta ri mo ne lu" if i % 2 else "zu bra kle wop", "aa" if i % 2 else "bb", i % 2) for i in range(40)]
docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int")
assert langid.predict(docs, langid.fit(docs)).where("lang_pred = lang").count() == 40
assert toxicity.score(docs, toxicity.fit(docs)).where("(score >= 0.5) = (toxic = 1)").count() == 40
turns = spark.createDataFrame([(1, 0, "user", "a."), (1, 1, "assistant", "b.")], "conv_id long, turn long, role string, text string")
assert repair.repair(turns)[1].count() == 2 and chat.read_back(chat.format_chat(turns)).count() == 1
words = spark.createDataFrame([("colour", 9), ("color", 3)], "word string, n long")
assert spelling.variant_groups(words).where("form = 'colour'").count() == 1
print("all well")
"""


def test_workers_need_no_package(tmp_path):
    """Workers that can't import the package run its operators."""
    script = tmp_path / "job.py"
    script.write_text(SCRIPT)
    repo = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, str(script), repo], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "all well" in out.stdout, out.stderr[-3000:]
