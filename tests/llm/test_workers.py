"""Operators on workers that do not have this package: a session whose tasks start in another folder."""

import os
import subprocess
import sys

ROOT = os.path.join(os.path.dirname(os.path.abspath(__file__)), "..", "..")
SCRIPT = """
import sys
root, folder = sys.argv[1:]
sys.path.insert(0, root)
from logsense.llm.queries import QUERIES
from logsense.session import local_session
spark = local_session(2)
rows = [(k, " ".join(f"word{j % (k + 7)}" for j in range(80 + k)), "en", f"s{k % 2}", 1) for k in range(30)]
spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(2).write.parquet(folder + "/documents.parquet")
spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").coalesce(1).write.parquet(folder + "/labels.parquet")
spark.createDataFrame([(1, rows[3][1])], "item_id long, text string").write.parquet(folder + "/benchmark.parquet")
found = {name: len(query(spark, folder).collect()) for name, query in QUERIES.items()}
print("ROWS", {k.split("_")[0]: n for k, n in found.items()})
"""


def test_every_operator_runs_without_the_package_on_workers(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    if "PYTHONPATH" in os.environ:
        keep = [p for p in os.environ["PYTHONPATH"].split(":") if os.path.abspath(p or ".") != os.path.abspath(ROOT)]
        env["PYTHONPATH"] = ":".join(keep)
    run = subprocess.run([sys.executable, "-c", SCRIPT, ROOT, str(tmp_path)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert run.returncode == 0, run.stderr[-3000:]
    rows = eval(run.stdout.split("ROWS", 1)[1])
    full = {"op1", "op4", "op5", "op7", "op8", "op9", "op10", "op11", "op12"}
    assert {k: rows[k] for k in full} == dict.fromkeys(full, 30) and rows["op13"] == 1200
