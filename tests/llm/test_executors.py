"""Executors need no copy of the package: workers that can't import it run the queries."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from sensorloom.session import spark_session
spark = spark_session("bare", spark__master="local[4]", spark__sql__shuffle__partitions="4",
                      spark__checkpoint__dir={folder!r}, spark__ui__showConsoleProgress="false")

def known(batches):
    import importlib.util
    import pyarrow
    for _ in batches:
        yield pyarrow.RecordBatch.from_pydict({{"known": [importlib.util.find_spec("sensorloom") is not None]}})

assert not any(r.known for r in spark.range(1).mapInArrow(known, "known boolean").collect())
from sensorloom.llm.queries import QUERIES
for name in {names!r}:
    print(name, QUERIES[name](spark, "/root/testdata/sf0.001").count())
"""


def test_workers_without_the_package(tmp_path):
    names = ["op1_line_dedup", "op2_quality_fm", "op3_token_counts", "op6_cube_mix", "op7_near_dedup", "op8_perplexity_rules", "op9_passages"]
    names += ["op11_ranked_search", "op12_html_text", "op13_spelling_variants"]
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    script = SCRIPT.format(root=ROOT, folder=str(tmp_path / "scratch"), names=names)
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-3000:]
    assert [line.split()[0] for line in done.stdout.splitlines() if line.startswith("op")] == names
