"""Python workers find the package wherever the driver starts: a fresh process in another folder."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
RUN = """
import sys
sys.path.insert(0, {repo!r})
import __spark_entry__ as entry
from pairsignal.session import local_session
spark = local_session(4, memory="3g", app="elsewhere")
for name in {names!r}:
    assert entry.queries()[name](spark, "/root/testdata/sf0.001").count() > 0, name
print("all ran")
"""


def test_queries_run_from_another_folder(tmp_path):
    names = ["op8_embedding_dedup", "op6_nra_top_k", "op10_packing", "op11_conversation_repair",
             "op12_importance_resample", "op13_run_length_index", "op1_toxicity"]
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    if path := os.environ.get("PYTHONPATH"):  # all of it but the repository
        env["PYTHONPATH"] = os.pathsep.join(p for p in path.split(os.pathsep) if os.path.abspath(p) != REPO)
    found = subprocess.run([sys.executable, "-c", RUN.format(repo=REPO, names=names)], cwd=tmp_path, env=env,
                           capture_output=True, text=True, timeout=900)
    assert "all ran" in found.stdout, found.stderr[-3000:]
