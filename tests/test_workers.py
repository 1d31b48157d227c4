"""Tasks run where the package cannot be imported, as on executors without a copy of it."""

import os
import subprocess
import sys

ROOT = os.path.abspath(os.path.join(os.path.dirname(__file__), ".."))

SCRIPT = f"""
import sys
sys.path.insert(0, {ROOT!r})
from riskframe.session import local_session
import __spark_entry__ as e
spark = local_session(2, "elsewhere")
for name in ("exp3_tree_phi_adds_up", "res1_smote", "sta1_p_value"):
    assert e.queries()[name](spark, {{sf!r}}).count() > 0, name
print("done")
"""


def test_tasks_do_not_import_the_package(tmp_path, sf):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    script = tmp_path / "run.py"
    script.write_text(SCRIPT.replace("{sf!r}", repr(sf)))
    out = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert out.stdout.strip().endswith("done"), out.stderr[-2000:]
