"""Python workers must not need the package on their path: run the one
worker-side function (the motion state function) from a process whose
working folder and environment do not contain the repository."""

import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
from groundtrack.session import build_session
from groundtrack.plans.streams import motion_stream
spark = build_session("local[2]", shuffle_partitions=2)
print("ROWS", motion_stream(spark, "/root/testdata/sf0.001").count())
"""


def test_state_function_runs_without_package_on_worker_path():
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    r = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tempfile.mkdtemp(prefix="gt-cwd-"),
                       env=env, capture_output=True, text=True, timeout=600)
    assert "ROWS 995" in r.stdout, r.stderr[-3000:]
