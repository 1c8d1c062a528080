"""Python parts of operators run on executors without an installed copy of the package."""

import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
import __spark_entry__ as E
from statsweep.session import local_session
spark = local_session(2, 4)
n = E.queries()["fire_triggers"](spark, "/root/testdata/sf0.001").count()
print("ROWS", n)
"""


def test_pandas_operator_from_another_directory():
    with tempfile.TemporaryDirectory() as d:
        r = subprocess.run([sys.executable, "-c", SCRIPT], cwd=d, capture_output=True, text=True, timeout=600,
                           env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    assert "ROWS" in r.stdout, r.stderr[-2000:]
