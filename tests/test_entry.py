"""The driver's contract, as a process without Spark sees it."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_queries_are_read_without_a_session():
    """queries() and oracle_sql() build no Column: there may be no session yet."""
    code = "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); assert q and set(s) <= set(q); from pyspark import SparkContext; assert SparkContext._active_spark_context is None"
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-2000:]
