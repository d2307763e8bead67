"""The entry gives the core's queries whatever becomes of the optional subpackage."""

import subprocess
import sys
from pathlib import Path

from millrace.plans import catalogue

ROOT = str(Path(__file__).parent.parent)


def names(*before):
    code = "; ".join(["import sys", *before, "import __spark_entry__ as e", "print(len(e.queries()), len(e.oracle_sql()), sum(n in e.queries() for n in ('q_tasks', 'p3_found')))"])
    return [int(x) for x in subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True).stdout.split()]


def test_core_queries_without_a_package_of_the_subpackage():
    want = [len(catalogue.queries()), len(catalogue.oracle_sql()), 2]
    for gone in ("zstandard", "xxhash", "millrace.llm"):
        assert names(f"sys.modules['{gone}'] = None") == want
