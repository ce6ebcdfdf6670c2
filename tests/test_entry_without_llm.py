"""The driver contract holds when the training-data operators cannot be imported."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
BLOCK = """
import sys
sys.modules[{name!r}] = None  # importing it fails
import __spark_entry__ as E
names = E.queries()
assert "mean_co2" in names and set(E.oracle_sql()) <= set(names)
print(sorted(n for n in names if n == "pipeline" or n.startswith("op")))
"""


def registered(name):
    done = subprocess.run([sys.executable, "-c", BLOCK.format(name=name)], cwd=REPO, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr
    return done.stdout.strip().splitlines()[-1]


def test_absent_subpackage_library_or_pipeline():
    absent = registered("ecoframe.llm")
    assert "op1_" not in absent and "pipeline" not in absent
    assert "op1_" not in registered("zstandard")  # a library of theirs is missing
    assert "'pipeline'" not in registered("corpus_pipeline")
