"""The entry file without the training-data subpackage or a library it needs."""

import subprocess
import sys

import pytest

from tests.conftest import ROOT

BLOCKED = """
import sys
sys.modules[{name!r}] = None
import __spark_entry__ as e
print(len(e.queries()), len(e.oracle_sql()), any(k.startswith("op") for k in e.queries()))
"""


@pytest.mark.parametrize("name", ["ahocorasick", "assay.llm", "corpus_pipeline"])
def test_core_queries_without_the_subpackage(name):
    out = subprocess.run([sys.executable, "-c", BLOCKED.format(name=name)], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    queries, oracles, training = out.stdout.split()
    assert int(queries) >= 72 and int(oracles) >= 62 and training == "False"
