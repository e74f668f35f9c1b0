"""The entry module with and without the optional subpackage."""

import subprocess
import sys

from tests.conftest import ROOT

WITHOUT = """
import sys
class Missing:
    def find_spec(self, name, path=None, target=None):
        if name == "corpus_pipeline" or name.startswith("gleanspark.llm"):
            raise ModuleNotFoundError("No module named " + name, name=name)
sys.meta_path.insert(0, Missing())
import __spark_entry__ as E
q, o = E.queries(), E.oracle_sql()
assert len(q) > 80 and set(o) <= set(q), (len(q), set(o) - set(q))
assert not any(n.startswith("op") and n[2:3].isdigit() for n in q) and "pipeline" not in q
print("fine")
"""


def test_entry_without_the_subpackage():
    got = subprocess.run([sys.executable, "-c", WITHOUT], cwd=ROOT, capture_output=True, text=True, timeout=300)
    assert got.stdout.strip().endswith("fine"), got.stderr[-2000:]


def test_oracles_belong_to_queries():
    import __spark_entry__ as E
    assert set(E.oracle_sql()) <= set(E.queries())
