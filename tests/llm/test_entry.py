"""Registration of the queries."""

import subprocess
import sys

import __spark_entry__ as entry


def test_all_queries_are_registered():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries() and set(entry.oracle_sql()) <= set(entry.queries())


def test_rest_works_without_the_subpackage():
    code = """
import sys
sys.modules["corpus_pipeline"] = None
for name in [n for n in sys.modules if n.startswith("stocktide.llm")]: del sys.modules[name]
class Away:
    def find_spec(self, name, path=None, target=None):
        if name.startswith("stocktide.llm"): raise ModuleNotFoundError(f"No module named {name!r}", name="stocktide.llm")
sys.meta_path.insert(0, Away())
import __spark_entry__ as e
assert not [n for n in e.queries() if n.startswith("op")] and "j1_weekly_demand" in e.queries()
"""
    subprocess.run([sys.executable, "-c", code], check=True, cwd=entry.os.path.dirname(entry.__file__))
