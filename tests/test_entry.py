"""The contract file without the corpus operators, and without what they need."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
BLOCK = """
import sys
class Block:
    def find_spec(self, name, path=None, target=None):
        if name == {name!r} or name.startswith({name!r} + "."):
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Block())
import __spark_entry__ as e
q, o = e.queries(), e.oracle_sql()
print(len(q), sum(n.startswith("op") and n[2].isdigit() for n in q), "pipeline" in q, set(o) <= set(q))
"""


def registered(name):
    done = subprocess.run([sys.executable, "-c", BLOCK.format(name=name)], cwd=ROOT, capture_output=True, text=True, timeout=120)
    return done.returncode, done.stdout.split(), done.stderr


@pytest.mark.parametrize("name", ["ahocorasick", "cohortflow.llm"])
def test_core_queries_stay(name):
    code, found, error = registered(name)
    assert code == 0, error
    assert int(found[0]) >= 90 and found[1:] == ["0", "False", "True"]


def test_a_missing_module_of_the_library_is_an_error():
    code, _, error = registered("cohortflow.operators.ranking")
    assert code != 0 and "cohortflow.operators.ranking" in error
