"""The registered queries without the optional part, or without a package that only it needs."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent

BLOCKED = """
import sys
sys.path.insert(0, {root!r})

class Blocked:
    def find_spec(self, name, path=None, target=None):
        if name == {name!r} or name.startswith({name!r} + "."):
            raise ModuleNotFoundError("blocked " + name, name=name)

sys.meta_path.insert(0, Blocked())
import __spark_entry__ as entry
from docsift.plans import queries
assert set(entry.queries()) == set(queries.QUERIES) and set(entry.oracle_sql()) == set(queries.ORACLES), sorted(entry.queries())
assert len(entry.queries()) >= 57
"""


@pytest.mark.parametrize("name", ["docsift.llm", "corpus_pipeline", "public_tokenizers", "zstandard"])
def test_library_without(name):
    done = subprocess.run([sys.executable, "-W", "ignore", "-c", BLOCKED.format(root=str(ROOT), name=name)], capture_output=True, text=True)
    assert done.returncode == 0, done.stderr[-2000:]
