import subprocess
import sys
from pathlib import Path

SCRIPT = """
import sys

class Absent:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[:2] == ["cartograin", "llm"] or name == "corpus_pipeline":
            raise ModuleNotFoundError(name)

sys.meta_path.insert(0, Absent())
import __spark_entry__ as entry

assert len(entry.queries()) > 150 and set(entry.oracle_sql()) <= set(entry.queries())
assert not [n for n in entry.queries() if n.startswith("op") or n == "pipeline"]
"""


def test_entry_point_without_the_corpus_operators():
    done = subprocess.run([sys.executable, "-c", SCRIPT], cwd=Path(__file__).resolve().parents[1], capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
