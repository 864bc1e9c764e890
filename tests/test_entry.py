"""The entry module without the text operators."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
BLOCKED = """
import sys
class Blocker:
    def find_spec(self, name, path=None, target=None):
        if name in {names!r}:
            raise ModuleNotFoundError(name)
sys.meta_path.insert(0, Blocker())
import __spark_entry__ as entry
names = entry.queries()
assert set(entry.oracle_sql()) <= set(names)
print(len(names), sum(n.startswith("op") and n[2].isdigit() for n in names), "pipeline" in names)
"""


def registered(*names):
    done = subprocess.run([sys.executable, "-c", BLOCKED.format(names=names)], cwd=ROOT, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    n, n_text, pipeline = done.stdout.split()
    return int(n), int(n_text), pipeline == "True"


def test_other_queries_stay_when_the_text_operators_cannot_be_imported():
    n, n_text, pipeline = registered("ahocorasick")
    assert n >= 97 and n_text == 0 and not pipeline
    assert registered("subpulse.llm", "corpus_pipeline") == (n, 0, False)


def test_text_operators_stay_without_the_pipeline():
    n, n_text, pipeline = registered("corpus_pipeline")
    without, _, _ = registered("subpulse.llm")
    assert n == without + n_text and not pipeline
