"""The entry module without the corpus operators, or without what they need: the table queries stay."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]

BLOCKED = """
import sys
class Missing:
    def find_spec(self, name, path=None, target=None):
        if name == {name!r} or name.startswith({name!r} + "."):
            raise ModuleNotFoundError("No module named " + repr(name), name=name)
sys.meta_path.insert(0, Missing())
import __spark_entry__ as e
from tablework.plans.registry import ANSWERS, QUERIES
print(len(e.queries()) == len(QUERIES), len(e.oracle_sql()) == len(ANSWERS), len(QUERIES) > 80)
"""


def _names(missing):
    code = BLOCKED.format(name=missing)
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    return out.stdout.split()


def test_table_queries_stay_without_the_corpus_operators():
    for missing in ("tablework.llm", "corpus_pipeline", "public_tokenizers", "regex"):
        assert _names(missing) == ["True", "True", "True"], missing
