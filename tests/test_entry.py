"""The optional part may be missing, its faults may not."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
BLOCK = """
import sys
class Block:
    def find_spec(self, name, path=None, target=None):
        if name == {name!r} or name.startswith({name!r} + "."):
            raise ModuleNotFoundError(name, name={name!r})
sys.meta_path.insert(0, Block())
import __spark_entry__ as e
print(len(e.queries()), len(e.oracle_sql()))
"""


@pytest.mark.parametrize("name", ["tillroll.llm", "corpus_pipeline", "public_tokenizers", "ahocorasick"])
def test_the_rest_registers_without_the_optional_part(name):
    done = subprocess.run(
        [sys.executable, "-c", BLOCK.format(name=name)], cwd=ROOT, capture_output=True, text=True, timeout=120
    )
    assert done.returncode == 0, done.stderr
    queries, sql = map(int, done.stdout.split())
    assert queries == sql > 60


def test_a_fault_of_the_optional_part_is_not_hidden():
    done = subprocess.run(
        [sys.executable, "-c", BLOCK.format(name="numpy.linalg")], cwd=ROOT, capture_output=True, text=True, timeout=120
    )
    assert done.returncode != 0
