"""The entry point without the optional subpackage, or without a library that it needs."""

import subprocess
import sys

import pytest

from crawlcorpus.plans.catalog import QUERIES

SCRIPT = """
import sys, warnings
warnings.simplefilter("ignore")
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name == {gone!r}:
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as entry
print(len(entry.queries()), len(entry.oracle_sql()))
"""


@pytest.mark.parametrize("gone", ["crawlcorpus.llm", "corpus_pipeline", "public_tokenizers", "regex"])
def test_core_queries_stay(gone):
    done = subprocess.run([sys.executable, "-c", SCRIPT.format(gone=gone)], capture_output=True, text=True, check=True,
                          cwd=__file__.rsplit("/", 2)[0])
    assert done.stdout.split() == [str(len(QUERIES))] * 2
