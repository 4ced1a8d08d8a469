"""The entry module without the training-data operators, or without one of their libraries."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).parents[1]


@pytest.mark.parametrize("missing", ["reviewloom.llm", "corpus_pipeline", "regex", "tokenizers", "public_tokenizers"])
def test_other_queries_stay(missing):
    code = f"import sys; sys.modules[{missing!r}] = None; import __spark_entry__ as e; print(len(e.queries()), 'prepare_reviews' in e.oracle_sql())"
    said = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    n, kept = said.stdout.split()[-2:]
    assert int(n) >= 60 and kept == "True"
