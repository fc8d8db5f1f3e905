"""The entry module without the libraries of the operators on training data."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_a_missing_library_costs_only_its_queries():
    code = (
        "import sys; sys.modules.update({'tiktoken': None, 'public_tokenizers': None}); import __spark_entry__ as e; "
        "names = set(e.queries()); assert len(names) > 100 and 'clean_text' in names; "
        "assert not [n for n in names if n.startswith('op') and n[2].isdigit()] and 'pipeline' not in names; "
        "assert set(e.oracle_sql()) <= names"
    )
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr[-800:]
    assert "no queries on training data" in done.stderr
