"""The entry point with and without what its optional queries need."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent
CODE = """
import sys
sys.path.insert(0, {root!r})
{before}
import __spark_entry__ as e
print(len(e.queries()), len(e.oracle_sql()))
"""


def counts(before):
    out = subprocess.run([sys.executable, "-c", CODE.format(root=str(ROOT), before=before)], capture_output=True, text=True, check=True)
    return tuple(map(int, out.stdout.split()[-2:]))


def test_missing_packages_take_their_own_queries_only():
    every, without = counts(""), counts("sys.modules['sentencepiece'] = sys.modules['public_tokenizers'] = None")
    assert without[0] <= every[0] and without[0] >= without[1] > 140
