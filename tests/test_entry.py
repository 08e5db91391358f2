"""The driver contract holds with and without the removable training-data folders."""

import subprocess
import sys

import pytest

CODE = """
import sys
for name in {missing!r}:
    sys.modules[name] = None          # as if the folder were deleted
import __spark_entry__ as e
names = set(e.queries())
assert set(e.oracle_sql()) <= names and "rfm_ntile" in names
print(sum(n.startswith("op") or n == "pipeline" for n in names if n != "orphans"))
"""


@pytest.mark.parametrize("missing", [["corpus_pipeline", "basketry.llm"], ["basketry.llm"], ["corpus_pipeline"]])
def test_entry_without_the_folders(missing):
    out = subprocess.run([sys.executable, "-c", CODE.format(missing=missing)], capture_output=True, text=True,
                         cwd=__file__.rsplit("/tests/", 1)[0])
    assert out.returncode == 0, out.stderr
    assert out.stdout.strip().splitlines()[-1] == "0"
