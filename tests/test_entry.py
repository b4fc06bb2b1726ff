"""The entry file with and without the optional part."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

from callweave.catalog import QUERIES

ROOT = Path(__file__).resolve().parent.parent


@pytest.mark.parametrize("pipeline", [True, False])
def test_the_rest_loads_without_the_optional_folders(tmp_path, pipeline):
    left_out = shutil.ignore_patterns("llm", ".git", "__pycache__", *[] if pipeline else ["corpus_pipeline.py"])
    shutil.copytree(ROOT, tmp_path / "copy", ignore=left_out)
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    got = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "copy", capture_output=True,
                         text=True, timeout=120)
    assert got.stdout.split() == [str(len(QUERIES))] * 2, got.stderr[-500:]
