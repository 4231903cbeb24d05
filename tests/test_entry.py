"""The library without its training-data part: it still imports and registers everything else."""

import os
import shutil
import subprocess
import sys

import pytest

from coursewise.plans import registry

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("left_out", [("llm",), ("llm", "corpus_pipeline.py")])
def test_entry_without_the_training_data_part(tmp_path, left_out):
    skip = shutil.ignore_patterns(*left_out, ".git", "__pycache__", ".pytest_cache", "spark-warehouse")
    copy = shutil.copytree(ROOT, tmp_path / "copy", ignore=skip)
    code = "import __spark_entry__ as e; print('NAMES', *sorted(e.queries())); print('SQL', *sorted(e.oracle_sql()))"
    env = os.environ | {"PYTHONPATH": str(copy)}
    said = subprocess.run([sys.executable, "-c", code], cwd=copy, env=env, capture_output=True, text=True, check=True).stdout
    names, sql = (set(line.split()[1:]) for line in said.splitlines() if line.startswith(("NAMES", "SQL")))
    assert names == set(registry.QUERIES) and sql == set(registry.ORACLES)
