"""The entry points with and without the training-data operators."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

from parcelog.queries import QUERIES, SQL

ROOT = Path(__file__).resolve().parent.parent
COUNT = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), 'pipeline' in e.queries())"


@pytest.mark.parametrize("gone", [("parcelog/llm", "tests/llm", "corpus_pipeline.py"), ("parcelog/llm", "tests/llm"), ("corpus_pipeline.py",)])
def test_core_queries_stay_without_the_training_data_operators(tmp_path, gone):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", ".*"))
    for name in gone:
        path = copy / name
        if path.is_dir():
            shutil.rmtree(path)
        elif path.exists():
            path.unlink()
    said = subprocess.run([sys.executable, "-c", COUNT], cwd=copy, env={"PYTHONPATH": str(copy), "PATH": ""}, capture_output=True, text=True, timeout=120)
    assert said.stdout.split() == [str(len(QUERIES)), str(len(SQL)), "False"], said.stderr
