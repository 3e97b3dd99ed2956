"""The rest of the library works without the training-data subpackage."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
ASK = "import __spark_entry__ as e; q = e.queries(); s = e.oracle_sql(); assert set(s) <= set(q); print(len(q), sum(k.startswith('op') or k == 'pipeline' for k in q))"


@pytest.mark.parametrize("pipeline", [True, False])
def test_without_the_subpackage(tmp_path, pipeline):
    """With the folders deleted, and with the pipeline's file left or deleted too."""
    skip = shutil.ignore_patterns("llm", "__pycache__", ".git", *([] if pipeline else ["corpus_pipeline.py"]))
    for name in ("skyledger", "tests"):
        shutil.copytree(ROOT / name, tmp_path / name, ignore=skip)
    for f in ROOT.glob("*.py"):
        if pipeline or f.name != "corpus_pipeline.py":
            shutil.copy(f, tmp_path)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", ASK], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    n, llm = map(int, done.stdout.split())
    assert n > 30 and llm == 0
    (tmp_path / "skyledger/llm/__pycache__").mkdir(parents=True)
    assert subprocess.run([sys.executable, "-c", ASK], cwd=tmp_path, env=env, capture_output=True, text=True).returncode == 0
