"""The library without its optional part: on a copy that lacks the training-data folders."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
CODE = """
import __spark_entry__ as entry
names = set(entry.queries())
assert len(names) > 80 and set(entry.oracle_sql()) <= names
assert not any(n.startswith("op") or n == "pipeline" for n in names), names
import tests.test_oracles, tests.test_plans, bench
"""


@pytest.mark.parametrize("pipeline_too", [False, True])
def test_entry_without_the_training_data_part(tmp_path, pipeline_too):
    def skipped(folder, names):
        gone = {"__pycache__", ".git", ".pytest_cache"}
        gone |= {"llm"} if Path(folder).name in ("affinia", "tests") else set()
        return gone | ({"corpus_pipeline.py"} if pipeline_too else set())

    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=skipped)
    assert not (copy / "affinia/llm").exists() and (copy / "corpus_pipeline.py").exists() != pipeline_too
    done = subprocess.run([sys.executable, "-c", CODE], cwd=copy, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
