"""The driver contract, also where the training-data operators are left out."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
TOLD = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), 'pipeline' in e.queries(), 'op1_simhash' in e.queries())"


def told(folder):
    run = subprocess.run([sys.executable, "-c", TOLD], cwd=folder, capture_output=True, text=True,
                         env={**os.environ, "PYTHONPATH": folder})
    assert run.returncode == 0, run.stderr
    return run.stdout.split()


@pytest.mark.parametrize("with_pipeline", [True, False])
def test_entry_without_training_data_operators(fresh_dir, with_pipeline):
    """A copy without the operators' folders, with and without the pipeline's file."""
    copy = f"{fresh_dir}/copy"
    left_out = {"llm", ".git", "__pycache__"} | (set() if with_pipeline else {"corpus_pipeline.py"})
    shutil.copytree(ROOT, copy, ignore=lambda folder, names: left_out & set(names))
    from checks.oracle import ORACLE
    from checks.queries import QUERIES

    assert told(copy) == [str(len(QUERIES)), str(len(ORACLE)), "False", "False"]
