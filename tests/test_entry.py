"""The entry module without its optional parts, in a copy of the tree."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
COUNT = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), 'pipeline' in e.queries())"


def copied(tmp_path, *without):
    for name in ("tarn", "catalogue", "tests"):
        shutil.copytree(ROOT / name, tmp_path / name, ignore=shutil.ignore_patterns("__pycache__", *without))
    for name in ("__spark_entry__.py", "bench.py", "corpus_pipeline.py"):
        if name not in without:
            shutil.copy(ROOT / name, tmp_path / name)
    done = subprocess.run([sys.executable, "-c", COUNT], cwd=tmp_path, capture_output=True, text=True, check=False)
    assert done.returncode == 0, done.stderr
    return done.stdout.split()


@pytest.mark.parametrize("without", [("llm",), ("llm", "corpus_pipeline.py")])
def test_without_the_corpus_operators(tmp_path, without):
    from catalogue.jobs import JOBS
    from catalogue.oracles import ORACLES

    assert copied(tmp_path, *without) == [str(len(JOBS)), str(len(ORACLES)), "False"]


def test_without_the_pipeline(tmp_path):
    if not (ROOT / "tarn" / "llm").exists():
        pytest.skip("no corpus operators here")
    assert copied(tmp_path, "corpus_pipeline.py")[2] == "False"
