"""The entry point where the training operators are gone."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
ASK = "import __spark_entry__ as e; print(*e.queries()); print(*e.oracle_sql())"


@pytest.mark.parametrize("left", [(), ("corpus_pipeline.py",)])
def test_the_rest_works_alone(tmp_path, left):
    for name in ("__spark_entry__.py", *left):
        if (ROOT / name).exists():
            shutil.copy(ROOT / name, tmp_path)
    shutil.copytree(ROOT / "tallywork", tmp_path / "tallywork", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    said = subprocess.run([sys.executable, "-B", "-c", ASK], cwd=tmp_path, capture_output=True, text=True, check=True)
    queries, sql = (set(line.split()) for line in said.stdout.splitlines())
    assert "usage_cube" in queries and queries == sql
    assert not {name for name in queries if name.startswith("op") and name[2].isdigit()} and "pipeline" not in queries
