"""The library without its optional parts: a copy that lacks them imports, with all other queries."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

from tillroll.catalog import QUERIES

REPO = Path(__file__).resolve().parents[1]
PARTS = {"folder": "tillroll/llm", "pipeline": "corpus_pipeline.py"}
SAY = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), 'pipeline' in e.queries())"


def said(folder: Path) -> list[str]:
    run = subprocess.run([sys.executable, "-c", SAY], cwd=folder, capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr[-2000:]
    return run.stdout.split()


@pytest.mark.parametrize("gone", [("folder",), ("pipeline",), ("folder", "pipeline")], ids="+".join)
def test_a_copy_without_optional_parts_imports(tmp_path, gone):
    away = {Path(PARTS[part]).name for part in gone}
    for name in ("tillroll", "corpus_pipeline.py", "oracle.py", "__spark_entry__.py"):
        source = REPO / name
        if name in away or not source.exists():
            continue
        if source.is_dir():
            shutil.copytree(source, tmp_path / name, ignore=shutil.ignore_patterns("__pycache__", *away))
        else:
            shutil.copy(source, tmp_path / name)
    assert said(tmp_path) == [str(len(QUERIES)), str(len(QUERIES)), "False"]
