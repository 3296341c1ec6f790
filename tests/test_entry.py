"""The driver contract with and without the optional corpus part."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
LIST = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), sum(k.startswith('op') for k in e.queries()))"


def listed(folder) -> list[int]:
    out = subprocess.run([sys.executable, "-c", LIST], cwd=folder, capture_output=True, text=True, check=True)
    return list(map(int, out.stdout.split()))


def test_the_rest_works_without_the_corpus_part(tmp_path):
    gone = shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "__pycache__", "spark-warehouse")
    shutil.copytree(ROOT, tmp_path / "copy", ignore=gone)
    n, sql, corpus = listed(tmp_path / "copy")
    assert n == sql >= 103 and corpus == 0


def test_nothing_else_imports_the_corpus_part():
    outside = [p for p in (ROOT / "footfall").rglob("*.py") if "llm" not in p.parts]
    assert outside and not any("llm" in p.read_text() for p in outside)
