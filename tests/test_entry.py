"""The registry without its optional parts."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
LIST = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), 'pipeline' in e.queries(), any(n.startswith('op1_') for n in e.queries()))"


@pytest.mark.parametrize("gone", [["tickloom/llm"], ["corpus_pipeline.py"], ["tickloom/llm", "corpus_pipeline.py"]])
def test_engine_queries_do_not_need_the_optional_parts(tmp_path, gone):
    from tickloom.plans import queries

    shutil.copytree(ROOT / "tickloom", tmp_path / "tickloom", ignore=shutil.ignore_patterns("__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if (ROOT / name).exists():
            shutil.copy(ROOT / name, tmp_path)
    for name in gone:
        path = tmp_path / name
        shutil.rmtree(path) if path.is_dir() else path.unlink(missing_ok=True)
    out = subprocess.run([sys.executable, "-c", LIST], cwd=tmp_path, capture_output=True, text=True, check=True, timeout=120).stdout.split()
    here = (ROOT / "tickloom" / "llm").is_dir() and "tickloom/llm" not in gone
    assert int(out[0]) >= len(queries.QUERIES) and int(out[1]) >= len(queries.ORACLE_SQL)
    assert out[2:] == [str(here and "corpus_pipeline.py" not in gone), str(here)]
