"""The core neither imports nor needs the text subpackage."""

import os
import pathlib
import re
import shutil
import subprocess
import sys

ROOT = pathlib.Path(__file__).resolve().parent.parent


def test_core_does_not_import_llm():
    for path in (ROOT / "sheafwork").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT).parts:
            assert not re.search(r"^\s*(?:from|import)\s+sheafwork\.llm", path.read_text(), re.M), path


def test_rest_works_without_llm(tmp_path):
    """A copy without the subpackage and its tests imports, and lists its queries."""
    copy = tmp_path / "repo"
    shutil.copytree(ROOT / "sheafwork", copy / "sheafwork", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", copy)
    code = "import __spark_entry__ as e, sheafwork.run, sheafwork.sql, sheafwork.streaming.files; q = e.queries(); assert 'p2_found' in q and 'p1_found' not in q and set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=copy, check=True, env={**os.environ, "PYTHONPATH": str(copy)})
