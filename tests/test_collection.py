"""Every test module is collected, and the query twins are among them, with and without the optional subpackage."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

from tradewind.queries import QUERIES

ROOT = Path(__file__).resolve().parent.parent
OPTIONAL = ("tradewind/llm", "tests/llm", "corpus_pipeline.py")


@pytest.mark.parametrize("optional", [True, False])
def test_all_modules_are_collected(tmp_path, optional):
    for name in ("tradewind", "oracle", "tests", "__spark_entry__.py", "corpus_pipeline.py"):
        source = ROOT / name
        if source.is_dir():
            skip = shutil.ignore_patterns("__pycache__", *(() if optional else ("llm",)))
            shutil.copytree(source, tmp_path / name, ignore=skip)
        elif source.exists() and (optional or name not in OPTIONAL):
            shutil.copy(source, tmp_path / name)
    run = subprocess.run(
        [sys.executable, "-m", "pytest", "tests", "--collect-only", "-q", "-p", "no:cacheprovider"], cwd=tmp_path, capture_output=True, text=True, timeout=300
    )
    assert run.returncode == 0, run.stdout[-2000:]
    assert sum("tests/test_queries.py::test_query[" in line for line in run.stdout.splitlines()) == len(QUERIES)
    assert ("tests/llm/" in run.stdout) == (optional and (ROOT / "tests/llm").exists())
