"""The entry points without the packages that may be absent."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent


@pytest.mark.parametrize("left", [(), ("corpus_pipeline.py",)], ids=["both gone", "pipeline left"])
def test_entry_works_without_the_training_data_package(tmp_path, left):
    shutil.copytree(ROOT / "stagemart", tmp_path / "stagemart", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", *(name for name in left if (ROOT / name).exists())):
        shutil.copy(ROOT / name, tmp_path)
    code = "import __spark_entry__ as e; from stagemart.queries import QUERIES; print(e.queries().keys() == QUERIES.keys() == e.oracle_sql().keys())"
    said = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert said.stdout.strip() == "True", said.stderr
