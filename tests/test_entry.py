"""The entry without the optional part, or with a broken one."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
SHOWN = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), any(n.startswith('op') for n in e.queries()))"


@pytest.mark.parametrize("left", [None, "__pycache__", "module"])
def test_other_queries_stay(tmp_path, left):
    shutil.copytree(ROOT / "lexigrid", tmp_path / "lexigrid", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    if left:
        (tmp_path / "lexigrid/llm/__pycache__").mkdir(parents=True)
        (tmp_path / "corpus_pipeline.py").write_text("import a_module_that_is_not_installed\n" if left == "module" else "")
    out = subprocess.run([sys.executable, "-c", SHOWN], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    n, twins, optional = out.stdout.split()
    assert int(n) >= 85 and int(twins) >= 76 and optional == "False", out.stderr
