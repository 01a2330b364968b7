"""The entry without the training-data subpackage."""

import os
import shutil
import subprocess
import sys

from conftest import ROOT


def test_entry_imports_without_the_llm_folders(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", "llm"))
    for with_pipeline in (True, False):
        if not with_pipeline and (copy / "corpus_pipeline.py").exists():
            os.remove(copy / "corpus_pipeline.py")
        said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(*sorted(e.queries()))"], cwd=copy,
                              capture_output=True, text=True, check=True, env={**os.environ, "PYTHONPATH": str(copy)})
        names = said.stdout.split()
        assert "rules_positive_top" in names and "pipeline" not in names and not any(n.startswith("op") for n in names)
