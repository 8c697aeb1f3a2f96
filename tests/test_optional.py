"""The library and its driver entry work without the optional training-data package."""

import os
import shutil
import subprocess
import sys

from conftest import ROOT


def test_entry_imports_without_the_optional_package(tmp_path):
    shutil.copytree(os.path.join(ROOT, "wideflow"), tmp_path / "wideflow", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 60 and set(e.oracle_sql()) == set(q); print(len(q))"
    got = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True,
                         env={**os.environ, "PYTHONPATH": str(tmp_path)}, timeout=120)
    assert got.returncode == 0, got.stderr


def test_other_import_errors_are_not_hidden(tmp_path):
    shutil.copytree(os.path.join(ROOT, "wideflow"), tmp_path / "wideflow", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    (tmp_path / "corpus_pipeline.py").write_text("import no_such_module_at_all\n")
    got = subprocess.run([sys.executable, "-c", "import __spark_entry__"], cwd=tmp_path, capture_output=True, text=True,
                         env={**os.environ, "PYTHONPATH": str(tmp_path)}, timeout=120)
    assert got.returncode != 0 and "no_such_module_at_all" in got.stderr
