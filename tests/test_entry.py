"""The driver's entry points with and without the corpus operators."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_entry_without_the_corpus_operators(tmp_path):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "__pycache__"))
    said = "import __spark_entry__ as e; q = e.queries(); assert 'pairs_same_key' in q and 'pipeline' not in q and set(e.oracle_sql()) <= set(q)"
    for pipeline in (True, False):
        if not pipeline:
            (copy / "corpus_pipeline.py").unlink(missing_ok=True)
        subprocess.run([sys.executable, "-c", said], cwd=copy, check=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(copy)})
