"""The entry file without the corpus operators: everything else stays registered."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def registered(folder):
    code = "import __spark_entry__ as e, json; print(json.dumps([sorted(e.queries()), sorted(e.oracle_sql())]))"
    done = subprocess.run([sys.executable, "-c", code], cwd=folder, capture_output=True, text=True, timeout=300, check=True)
    import json

    return json.loads(done.stdout.strip().splitlines()[-1])


def test_import_without_corpus_operators(tmp_path):
    from tallyreel import catalog

    skip = shutil.ignore_patterns("llm", "__pycache__", ".git", "spark-warehouse")
    shutil.copytree(ROOT, tmp_path / "bare", ignore=skip)
    queries, sql = registered(tmp_path / "bare")
    assert queries == sorted(catalog.PLANS) == sql
    (tmp_path / "bare" / "corpus_pipeline.py").unlink()
    assert registered(tmp_path / "bare") == [queries, sql]
