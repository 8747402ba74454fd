"""The library without the corpus operators: it imports, lists its queries, and its tests can be collected."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_the_rest_works_without_the_corpus_operators(tmp_path):
    copy = tmp_path / "copy"
    left_out = shutil.ignore_patterns("llm", ".git", "__pycache__", ".pytest_cache", "spark-warehouse")
    shutil.copytree(ROOT, copy, ignore=left_out)
    for pipeline in (True, False):
        if not pipeline and (copy / "corpus_pipeline.py").exists():
            os.remove(copy / "corpus_pipeline.py")
        said = subprocess.run(
            [sys.executable, "-c", "import __spark_entry__ as e; q = e.queries(); print(len(q), any(n[:2] == 'op' or n == 'pipeline' for n in q), set(e.oracle_sql()) <= set(q))"],
            cwd=copy, capture_output=True, text=True, env=os.environ | {"PYTHONPATH": ""}, timeout=120,
        )
        count, corpus, known = said.stdout.split()
        assert int(count) > 100 and (corpus, known) == ("False", "True"), said.stderr
    said = subprocess.run([sys.executable, "-m", "pytest", "--collect-only", "-q", "-p", "no:cacheprovider", "tests"], cwd=copy, capture_output=True, text=True, timeout=300)
    assert said.returncode == 0, said.stdout[-2000:]
