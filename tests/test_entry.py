"""The library works where the folder for training data is not installed."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_without_the_folder(tmp_path):
    for name in ("__spark_entry__.py", "bench.py", "corpus_pipeline.py"):
        if os.path.exists(f"{ROOT}/{name}"):
            shutil.copy(f"{ROOT}/{name}", tmp_path)
    shutil.copytree(f"{ROOT}/lexifacet", tmp_path / "lexifacet", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = (
        "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql();"
        "assert len(q) > 100 and set(o) <= set(q) and 'pipeline' not in q and not any(k.startswith('op1') for k in q)"
    )
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": str(tmp_path)})
    assert done.returncode == 0, done.stderr
