"""The library without the corpus subpackage, its tests and its pipeline."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
CHECK = "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); assert 'overlap_join' in q and set(s) <= set(q) and not any(n == 'pipeline' or n.startswith('op') and n[2].isdigit() for n in q)"


@pytest.mark.skipif("DUPLEXA_WITHOUT_CORPUS" in os.environ, reason="this is the copy")
@pytest.mark.parametrize("pipeline", [True, False])
def test_the_rest_works_without_the_corpus_folders(tmp_path, pipeline):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", "llm", ".pytest_cache"))
    if not pipeline:
        (copy / "corpus_pipeline.py").unlink(missing_ok=True)
    assert not (copy / "duplexa/llm").exists() and not (copy / "tests/llm").exists()
    env = {**os.environ, "DUPLEXA_WITHOUT_CORPUS": "1", "PYTHONPATH": os.pathsep.join(filter(None, [str(copy), os.environ.get("PYTHONPATH")]))}
    subprocess.run([sys.executable, "-c", CHECK], cwd=copy, env=env, check=True, timeout=120)
    if not pipeline:
        # All that is there is collected. What the rest's own tests say is said beside this test; here some of them run.
        for more in (["tests", "--collect-only"], ["tests/test_scoring.py", "tests/test_overlap.py", "tests/test_sources.py", "-x"]):
            done = subprocess.run([sys.executable, "-m", "pytest", "-q", *more], cwd=copy, env=env, capture_output=True, text=True, timeout=900)
            assert done.returncode == 0, done.stdout[-3000:]
