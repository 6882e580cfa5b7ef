"""The library stands without its training-data subpackage."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).parent.parent


def test_entry_and_other_tests_load_without_the_subpackage(tmp_path):
    left_out = shutil.ignore_patterns("llm", ".git", "__pycache__", ".pytest_cache")
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=left_out)
    script = "import __spark_entry__ as e; print(len(e.queries()), 'pipeline' in e.queries())"
    run = subprocess.run([sys.executable, "-c", script], cwd=copy, capture_output=True, text=True)
    assert run.returncode == 0, run.stderr
    count, pipeline = run.stdout.split()[-2:]
    assert int(count) >= 65 and pipeline == "False"
    command = [sys.executable, "-m", "pytest", "tests", "-q", "--collect-only", "-p", "no:cacheprovider"]
    collected = subprocess.run(command, cwd=copy, capture_output=True, text=True)
    assert collected.returncode == 0, collected.stdout + collected.stderr
