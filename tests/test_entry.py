"""The driver's entry with and without the corpus operators."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
NAMES = "import __spark_entry__ as e; q = e.queries(); print(len(q), 'rollup_hour' in q, 'pipeline' in q)"


def names_found(folder, code=NAMES):
    env = {**os.environ, "PYTHONPATH": os.pathsep.join(p for p in sys.path if p and p != ROOT)}
    done = subprocess.run([sys.executable, "-c", code], cwd=folder, env=env, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    return done.stdout.split()


@pytest.mark.parametrize("left_out", [("rollmill/llm", "tests/llm"), ("rollmill/llm", "tests/llm", "corpus_pipeline.py")])
def test_entry_without_the_corpus_operators(tmp_path, left_out):
    copy = tmp_path / "copy"
    gone = {os.path.join(ROOT, name) for name in left_out}
    skip = {".git", "__pycache__", ".pytest_cache"}
    shutil.copytree(
        ROOT, copy, ignore=lambda d, names: [n for n in names if n in skip or os.path.join(d, n) in gone]
    )
    count, rollup, pipeline = names_found(copy)
    assert int(count) > 50 and rollup == "True" and pipeline == "False"


@pytest.mark.skipif(not os.path.isdir(os.path.join(ROOT, "rollmill/llm")), reason="no corpus operators")
@pytest.mark.parametrize("library", ["xxhash", "public_tokenizers"])
def test_entry_without_a_library_of_the_corpus_operators(library):
    hidden = f"import sys; sys.modules['{library}'] = None; "
    count, rollup, pipeline = names_found(ROOT, hidden + NAMES)
    assert int(count) > 50 and rollup == "True" and pipeline == "False"
