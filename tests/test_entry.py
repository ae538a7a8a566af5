"""The driver's entry, with and without the training-text operators."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def names(folder):
    told = subprocess.run(
        [sys.executable, "-c", "import __spark_entry__ as e\n"
         "print(*sorted(e.queries()), '|', *sorted(e.oracle_sql()))"],
        cwd=folder, capture_output=True, text=True, env=os.environ | {"PYTHONPATH": folder})
    assert told.returncode == 0, told.stderr
    queries, oracles = told.stdout.strip().splitlines()[-1].split("|")
    return queries.split(), oracles.split()


def test_every_query_has_sql_or_is_known_to_have_none():
    queries, oracles = names(ROOT)
    assert set(oracles) <= set(queries)


def test_the_rest_stands_without_the_operators_for_text(tmp_path):
    """Whichever of their parts is deleted: the folder alone, or the pipeline too."""
    whole = [q for q in names(ROOT)[0] if not q.startswith("op") and q != "pipeline"]
    for number, leave_pipeline in enumerate((True, False)):
        copy = tmp_path / str(number)
        shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "__pycache__"))
        if not leave_pipeline:
            os.remove(copy / "corpus_pipeline.py")
        queries, oracles = names(str(copy))
        assert queries == whole and len(queries) >= 104 and set(oracles) <= set(whole)
