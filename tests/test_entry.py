"""The library without its training-text part, and tables that go when their scope ends."""

import os
import shutil
import subprocess
import sys

import pytest

from telemill.session import keep, materialize, release, scratch, shared_dir

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
LIST = "import __spark_entry__ as e; print(','.join(e.queries()), len(e.oracle_sql()))"


def listed(folder):
    out = subprocess.run([sys.executable, "-c", LIST], cwd=folder, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": folder})
    assert out.returncode == 0, out.stderr
    names, n = out.stdout.split()
    return names.split(","), int(n)


@pytest.mark.parametrize("pipeline", (False, True))
def test_entry_without_training_text(tmp_path, pipeline):
    """Both folders gone, with and without the pipeline file: all other queries are still there."""
    copy = str(tmp_path / "repo")
    skip = shutil.ignore_patterns("llm", ".git", "__pycache__", "*.json", "*.md", *(() if pipeline else ("corpus_pipeline.py",)))
    shutil.copytree(ROOT, copy, ignore=skip)
    names, n = listed(copy)
    assert "event_spans" in names and not any(x.startswith("op") or x == "pipeline" for x in names)
    assert n == len(names)


def test_other_import_errors_are_not_hidden(tmp_path):
    copy = str(tmp_path / "repo")
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", "*.json", "*.md", "tests"))
    folder = os.path.join(copy, "telemill", "llm")
    os.makedirs(folder, exist_ok=True)
    for name in ("__init__.py", "queries.py"):
        with open(os.path.join(folder, name), "w") as f:
            f.write("import no_such_module\n" if name == "queries.py" else "")
    out = subprocess.run([sys.executable, "-c", LIST], cwd=copy, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": copy})
    assert out.returncode != 0 and "no_such_module" in out.stderr


def stored(spark):
    folder = shared_dir(spark).removeprefix("file:")
    return {os.path.join(folder, x) for x in os.listdir(folder)}


def test_scratch(spark):
    before = stored(spark)
    with scratch(spark):
        a = materialize(spark.range(3), "a")
        b = materialize(a.selectExpr("id + 1 as id"), "b")
        assert len(stored(spark) - before) == 2
        release(a)
        assert len(stored(spark) - before) == 1
        with scratch(spark):
            inner = keep(materialize(b, "c"))
            materialize(b, "d")
        assert len(stored(spark) - before) == 2 and inner.count() == 3
    assert stored(spark) == before
    with scratch(spark):
        kept = keep(materialize(spark.range(5), "e"))
    assert kept.count() == 5 and len(stored(spark) - before) == 1
    release(kept)
    with pytest.raises(ZeroDivisionError), scratch(spark):
        materialize(spark.range(3), "f")
        1 / 0  # noqa: B018
    assert stored(spark) == before
