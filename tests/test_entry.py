"""The entry module in trees that lack the training-data operators, their pipeline, or both."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
ASK = "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"


@pytest.mark.parametrize("missing", [["llm"], ["corpus_pipeline.py"], ["llm", "corpus_pipeline.py"]], ids="-".join)
def test_entry_imports_without(tmp_path, missing):
    from trafficloom.catalog.oracles import ORACLES
    from trafficloom.catalog.queries import QUERIES

    shutil.copytree(ROOT / "trafficloom", tmp_path / "trafficloom", ignore=shutil.ignore_patterns("__pycache__", *missing))
    for name in {"__spark_entry__.py", "corpus_pipeline.py"} - set(missing):
        if (ROOT / name).exists():
            shutil.copy(ROOT / name, tmp_path / name)
    done = subprocess.run([sys.executable, "-c", ASK], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    queries, oracles = (set(line.split()) for line in done.stdout.splitlines())
    assert set(QUERIES) <= queries and set(ORACLES) <= oracles <= queries
    assert "pipeline" not in queries
    if "llm" in missing:
        assert queries == set(QUERIES)


def test_entry_leaves_the_pipeline_of_another_tree(tmp_path, monkeypatch):
    shutil.copytree(ROOT / "trafficloom", tmp_path / "own" / "trafficloom", ignore=shutil.ignore_patterns("__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path / "own")
    (tmp_path / "other").mkdir()
    (tmp_path / "other" / "corpus_pipeline.py").write_text("run = ORACLE_SQL = None\n")
    monkeypatch.setenv("PYTHONPATH", str(tmp_path / "other"))
    done = subprocess.run([sys.executable, "-c", ASK], cwd=tmp_path / "own", capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    assert "pipeline" not in done.stdout.split()
