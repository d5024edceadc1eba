"""Every query of the catalogue gives the rows of its SQL in DuckDB."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

from curatrix.plans import catalogue

DATA = Path("/root/testdata/sf0.001")


def rows(frame):
    frame = frame[sorted(frame.columns)]
    return sorted(tuple(repr(round(x, 6)) if isinstance(x, float) else str(list(x)) if hasattr(x, "__iter__") and not isinstance(x, str) else str(x) for x in r) for r in frame.itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in DATA.glob("*.parquet"):
        con.sql(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query_equals_sql(spark, duck, name):
    got = catalogue.queries()[name](spark, str(DATA)).toPandas()
    want = duck.sql(catalogue.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_entry_without_the_training_part(tmp_path):
    """A folder that only caches are left of, or a missing pipeline, takes nothing else away."""
    root = Path(__file__).resolve().parent.parent
    shutil.copytree(root / "curatrix", tmp_path / "curatrix", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    (tmp_path / "curatrix/llm/__pycache__").mkdir(parents=True)
    (tmp_path / "corpus_pipeline.py").write_text("from curatrix.llm import language_id\n")
    for _ in range(2):
        said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, capture_output=True, text=True)
        assert said.returncode == 0, said.stderr
        assert said.stdout.split() == [str(len(catalogue.queries()))] * 2 and "left out" in said.stderr
        (tmp_path / "corpus_pipeline.py").unlink(missing_ok=True)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 67
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
