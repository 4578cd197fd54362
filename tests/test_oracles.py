"""Every query of the catalog that SQL can express against DuckDB."""

import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

from tracewell.plans import catalog

ROOT = Path(__file__).resolve().parent.parent

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query(spark, sf, con, name):
    df = catalog.QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    found = con.execute(catalog.ORACLES[name])
    theirs = [c[0] for c in found.description]
    assert sorted(theirs) == columns
    rows = lambda many, at: sorted(tuple(str(r[i]) for i in at) for r in many)
    assert rows(df.select(*columns).collect(), range(len(columns))) == rows(found.fetchall(), [theirs.index(c) for c in columns])


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


@pytest.mark.parametrize("pipeline", [True, False])
def test_without_text_operators(tmp_path, pipeline):
    """A copy without the text operators has all other queries, whether the pipeline's file is there or not."""
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if (ROOT / name).exists() and (pipeline or name != "corpus_pipeline.py"):
            shutil.copy(ROOT / name, tmp_path)
    shutil.copytree(ROOT / "tracewell", tmp_path / "tracewell", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"
    said = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)})
    assert said.stdout.splitlines() == [" ".join(sorted(catalog.QUERIES)), " ".join(sorted(catalog.ORACLES))]
