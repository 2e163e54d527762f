"""The driver contract: queries against the SQL that must give the same rows, and the library without its subpackage llm."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

from immunoframe.plans import queries as core

TOP = Path(__file__).resolve().parent.parent
DATA = Path("/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(round(r[i], 6) if isinstance(r[i], float) else r[i] for i in order)) for r in rows)


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


@pytest.mark.skipif(not DATA.exists(), reason="needs the test tables")
@pytest.mark.parametrize("name", sorted(core.oracle_sql()))
def test_same_rows_as_sql(spark, duck, name):
    own = core.queries()[name](spark, str(DATA))
    other = duck.sql(core.oracle_sql()[name])
    assert sorted(own.columns) == sorted(other.columns)
    assert normal([tuple(r) for r in own.collect()], own.columns) == normal(other.fetchall(), other.columns)


@pytest.mark.parametrize("gone", [["immunoframe/llm", "tests/llm", "corpus_pipeline.py"], ["immunoframe/llm"]])
def test_without_the_subpackage(tmp_path, gone):
    copy = tmp_path / "repo"
    shutil.copytree(TOP, copy, ignore=shutil.ignore_patterns(".git", "__pycache__"))
    for g in gone:
        shutil.rmtree(copy / g) if (copy / g).is_dir() else (copy / g).unlink(missing_ok=True)
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(*e.queries())"], cwd=copy, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(copy)}, capture_output=True, text=True, check=True)
    assert set(said.stdout.split()) == set(core.queries())
