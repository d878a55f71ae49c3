"""Every registered query against its DuckDB oracle on the smallest tables."""

import glob
import os
import shutil
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from exhibita.plans import registry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")


def plain(v):
    return repr(round(v, 6)) if isinstance(v, float) else bytes(v).hex() if isinstance(v, (bytes, bytearray)) else repr(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_equals_oracle(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted([plain(r[c]) for c in columns] for r in df.collect())
    cursor = duck.execute(registry.ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    expected = sorted([plain(r[names.index(c)]) for c in columns] for r in cursor.fetchall())
    assert got == expected and got


def test_entry(spark):
    assert entry.entry(spark).columns == ["item_id", "anchor_id", "anchor_type", "start", "end"]
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_the_optional_subpackage_may_be_missing_but_not_broken(tmp_path):
    top = os.path.dirname(os.path.abspath(entry.__file__))
    shutil.copytree(f"{top}/exhibita", tmp_path / "exhibita", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{top}/__spark_entry__.py", tmp_path)
    run = lambda: subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()))"], cwd=tmp_path, capture_output=True, text=True)
    assert run().stdout.split()[-1] == str(len(registry.QUERIES))
    (tmp_path / "exhibita" / "llm").mkdir()
    (tmp_path / "exhibita" / "llm" / "__init__.py").write_text("")
    (tmp_path / "exhibita" / "llm" / "catalogue.py").write_text("import no_such_module")
    broken = run()
    assert broken.returncode and "no_such_module" in broken.stderr
