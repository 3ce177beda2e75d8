"""Every registered query with SQL against DuckDB at the smallest scale, and that the training-data operators can be taken away."""

import math
import os
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry
from keelstone.plans import catalog

ROOT = Path(__file__).resolve().parents[1]
DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = lambda v: round(v, 4) if isinstance(v, float) and math.isfinite(v) else v
    return [columns[i] for i in order], sorted(repr([plain(r[i]) for i in order]) for r in data)


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for p in Path(DATA).glob("*.parquet"):
        con.sql(f"create view {p.stem} as select * from '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_oracle(spark, duck, name):
    df = catalog.QUERIES[name](spark, DATA)
    want = duck.sql(catalog.ORACLES[name])
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(want.columns, want.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_without_the_training_data_operators(tmp_path):
    for name in ("__spark_entry__.py", "keelstone"):
        (tmp_path / name).symlink_to(ROOT / name) if name.endswith(".py") else subprocess.run(["cp", "-r", ROOT / name, tmp_path], check=True)
    subprocess.run(["rm", "-rf", tmp_path / "keelstone/llm"], check=True)
    (tmp_path / "__spark_entry__.py").unlink()
    (tmp_path / "__spark_entry__.py").write_text((ROOT / "__spark_entry__.py").read_text())
    run = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), any(q[:2] == 'op' or q == 'pipeline' for q in e.queries()))"], cwd=tmp_path, capture_output=True, text=True, env=os.environ | {"PYTHONPATH": str(tmp_path)})
    assert run.stdout.split()[-1] == "False" and int(run.stdout.split()[0]) == len(catalog.QUERIES), run.stderr
