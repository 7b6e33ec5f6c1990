"""Every query of the later modules against its SQL twin in DuckDB."""

import glob
import importlib
import os

import duckdb
import pytest

DATA = "/root/testdata/sf0.001"
MODULES = [importlib.import_module(f"siftmill.queries.{m}") for m in ("deliveries", "scoring", "enrichment")]


def _rows(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    text = lambda v: "None" if v is None or v != v else str(v) if isinstance(v, (bool, str)) else f"{float(v):.4f}" if hasattr(v, "__float__") else str(v)
    return sorted("|".join(text(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("module,name", [(m, n) for m in MODULES for n in sorted(m.SQL)], ids=lambda x: x if isinstance(x, str) else "")
def test_queries_against_sql(spark, module, name):
    con = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    df = module.QUERIES[name](spark, DATA)
    want = con.execute(module.SQL[name])
    columns = [c[0] for c in want.description]
    assert sorted(df.columns) == sorted(columns)
    assert _rows([tuple(r) for r in df.collect()], df.columns) == _rows(want.fetchall(), columns)
