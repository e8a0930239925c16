"""Every query of the catalog against its DuckDB SQL, by sorted rows."""

import math
import os

import duckdb
import pytest

from tariffspark.plans import catalog

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.9g}")
    return value


def rows(names, data):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, name):
    df = catalog.QUERIES[name](spark, SF)
    found = rows(df.columns, df.collect())
    if name not in catalog.ORACLES:
        assert found
        return
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    done = con.execute(catalog.ORACLES[name])
    names = [d[0] for d in done.description]
    assert sorted(names) == sorted(df.columns)
    assert found == rows(names, done.fetchall())
