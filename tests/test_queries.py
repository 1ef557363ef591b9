from __future__ import annotations

import duckdb
import pytest

from terrane.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    return float(f"{float(v):.9g}") if type(v).__name__ in ("float", "Decimal") else v


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, oracle, name):
    df = registry.queries()[name](spark, SF)
    want = oracle.sql(registry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(want.columns)
    order = [want.columns.index(c) for c in df.columns]
    rows = sorted([tuple(plain(v) for v in r) for r in df.collect()], key=repr)
    assert rows == sorted([tuple(plain(r[i]) for i in order) for r in want.fetchall()], key=repr)


def test_all_queries_read_every_part(spark, oracle):
    parts = {r[0] for r in oracle.sql("SELECT p_partkey FROM part").fetchall()}
    found = registry.queries()
    assert parts <= {r.node for r in found["connected_components"](spark, SF).collect()}
    assert {x for r in found["adjacency"](spark, SF).collect() for x in (r.a, r.b)} == parts
    for name in ("paint_smallest", "cell_join"):
        assert any(r.p_partkey % 10 for r in found[name](spark, SF).collect())
    assert not any("% 10 = 0" in s or "p_size <= 3" in s for s in registry.oracle_sql().values())
