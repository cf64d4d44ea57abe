"""Every registered catalogue query against its DuckDB SQL."""

from __future__ import annotations

import duckdb
import pytest

from foliant.plans import every

QUERIES, ORACLES = every()
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def rows(names, records):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def plain(v):
        return None if v is None else f"{float(v):.6f}" if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)

    return sorted(str(tuple(plain(r[i]) for i in order)) for r in records)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, sf_dir, duck):
    df = QUERIES[name](spark, sf_dir)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    if name in ORACLES:
        cur = duck.execute(ORACLES[name])
        names = [d[0] for d in cur.description]
        assert sorted(names) == sorted(df.columns)
        assert got == rows(names, cur.fetchall())
    else:
        assert got
