"""Every registered query of the operators against its SQL, at the smallest scale."""

import duckdb
import pytest

from chartstreak.llm.queries import REGISTRY

SF = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages conversations".split()


@pytest.mark.parametrize("name", [n for n, (_, sql) in REGISTRY.items() if sql])
def test_equals_sql(spark, name):
    query, sql = REGISTRY[name]
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    want = con.sql(sql).df()
    got = query(spark, SF).toPandas()
    cols = sorted(want.columns)
    assert sorted(got.columns) == cols
    # a column of nulls alone has another type on each side
    frames = [x[cols].astype(object).where(x[cols].notna(), None).map(lambda v: "null" if v is None else str(v))
              .sort_values(cols).reset_index(drop=True) for x in (got, want)]
    assert frames[0].equals(frames[1])


def test_one_query_per_operator():
    numbers = [int(n[2:].split("_")[0]) for n in REGISTRY]
    assert sorted(numbers) == list(range(1, len(numbers) + 1))
