"""The registered queries of the subpackage against their SQL twins on sf0.001."""

import duckdb
import pytest

from quire.llm import queries

SF001 = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_its_twin(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF001}/{t}.parquet'")
    rel = con.sql(queries.ORACLES[name])
    got = queries.QUERIES[name](spark, SF001).select(*rel.columns)
    assert sorted(got.columns) == sorted(queries.QUERIES[name](spark, SF001).columns)
    assert sorted(map(tuple, got.collect())) == sorted(rel.fetchall())


def test_every_operator_is_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES if n.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in queries.QUERIES
