import glob
import os

import pytest

from litengine.llm import queries as Q
from tests.test_queries import table


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_query(spark, sf, name):
    got = Q.QUERIES[name](spark, sf).toPandas()
    assert len(got)
    if name in Q.SQL:
        con = pytest.importorskip("duckdb").connect()
        for p in glob.glob(f"{sf}/*.parquet"):
            con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
        assert table(got) == table(con.execute(Q.SQL[name]).df())


@pytest.mark.parametrize(
    ("name", "columns"),
    [
        ("p1_found", "run_id bucket pos term_id"), ("p2_found", "pmid sent_start sent_len"), ("p5_found", "run_id pos uid"), ("p6_found", "item n_entries n_runs mark"), ("p8_found", "doc_id item_id"), ("p10_found", "doc_id band"),
    ],
)
def test_columns(spark, sf, name, columns):
    assert Q.QUERIES[name](spark, sf).columns == columns.split()
