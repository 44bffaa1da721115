import glob
import os

import pandas as pd
import pytest

from litengine.plans import queries as Q


@pytest.fixture(scope="module")
def duck(sf):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for p in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


def table(pdf):
    pdf = pdf[sorted(pdf.columns)]
    cells = [[None if pd.isna(x) else round(float(x), 6) if isinstance(x, float) else x for x in pdf[c]] for c in pdf.columns]
    return sorted(zip(*(map(str, c) for c in cells), strict=True))


@pytest.mark.parametrize("name", sorted(Q.SQL))
def test_against_sql(spark, sf, duck, name):
    got, want = Q.QUERIES[name](spark, sf).toPandas(), duck.execute(Q.SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert table(got) == table(want)


@pytest.mark.parametrize("name", sorted(set(Q.QUERIES) - set(Q.SQL)))
def test_runs(spark, sf, name):
    assert Q.QUERIES[name](spark, sf).count() > 0


def test_llm_is_optional():
    """Nothing outside the subpackage imports it."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for path in glob.glob(f"{root}/litengine/**/*.py", recursive=True):
        if "/llm/" not in path:
            with open(path, encoding="utf-8") as f:
                assert "litengine.llm" not in f.read(), path


@pytest.mark.parametrize("slip", [str.upper, lambda x: x.lower() + " ", lambda x: x.replace(",", "")])
def test_crosslink_finds_a_disease_typed_with_a_slip(spark, sf, tmp_path, slip):
    traits = [t for t in pd.read_parquet(f"{sf}/trait_terms.parquet")["trait_name"].dropna() if "," in t]
    packed = "|".join(pd.read_parquet(f"{sf}/assertions_flat.parquet")["trait_names"].dropna())
    trait = max(traits, key=packed.count)
    found = []
    for disease in (trait, slip(trait)):
        d = tmp_path / str(len(found))
        d.mkdir()
        for name in ("articles", "assertions_flat", "trait_terms"):
            os.symlink(f"{sf}/{name}.parquet", d / f"{name}.parquet")
        rows = [("q", (disease,))]
        spark.createDataFrame(rows, "query_id string, summary struct<disease_query:string>").write.parquet(str(d / "candidates.parquet"))
        found.append(Q.entity_crosslink_by_query(spark, str(d)).filter("query_id is null").toPandas())
    assert found[0]["bucket"].str.contains("only_clinvar").any()
    assert found[0]["disease"].nunique() == 1
    assert table(found[1]) == table(found[0])
