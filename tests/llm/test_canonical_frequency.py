import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from litengine.llm import canonical as CA
from litengine.llm import frequency as FR

TERMS = [(1, "ABCD3", "zikelin receptor subunit 3", ["UVRYG", "p16jyvls"]), (2, "ABCD4", "zikelin receptor subunit 4", None), (3, "WXYZ1B", "pazelin transporter 1", ["Zobsn-1"]), (4, None, None, None), (5, "QXGI-1", "gopelin binding protein 1", [])]
DDL = "term_id long, symbol string, full_name string, synonyms array<string>"


@pytest.fixture(scope="module")
def names(spark):
    return CA.vocabulary(spark.createDataFrame(TERMS, DDL), "term_id", ["symbol"], ["synonyms"], ["full_name"]).cache()


@pytest.fixture(scope="module")
def mapped(spark, names):
    df = spark.createDataFrame([(i, "b", i, v) for i, v in enumerate(WRITTEN)], "run_id long, bucket string, pos int, value string")
    got = {r["value"]: r["term_id"] for r in CA.map_entries(df, names, spark.createDataFrame(TERMS, DDL).select("symbol")).collect()}
    return got


WRITTEN = {
    "abcd3": 1, "ABCD-3": 1, "ABCD_3 ": 1, "ABCD 3": 1, "AB​CD3": 1, "АВCD3": 1, "ＡＢＣＤ３": 1, '"ABCD3"': 1, "ABCD3.": 1, "ABCD3 mRNA": 1, "anti-ABCD3": 1, "hABCD3": 1, "human ABCD3": 1, "ΔABCD3": 1,
    "ABCD3(+)": 1, "ABCD3-201": 1, "ABCD-III": 1, "ACBD3": 1, "ABD3": 1, "ABCCD3": 1, "uvryg": 1, "UVRYG (ABCD3)": 1, "UVRYG/ABCD3": 1, "Zikelin Receptor Subunit 3": 1, "zikelin-receptor-subunit-3": 1,
    "zikelin receptor subunit 4 (human)": 2, "zikelim receptor subunit 4": 2, "zikelin receptor subunit 4 [ABCD4]": 2, "WXYZ-1-beta": 3, "WXYZ1β": 3, "zobsn 1": 3, "QXGI1": 5, "QXGI-1 gene": 5,
    "gopelin binding 1": 5, "gopelin bindin 1": 0, "receptor subunit 3": 1, "UVRYG " + "[ABCD3] " * 40: 1, "zikelin receptor subunit 3 " + "(human) " * 40: 1,
    "ABCD9": 0, "zikelin receptor subunit": 0, "zikelin receptor subunit 9": 0, "receptor": 0, "3": 0, "clone E3": 0, "KX-33": 0, "?": 0, "ABCD3, copied from the supplementary sheet, the band described above, and more of it than any name": 0,
}


@pytest.mark.parametrize("value", sorted(WRITTEN))
def test_written(mapped, value):
    assert mapped[value] == WRITTEN[value]


def test_cases(spark, names):
    rows = [(1, "b", 0, "ABCD3"), (1, "b", 1, None), (1, "b", 2, "  "), (1, "b", 3, "abcd3"), (1, "b", 4, "abcd3")]
    df = spark.createDataFrame(rows, "run_id long, bucket string, pos int, value string")
    got = CA.map_entries(df, names, spark.createDataFrame(TERMS, DDL).select("symbol"))
    assert sorted((r["pos"], r["term_id"]) for r in got.collect()) == [(3, 1), (4, 1)]
    assert CA.map_entries(df.limit(0), names).count() == 0
    empty = CA.vocabulary(spark.createDataFrame([], DDL), "term_id", ["symbol"], ["synonyms"], ["full_name"])
    assert {r["term_id"] for r in CA.map_entries(df, empty).collect()} == {0}


def test_one_edit_against_brute_force(spark):
    def near(a, b):
        if a == b:
            return True
        edits = {a[:i] + a[i + 1 :] for i in range(len(a))} | {a[:i] + c + a[i:] for i in range(len(a) + 1) for c in "ab"}
        edits |= {a[:i] + c + a[i + 1 :] for i in range(len(a)) for c in "ab"} | {a[:i] + a[i + 1] + a[i] + a[i + 2 :] for i in range(len(a) - 1)}
        return b in edits

    tokens = ["".join(f"{n:b}") .replace("1", "a").replace("0", "b") for n in range(1, 48)]
    t = spark.createDataFrame([(x,) for x in tokens], "token string")
    idf = spark.createDataFrame([(x, 1, 1.0) for x in tokens], "vt string, df long, idf double")
    got = {(r["token"], r["vt"]) for r in CA.repair(t, idf).collect()}
    want = {(a, b) for a in tokens for b in tokens if a == b or (min(len(a), len(b)) >= 3 and near(a, b))}
    assert got == want


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(0, 65535), min_size=1, max_size=300))
def test_bitmaps(offsets):
    a = np.unique(np.array(offsets, dtype=np.uint16))
    assert FR.unpacked(FR.packed(a)).tolist() == a.tolist()
    big = np.arange(0, 65536, 7, dtype=np.uint16)
    both = FR.union([FR.packed(a), FR.packed(big)])
    assert FR.cardinality(both) == len(set(offsets) | set(big.tolist()))
    assert FR.packed(big)[:1] == b"b"


def test_frequencies(spark):
    rows = [("x", r) for r in range(100_000, 170_000)] + [("y", 1), ("y", 1), ("y", 70_000), (None, 3), ("z", None)]
    df = spark.createDataFrame(rows, "item string, rid long").repartition(7)
    got = {r["item"]: (r["n_entries"], r["n_runs"]) for r in FR.frequencies(df, "item", "rid").collect()}
    assert got == {"x": (70_000, 70_000), "y": (3, 2)}
    assert FR.frequencies(df.limit(0), "item", "rid").count() == 0
    f = spark.createDataFrame([("a", 9, 6), ("b", 9, 5), ("c", 2, 2), ("d", 4, 4)], "item string, n_entries long, n_runs long")
    assert {r["item"]: r["mark"] for r in FR.marked(f, 100).collect()} == {"a": "common", "b": None, "c": "rare", "d": None}
    assert FR.marked(f, 10).filter(F.col("mark") == "common").count() == 2


@pytest.mark.parametrize("least", [1, 10_000])
def test_hot_keys_are_spread_and_nothing_is_lost(spark, least):
    from litengine.llm.common import spread_join

    many = spark.createDataFrame([(i, "hot" if i % 3 == 0 else f"k{i}", "c") for i in range(300)], "id long, key string, n string")
    few = spark.createDataFrame([("hot", 1), ("hot", 2), ("k1", 3), ("none", 4)], "key string, v int")
    got = sorted((r["id"], r["v"]) for r in spread_join(many, few, ["key"], F.col("id"), least=least).collect())
    assert got == sorted([(i, v) for i in range(0, 300, 3) for v in (1, 2)] + [(1, 3)])
    assert spread_join(many, few, ["key"], F.col("id"), "left", least=least).count() == 300 + 100
    assert spread_join(many.limit(0), few, ["key"], F.col("id")).count() == 0
