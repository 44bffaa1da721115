import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from litengine.functions import text as TX
from litengine.functions import tokens as TK
from litengine.functions import variants as V


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "x string").select(f(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("NM_003978.5(PSTPIP1):c.1034A>G (p.Tyr345Cys)", ["NM_003978.5(PSTPIP1):c.1034A>G", "c.1034A>G", "p.Tyr345Cys"]),
        ("c.123A>G c.123_124del c.123_124ins", ["c.123A>G", "c.123_124del", "c.123_124ins"]),
        ("p.Ala123Val p.M1V p.Gln219Ter", ["p.Ala123Val", "p.M1V", "p.Gln219Ter"]),
        ("rs12345678 xrs9", ["rs12345678"]),
        ("c.340+1G>T", []),
        ("p.G12fs p.Gly1206fs", []),
        ("c.123A&gt;G p.G12C", ["p.G12C"]),
        ("c.1A>G then c.1A>G", ["c.1A>G"]),
        ("", []),
        (None, None),
    ],
)
def test_variants(spark, text, expected):
    assert one(spark, text, V.variants_in) == expected


@pytest.mark.parametrize(("v", "gene"), [("NM_015331.3(NCSTN):c.1229C>T (p.Ala410Val)", "NCSTN"), ("rs123456", "rs123456"), ("GRCh37/hg19 13q13.1(chr13:32668492-33154022)x1",) * 2])
def test_gene_of_variant(spark, v, gene):
    assert one(spark, v, V.gene_of_variant) == gene


@pytest.mark.parametrize(("name", "ok"), [("BRCA2", True), ("-GOV", True), ("2-B08", True), ("HLA-DR", True), ("A", False), ("Brca2", False), ("ABCDEFGHI", False), ("IL 2", False), ("BRCA2\n", False), (None, False)])
def test_acronym(spark, name, ok):
    assert one(spark, name, V.is_acronym) is ok


def test_escape_hides_substitutions(spark):
    assert one(spark, "c.123A>G p.G12C", lambda c: V.variants_in(TX.xml_escape(c))) == ["p.G12C"]


@pytest.mark.parametrize(("xml", "ok"), [("<a><b>x</b></a>", True), ("<a>x</a>", False), ("<a/>", False), ("<a><b>x</b>", False), ("", False), (None, False), ('<?xml version="1.0"?><a><b/></a>\n', True)])
def test_xml_usable(spark, xml, ok):
    assert one(spark, xml, TX.xml_usable) is ok


def test_lists(spark):
    assert one(spark, " BRCA2,\tTP53 ", TX.split_list) == ["BRCA2", "TP53"]
    df = spark.createDataFrame([([None, "A"],), ([],), (None,)], "a array<string>")
    assert [r[0] for r in df.select(TX.join_list(F.col("a"))).collect()] == ["None, A", None, None]


@pytest.mark.parametrize(("m", "ok"), [("HTTP 429", True), ("Connection reset", True), ("401 unauthorized", False), (None, False)])
def test_retriable(spark, m, ok):
    assert one(spark, m, TX.is_retriable) is ok


@pytest.mark.parametrize(("t", "n"), [("", 1), ("a" * 8, 2), ("a" * 11, 2)])
def test_estimate(spark, t, n):
    assert one(spark, t, lambda c: TK.estimate(F.length(c))) == n


def test_budget():
    assert TK.budget(4096, "Pancreatic cancer") == 3025
    assert TK.budget(6000, "Pancreatic cancer") == 4549
    with pytest.raises(ValueError, match="300"):
        TK.budget(300, "Pancreatic cancer")


@settings(max_examples=15, deadline=None)
@given(texts=st.lists(st.text(st.characters(blacklist_categories=("Cs",), blacklist_characters="\x00"), max_size=30), min_size=1, max_size=20))
def test_json_length(spark, texts):
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "x string").select(TK.ascii_json_length(F.col("x"))).collect()]
    assert got == [len(json.dumps(t)) for t in texts]
