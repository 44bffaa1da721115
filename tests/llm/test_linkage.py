import math

import pytest

from litengine.llm import linkage as LK


@pytest.mark.parametrize(
    ("text", "cdna", "protein", "left"),
    [
        ("NM_933937.3:c.15707C>A", "15707C>A", None, []), ("c.15673+2A>C (MQEZ2)", "15673+2A>C", None, ["MQEZ2"]), ("17570C/A (DFQI1)", "17570C>A", None, ["DFQI1"]), ("X1 c. 8339G&gt;C", "8339G>C", None, ["X1"]),
        ("ELFW3 9607G-->T", "9607G>T", None, ["ELFW3"]), ("3646+2T-G", "3646+2T>G", None, []), ("c.1_5delinsTCT", "1_5delinsTCT", None, []), ("c.12_13delAG", "12_13del", None, []), ("AB1, 9_9dup", "9_9dup", None, ["AB1"]),
        ("QPIVV9 Ile2821Lys mutation", None, "I2821K", ["QPIVV9"]), ("p.(Ala2634fs)", None, "A2634fs", []), ("p29virrf S1911=", None, "S1911=", ["p29virrf"]), ("DUNVP9 Gln-3526-Lys", None, "Q3526K", ["DUNVP9"]),
        ("His4324→Gln in Desvt-5", None, "H4324Q", ["Desvt-5"]), ("VRYF1A VAL1599GLY", None, "V1599G", ["VRYF1A"]), ("A5468fsX10", None, "A5468fs", []), ("ELFW3 Ile2524fs*29", None, "I2524fs", ["ELFW3"]),
        ("p.Glu3246*", None, "E3246*", []), ("p.Arg2858Ter", None, "R2858*", []), ("D946V variant of QOBR-2", None, "D946V", ["QOBR-2"]), ("IRQL1 E3246Ter", None, "E3246*", ["IRQL1"]), ("rs446972437", None, None, ["rs446972437"]), ("", None, None, []),
    ],
)
def test_read(text, cdna, protein, left):
    _, c, p, w = LK.read_text(text)
    assert (c, p, w) == (cdna, protein, left)


def test_propagation_prefers_the_consistent_matching(spark):
    """Two entries, two records; entry 0 fits both records alike, entry 1 fits only the first."""
    pairs = spark.createDataFrame([(0, "u", 5.0), (0, "v", 5.0), (1, "u", 50.0), (2, "w", 3.0)], "e int, u string, odds double")
    got = {(r["e"], r["u"]): r["confidence"] for r in LK.propagate(pairs, ["e"], ["u"]).collect()}
    assert got[2, "w"] == 0.75
    assert got[1, "u"] > 0.95
    assert got[0, "v"] > 0.7 > 0.3 > got[0, "u"]
    # exact marginals over the four matchings that are allowed
    weights = {(): 1, ("0u",): 5, ("0v",): 5, ("1u",): 50, ("0v", "1u"): 250}
    exact = sum(w for m, w in weights.items() if "0v" in m) / sum(weights.values())
    assert math.isclose(got[0, "v"], exact, abs_tol=0.1)


def test_marginals_against_enumeration(spark):
    """A chain of descriptions and notations: messages are exact on it."""
    edges = [(0, "u", 4.0), (0, "v", 1.5), (1, "v", 3.0), (1, "w", 0.4), (2, "w", 2.0), (3, "x", 9.0)]
    got = {(r["e"], r["u"]): r["confidence"] for r in LK.propagate(spark.createDataFrame(edges, "e int, u string, odds double"), ["e"], ["u"], settled=1e-7).collect()}
    total, mass = 0.0, dict.fromkeys(got, 0.0)
    for k in range(1 << len(edges)):
        chosen = [e for i, e in enumerate(edges) if k >> i & 1]
        if len({e[0] for e in chosen}) == len({e[1] for e in chosen}) == len(chosen):
            weight = math.prod(e[2] for e in chosen)
            total += weight
            for e in chosen:
                mass[e[0], e[1]] += weight
    for pair, m in mass.items():
        assert math.isclose(got[pair], m / total, abs_tol=1e-5)


def test_propagation_decides_rows(spark):
    """Two records have the change under the run's trait, so the bare entry is a tie; another bare slip claims one of them, and without messages its own odds would do."""
    pairs = spark.createDataFrame([(0, "u", 3.0), (1, "u", 300.0)], "e int, u string, odds double")
    on = {r["e"]: r["confidence"] for r in LK.propagate(pairs, ["e"], ["u"]).collect()}
    off = {r["e"]: r["confidence"] for r in LK.propagate(pairs, ["e"], ["u"], rounds=0).collect()}
    assert off[0] >= 0.6 > on[0]
    assert on[1] >= 0.6


def test_estimate_follows_the_data():
    assert LK.estimate({}) == {}
    clean = {("same", "not", None, "same"): 4000, ("residue", "not", None, None): 300, ("same", None, "shared", None): 9, ("same", None, "not", None): 1}
    got = LK.estimate(clean)
    assert got["same", "not", None, "same"] > 50 > 1 > got["residue", "not", None, None]
    assert got["same", None, "shared", None] > 5 * got["same", None, "not", None]
    # slips that agree in all else are believed more than those that agree in nothing else
    mixed = LK.estimate(clean | {("digit", "shared", None, "same"): 400, ("digit", "not", None, "other"): 400})
    assert mixed["digit", "shared", None, "same"] > 5 * mixed["digit", "not", None, "other"]


@pytest.mark.parametrize(
    ("a", "b", "want"),
    [
        ("5A>G", "5A>G", "same"), ("5A>G", "5A>T", "residue"), ("K2R", "K2fs", "residue"), ("1234A>G", "1243A>G", "digit"), ("1234A>G", "124A>G", "digit"), ("1234A>G", "1235A>G", "digit"), ("1234A>G", "1299A>G", None),
        ("123+2T>G", "123+3T>G", "digit"), ("10_12del", "12_14del", "shift"), ("10_12del", "12_15del", None), ("K2R", "M2R", "residue"), ("K22R", "K27R", "digit"), ("K22R", "M27R", None),
    ],
)
def test_agreement(a, b, want):
    assert LK.agreement(a, b) == LK.agreement(b, a) == want
    if want in ("same", "residue", "digit"):
        assert set(LK.keys_of(a)) & set(LK.keys_of(b))


def match(spark, entries, records):
    names = spark.createDataFrame([("gena1", 1), ("genb2", 2), ("synb", 2)], "name string, gene long")
    tx = spark.createDataFrame([("NM_1", 1)], "transcript string, gene long")
    e = spark.createDataFrame(entries, "run_id long, pos int, value string, trait string")
    r = spark.createDataFrame(records, "uid string, gene long, transcript string, traits array<string>, kinds array<struct<kind:string,change:string>>")
    return {(x["run_id"], x["pos"]): x["uid"] for x in LK.match(e, r, names, tx).collect()}


RECORDS = [
    ("u1", 1, "NM_1", ["t"], [("c", "5A>G"), ("p", "K2R"), ("q", "K1R")]), ("u2", 2, None, ["t"], [("c", "5A>G"), ("p", "M9V")]), ("u3", 2, None, ["s"], [("c", "7C>T"), ("p", "M9V")]), ("u4", 2, None, [], []),
]


def test_match(spark):
    entries = [
        (1, 0, "GENA1 c.5A>G", "x"), (1, 1, "NM_1.9:c.5A>G", "x"), (1, 2, "GENA-1 K1R", None), (1, 3, "c.5A>G", "t"), (1, 4, "c.7C>T", "s"), (1, 5, "c.7C>T", "t"), (1, 6, "OTHER9 c.5A>G", "t"), (1, 7, None, "t"),
        (1, 8, " ", "t"), (1, 9, "GENA1 c.5A>T", "t"), (1, 10, "synb:c.7C>T", None), (1, 11, "rs5", "t"), (1, 12, "GENA1 c.5A>G", "x"), (1, 13, "GENB2 p.M9V", "zz"),
    ]
    got = match(spark, entries, RECORDS)
    assert {k[1]: v for k, v in got.items()} == {0: "u1", 1: "u1", 2: "u1", 4: "u3", 10: "u3", 12: "u1"}
    assert match(spark, entries[:0], RECORDS) == {}
    assert match(spark, entries, RECORDS[:0]) == {}


@pytest.mark.parametrize("disease", ["VELK'S DISEASE, TYPE 3", "Velk's disease, type 3 ", "Velk's disease type 3", " velk\u2019s  disease, Type 3", "Velk's disease, type 3"])
def test_a_disease_typed_with_a_slip_is_the_same_trait(spark, disease):
    """An entry without a gene leans on the run's disease alone; one trait written in two ways is one."""
    records = [("u1", 1, None, ["Velk's disease, type 3", "VELK'S DISEASE TYPE 3"], [("c", "5A>G")]), ("u2", 2, None, ["Velk's disease, type 2"], [("c", "5A>G")]), ("u3", 2, None, ["--", None], [("c", "8C>T")])]
    got = match(spark, [(1, 0, "c.5A>G", disease), (1, 1, "c.5A>T", disease), (2, 0, "c.8C>T", "-"), (3, 0, "c.8C>T", None)], records)
    assert got == {(1, 0): "u1"}


def test_a_disease_typed_with_a_slip_strengthens_a_match(spark):
    names = spark.createDataFrame([("gena1", 1)], "name string, gene long")
    tx = spark.createDataFrame([], "transcript string, gene long")
    e = spark.createDataFrame([(1, 0, "GENA1 K1R", "Velk's disease, type 3"), (2, 0, "GENA1 K1R", "VELK'S DISEASE TYPE 3 "), (3, 0, "GENA1 K1R", "other")], "run_id long, pos int, value string, trait string")
    r = spark.createDataFrame([("u1", 1, None, ["Velk's disease, type 3"], [("q", "K1R")])], "uid string, gene long, transcript string, traits array<string>, kinds array<struct<kind:string,change:string>>")
    got = {x["run_id"]: x["confidence"] for x in LK.match(e, r, names, tx).collect()}
    assert got[1] == got[2] > got[3]
