import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from litengine.operators import multivalue as MV
from litengine.operators import nested as NE
from litengine.plans import queries as Q


def rows(spark, payloads):
    df = spark.createDataFrame([(i, p, "clash") for i, p in enumerate(payloads)], "id long, p string, child string")
    return {(r["id"], r["child"], r["parent_pos"], r["child_pos"]) for r in NE.shred(df, "id", "p").collect()}


def test_shred_shapes(spark):
    payloads = [
        json.dumps({"a": [{"b": [{"x": 1}, None, {}, {"x": 2}]}, {"b": {"x": 3}}]}),
        json.dumps(json.dumps({"a": {"k": [{"b": []}]}})),  # a string, and a wrapping key
        json.dumps([{"a": [{"y": json.dumps({"q": 1})}]}]),
        "{cut", None, "", "[]", "3",
    ]
    assert rows(spark, payloads) == {(0, "$.a", 0, 0), (0, "$.a", 0, 1), (0, "$.a.b", 0, 0), (0, "$.a.b", 0, 3), (0, "$.a.b", 1, 0), (1, "$.a", 0, 0), (2, "$.a", 0, 0)}


def test_any_number_of_values_decides_no_table(spark):
    """20,003 keys in one record, a data key in each; the child tables are all there."""
    payloads = [json.dumps({f"k{i}": i for i in range(20_000)} | {"g": [{"s": 1}]}), json.dumps({"g": {"s": 2}, "h": [{"t": 1}, {}]})]
    assert rows(spark, payloads) == {(0, "$.g", 0, 0), (1, "$.g", 0, 0), (1, "$.h", 0, 0)}


def test_a_key_that_wraps_a_list_and_is_a_value_elsewhere(spark):
    assert rows(spark, [json.dumps({"g": {"g": [{"s": 1}, {"s": 2}]}}), json.dumps({"g": {"g": "x"}}), json.dumps({"g": [{"g": "y"}]})]) == {(0, "$.g", 0, 0), (0, "$.g", 0, 1), (1, "$.g", 0, 0), (2, "$.g", 0, 0)}


def test_shred_empty(spark):
    assert rows(spark, []) == set()


def test_child_table(spark):
    df = spark.createDataFrame([(1, json.dumps({"g": [{"s": "A", "odd key": 2}]}))], "id long, p string")
    r = NE.child_table(NE.shred(df, "id", "p"), "id", "$.g", {"s": "s", "odd": "odd key", "no": "zzz"}).first()
    assert (r["s"], r["odd"], r["no"], r["row_key"], r["parent_key"]) == ("A", "2", None, "1#0/g:0", "1#0")


def test_p3_against_python(spark, sf):
    got = {tuple(r) for r in Q.p3_found(spark, sf).collect()}
    want = set()

    def items(x, wrap=None):
        x = x[wrap] if isinstance(x, dict) and wrap in x else x
        return [x] if isinstance(x, dict) else x if isinstance(x, list) else []

    def text(x, *keys):
        return next((str(x[k]) for k in keys if x.get(k) is not None), "")

    for r in spark.read.parquet(f"{sf}/assertions_nested.parquet").collect():
        try:
            p = json.loads(r["payload"])
        except ValueError:
            continue
        p = json.loads(p) if isinstance(p, str) else p
        p = p[0] if isinstance(p, list) else p
        for i, v in enumerate(items(p.get("variation_set"))):
            want |= {(r["raw_id"], "coordinate", i, j, text(c, "assembly_name", "assembly")) for j, c in enumerate(items((v or {}).get("variation_loc") or (v or {}).get("coordinates"))) if c}
        want |= {(r["raw_id"], "gene", 0, j, text(g, "symbol")) for j, g in enumerate(items(p.get("genes"), "gene")) if g}
        c = p.get("germline_classification") or p.get("clinical_significance") or {}
        c = json.loads(c) if isinstance(c, str) and c else c or {}
        for j, t in enumerate(items(c.get("trait_set") or c.get("traits"), "trait")):
            if t:
                want.add((r["raw_id"], "trait", 0, j, text(t, "trait_name")))
                want |= {(r["raw_id"], "trait_xref", j, k, f"{text(x, 'db_source', 'db')}:{text(x, 'db_id', 'id')}") for k, x in enumerate(items(t.get("trait_xrefs"))) if x}
    assert got == want


G = MV.Grammar(forms=Q.ALIAS_FORMS, vocabulary=("Narvin's disease, distal, 2", "Narvin's disease"))


@pytest.mark.parametrize(
    ("cell", "values"),
    [
        (None, []), ("", []), ("   ", []), ("a", ["a"]), ("a, b;c|d\ne / f", list("abcdef")), ("a,,b, ; ", ["a", None, "b"]), ("None, x", [None, "x"]),
        ('[a, b, "c, d"]', ["a", "b", "c, d"]), ("[Gln12]", ["[Gln12]"]), ("[a; b], c", ["[a; b]", "c"]), ("'a, 'b, c'", ["'a", "b, c"]), ("\u201ca, b\u201d\uff0cc\uff1b\u2018d, e\u2019", ["a, b", "c", "d, e"]), ("it's, o'clock", ["it's", "o'clock"]),
        ('"EX1DEL, 2.3-KB",c.1A>G', ["EX1DEL, 2.3-KB", "c.1A>G"]), ("EX1DEL, 2.3-KB| ABC1, GLY12VAL", ["EX1DEL, 2.3-KB", "ABC1, GLY12VAL"]), ("EX1DEL\\, 2.3-KB", ["EX1DEL, 2.3-KB"]),
        ("c.[1A>G;2del];x", ["c.[1A>G;2del]", "x"]), ("Narvin's disease, distal, 2, Narvin's disease", ["Narvin's disease, distal, 2", "Narvin's disease"]),
        ('["a, b", "c", null]', ["a, b", "c"]), ("['a, b', 'c']", ["a, b", "c"]), ("'a, b', 'c'", ["a, b", "c"]), ('"say ""hi"", you", x', ['say "hi", you', "x"]),
        ('of the "rope" kind, y', ['of the "rope" kind', "y"]), ("a; a", ["a", "a"]), ("x (a; b), y", ["x (a; b)", "y"]),
    ],
)
def test_cells(cell, values):
    got = MV.Cell(cell or "", G).values()
    assert [(p, v) for p, v, _ in got] == [(i, v) for i, v in enumerate(values, 1) if v is not None]


def test_flags():
    assert MV.Cell('"open, b', G).values() == [(1, '"open', "quote"), (2, "b", None)]
    assert MV.Cell("(open, b", G).values()[0] == (1, "(open", "bracket")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("ab,;|\"'\\ ()[]", min_size=1, max_size=8).filter(lambda s: s.strip() == s != "" and s != "None"), min_size=1, max_size=6))
def test_quoted_round_trip(values):
    cell = "; ".join('"' + v.replace("\\", "\\\\").replace('"', '""') + '"' for v in values)
    assert [v for _, v, _ in MV.Cell(cell, MV.Grammar()).values()] == values


@settings(max_examples=200, deadline=None)
@given(st.text("a,;|\n\"'\\ ()[]{}/", max_size=60))
def test_any_cell_ends(cell):
    for p, v, _ in MV.Cell(cell, G).values():
        assert p >= 1
        assert v.strip()


def test_long_cell_is_linear():
    import time

    began = time.time()
    assert len(MV.Cell("(" * 20_000 + "," + "'a," * 20_000, G).values()) > 20_000
    assert time.time() - began < 20


def test_split_cells(spark):
    df = spark.createDataFrame([("u", "a|b", None, 1), (None, "c", "", 2)], "uid string, aliases string, other string, item int")
    got = {tuple(r) for r in MV.split_cells(df, ["uid"], {"aliases": G, "other": G}).collect()}
    assert got == {("u", "aliases", 1, "a", None), ("u", "aliases", 2, "b", None), (None, "aliases", 1, "c", None)}


def test_a_schema_that_is_too_large_is_an_error(spark, monkeypatch):
    """It is never cut: which child tables there are would differ from run to run."""
    df = spark.createDataFrame([(1, '{"genes":[{"symbol":"A"}],"by_id":{"a1":1,"a2":2,"a3":3}}')], "id long, payload string")
    n = sum(map(len, NE.infer_shapes(df, "payload").values()))
    monkeypatch.setattr(NE, "MAX_KEYS", n)
    assert sum(map(len, NE.infer_shapes(df, "payload").values())) == n
    monkeypatch.setattr(NE, "MAX_KEYS", n - 1)
    with pytest.raises(ValueError, match="data in its keys"):
        NE.infer_shapes(df, "payload")
