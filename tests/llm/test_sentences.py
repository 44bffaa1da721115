import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from litengine.llm import sentences as SE

SPLIT = [
    ["Dr. Osk saw No. 14A, i.e. the aunt of no. 5.", "Next."],
    ["Samples came from the U.K. and the U.S.A. on dry ice.", "Probands came from Osk and the U.K.", "Then it ended."],
    ["It rose by 2.5 mg/kg b.i.d. in all.[12]", "c.12A>G was absent."],
    ["Key findings", "A was B."],
    ["BACKGROUND: 5 of 9 relapsed (est. 5.0)."],
    ['One said, "It came back. Nobody told us." and left.', '"Is it X?"', "However, no."],
    ["(Raw counts are in Suppl. Tab. 3.)", "It was late ... but not too late."],
    ["Exclusions were sepsis, etc.", "We thank Mt. Velm Univ. Hosp. for it."],
    ["Am 3. Mai 2001 wurde die Studie beendet.", "Ab der 3. Woche sank der Wert auf 31,8 mmol/l.", "Die 2. Probe zeigte nichts (vgl. Abb. 6).", "Das gilt z. B. nach ca. 11 Monaten."],
    ["„Das überrascht uns.“, sagte die Leiterin.", "Warum?"],
    ["« C'est un résultat net. » a déclaré la responsable.", "Quel soulagement !", "Les auteurs restent prudents...", "Le gène (cf. fig. 9) reste peu étudié."],
    ["«No vimos nada.» comentó una enfermera.", "El 1.º de mayo terminó.", "¿Es X la causa?", "El Dr. Osk y la Dra. Velm revisaron todo."],
    ["В 2002 г. исследование было завершено.", "«Нас удивил.» — сказала она.", "Изучены кровь и др. ткани."],
]
GLUED = [
    ["这一点出乎意料！", "一位医生说：“结果很意外。我们没有想到。”然后离开了。", "“有效吗？”患者常这样问。", "剂量为2.5 mg/kg（最大9 mg）。"],
    ["「結果は意外だった。誰も予想しなかった。」と担当医は述べた。", "検体は保存された…その後、送られた。"],
]


@pytest.mark.parametrize("parts", SPLIT + GLUED)
def test_languages(parts):
    text = ("" if parts in GLUED else " ").join(p + ("\n" if p == "Key findings" else "") for p in parts)
    assert [text[a : a + n] for a, n in SE.split(text)] == parts


def test_scripts_without_stops():
    th = "อายุเฉลี่ยของกลุ่มนี้คือ 46.1 ปี การทดลองนี้ใช้ยา 2.5 มก. ต่อวัน ดังนั้นจึงควรตรวจ นอกจากนี้ยังพบในกล้ามเนื้อ ผิวหนัง และเลือด"
    assert len(SE.split(th)) == 4
    hi = 'डॉ. Osk ने देखा।यहाँ क्यों नहीं मिला?"यह नया है।" एक चिकित्सक ने कहा।'
    assert len(SE.split(hi)) == 3
    assert len(SE.split("其余正常 变异见于14个家系　研究结束")) == 3


def test_edges():
    assert SE.split("") == []
    assert SE.split(" \n ") == []
    assert SE.split("no stop") == [(0, 7)]
    assert SE.split('He said "open. Then more. End.') != []


ALPHABET = "aB .!?\"()[]“”「」。\n1é"


@settings(max_examples=150, deadline=None)
@given(st.text(ALPHABET, max_size=200), st.integers(5, 60))
def test_any_chunking_is_the_same(text, chunk):
    whole = SE.split(text)
    assert SE.split(text, chunk) == whole
    covered = set()
    for a, n in whole:
        part = text[a : a + n]
        assert part == part.strip() != ""
        assert not covered & set(range(a, a + n))
        covered |= set(range(a, a + n))
    assert all(i in covered for i, c in enumerate(text) if not c.isspace())


FN = st.tuples(st.tuples(*[st.integers(0, SE.KINDS - 1)] * SE.KINDS), st.integers(-3, 3) | st.just(SE.FAR), st.integers(0, 3))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(FN, max_size=9), max_size=4))
def test_the_scan_is_the_chain(texts):
    rows = [(i, f) for i, fs in enumerate(texts) for f in fs]
    want = []
    for fs in texts:
        q, d = 0, 0
        for g, a, b in fs:
            want.append((q, d))
            q, d = g[q], max(d + a, b)
    q, d = SE.compose(np.array([f[0] for _, f in rows], dtype=np.int64).reshape(-1, SE.KINDS), np.array([f[1] for _, f in rows], dtype=np.int64), np.array([f[2] for _, f in rows], dtype=np.int64), np.array([i for i, _ in rows]))
    assert list(zip(q.tolist(), d.tolist(), strict=True)) == want


@settings(max_examples=100, deadline=None)
@given(FN, FN, FN)
def test_functions_are_associative(f, g, h):
    def run(x):
        return [(x[0][q], max(d + x[1], x[2])) for q in range(SE.KINDS) for d in range(9)]

    assert run(SE.then(SE.then(f, g), h)) == run(SE.then(f, SE.then(g, h)))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.tuples(st.booleans(), st.integers(0, 7)), max_size=9), max_size=4))
def test_closers_ahead(texts):
    rows = [(i, *x) for i, xs in enumerate(texts) for x in xs]
    want = []
    for xs in texts:
        for i in range(len(xs)):
            got = 0
            for stop, bits in xs[i + 1 :]:
                got |= bits
                if stop:
                    break
            want.append(got)
    assert SE.closers_ahead(np.array([r[1] for r in rows], dtype=bool), np.array([r[2] for r in rows], dtype=np.int64), np.array([r[0] for r in rows])).tolist() == want


def test_quotations_and_brackets_of_any_size():
    inner = "He came back. Nobody told us. " * 80
    text = f'One said, "{inner}So it was." and left. Then it ended.'
    assert len(text) > 2_000
    assert [text[a : a + n] for a, n in SE.split(text, 64)] == [text[: text.index(" Then")], "Then it ended."]
    deep = "It was (two (three. Four (five. Six (seven. Eight (nine. Ten) x) x) x) seven. Y) here. Next."
    assert [deep[a : a + n] for a, n in SE.split(deep)] == [deep[:-6], "Next."]
    cut = f'One said, "{inner}and left. Then it ended.'  # never closed: every stop counts
    assert len(SE.split(cut, 100)) == len(SE.split(cut)) > 160


@pytest.mark.parametrize("chunk", [64, 1000, 10**6])
def test_texts_in_spark(spark, chunk):
    long = 'It was seen. "It came. Back." was said (no. 5). ' * 200
    quoted = f'One said, "{long.replace(chr(34), "")}" and left.\nThen (it. Ended). Now'
    df = spark.createDataFrame([("1", long, 0), ("2", "Short. Text.", 0), ("3", None, 0), ("4", "", 0), ("5", quoted, 1), ("6", "  \n ", 1), ("7", " a. b) B. ", 1)], "k string, t string, sent_len int")
    got = {}
    for r in SE.sentences(df, "k", "t", chunk).collect():
        got.setdefault(r["k"], set()).add((r["sent_start"] - 1, r["sent_len"]))
    assert got == {"1": set(SE.split(long)), "2": {(0, 6), (7, 5)}, "5": set(SE.split(quoted)), "7": set(SE.split(" a. b) B. "))}
    assert SE.sentences(df.limit(0), "k", "t", chunk).count() == 0


def test_abbreviations_of_a_corpus(spark):
    rows = [("It was seen on the blvd. near us (zob. rys. 4).",)] * 12 + [("We went home. then we left the home for the sea.",)] * 12 + [("He is at sea. The sea.",)] * 12 + [(None,), ("",)]
    df = spark.createDataFrame(rows, "t string")
    learned = SE.learn_abbreviations(df, "t")
    assert {"blvd", "zob", "rys"} == learned
    assert SE.learn_abbreviations(df, "t", often=13) == frozenset()
    text = "See Blvd. Osk and Zob. Velm there. Next."
    assert len(SE.split(text)) > 2
    assert [text[a : a + n] for a, n in SE.split(text, learned=learned)] == ["See Blvd. Osk and Zob. Velm there.", "Next."]
    keyed = spark.createDataFrame([("1", text)], "k string, t string")
    assert SE.sentences(keyed, "k", "t", 8, learned).count() == 2
