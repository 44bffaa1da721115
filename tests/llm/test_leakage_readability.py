import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from litengine.llm import leakage as LE
from litengine.llm import readability as RD

ITEM = "The freezer diary checked twice that the spring intake still had 965 gut explants; 18 carried c.870A>T of UDNV1B and were discarded. Vesicle count over protein in tendon strips was 2.13 after mild hypoxia."
OTHER = "Of 616 retinal slices seen by the night shift, 2 showed doubled pigment loss and a third copy of HEQB2. All procedures were carried out in accordance with the guidelines. Which change in IRQL1 explains it?"
AROUND = "Measurement of hearing threshold at regular intervals provided an objective indicator. "


@pytest.fixture(scope="module")
def finder():
    return LE.Finder([(1, ITEM), (2, OTHER), (3, "")])


@pytest.mark.parametrize(
    ("text", "found"),
    [
        (ITEM, {1}), (AROUND + ITEM.upper() + AROUND, {1}), (AROUND * 3, set()), ("", set()),
        (AROUND + ITEM.replace("checked twice", "verified").replace("discarded", "thrown away").replace("diary", "dairy"), {1}),
        (ITEM[len(ITEM) // 2 :] + " " + AROUND + ITEM[: len(ITEM) // 3], {1}), (ITEM[:40], set()), (f"<p>{ITEM.replace('965', '<b>965</b>')}</p>", {1}),
        (ITEM.replace("965", "17").replace("UDNV1B", "ABCD9").replace("2.13", "9.99").replace("18", "4").replace("870A", "3T"), set()),
        ("All procedures were carried out in accordance with the guidelines. " + AROUND, set()), ("See the item on the freezer diary and the spring intake.", set()), (OTHER + ITEM, {1, 2}),
    ],
)
def test_leaks(finder, text, found):
    assert {i for i, _ in finder.find(text)} == found


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(1, 4), max_size=12), min_size=1, max_size=4), st.lists(st.integers(0, 4), max_size=20))
def test_automaton_against_brute_force(items, seq):
    a = LE.Automaton(items, 3)
    got = {(end, n, k, e) for end, n, s in a.matches(seq, 3) for k, e in a.places(s)}
    want = set()
    for end in range(1, len(seq) + 1):
        for k, item in enumerate(items):
            for e in range(1, len(item) + 1):
                n = 0
                while n < min(end, e) and seq[end - 1 - n] == item[e - 1 - n]:
                    n += 1
                want.add((end, n, k, e))
    longest = {}
    for end, n, _, _ in want:
        longest[end] = max(longest.get(end, 0), n)
    for end, n, k, e in got:  # every reported match is one, and the longest there
        assert seq[end - n : end] == items[k][e - n : e]
        assert n == longest[end]
    for end, n in longest.items():  # and every right-maximal one is reported, at each of its places
        if n >= 3 and longest.get(end + 1, 0) <= n:
            assert {(k, e) for x, m, k, e in got if x == end} == {(k, e) for x, m, k, e in want if x == end and m == n}


def test_first_look_loses_nothing(finder):
    rng = random.Random(0)
    ws = ITEM.split()
    for _ in range(100):
        a = rng.randrange(len(ws) // 2)
        text = AROUND + " ".join(ws[a : a + rng.randrange(10, len(ws))]) + " " + AROUND
        worth = finder.worth_it(text)
        finder.worth_it = lambda t: True
        found = finder.find(text)
        del finder.worth_it
        assert worth or not found


def test_leaks_in_spark(spark):
    df = spark.createDataFrame([(1, ITEM, 5), (1, ITEM, 5), (2, None, 5), (3, "", 5)], "doc_id long, text string, item_id int")
    got = LE.leaks(df, [(7, ITEM), (8, ITEM), (9, None)])
    assert sorted((r["doc_id"], r["item_id"]) for r in got.collect()) == [(1, 7), (1, 7), (1, 8), (1, 8)]
    assert LE.leaks(df, []).count() == 0


def test_an_item_without_figures_or_genes_leaks_by_coverage():
    plain = "the freezer diary said that every spring intake was checked twice by the night shift before any of it went to the cold room"
    f = LE.Finder([(1, plain)])
    assert [i for i, _ in f.find(AROUND + plain + ". " + AROUND)] == [1]
    assert f.find(AROUND + plain[:30] + ". " + AROUND) == []


def test_the_match_that_goes_on_may_stand_behind_many_others():
    """50 matches at one place of the document, none of which goes on in the item, before the one that does."""
    f = LE.Finder([(1, "alpha beta gamma delta " + "one two three " * 60)], coverage=0.0)
    doc = "alpha beta gamma zeta one two three".split()
    covered = [f._share(0, [(0, 0, 3), *others, (5, 4, 2)], doc, doc)[0] for others in ([], [(4, 20 + i, 1) for i in range(50)])]
    assert covered[0] == pytest.approx(6 / 184)  # the changed word counts too
    assert covered[1] == pytest.approx(56 / 184)


def test_an_item_in_a_script_without_blanks():
    item = "研究人员发现该基因的变异与心肌病有关，但需要更多样本来确认这一点"
    f = LE.Finder([(1, item), (2, "ผู้ป่วยได้รับยาทุกวันและอาการดีขึ้นอย่างต่อเนื่องภายในสองสัปดาห์")])
    assert [i for i, _ in f.find("前言。" + item + "。完")] == [1]
    assert [i for i, _ in f.find(item[: len(item) // 2])] == [1]
    assert [i for i, _ in f.find(AROUND + "ผู้ป่วยได้รับยาทุกวันและอาการดีขึ้นอย่างต่อเนื่อง")] == [2]
    assert f.find("这一点出乎意料！一位医生说结果很意外。") == []


@settings(max_examples=200, deadline=None)
@given(st.text("aB1é\u0301<b> >\ufb01½①中ไท\u200b-\u2013.,カ\u3099 ", max_size=40))
def test_words_are_placed_in_the_text_itself(text):
    at = LE.placed_words(text)
    assert len(at) == len(LE.words(text))
    assert all(0 <= a < b <= len(text) for a, b in at)
    assert all(x[0] <= y[0] and x[1] <= y[1] for x, y in zip(at, at[1:], strict=False))  # one character may be two words


def test_spans_and_removal(spark):
    rest = "The remaining part of this document is about something else entirely."
    marked = ITEM.replace("965", "<b>965</b>").replace("explants", "ex\u00adplants")
    rows = [(1, f"{rest} {marked} {rest}"), (2, rest), (3, None), (4, OTHER), (5, rest + " " + ITEM[:60])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = [(7, ITEM), (8, OTHER)]
    spans = {(r["doc_id"], r["item_id"]): r for r in LE.spans(docs, items).collect()}
    assert set(spans) == {(1, 7), (4, 8)}
    r = spans[1, 7]
    assert rows[0][1][r["span_start"] - 1 : r["span_start"] - 1 + r["span_len"]] == marked[:-1]
    clean = {r["doc_id"]: r["clean"] for r in LE.remove_spans(docs, items).collect()}
    assert set(clean) == {1, 4}
    assert clean[1] == f"{rest} . {rest}"
    assert LE.Finder(items).find(clean[1]) == []
    assert {r["doc_id"] for r in LE.spans(docs, items, length=8).collect()} == {1, 4, 5}  # long enough, though no leak
    assert LE.remove_spans(docs, []).count() == 0


def test_items_in_several_passes(spark):
    docs = spark.createDataFrame([(1, OTHER + " " + ITEM), (2, AROUND)], "doc_id long, text string")
    items = [(7, ITEM), (8, OTHER), (9, None)]
    assert len(list(LE.passes(items, 40))) == 2
    assert {tuple(r)[:2] for r in LE.leaks(docs, items, a_pass=40).collect()} == {(1, 7), (1, 8)}


def test_many_items_stay_small():
    """30,000 items of other words: what is broadcast grows with the items, not with the square of their words."""
    import pickle

    rng = random.Random(5)
    items = [(i, " ".join(f"w{rng.randrange(300_000)}x" for _ in range(30))) for i in range(30_000)]
    f = LE.Finder(items)
    assert len(pickle.dumps(f)) < 300_000_000
    assert [i for i, _ in f.find(items[77][1] + " " + AROUND + items[29_999][1])] == [77, 29_999]


EASY = ["We can play with the cat at the park.", "He likes to read a red book.", "I can not run with the dog."]
HARD = ["Constitutive oligomerisation of the homodimer antagonises compensatory transcriptional repression.", "Haploinsufficiency necessitates comprehensive immunophenotyping of the parenchyma.", "Epistatic modification recapitulates mitochondrial bioenergetics in the subpopulations."]


def text(kind, n, rng):
    return " ".join(rng.choice(kind) for _ in range(n))


@pytest.fixture(scope="module")
def model():
    rng = random.Random(2)
    rows = [(text(EASY, 8, rng), {1: 1}) for _ in range(30)] + [(text(HARD, 6, rng), {4: 1}) for _ in range(30)]
    rows += [(text(EASY, 8, rng), {4: 1}), (text(HARD, 6, rng), {1: 1})]  # raters err
    return RD.fit(rows)


def test_bands_held_out(model):
    rng = random.Random(3)
    s = RD.Scorer(model)
    assert s.bands([text(EASY, 9, rng) for _ in range(20)]) == [1] * 20
    assert s.bands([text(HARD, 9, rng) for _ in range(20)]) == [4] * 20
    mixed = text(HARD, 9, rng) + " " + EASY[0]
    assert s.bands([mixed, mixed.upper(), "<p>" + mixed + "</p>"]) == [4, 4, 4]


def test_bands_left_out(model):
    de = "Die mittlere Dosis lag bei der Gruppe und wurde von den Leuten nicht gut vertragen. " * 5
    zh = "这一点出乎意料 " * 60
    assert RD.Scorer(model).bands([None, "", "Too short.", de, zh, "12 34 " * 40]) == [None] * 6
    assert RD.fit([]) is None
    assert RD.fit([("", {1: 1}), (None, {2: 1})]) is None


def test_bands_in_spark(spark, model):
    rng = random.Random(4)
    rows = [(i, text(EASY if i % 2 else HARD, 9, rng), "x") for i in range(30)] + [(99, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, band string")
    got = {r["doc_id"]: r["band"] for r in RD.bands(docs, model).collect()}
    assert got == {i: 1 if i % 2 else 4 for i in range(30)}
    assert RD.bands(docs, None).count() == 0
    labels = spark.createDataFrame([(1, "r", 1), (1, "s", 2), (1, "t", 9), (None, "r", 1), (77, "r", 1)], "doc_id long, rater string, band int")
    assert [v for _, v in RD.labelled_texts(docs, labels)] == [{1: 1, 2: 1}]


@pytest.mark.parametrize(("text", "lower"), [("Abcdef Ghijkl Mnopqr Stuvwx", False), ("aBCDEFGhIJKLMNoPQRSTUvWXYZ", True), ("\u00c4bcdef \u00d6hijkl \u00c4nopqr", False), ("123 \u2014", False), ("ABC", True), ("", False)])
def test_capitals_are_counted_over_the_whole_text(text, lower):
    """Every seventh character alone says the opposite of the first three."""
    assert RD.mostly_capitals(text) == lower
    assert RD.raw_tokens(text) == (text.lower() if lower else text).split()


GERMAN = ["Die mittlere Dosis lag bei der Gruppe und wurde von den Leuten nicht gut vertragen.", "Das Gewebe wurde mit der Probe auf Veränderungen untersucht.", "Es ist für die Gruppe nicht bekannt."]
FRENCH = ["Les patients ont été examinés dans une seule clinique par les médecins.", "La dose moyenne est de deux grammes pour le groupe avec une variation.", "Il ne faut pas prendre cette dose sur une longue période."]


def test_language_goes_beyond_its_first_words():
    """The seed words decide nothing in the end: an English text without them is English, a German one with English words strewn in is not."""
    rng = random.Random(6)
    language = RD.fit_language([text(k, 8, rng) for k in (EASY, HARD, GERMAN, FRENCH) for _ in range(12)])
    model = RD.fit([(text(EASY, 8, rng), {1: 1}) for _ in range(8)] + [(text(HARD, 6, rng), {4: 1}) for _ in range(8)], language)
    bare = "haploinsufficiency necessitates comprehensive immunophenotyping parenchyma constitutive oligomerisation homodimer antagonises compensatory repression. " * 4
    assert not RD.looks_english(bare.split())
    strewn = text(GERMAN, 12, rng) + " the of and to in is" * 3
    got = RD.Scorer(model).bands([bare, strewn, text(FRENCH, 12, rng), text(EASY, 12, rng)])
    assert got[0] == 4
    assert got[1:] == [None, None, 1]
    assert not RD.fit_language([]).any()
    assert not RD.fit_language([text(GERMAN, 8, rng)]).any()


def test_sample_is_the_same_in_every_run(spark):
    docs = spark.createDataFrame([(i, f"t{i}") for i in range(50)] + [(60, None), (None, "x")], "doc_id long, text string")
    assert RD.sample_texts(docs, 10) == RD.sample_texts(docs.repartition(7), 10)
    assert len(RD.sample_texts(docs, 10)) == 10


def test_language_rests_on_all_texts(spark):
    """Sums over blocks are those over all texts, and so is what is learned."""
    rng = random.Random(7)
    texts = [text(k, 3, rng) for k in (EASY, HARD, GERMAN, FRENCH) for _ in range(12)] + [None, "", "12 \u00b6", "\u8fd9\u4e00\u70b9 \u51fa\u4e4e", "THE DOSE", "it's x\u00e9\u00ff"]
    whole, parts = next(RD.Words.blocks(texts, 1 << 62)), [RD.Words.unpack(*b.pack()) for b in RD.Words.blocks(texts, 40)]
    words = [[w for s in RD.sentences(t or "") for w in s] for t in texts]
    assert [x for b in parts for x in b.english(None)] == list(whole.english(None)) == [RD.looks_english(ws) and not RD.is_foreign_script(" ".join(ws)) for ws in words if ws]
    language = RD.fit_language(texts)
    assert len(parts) > 5
    for weights in (None, language):
        n = {}
        for b in parts:
            for r in b.tally(None, weights)[0].itertuples(index=False):
                a = n.setdefault(r.word, [0, 0])
                a[0], a[1] = a[0] + r.other, a[1] + r.english
        counts, english, changed = whole.tally(None, weights)
        assert n == {r.word: [r.other, r.english] for r in counts.itertuples(index=False)}
        assert (english, changed) == (sum(b.tally(None, weights)[1] for b in parts), sum(b.tally(None, weights)[2] for b in parts))
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(5)
    assert abs(RD.learn_language(docs) - language).max() < 1e-12
    assert not RD.learn_language(docs.limit(0)).any()
    assert (RD.most_of_a_word(3), RD.most_of_a_word(3_000), RD.most_of_a_word(300_000)) == (50, 50, 5_000)


def test_executors_fit_what_the_driver_fits(spark):
    rng = random.Random(8)
    rows = [(i, text(HARD if i % 3 == 0 else EASY, 6, rng)) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, "r", 4 if i % 3 == 0 else 1) for i in range(60)] + [(5, "s", 3)], "doc_id long, rater string, band int")
    language = RD.learn_language(docs)
    here, there = RD.learn(docs, labels, language), RD.learn(docs, labels, language, on_driver=0)
    assert abs(here.weights - there.weights).max() < 1e-9
    assert abs(here.bias - there.bias).max() < 1e-9
    assert RD.learn(docs, labels.filter("band = 0"), language, on_driver=-1) is None


def test_reading_level_rests_on_all_documents(spark, tmp_path):
    """Of 4,300 labelled documents those with the last hashes are the only ones of their band and vocabulary."""
    from litengine.llm import queries as Q

    rng = random.Random(9)
    ids = [r[0] for r in spark.range(4_300).selectExpr("id").orderBy(F.xxhash64("id"), "id").collect()]
    rows = [(d, text(EASY if i < 4_000 else HARD, 6, rng)) for i, d in enumerate(ids)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(d, "r", 1 if i < 4_000 else 4) for i, d in enumerate(ids)], "doc_id long, rater string, band int").write.parquet(f"{tmp_path}/reading_labels.parquet")
    got = {r["doc_id"]: r["band"] for r in Q.QUERIES["p10_found"](spark, str(tmp_path)).collect()}
    assert got == {d: 1 if i < 4_000 else 4 for i, d in enumerate(ids) if len(rows[i][1].split()) >= 40}
    assert sum(b == 4 for b in got.values()) > 100
