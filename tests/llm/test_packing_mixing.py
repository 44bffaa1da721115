from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from litengine.llm import mixing as MX
from litengine.llm import packing as PK


def test_nnls_against_enumeration():
    rng = np.random.default_rng(1)
    for _ in range(20):
        a, b = rng.random((5, 4)), rng.random(5)
        x = PK.nnls(a, b)
        assert (x >= 0).all()
        best = min(
            np.linalg.norm(a[:, s] @ np.maximum(np.linalg.lstsq(a[:, s], b, rcond=None)[0], 0) - b) for k in range(1, 16) if len(s := [i for i in range(4) if k >> i & 1]) and (np.linalg.lstsq(a[:, s], b, rcond=None)[0] >= 0).all()
        )
        assert np.linalg.norm(a @ x - b) <= best + 1e-6


def one_by_one(hist, capacity):
    """Best fit, item after item."""
    gaps = []
    for c in sorted((c for c, n in hist.items() for _ in range(n)), reverse=True):
        fit = [g for g in gaps if g >= c]
        if fit:
            gaps.remove(min(fit))
            gaps.append(min(fit) - c)
        else:
            gaps.append(capacity - c)
    return len(gaps)


HIST = st.dictionaries(st.integers(1, 40), st.integers(1, 60), min_size=1, max_size=12)


@settings(max_examples=120, deadline=None)
@given(HIST, st.integers(40, 100))
def test_solve(hist, capacity):
    assert PK.size(PK.best_fit(hist, capacity)) == one_by_one(hist, capacity)
    for found in (PK.solve(hist, capacity), PK.by_patterns(hist, capacity), PK.best_fit(hist, capacity)):
        used = Counter()
        for p, times in found:
            assert times > 0
            assert sum(c * k for c, k in p.items()) <= capacity
            for c, k in p.items():
                used[c] += k * times
        assert +used == Counter(hist)
        # ranks tile every length
        ranks = Counter()
        for c, r, times, k, _ in PK.ranges(found):
            assert r == ranks[c]
            ranks[c] += times * k
        assert ranks == +Counter(hist)
    n = PK.size(PK.solve(hist, capacity))
    assert PK.least(hist, capacity) <= n <= one_by_one(hist, capacity)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 20), st.integers(1, 4), min_size=1, max_size=8), st.integers(20, 60))
def test_fullest_against_enumeration(hist, capacity):
    first = max(hist)
    best = 0
    for counts in np.ndindex(*(n + 1 for n in hist.values())):
        p = dict(zip(hist, counts, strict=True))
        total = sum(c * k for c, k in p.items())
        if p[first] and total <= capacity:
            best = max(best, total)
    got = PK.fullest(hist, sorted(hist, reverse=True), first, capacity)
    assert got[first] >= 1
    assert all(k <= hist[c] for c, k in got.items())
    assert sum(c * k for c, k in got.items()) == best


def test_solve_is_tight():
    assert PK.size(PK.solve({60: 100, 40: 100}, 100)) == 100
    assert PK.size(PK.solve({50: 7, 25: 2}, 100)) == 4
    assert PK.size(PK.solve({45: 2, 35: 2, 20: 2, 10: 2, 30: 2}, 140)) == 2
    assert PK.solve({}, 10) == []


def test_more_lengths_and_items_than_any_list_could_hold():
    """Six million items of sixty lengths, and a thousand lengths: fillings come with their multiplicity."""
    rng = np.random.default_rng(3)
    hist = {int(c): 100_000 for c in rng.choice(np.arange(20, 900), 60, replace=False)}
    found = PK.solve(hist, 1000)
    assert len(found) < 2_000
    assert PK.least(hist, 1000) <= PK.size(found) <= PK.size(PK.best_fit(hist, 1000))
    many = {c: 3 for c in range(1, 1001)}
    assert PK.size(PK.solve(many, 4096)) <= PK.size(PK.best_fit(many, 4096))


def test_pack_in_spark(spark, monkeypatch):
    rows = [(r, "b", i, 1 + (i * 7) % 23) for r in (1, 2) for i in range(300)] + [(3, "b", 0, 130), (4, "b", 0, 5), (5, "b", 0, 40), (5, "b", 1, 80), (5, "b", 2, 80)]
    df = spark.createDataFrame(rows, "run_id long, bucket string, pos int, t int").withColumns({"k": F.lit("x"), "piece": F.lit("clash")})
    budgets = [(1, 50, 10), (2, 200, 0), (3, 10, 10)]
    for block in (PK.BLOCK, 4):  # equal items in one block, and in many
        monkeypatch.setattr(PK, "BLOCK", block)
        out = PK.pack(df, ["run_id"], "t", ["bucket", "pos"], budgets).collect()
        load, cost = Counter(), Counter()
        for r in out:
            load[r["budget_id"], r["run_id"], r["container"]] += r["cost"]
            cost[r["budget_id"], r["run_id"], r["pos"]] += r["cost"]
        assert {r["budget_id"] for r in out} == {1, 2}
        assert all(n <= {1: 50, 2: 200}[b] for (b, *_), n in load.items())
        assert len({(r["budget_id"], r["run_id"], r["pos"], r["piece"]) for r in out}) == len(out) == 600 + 4 + 1 + 1 + 2 + 2 + 605
        for run, _, pos, t in rows:  # nothing lost: every piece bears the overhead
            assert cost[1, run, pos] == t + 10 * -(-t // 40)
            assert cost[2, run, pos] == t
        for b, run in {(b, run) for b, run, _ in load}:
            ids = {c for x, r, c in load if (x, r) == (b, run)}
            assert ids == set(range(len(ids)))
        assert sorted(r["cost"] for r in out if (r["run_id"], r["budget_id"]) == (3, 1)) == [20, 50, 50, 50]
    assert PK.pack(df.limit(0), ["run_id"], "t", ["bucket", "pos"], budgets).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 50), min_size=1, max_size=8), st.integers(0, 10**6))
def test_schedule_deviates_by_less_than_a_block(shares, seed):
    """Blocks of any sizes below 100 tokens: after every one, while no source has run out, each has its share to within one block."""
    weights = {f"s{i}": Fraction(x, sum(shares)) for i, x in enumerate(shares)}
    rng = np.random.default_rng(seed)
    sizes = {}
    for s, w in weights.items():
        sizes[s] = []
        while sum(sizes[s]) < 3000 * w:
            sizes[s].append(int(rng.integers(30, 100)))
    got, worst = MX.schedule(weights, sizes)
    assert [slot for *_, slot in got] == list(range(sum(map(len, sizes.values()))))
    done, tokens, most, running = Counter(), Counter(), 0.0, 0.0
    for s, i, _ in got:
        assert i == done[s]
        done[s] += 1
        tokens[s] += sizes[s][i]
        most = max(most, *(abs(float(tokens[k] - w * sum(tokens.values()))) for k, w in weights.items()))
        if all(done[k] < len(sizes[k]) for k in weights):
            running = most
    assert most == pytest.approx(worst)
    assert running < 100


def test_plan():
    t = [{"mix_id": 1, "source": s, "target_share": w, "max_repeats": r} for s, w, r in (("a", 0.5, 2), ("b", 0.3, 1), ("c", 0.2, 9))]
    plan = {p["source"]: p for p in MX.plan_sizes(t, {"a": 100, "b": 90})}
    assert plan["c"]["take"] == 0
    assert plan["a"]["take"] / plan["b"]["take"] == pytest.approx(5 / 3, rel=0.02)
    assert plan["a"]["take"] <= 200
    assert plan["b"]["take"] <= 90


def test_tokenizer():
    P = pytest.importorskip("public_tokenizers")
    tiktoken = pytest.importorskip("tiktoken")
    own = MX.encoder(MX.TOKENIZER)
    other = tiktoken.Encoding("x", pat_str=P.PATTERN, mergeable_ranks=own._mergeable_ranks, special_tokens={})
    for text in ("It's  a test.\n\n 12,5 ml  ", "血液、皮肤 37℃ ", "", " \t\n", "<|endoftext|> don't"):
        assert own.encode_ordinary(text) == other.encode_ordinary(text)


def test_mix(spark):
    pytest.importorskip("tiktoken")
    rows = [(i, "some words of a text " * (1 + i % 5), ("A-x ", "b", None)[i % 3]) for i in range(600)] + [(900, None, "b"), (901, "", "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("copy", F.lit("clash"))
    targets = spark.createDataFrame([(1, "a_x", 0.75, 2), (1, "b", 0.25, 1), (2, "zzz", 1.0, 2)], "mix_id int, source string, target_share double, max_repeats int")
    chosen, report = MX.mix(docs, targets, blocks=100)
    got = {(r["mix_id"], r["source"]): r for r in report.collect()}
    assert got[1, "a_x"]["share"] == pytest.approx(0.75, abs=0.01)
    assert got[1, "a_x"]["most_copies"] <= 2
    assert got[1, "b"]["most_copies"] == 1
    assert got[2, "zzz"]["tokens"] == 0
    assert not got[2, "zzz"]["met"]
    assert chosen.count() == chosen.select("mix_id", "doc_id", "copy").distinct().count()
    # the deviation at every document, counted on the rows themselves
    sent, worst = Counter(), 0.0
    for r in sorted((r for r in chosen.collect() if r["mix_id"] == 1), key=lambda r: (r["slot"], r["place"])):
        sent[r["source"]] += r["tokens"]
        worst = max(worst, *(abs(sent[s] - w * sum(sent.values())) for s, w in (("a_x", 0.75), ("b", 0.25))))
    assert worst / got[1, "b"]["block_tokens"] == pytest.approx(got[1, "b"]["worst_blocks"], abs=1e-6)
    assert got[1, "b"]["worst_blocks"] < 1
    assert MX.mix(docs.limit(0), targets)[0].count() == 0
