"""Items of varying length into containers of a fixed capacity (problem 7).

Pattern packing by non-negative least squares, for each group (a run and a budget):

1. The group's lengths become a histogram: at most `capacity` distinct numbers, however many items there are. An item that alone
   exceeds the capacity is divided into pieces first; no other is. One histogram of a group's own sizes serves all budgets.
2. Patterns are enumerated: for the longest length that is left, the fullest container that holds it (a bounded subset-sum over bit sets,
   exact), as often as the histogram allows, and so on; the fillings of best fit; each length alone. All lengths take part.
3. Non-negative repeat counts that fit the histogram best, with wasted space as one more row to be fitted to zero, are found by an
   active-set method and rounded as far as the histogram allows.
4. What is left over is packed best-fit, longest first, into the gaps and into new containers. All fillings are kept with their
   multiplicity, so the work depends on the number of distinct lengths, not of items.
5. The whole-numbered repeat counts that the enumeration passed through are solutions of the same system; where they need fewer
   containers than the rounded fit, they stand. So a group never takes more containers than best fit.
6. The containers are described by length and rank only; items find theirs by their rank among the items of the same size of their
   group. Ranks of more than BLOCK equal items are counted in blocks with an offset for each, so they are never in one task.

Every item (or piece) is in exactly one container and no container exceeds the capacity. Defined cases: null and blank values are no items;
empty tables give no rows; a budget that is no more than the overhead of an item holds nothing and gives no rows; equal items are told
apart by their place; a group that fits one container is one container.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from litengine.runtime import parallelism

#: Weight of wasted space beside the histogram's rows (which count in tokens).
WASTE = 0.3
#: Equal items of a group that are ranked in one task; more are cut into blocks.
BLOCK = 100_000

Fillings = list[tuple[dict[int, int], int]]  # (how many of each length, how many containers are filled so)


def nnls(a: np.ndarray, b: np.ndarray, x: np.ndarray | None = None) -> np.ndarray:
    """Non-negative least squares by active sets over the normal equations, from a start that is not negative."""
    g, h = a.T @ a, a.T @ b
    n = len(h)
    x = np.zeros(n) if x is None else x.astype(float)
    passive = x > 0
    tol = 1e-9 * max(1.0, float(np.abs(h).max(initial=0)))
    inner = bool(passive.any())
    for _ in range(10 * n + 10):
        if not inner:
            w = h - g @ x
            w[passive] = -np.inf
            j = int(np.argmax(w)) if n else 0
            if not n or w[j] <= tol:
                break
            passive[j] = True
        inner = False
        while True:
            at = np.flatnonzero(passive)
            s = np.zeros(n)
            try:
                s[at] = np.linalg.solve(g[np.ix_(at, at)], h[at])
            except np.linalg.LinAlgError:
                s[at] = np.linalg.lstsq(g[np.ix_(at, at)], h[at], rcond=None)[0]
            neg = passive & (s <= 1e-12)
            if not neg.any():
                x = s
                break
            x = x + float(np.min(x[neg] / np.maximum(x[neg] - s[neg], 1e-12))) * (s - x)
            x[x <= 1e-12] = 0
            passive &= x > 0
            if not passive.any():
                x = np.zeros(n)
                break
    return x


def fullest(left: dict[int, int], lengths: list[int], first: int, capacity: int) -> dict[int, int]:
    """The filling with one of `first` that leaves least space, longer lengths preferred. lengths: descending."""
    room, sums, steps = capacity - first, 1, []
    mask = (1 << (room + 1)) - 1
    for c in lengths:
        n = min(left[c] - (c == first), room // c)
        k = 1
        while n > 0:  # counts by doubling
            take = min(k, n)
            more = sums | (sums << c * take) & mask
            if more != sums:
                steps.append((c, take, sums))
                sums = more
            n, k = n - take, 2 * k
        if sums >> room:  # full
            break
    best, out = sums.bit_length() - 1, {first: 1}
    for c, take, before in reversed(steps):
        if not before >> best & 1:
            best -= c * take
            out[c] = out.get(c, 0) + take
    return out


def by_patterns(hist: dict[int, int], capacity: int) -> Fillings:
    """The longest length left in its fullest filling, as often as that goes, until nothing is left."""
    left, lengths, out = dict(hist), sorted(hist, reverse=True), []
    while lengths:
        p = fullest(left, lengths, lengths[0], capacity)
        times = min(left[c] // k for c, k in p.items())
        out.append((p, times))
        for c, k in p.items():
            left[c] -= k * times
        lengths = [c for c in lengths if left[c]]
    return out


def best_fit(hist: dict[int, int], capacity: int, begun: Fillings = ()) -> Fillings:
    """Best fit, longest first, into the gaps of the containers there are and into new ones. The tightest gap that takes an item takes its
    equals too, so whole multiplicities are placed at once; exactly what placing them one by one gives."""
    classes = [[capacity - sum(c * k for c, k in p.items()), p, t] for p, t in begun if t > 0]
    for c in sorted((c for c, n in hist.items() if n > 0), reverse=True):
        n = hist[c]
        for x in sorted((x for x in classes if x[0] >= c), key=lambda x: x[0]):
            q = x[0] // c
            full = min(x[2], n // q)
            rest = n - full * q if full < x[2] else 0  # fewer than q: one more container takes them
            for k, m in ((q, full), (rest, 1 if rest else 0)):
                if m:
                    classes.append([x[0] - k * c, {**x[1], c: x[1].get(c, 0) + k}, m])
            x[2] -= full + (1 if rest else 0)
            n -= full * q + rest
            if not n:
                break
        if n:
            q = capacity // c
            for k, m in ((q, n // q), (n % q, 1 if n % q else 0)):
                if m:
                    classes.append([capacity - k * c, {c: k}, m])
        classes = [x for x in classes if x[2]]
    return [(p, t) for _, p, t in classes]


def least(hist: dict[int, int], capacity: int) -> int:
    """No packing has fewer containers: by space, by how many of the shortest fit, and by the lengths of which no two fit."""
    total = sum(c * n for c, n in hist.items())
    room, most = capacity, 0
    for c in sorted(hist):
        k = min(hist[c], room // c)
        most, room = most + k, room - k * c
        if k < hist[c]:
            break
    return max(-(-total // capacity), -(-sum(hist.values()) // max(most, 1)), sum(n for c, n in hist.items() if 2 * c > capacity))


def rounded(patterns: list[dict[int, int]], x: np.ndarray, hist: dict[int, int], capacity: int) -> Fillings:
    """Counts to whole numbers, the largest first, as far as the histogram allows; best fit for what is left."""
    left, out = dict(hist), []
    for j in np.argsort(-x, kind="stable").tolist():
        if x[j] < 0.5:
            break
        times = min(int(x[j] + 0.5), *(left[c] // k for c, k in patterns[j].items()))
        if times:
            out.append((patterns[j], times))
            for c, k in patterns[j].items():
                left[c] -= k * times
    return best_fit(left, capacity, out)


def size(found: Fillings) -> int:
    return sum(t for _, t in found)


def solve(hist: dict[int, int], capacity: int) -> Fillings:
    """All lengths of the histogram used up, in as few containers as the fit and the fillings it was made from can show."""
    hist = {c: n for c, n in hist.items() if n > 0}
    if sum(c * n for c, n in hist.items()) <= capacity:
        return [(hist, 1)] if hist else []
    chosen = by_patterns(hist, capacity)
    fitted = best_fit(hist, capacity)
    bound = least(hist, capacity)
    start: Counter = Counter()
    for p, t in chosen:
        start[tuple(sorted(p.items()))] += t
    pool = dict.fromkeys([*start, *(tuple(sorted(p.items())) for p, _ in fitted), *(((c, min(n, capacity // c)),) for c, n in hist.items())])
    pats = [dict(p) for p in pool]
    lengths = sorted(hist)
    at = {c: i for i, c in enumerate(lengths)}
    a = np.zeros((len(lengths) + 1, len(pats)))
    for j, p in enumerate(pats):
        for c, k in p.items():
            a[at[c], j] = k * c  # space counts, not numbers
        a[-1, j] = WASTE * (capacity - sum(c * k for c, k in p.items()))
    b = np.array([hist[c] * c for c in lengths] + [0.0])
    out = rounded(pats, nnls(a, b, np.array([start.get(p, 0) for p in pool], dtype=float)), hist, capacity)
    for other in (chosen, fitted):
        if size(out) == bound:
            break
        if size(other) < size(out):
            out = other
    return out


def ranges(found: Fillings) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, containers, items of that length in each, first container) of all fillings."""
    rank: Counter = Counter()
    out, first = [], 0
    for p, times in found:
        for c, k in sorted(p.items()):
            out.append((c, rank[c], times, k, first))
            rank[c] += times * k
        first += times
    return out


def divided(tokens: int, limit: int, overhead: int) -> tuple[int, int]:
    """(pieces that fill a container alone, cost of the last piece); each piece bears the overhead."""
    room = limit - overhead
    full = max(-(-tokens // room) - 1, 0)
    return full, tokens - full * room + overhead


def describe(sizes: dict[int, int], limit: int, overhead: int) -> dict[int, dict]:
    """Size → where its items go: `full` pieces each from container `base` on, and the last piece by ranges of its rank, which begins at `shift` for this size."""
    if limit <= overhead:
        return {}
    cut = {t: divided(t, limit, overhead) for t in sizes}
    hist: Counter = Counter()
    shift = {}
    for t in sorted(sizes):
        shift[t] = hist[cut[t][1]]
        hist[cut[t][1]] += sizes[t]
    found = solve(dict(hist), limit)
    by: dict[int, list[dict]] = {}
    for c, r, times, k, first in ranges(found):
        by.setdefault(c, []).append({"r": r, "times": times, "k": k, "c": first})
    out, base = {}, size(found)
    for t in sorted(sizes):
        full, last = cut[t]
        lo, hi = shift[t], shift[t] + sizes[t]
        mine = [x for x in by[last] if x["r"] < hi and x["r"] + x["times"] * x["k"] > lo]
        out[t] = {"full": full, "last": last, "shift": lo, "base": base, "ranges": mine}
        base += full * sizes[t]
    return out


def pack(items: DataFrame, group: list[str], tokens: str, place: list[str], budgets: list[tuple[int, int, int]]) -> DataFrame:
    """(group…, place…, budget_id, piece, cost, container), containers numbered from 0 in each group and budget.

    items: (group…, place…, tokens); place tells the items of a group apart. budgets: a short list of (budget_id, token_limit, item_overhead).
    """
    spark = items.sparkSession
    rows = items.select(*group, *place, F.col(tokens).cast("long").alias("__t"))
    counts = rows.groupBy(*group, "__t").agg(F.count(F.lit(1)).alias("n"))
    hist = counts.groupBy(*group).agg(F.collect_list(F.struct(F.col("__t").alias("t"), "n")).alias("h"))  # an entry for each distinct size
    keys = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in hist.select(*group).schema.fields)
    where = "array<struct<budget_id:int,room:long,overhead:int,full:long,last:long,shift:long,base:long,ranges:array<struct<r:long,times:long,k:long,c:long>>>>"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for *key, h in pdf.itertuples(index=False, name=None):
                sizes = {int(x["t"]): int(x["n"]) for x in h}
                plans = [(b, limit, over, describe(sizes, limit, over)) for b, limit, over in budgets]
                out += [(*key, t, n, [{"budget_id": b, "room": limit - over, "overhead": over, **plan[t]} for b, limit, over, plan in plans if plan]) for t, n in sizes.items()]
            yield pd.DataFrame(out, columns=[*group, "__t", "__n", "__w"])

    # little data and much work: a number of tasks that adaptive execution leaves as it is
    described = hist.repartition(parallelism(spark), *group).mapInPandas(run, f"{keys}, __t long, __n long, __w {where}")
    met = rows.join(described, [*group, "__t"])
    # rank of an item among those of its size: its place within its block, after the items of earlier blocks; nearly all are one block
    met = met.withColumn("__b", F.when(F.col("__n") > BLOCK, F.pmod(F.xxhash64(*place), F.ceil(F.col("__n") / BLOCK))).otherwise(0))
    met = met.withColumn("__r", F.row_number().over(W.partitionBy(*group, "__t", "__b").orderBy(*place)).cast("long") - 1)
    big = rows.join(counts.filter(F.col("n") > BLOCK).withColumnRenamed("n", "__n"), [*group, "__t"])
    blocks = big.groupBy(*group, "__t", F.pmod(F.xxhash64(*place), F.ceil(F.col("__n") / BLOCK)).alias("__b")).agg(F.count(F.lit(1)).alias("__k"))
    before = F.coalesce(F.sum("__k").over(W.partitionBy(*group, "__t").orderBy("__b").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    met = met.join(blocks.withColumn("__from", before).drop("__k"), [*group, "__t", "__b"], "left").withColumn("__r", F.col("__r") + F.coalesce("__from", F.lit(0)))

    met = met.select(*group, *place, "__t", "__r", F.explode("__w").alias("w"))
    met = met.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.col("w.full"))))
    last, rank = F.col("piece") == F.col("w.full"), F.col("__r") + F.col("w.shift")
    mine = F.get(F.filter("w.ranges", lambda x: (rank >= x["r"]) & (rank < x["r"] + x["times"] * x["k"])), F.lit(0))
    met = met.withColumn("__m", F.when(last, mine))
    container = F.when(last, F.col("__m.c") + F.floor((rank - F.col("__m.r")) / F.col("__m.k"))).otherwise(F.col("w.base") + F.col("__r") * F.col("w.full") + F.col("piece"))
    cost = F.when(last, F.col("w.last")).otherwise(F.col("w.room") + F.col("w.overhead"))
    return met.select(*group, *place, F.col("w.budget_id").alias("budget_id"), F.col("piece").cast("int").alias("piece"), cost.cast("int").alias("cost"), container.cast("long").alias("container"))
