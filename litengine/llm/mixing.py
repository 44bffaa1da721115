"""Sources mixed to target shares of the total size (problem 9).

1. Every document's size is counted in tokens of a public tokenizer, once, whatever the number of mixtures.
2. The size of a mixture is the largest at which every source that has anything can give its share with at most max_repeats copies of a
   document. Targets of sources that have nothing can't be met; they are reported, and the others keep their shares among themselves.
3. A source's documents are put into one order (by hash) and repeated; each copy has a place in its source's stream of tokens, found
   with prefix sums over hash ranges, so no source is ever in one task.
4. Pfair: a source's stream is cut into blocks of whole documents, each smaller than `block` tokens (the size of the mixture over `blocks`,
   but at least twice the longest document). A block that begins after A and ends after B tokens of its source, with weight w, is released
   when A / w tokens of the mixture are out and due at B / w; earliest deadline first among the released. At every document of the mixture
   each source has had its weight's share to within one block; the worst deviation is measured on the actual sizes and reported. There are
   about `blocks` blocks a mixture, so the schedule is a small table, made in one task and joined back by source and block.

Defined cases: null texts have no tokens and are left out, like documents whose source is in no mixture; source names are compared without
case, outer blanks and the difference of '-' and '_'; a target of null, zero or less is none; max_repeats of null or less than 1 counts as 1;
empty tables give no rows; copies of a document are documents of their own.
"""

from __future__ import annotations

import base64
import heapq
import math
from collections.abc import Iterator
from fractions import Fraction
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from litengine.runtime import checkpoint

BLOCKS, RANGES = 2_000, 1_024
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"

# Fixed value: how the tokenizer's texts are cut before pairs are merged.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
_encoders: dict[str, object] = {}


def encoder(path: str, content: bytes | None = None):  # noqa: ANN201
    """The tokenizer of a ranks file, or of its content; one a worker."""
    if path not in _encoders:
        import tiktoken

        lines = (Path(path).read_bytes() if content is None else content).splitlines()
        ranks = {base64.b64decode(t): int(r) for t, r in (x.split() for x in lines if x)}
        _encoders[path] = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encoders[path]


def token_counts(docs: DataFrame, keys: list[str], text: str, path: str = TOKENIZER) -> DataFrame:
    """(keys…, tokens) of the rows that have a text; whole texts, one pass without a shuffle. The ranks file (1 MB) is read once, on the driver, and broadcast."""
    ranks = docs.sparkSession.sparkContext.broadcast(Path(path).read_bytes())
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keys).schema.fields) + ", tokens long"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = encoder(path, ranks.value).encode_ordinary
        for pdf in batches:
            yield pdf[keys].assign(tokens=[len(count(t)) for t in pdf["__t"]])

    return docs.filter(F.col(text).isNotNull()).select(*keys, F.col(text).alias("__t")).mapInPandas(run, schema)


def same_name(c: Column) -> Column:
    return F.replace(F.lower(F.trim(c)), F.lit("-"), F.lit("_"))


def plan_sizes(targets: list[dict], have: dict[str, int]) -> list[dict]:
    """One row for each target: weight among the sources that have anything, tokens to take, tokens there are."""
    out = []
    for mix in sorted({t["mix_id"] for t in targets}):
        rows = [t | {"have": have.get(t["source"], 0), "reps": max(1, t["max_repeats"] or 1)} for t in targets if t["mix_id"] == mix and (t["target_share"] or 0) > 0]
        live = [t for t in rows if t["have"] > 0]
        total = sum(t["target_share"] for t in live)
        size = min((t["have"] * t["reps"] * total / t["target_share"] for t in live), default=0)
        for t in rows:
            weight = t["target_share"] / total if t["have"] else 0.0
            out.append(t | {"weight": weight, "take": int(size * weight), "size": size})
    return out


def schedule(weights: dict[str, Fraction], sizes: dict[str, list[int]]) -> tuple[list[tuple[str, int, int]], float]:
    """((source, block, slot) in the order of the slots, the worst deviation of any source from its share after any block, in tokens).

    Between two blocks' ends deviations change linearly, so no document inside a block sees a larger one. Earliest deadline first among
    the blocks whose release has come; ties go to the heavier source, then by name. Sources that have run out leave the rest to the others.
    """
    sent = dict.fromkeys(weights, 0)
    begun = dict.fromkeys(weights, 0)
    ready: list[tuple[Fraction, Fraction, str]] = []
    waiting: list[tuple[Fraction, str]] = [(Fraction(0), s) for s in sorted(weights) if sizes.get(s)]
    out, now, worst = [], 0, 0.0
    for slot in range(sum(len(sizes.get(s, ())) for s in weights)):
        while waiting and (waiting[0][0] <= now or not ready):  # at the very end none may be released: the next one goes
            _, s = heapq.heappop(waiting)
            heapq.heappush(ready, ((sent[s] + sizes[s][begun[s]]) / weights[s], -weights[s], s))
        *_, s = heapq.heappop(ready)
        out.append((s, begun[s], slot))
        n = sizes[s][begun[s]]
        sent[s], begun[s], now = sent[s] + n, begun[s] + 1, now + n
        worst = max(worst, *(abs(float(sent[k] - w * now)) for k, w in weights.items()))
        if begun[s] < len(sizes[s]):
            heapq.heappush(waiting, (sent[s] / weights[s], s))
    return out, worst


def places(sized: DataFrame) -> DataFrame:
    """sized (doc_id, source, tokens) with `start`, the tokens before it in its source's order, and `total` of the source."""
    h = F.xxhash64("doc_id")
    rows = sized.withColumn("__h", h).withColumn("__r", F.pmod(F.shiftright(F.col("__h"), 8), F.lit(RANGES)).cast("int"))
    per = rows.groupBy("source", "__r").agg(F.sum("tokens").alias("__n"))
    before = W.partitionBy("source").orderBy("__r").rowsBetween(W.unboundedPreceding, -1)
    per = per.select("source", "__r", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__from"), F.sum("__n").over(W.partitionBy("source")).alias("total"))
    within = W.partitionBy("source", "__r").orderBy("__h", "doc_id").rowsBetween(W.unboundedPreceding, -1)
    return rows.withColumn("__w", F.coalesce(F.sum("tokens").over(within), F.lit(0))).join(per, ["source", "__r"]).select("doc_id", "source", "tokens", (F.col("__from") + F.col("__w")).alias("start"), "total")


def mix(docs: DataFrame, targets: DataFrame, tokenizer: str = TOKENIZER, blocks: int = BLOCKS) -> tuple[DataFrame, DataFrame]:
    """The selection (mix_id, source, doc_id, copy, tokens, block, slot, place) and the report (mix_id, source, target_share, share, tokens, documents,
    most_copies, met, block_tokens, worst_blocks). A mixture is read in the order of (slot, place); worst_blocks is the largest deviation of any of its
    sources from its share at any document, in blocks."""
    spark = docs.sparkSession
    wanted = targets.select("mix_id", same_name(F.col("source")).alias("source"), "target_share", "max_repeats")
    goals = [r.asDict() for r in wanted.collect()]  # a table of targets, a few rows a mixture
    names = sorted({g["source"] for g in goals if g["source"]})
    mine = docs.select("doc_id", same_name(F.col("source")).alias("source"), "text").filter(F.col("source").isin(names))
    counted = checkpoint(token_counts(mine, ["doc_id", "source"], "text", tokenizer).filter("tokens > 0"))  # read twice: never count a text twice
    sized = checkpoint(places(counted))
    totals = sized.groupBy("source").agg(F.sum("tokens").alias("n"), F.max("tokens").alias("longest")).collect()
    longest = {r["source"]: r["longest"] for r in totals}
    plans = plan_sizes(goals, {r["source"]: r["n"] for r in totals})

    shares, weights, block_of = [], {}, {}
    for m in sorted({p["mix_id"] for p in plans}):
        live = [p for p in plans if p["mix_id"] == m and p["weight"] > 0]
        total = sum(Fraction(p["target_share"]).limit_denominator(10**6) for p in live)
        weights[m] = {p["source"]: Fraction(p["target_share"]).limit_denominator(10**6) / total for p in live}
        most = max((longest[p["source"]] for p in live), default=1)
        block_of[m] = max(2 * most, math.ceil(live[0]["size"] / blocks) if live else 1)
        shares += [(m, p["source"], p["take"], p["reps"], block_of[m] - most) for p in live]
    plan_df = spark.createDataFrame(shares, "mix_id int, source string, take long, reps int, width long")

    copies = sized.join(F.broadcast(plan_df), "source")  # one row for each target
    copies = copies.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("reps") - 1))).withColumn("place", F.col("start") + F.col("copy") * F.col("total"))
    # a document belongs to the block it begins in; one of `width` tokens and the longest document together stay below a block
    chosen = copies.filter(F.col("place") + F.col("tokens") / 2 <= F.col("take")).withColumn("block", F.floor(F.col("place") / F.col("width")).cast("int"))
    held: dict[tuple, dict[int, int]] = {}
    for r in chosen.groupBy("mix_id", "source", "block").agg(F.sum("tokens").alias("n")).collect():  # at most twice `blocks` rows a mixture
        held.setdefault((r["mix_id"], r["source"]), {})[r["block"]] = r["n"]
    slots, worst = [], {}
    for m, ws in weights.items():
        order = {s: sorted(held.get((m, s), ())) for s in ws}
        got, most = schedule(ws, {s: [held[m, s][b] for b in bs] for s, bs in order.items()}) if ws else ([], 0.0)
        slots += [(m, s, order[s][i], slot) for s, i, slot in got]
        worst[m] = most / block_of[m]
    slot_df = spark.createDataFrame(slots, "mix_id int, source string, block int, slot int")
    chosen = chosen.join(F.broadcast(slot_df), ["mix_id", "source", "block"]).select("mix_id", "source", "doc_id", "copy", "tokens", "block", "slot", "place")

    goal_df = spark.createDataFrame(
        [(p["mix_id"], p["source"], p["target_share"], p["reps"], block_of[p["mix_id"]], worst[p["mix_id"]]) for p in plans],
        "mix_id int, source string, target_share double, max_repeats int, block_tokens long, worst_blocks double",
    )
    got = chosen.groupBy("mix_id", "source", "doc_id").agg(F.sum("tokens").alias("t"), F.count(F.lit(1)).alias("c"))
    got = got.groupBy("mix_id", "source").agg(F.sum("t").alias("tokens"), F.count(F.lit(1)).alias("documents"), F.max("c").alias("most_copies"))
    got = got.withColumn("share", F.col("tokens") / F.sum("tokens").over(W.partitionBy("mix_id")))
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("tokens", "documents", "most_copies")]
    report = goal_df.join(got, ["mix_id", "source"], "left").select("mix_id", "source", "target_share", "max_repeats", *zero, F.coalesce("share", F.lit(0.0)).alias("share"), "block_tokens", "worst_blocks")
    return chosen, report.withColumn("met", F.abs(F.col("share") - F.col("target_share")) <= 0.005)
