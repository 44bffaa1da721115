"""Candidates to chunks, verdicts to one verdict, names to statuses."""

from __future__ import annotations

import json
import logging
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litengine.functions import text as TX
from litengine.functions import tokens as TK
from litengine.functions import variants as V
from litengine.operators.reconcile import BUCKET_KEYS

log = logging.getLogger("litengine")

CLASSES = ("confirmed", "uncertain", "rejected", "not_assessed")
VERDICT_DDL = "confirmed array<string>, uncertain array<string>, rejected array<string>, not_assessed array<string>, notes string, error string"
# The statuses of a report, by precedence, and the note where no chunk left one.
STATUSES = ("Confirmed", "Uncertain", "Rejected")
NOT_ASSESSED = "Not assessed"
ALL_FINE = "Processed all chunks successfully."


def unpivot(candidates: DataFrame, keys: tuple[str, ...] = ("run_id",), include_ids: bool = True) -> DataFrame:
    """(keys…, bucket, bucket_ord, pos, item): lists only, in the dictionary's order, then the pmids. Null lists and null entries give nothing."""
    names = [*BUCKET_KEYS, *(["pmids"] if include_ids else [])]
    lists = [F.struct(F.lit(n).alias("bucket"), F.lit(i + 1).alias("bucket_ord"), F.col(n).alias("l")) for i, n in enumerate(names) if n in candidates.columns]
    return (
        candidates.select(*keys, F.explode(F.array(*lists)).alias("b"))
        .select(*keys, "b.bucket", "b.bucket_ord", F.posexplode("b.l").alias("pos", "item"))
        .filter(F.col("item").isNotNull())
    )


def pack(items: DataFrame, available: int, keys: tuple[str, ...] = ("run_id",), overhead: int = TK.ITEM_OVERHEAD) -> DataFrame:
    """(keys…, chunk_id, pos, bucket, item, cost): order-sensitive next-fit within each key.

    The state runs through a whole key, so the rows of one key are sorted within their task and streamed through a fold
    (mapInPandas keeps one running number a key, never a whole group).
    """
    ordered = items.withColumn("cost", TK.item_cost(F.col("item"), overhead)).repartition(*(F.col(k) for k in keys)).sortWithinPartitions(*keys, "bucket_ord", "pos", "item")
    ordered = ordered.select(*keys, "bucket_ord", "pos", "bucket", "item", "cost")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ordered.schema.fields) + ", chunk_id int"

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, used, chunk = None, 0, 0
        for pdf in batches:
            ids = []
            for key, cost in zip(zip(*(pdf[k] for k in keys), strict=True), pdf["cost"], strict=True):
                if key != last:
                    last, used, chunk = key, 0, 0
                if used and used + cost > available:
                    chunk, used = chunk + 1, 0
                used += cost
                ids.append(chunk)
            yield pdf.assign(chunk_id=pd.Series(ids, index=pdf.index, dtype="int32"))

    return ordered.mapInPandas(fold, schema)


class Validator(Protocol):
    """Turns a chunk (bucket → names) into the JSON text of a verdict; may raise."""

    def __call__(self, query: str, chunk: dict[str, list[str]]) -> str: ...


def stub_validator(query: str, chunk: dict[str, list[str]]) -> str:
    """Deterministic stand-in: names on both sides are confirmed, curated ones uncertain, the rest not assessed."""
    out: dict[str, list[str] | str] = {c: [] for c in CLASSES}
    for bucket, names in chunk.items():
        out["confirmed" if "_in_" in bucket else "uncertain" if bucket.endswith("clinvar") else "not_assessed"].extend(names)
    return json.dumps(out | {"notes": f"{query}: {sum(map(len, chunk.values()))} candidates."})


#: Calls made side by side in one task; more than that are spread over tasks.
THREADS = 8


def validate(chunks: DataFrame, query: str, validator: Validator, max_concurrent: int = 3, retries: int = 3, wait: Callable[[float], None] | None = None) -> DataFrame:
    """(chunk_id, verdict, error): one verdict text a chunk, or the last error of a chunk that failed for good. chunks: (chunk_id, bucket, item).

    At most max_concurrent calls at a time: a chunk that waits for its next attempt holds its own place only, and the next chunk is begun
    as soon as any place is free.
    """
    from concurrent.futures import ThreadPoolExecutor

    from litengine.sources.retry import retriable_message, retrying

    tasks = max(1, max_concurrent // THREADS)
    threads = max(1, max_concurrent // tasks)
    grouped = chunks.groupBy("chunk_id").agg(F.to_json(F.collect_list(F.struct("bucket", "item"))).alias("c")).repartition(tasks, "chunk_id")

    def one(text: str) -> tuple[str | None, str | None]:
        chunk: dict[str, list[str]] = {}
        for x in json.loads(text):
            chunk.setdefault(x["bucket"], []).append(x["item"])
        try:
            return retrying(lambda: validator(query, chunk), retries, worth=lambda e: retriable_message(str(e)), wait=wait), None
        except Exception as e:
            log.error("a chunk of %d candidates failed: %s", sum(map(len, chunk.values())), TX.shortened(str(e)))
            return None, f"{type(e).__name__}: {e}"

    def call(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(threads) as pool:
            for pdf in batches:
                got = list(pool.map(one, pdf["c"]))
                yield pd.DataFrame({"chunk_id": pdf["chunk_id"], "verdict": [v for v, _ in got], "error": [e for _, e in got]})

    return grouped.mapInPandas(call, "chunk_id int, verdict string, error string")


def error_verdict(message: str) -> dict:
    """What stands for a verdict where no validator could be had."""
    return {"error": message} | {c: [] for c in CLASSES} | {"notes": ""}


def parse_verdict(text: Column) -> Column:
    """JSON text to a verdict struct; null where it is no object."""
    return F.from_json(TX.strip(text), VERDICT_DDL)


def merge(verdicts: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Chunk verdicts (chunk_no, the four lists, notes; all null for a failed chunk) to one row a key.

    Lists: united, without repeats, sorted. Notes lose their last character and are joined by ' | ' in chunk order.
    Repeats are removed map-side before anything is collected, so a list is never longer than its distinct names.
    """
    if not keys:  # one implicit key
        return merge(verdicts.withColumn("__all", F.lit(0)), ("__all",)).drop("__all")
    ok = F.col("confirmed").isNotNull() | F.col("uncertain").isNotNull() | F.col("rejected").isNotNull() | F.col("not_assessed").isNotNull() | F.col("notes").isNotNull()
    if "error" in verdicts.columns:
        ok = ok & F.col("error").isNull()
    named = verdicts.filter(ok).select(*keys, F.explode(F.array(*(F.struct(F.lit(c).alias("class"), F.col(c).alias("names")) for c in CLASSES))).alias("x"))
    named = named.select(*keys, "x.class", F.explode("x.names").alias("name")).filter(F.col("name").isNotNull())
    lists = named.groupBy(*keys).agg(*(F.array_sort(F.collect_set(F.when(F.col("class") == c, F.col("name")))).alias(c) for c in CLASSES))
    note = F.when(ok & (F.col("notes") != ""), F.struct("chunk_no", TX.drop_last(F.col("notes")).alias("n")))
    base = verdicts.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("chunk_count"), F.count_if(ok).alias("successful_chunks"), F.array_join(F.transform(F.array_sort(F.collect_list(note)), lambda s: s["n"]), " | ").alias("notes")
    )
    out = base.join(lists, list(keys), "left")
    empty = F.array().cast("array<string>")
    return out.select(*keys, *(F.coalesce(F.col(c), empty).alias(c) for c in CLASSES), F.when(F.col("notes") == "", ALL_FINE).otherwise(F.col("notes")).alias("notes"), "chunk_count", "successful_chunks")


def status_table(verdicts: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys…, name, rank): the best class of each name, 1 confirmed, 2 uncertain, 3 rejected. What is merely listed as not assessed has no row."""
    lists = F.array(*(F.struct(F.lit(i + 1).alias("rank"), F.col(c).alias("names")) for i, c in enumerate(CLASSES[:3])))
    named = verdicts.select(*keys, F.explode(lists).alias("x")).select(*keys, "x.rank", F.explode("x.names").alias("name"))
    return named.groupBy(*keys, "name").agg(F.min("rank").alias("rank"))


def status_of(rank: Column) -> Column:
    out = F.lit(NOT_ASSESSED)
    for i, s in reversed(list(enumerate(STATUSES))):
        out = F.when(rank == i + 1, s).otherwise(out)
    return out


def with_status(names: DataFrame, verdicts: DataFrame, keys: tuple[str, ...] = (), is_variant: Column | None = None, name: str = "name") -> DataFrame:
    """Left lookup. A variant is looked up by the gene written in it, else by itself. The side of the statuses grows with the verdicts, so the join is left to the planner."""
    lookup = F.when(is_variant, V.gene_of_variant(F.col(name))).otherwise(F.col(name)) if is_variant is not None else F.col(name)
    table = status_table(verdicts, keys).withColumnRenamed("name", "__lookup")
    return names.withColumn("__lookup", lookup).join(table, [*keys, "__lookup"], "left").withColumn("status", status_of(F.col("rank"))).drop("__lookup", "rank")

