"""Occurrences and record frequency of every distinct value (problem 6).

Vertical layout: each task keeps, for every term, a counter and a compressed bitmap of the record identifiers, cut into
chunks of 2^16 identifiers; a chunk is a sorted array of 16-bit offsets while that is shorter, else 2^16 bits (8 KB). Chunks travel
by (term, chunk) and are merged by union; a term's document frequency is the sum of the cardinalities of its chunks.

A task holds at most HELD offsets before it hands its chunks on, so memory doesn't grow with the input; a term that holds a
third of all entries is a few KB a task and chunk, and its chunks are merged by different tasks.

Defined cases: null values and values that are blank are no entries; null records are no records; an empty table gives no rows;
a value repeated within a record counts as that many entries and one record.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK = 16
ARRAY_MOST = 4096  # offsets; beyond, the bit form is shorter
HELD = 2_000_000
COMMON_SHARE, COMMON_LEAST, RARE_MOST = 0.05, 5, 2
SCHEMA = "item string, chunk long, bits binary, n long"


def packed(offsets: np.ndarray) -> bytes:
    """Sorted distinct 16-bit offsets, in the shorter of the two forms; the first byte tells which."""
    if len(offsets) <= ARRAY_MOST:
        return b"a" + offsets.astype("<u2").tobytes()
    bits = np.zeros(1 << CHUNK, dtype=np.uint8)
    bits[offsets] = 1
    return b"b" + np.packbits(bits, bitorder="little").tobytes()


def unpacked(data: bytes) -> np.ndarray:
    if data[:1] == b"a":
        return np.frombuffer(data, dtype="<u2", offset=1)
    return np.flatnonzero(np.unpackbits(np.frombuffer(data, dtype=np.uint8, offset=1), bitorder="little")).astype(np.uint16)


def union(parts: list[bytes]) -> bytes:
    return parts[0] if len(parts) == 1 else packed(np.unique(np.concatenate([unpacked(p) for p in parts])))


def cardinality(data: bytes) -> int:
    return (len(data) - 1) // 2 if data[:1] == b"a" else int(np.unpackbits(np.frombuffer(data, dtype=np.uint8, offset=1)).sum())


def _batch(items: list, chunks: list, bits: list, ns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array(chunks, pa.int64()), pa.array(bits, pa.binary()), pa.array(ns, pa.int64())], ["item", "chunk", "bits", "n"])


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial bitmaps and counters of (item, record id) rows."""

    def flush(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(held)
        codes = t.column("item").combine_chunks().dictionary_encode()
        ids = t.column("rid").to_numpy()
        code = codes.indices.to_numpy()
        order = np.lexsort((ids, code))
        code, ids = code[order], ids[order]
        chunk, low = ids >> CHUNK, (ids & ((1 << CHUNK) - 1)).astype(np.uint16)
        starts = np.flatnonzero(np.r_[True, (code[1:] != code[:-1]) | (chunk[1:] != chunk[:-1])])
        ends = np.r_[starts[1:], len(code)]
        names = codes.dictionary.to_pylist()
        for a in range(0, len(starts), 20_000):
            items, chunks, bits, ns = [], [], [], []
            for s, e in zip(starts[a : a + 20_000], ends[a : a + 20_000], strict=True):
                items.append(names[code[s]])
                chunks.append(int(chunk[s]))
                bits.append(packed(low[s:e] if e - s == 1 else np.unique(low[s:e])))
                ns.append(int(e - s))
            yield _batch(items, chunks, bits, ns)

    held, n = [], 0
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n >= HELD:
            yield from flush(held)
            held, n = [], 0
    if n:
        yield from flush(held)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (item, chunk): united chunk by chunk; only one chunk is open at a time."""
    open_key, parts, count = None, [], 0
    for b in batches:
        items, chunks, bits, ns = [], [], [], []
        for item, chunk, data, n in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
            if (item, chunk) != open_key:
                if open_key:
                    items.append(open_key[0])
                    chunks.append(open_key[1])
                    bits.append(union(parts))
                    ns.append(count)
                open_key, parts, count = (item, chunk), [], 0
            parts.append(data)
            count += n
            if len(parts) >= 64:
                parts = [union(parts)]
        if items:
            yield _batch(items, chunks, bits, ns)
    if open_key:
        yield _batch([open_key[0]], [open_key[1]], [union(parts)], [count])


def bitmaps(values: DataFrame, item: str, record: str) -> DataFrame:
    """(item, chunk, bits, n): the vertical layout itself. record: a long column."""
    rows = values.select(F.col(item).alias("item"), F.col(record).cast("long").alias("rid")).filter("item is not null and rid is not null")
    partial = rows.mapInArrow(_build, SCHEMA)
    return partial.repartition("item", "chunk").sortWithinPartitions("item", "chunk").mapInArrow(_merge, SCHEMA)


def frequencies(values: DataFrame, item: str, record: str) -> DataFrame:
    """(item, n_entries, n_runs) of every value."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([cardinality(x) for x in b.column(2).to_pylist()], pa.int64()), b.column(3)], ["item", "df", "n"])

    counted = bitmaps(values, item, record).mapInArrow(count, "item string, df long, n long")
    return counted.groupBy("item").agg(F.sum("n").alias("n_entries"), F.sum("df").alias("n_runs"))


def marked(freq: DataFrame, n_records: int, share: float = COMMON_SHARE, least: int = COMMON_LEAST, most: int = RARE_MOST) -> DataFrame:
    """With a mark: 'common' in more than a share of all records and in at least a few, else 'rare' in at most a few, else null."""
    common = (F.col("n_runs") > share * n_records) & (F.col("n_runs") >= least)
    return freq.withColumn("mark", F.when(common, "common").when(F.col("n_runs") <= most, "rare"))
