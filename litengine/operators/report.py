"""Labelled report of the buckets, and where it is written."""

from __future__ import annotations

import csv
import json
import logging
from collections.abc import Iterator
from datetime import datetime

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litengine.functions import variants as V
from litengine.operators import validate as VA
from litengine.operators.reconcile import BUCKETS

log = logging.getLogger("litengine")


def note_of(bucket: Column) -> Column:
    out = F.lit(None).cast("string")
    for key, *_, note in BUCKETS:
        out = F.when(bucket == key, note).otherwise(out)
    return out


def report(bucketed: DataFrame, verdicts: DataFrame | None = None, keys: tuple[str, ...] = (), status_column: str = "Perplexity Status") -> DataFrame:
    """(keys…, Entity Type, Entity Name, Associated Gene, Source, [status], Notes, bucket_ord), unordered: the sink orders by bucket_ord, name.

    Without a verdict there is no status column.
    """
    variant = F.col("etype") == "variant"
    df = bucketed if verdicts is None else VA.with_status(bucketed, verdicts, keys, is_variant=variant)
    return df.select(
        *keys,
        F.initcap("etype").alias("Entity Type"),
        F.col("name").alias("Entity Name"),
        F.when(variant, V.gene_of_variant(F.col("name"))).otherwise("").alias("Associated Gene"),
        F.col("source").alias("Source"),
        *([] if verdicts is None else [F.col("status").alias(status_column)]),
        note_of(F.col("bucket")).alias("Notes"),
        "bucket_ord",
    )


def ordered(rep: DataFrame) -> DataFrame:
    return rep.orderBy("bucket_ord", "Entity Name").drop("bucket_ord")


def usable(verdict: dict | None) -> bool:
    """A verdict that is there and is no error."""
    return bool(verdict) and "error" not in verdict


def rendered(verdict: dict) -> str:
    """A verdict as text, indented by two blanks."""
    return json.dumps(verdict, indent=2)


def indented_json(fields: list[str]) -> Column:
    """The same rendering of columns of names and notes."""

    @F.pandas_udf("string")
    def render(rows: pd.DataFrame) -> pd.Series:
        plain = ([list(x) if isinstance(x, np.ndarray) else x for x in rows[f]] for f in fields)
        return pd.Series([rendered(dict(zip(fields, values, strict=True))) for values in zip(*plain, strict=True)])

    return render(F.struct(*fields))


def write_csv(rep: DataFrame, path: str) -> None:
    """Comma-separated with a header; a folder with one file for each partition, so that a large report passes through no single machine."""
    ordered(rep).write.mode("overwrite").option("header", True).option("emptyValue", "").option("escape", '"').csv(path)


def write_csv_file(rep: DataFrame, path: str) -> None:
    """One named file, in order; a partition at a time passes through the driver, never the whole report."""
    lines = ordered(rep)
    with open(path, "w", encoding="utf-8", newline="") as f:
        out = csv.writer(f, lineterminator="\n")
        out.writerow(lines.columns)
        for row in lines.toLocalIterator(prefetchPartitions=True):
            out.writerow(row)


def text_lines(rep: DataFrame, disease: str, verdict: dict | None = None, now: datetime | None = None) -> Iterator[str]:
    """Plain text: header, table in right-aligned columns, count, and the verdict, even one that is an error. Lines are made as they are
    read; how wide the columns are and how many rows there are is one aggregate."""
    rule = "=" * 80
    yield from (f"Disease: {disease}", f"Generated: {(now or datetime.now()).strftime('%Y-%m-%d %H:%M:%S')}", rule)
    lines = ordered(rep)
    n, *widths = lines.agg(F.count(F.lit(1)), *(F.max(F.coalesce(F.length(F.col(f"`{c}`").cast("string")), F.lit(4))) for c in lines.columns)).first()
    widths = [max(len(c), w or 0) for c, w in zip(lines.columns, widths, strict=True)]
    yield " ".join(c.rjust(w) for c, w in zip(lines.columns, widths, strict=True))
    for row in lines.toLocalIterator(prefetchPartitions=True):
        yield " ".join(str(x).rjust(w) for x, w in zip(row, widths, strict=True))
    yield from (rule, f"Total entities: {n}")
    if verdict:
        yield f"Perplexity verdict: {rendered(verdict)}"


def emit(rep: DataFrame, disease: str, verdict: dict | None = None, path: str | None = None, verbose: bool = False) -> None:
    """CSV where the path ends in .csv, a folder of CSV files where it ends in .csv/, text otherwise; to the log where asked, or where there is no path."""
    if path and path.endswith(".csv/"):
        write_csv(rep, path)
    elif path and path.endswith(".csv"):
        write_csv_file(rep, path)
    elif path:
        with open(path, "w", encoding="utf-8") as f:
            f.writelines(line + "\n" for line in text_lines(rep, disease, verdict))
    if verbose or not path:
        for line in text_lines(rep, disease, verdict if usable(verdict) else None):
            log.info("%s", line)
