"""The batch transforms over an unbounded table of mentions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litengine.operators.literature import tagged_genes


def mention_counts(stream: DataFrame, window: str = "1 hour", late: str = "2 hours", min_score: float = 0.75) -> DataFrame:
    """Gene mentions a window and name; a repeated mention_id within the watermark counts once, later ones are dropped with their windows."""
    genes = tagged_genes(stream, min_score).withWatermark("found_at", late).dropDuplicatesWithinWatermark(["mention_id"])
    return genes.groupBy(F.window("found_at", window), "name").agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct("pmid").alias("articles"))


def first_seen(stream: DataFrame) -> DataFrame:
    """Names with the time of their first mention, kept as state."""
    return stream.filter(F.col("name").isNotNull()).groupBy("etype", "name").agg(F.min("found_at").alias("first_seen"))
