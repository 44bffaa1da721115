"""What several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litengine.runtime import table

LISTS = ("genes_only_abstract", "genes_only_full_text")


def runs_once(spark, d: str, *columns: str) -> DataFrame:
    """Candidates with each run once: the latest delivery. The columns travel only once; rows without a run id are no runs.

    Deliveries differ in loaded_at alone, so the arrays are not part of the aggregate's key.
    """
    df = table(spark, d, "candidates").filter(F.col("run_id").isNotNull()).select("run_id", "loaded_at", *columns)
    return df.groupBy("run_id").agg(F.max_by(F.struct(*columns), F.struct(F.coalesce("loaded_at", F.timestamp_seconds(F.lit(0))).alias("l"))).alias("r")).select("run_id", "r.*")


def entries(spark, d: str, lists: tuple[str, ...] = LISTS) -> DataFrame:
    """(run_id, bucket, pos, value): every entry of the lists, nulls included, in its place."""
    runs = runs_once(spark, d, *lists)
    parts = F.array(*(F.struct(F.lit(n).alias("bucket"), F.col(n).alias("l")) for n in lists))
    return runs.select("run_id", F.explode(parts).alias("b")).select("run_id", "b.bucket", F.posexplode("b.l").alias("pos", "value"))


#: A key is hot if it holds more than one in SHARES of all rows, and at least HOT; there are fewer than SHARES such keys.
SHARES, HOT = 1_000, 10_000


def spread_join(many: DataFrame, few: DataFrame, keys: list[str], by: Column, how: str = "inner", counts: DataFrame | None = None, least: int = HOT) -> DataFrame:
    """many joined with few on keys that are never null; only hot keys are salted: their rows in `few` are copied as often as their rows in
    `many` need parts, and a row's part follows from the hash of `by`. counts: (keys…, n) of `many`, if they are there already."""
    counts = many.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")) if counts is None else counts
    limit = max((counts.agg(F.sum("n")).first()[0] or 0) / SHARES, least)
    hot = F.broadcast(counts.filter(F.col("n") > limit).select(*keys, F.ceil(F.col("n") / limit).cast("int").alias("__copies")))
    parts = many.join(hot, keys, "left").withColumn("__salt", F.coalesce(F.pmod(F.xxhash64(by), F.col("__copies")).cast("int"), F.lit(0))).drop("__copies")
    copies = few.join(hot, keys, "left").withColumn("__salt", F.explode(F.sequence(F.lit(0), F.coalesce("__copies", F.lit(1)) - 1))).drop("__copies")
    return parts.join(copies, [*keys, "__salt"], how).drop("__salt")
