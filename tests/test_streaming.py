from pyspark.sql import functions as F

from litengine.operators.literature import tagged_genes
from litengine.streaming.mentions import mention_counts


def test_stream_equals_batch(spark, sf, tmp_path):
    schema = spark.read.parquet(f"{sf}/mentions.parquet").schema
    (tmp_path / "in").mkdir()
    spark.read.parquet(f"{sf}/mentions.parquet").orderBy("found_at").coalesce(1).write.mode("overwrite").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    q = mention_counts(stream, late="3650 days").writeStream.outputMode("update").format("memory").queryName("counts").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    got = spark.table("counts").groupBy("name").agg(F.sum("n").alias("n"))
    want = tagged_genes(spark.read.schema(schema).parquet(str(tmp_path / "in"))).filter("found_at is not null").dropDuplicates(["mention_id"]).groupBy("name").agg(F.count(F.lit(1)).alias("n"))
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in want.collect()}
