"""Micro-batch keyed upserts through Structured Streaming."""

from pyspark.sql import Row

from triad.streaming.upserts import read_latest, upsert_stream


def test_stream_upserts(spark, tmp_path):
    src = tmp_path / "src"
    schema = "id string, v long, t long"
    spark.createDataFrame([Row(id="a", v=1, t=1), Row(id="b", v=2, t=1)], schema).coalesce(1) \
        .write.parquet(str(src / "batch1"))
    spark.createDataFrame([Row(id="a", v=10, t=2), Row(id="a", v=11, t=3), Row(id="c", v=3, t=1)], schema) \
        .coalesce(1).write.parquet(str(src / "batch2"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1) \
        .option("recursiveFileLookup", "true").parquet(str(src))
    q = upsert_stream(stream, str(tmp_path / "table"), ["id"], ["v"], str(tmp_path / "ckpt"), order=["t"])
    q.awaitTermination(120)
    got = {r.id: (r.v, r.t) for r in read_latest(spark, str(tmp_path / "table")).collect()}
    assert got == {"a": (11, 3), "b": (2, 1), "c": (3, 1)}
