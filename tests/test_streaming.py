from pyspark.sql import functions as F

from vectable.functions.embedders import counts_of
from vectable.operators.ingest import bucket_of
from vectable.streaming.ingest import upsert_stream
from vectable.table import VectorTable

TABLE = VectorTable(dims=2)
SCHEMA = "id string, text string, metadata struct<lang string>, ord long"


def test_stream_ends_in_the_same_table_as_one_batch(spark, tmp_path):
    source, path, checkpoint = str(tmp_path / "in"), str(tmp_path / "t"), str(tmp_path / "c")
    first = spark.createDataFrame([("a", "one", ("en",), 1), ("b", "two", ("en",), 1), ("b", "two!", ("de",), 2), ("x", None, ("en",), 1)], SCHEMA)
    empty = first.limit(0).drop("ord").withColumn("embedding", F.array().cast("array<float>"))
    empty.withColumn("bucket", bucket_of(TABLE, 4)).write.parquet(path)
    schema = first.schema

    def run():
        query = upsert_stream(
            spark.readStream.schema(schema).parquet(source), path, TABLE, 4, checkpoint, str(tmp_path / "r"), model=counts_of(".", "e"), order="ord"
        )
        assert query.awaitTermination(120) and query.exception() is None
        return {r.id: (r.text, list(r.embedding)) for r in spark.read.parquet(path).collect()}

    first.write.parquet(source)
    assert run() == {"a": ("one", [3.0, 1.0]), "b": ("two!", [4.0, 0.0])}
    spark.createDataFrame([("b", "changed", ("en",), 3), ("c", "three", ("en",), 1)], SCHEMA).write.mode("append").parquet(source)
    assert run() == {"a": ("one", [3.0, 1.0]), "b": ("changed", [7.0, 1.0]), "c": ("three", [5.0, 2.0])}
    assert run().keys() == {"a", "b", "c"}
    refused = spark.read.parquet(str(tmp_path / "r"))
    assert [(r.id, r.reason) for r in refused.collect()] == [("x", "neither text nor vector")]
