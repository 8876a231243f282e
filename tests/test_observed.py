"""Counts that come out of a write: equal to counting, in one scan; and of a stream, batch by batch."""

from pyspark.sql import functions as F

from docgraph.sinks.observed import Listener, metrics, observed

def axes():
    return {"kind": (F.col("kind"), ["a", "b"]), "via": (F.col("via"), ["x"])}


ROWS = [("a", "x"), ("a", None), ("c", "x"), (None, "y"), ("b", "x")]
WANT = {"rows": 5, "kind=a": 2, "kind=b": 1, "kind=*": 2, "via=x": 3, "via=*": 2}


def test_counts_of_one_scan(spark, tmp_path):
    read = spark.sparkContext.accumulator(0)

    def counting(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    df = spark.createDataFrame(ROWS * 100, "kind string, via string").mapInArrow(counting, "kind string, via string")
    df, counts = observed(df, axes())
    df.write.parquet(f"{tmp_path}/t")
    assert counts() == {k: 100 * v for k, v in WANT.items()} and read.value == 500
    empty, counts = observed(df.where("false"), axes())
    empty.write.parquet(f"{tmp_path}/e")
    assert set(counts().values()) == {0}


def test_counts_of_a_stream(spark, tmp_path):
    told = Listener("pages")
    spark.streams.addListener(told)
    try:
        for _ in range(2):
            spark.createDataFrame(ROWS, "kind string, via string").write.mode("append").parquet(f"{tmp_path}/in")
            rows = spark.readStream.schema("kind string, via string").parquet(f"{tmp_path}/in").observe("pages", *metrics(axes()))
            rows.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start().awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        assert told.counts() == {k: 2 * v for k, v in WANT.items()}
    finally:
        spark.streams.removeListener(told)
