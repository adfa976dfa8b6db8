from pyspark.sql import functions as F

from ledgerlens.functions.columns import ratio_band, safe_ratio
from ledgerlens.operators.lookup import map_values
from ledgerlens.operators.quantiles import Cut, bin_columns


def test_row_wise_steps_take_a_stream(spark, tmp_path):
    df = spark.createDataFrame([(1, " a", 5.0, 10.0), (2, "z", 0.0, 3.0)], "i int, k string, x double, y double")
    df.write.parquet(str(tmp_path / "in"))
    mapping = spark.createDataFrame([("a", "A", 1.0, "FIRST")], "raw string, clean string, n double, to string")

    def steps(frame):
        frame = map_values(frame, "k", mapping, "clean", "to", "g")
        frame = bin_columns(frame, {"x": Cut(1)}, edges={"x": [0.0, 9.0]})
        return frame.withColumn("band", ratio_band(safe_ratio(F.col("x"), F.col("y"))))

    stream = steps(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")))
    q = stream.writeStream.format("memory").queryName("rows_out").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    key = lambda r: r["i"]
    assert sorted(spark.table("rows_out").collect(), key=key) == sorted(steps(df).collect(), key=key)
