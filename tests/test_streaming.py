"""Row-local transforms apply unchanged to a streaming DataFrame."""

import time

from pyspark.sql import functions as F

from shroud.operators import transforms as P
from shroud.operators.generalize import trim_tails


def test_row_local_transforms_on_stream(spark, tmp_path):
    stream = (spark.readStream.format("rate").option("rowsPerSecond", 50).load()
              .select(F.col("value").cast("string").alias("v"),
                      F.concat(F.lit("2013-01-01T"), F.col("value").cast("string")).alias("t")))
    out = trim_tails(P.date_part_only(P.mark_value(stream, "v", "0"), "t"), "v", high=10)
    q = (out.writeStream.format("memory").queryName("shroud_stream_test")
         .option("checkpointLocation", str(tmp_path / "ck")).trigger(processingTime="1 second")
         .start())
    try:
        got = []
        for _ in range(30):
            time.sleep(1)
            got = spark.sql("SELECT * FROM shroud_stream_test").collect()
            if len(got) > 20:
                break
    finally:
        q.stop()
    assert got
    assert all(r["t_DI"] == "2013-01-01" for r in got)
    assert all(r["v_DI"] == ">= 10" for r in got if r["v"] not in ("zero",) and int(r["v"]) >= 10)
