"""The incremental job: two arrivals of raw files, processed with availableNow, equal the
batch result, and a restart from the checkpoint adds nothing twice."""

from pyspark.sql import functions as F

from sigscore.operators import cook_signals
from sigscore.schemas import SCORED_COLUMNS
from sigscore.session import scratch_path
from sigscore.sources import fixtures as X
from sigscore.streaming.hourly import read_raw_stream, start_cook_stream

from conftest import SF_SMALL


def test_incremental_equals_batch(spark):
    raw = X.raw_signals(spark, SF_SMALL)
    dim = X.subtype_dim(spark)
    landing, out, ckpt = (scratch_path(spark, n) for n in ("landing", "stream_out", "ckpt"))
    first = raw.where(F.col("date") < "2024-01-15")
    first.write.parquet(landing + "/batch=1")
    stream = read_raw_stream(spark, landing + "/*")
    start_cook_stream(stream, dim, out, ckpt).awaitTermination()
    raw.where(F.col("date") >= "2024-01-15").write.parquet(landing + "/batch=2")
    start_cook_stream(read_raw_stream(spark, landing + "/*"), dim, out, ckpt).awaitTermination()
    start_cook_stream(read_raw_stream(spark, landing + "/*"), dim, out, ckpt).awaitTermination()
    got = spark.read.parquet(out).select(*SCORED_COLUMNS)
    want = cook_signals(raw, dim)
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_stream_beyond_broadcast_budget(spark):
    from sigscore.streaming.hourly import cook_stream
    raw = X.raw_signals(spark, SF_SMALL)
    dim = X.subtype_dim(spark)
    landing, out, ckpt = (scratch_path(spark, n) for n in ("landing2", "stream_out2", "ckpt2"))
    raw.write.parquet(landing + "/batch=1")
    query = (cook_stream(read_raw_stream(spark, landing + "/*"), dim, broadcast_max_bytes=0)
             .writeStream.format("parquet").option("checkpointLocation", ckpt)
             .partitionBy("date", "hour").trigger(availableNow=True).start(out))
    query.awaitTermination()
    got = spark.read.parquet(out).select(*SCORED_COLUMNS)
    want = cook_signals(raw, dim)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
