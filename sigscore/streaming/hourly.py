"""The scoring job as an incremental Structured Streaming query.

Instead of an external scheduler calling the batch job once per hour, new raw files are picked
up as they land. ``start_cook_batches`` re-reads and re-measures the dimension for every micro-batch,
which is a batch job then with its own choice of join, and appends each batch once to a table.
``start_cook_stream`` plans one stream-static join when it starts (the dimension's size is judged
then; its rows are read again in each micro-batch), written by the Parquet file sink partitioned by ``date, hour``. The file sink's log
makes the output exactly-once across restarts and lost executors; ``available_now`` processes
whatever is there and stops, which is how an hourly trigger runs it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sigscore.functions.curves import Curve
from sigscore.operators.enrich import cook_signals, enrich_halflife, score_signals
from sigscore.operators.dimension import dim_current
from sigscore.operators.sizing import DEFAULT_BROADCAST_MAX_BYTES
from sigscore.schemas import PARTITION_COLUMNS, RAW_SCHEMA
from sigscore.sinks.tables import append_once


def read_raw_stream(spark: SparkSession, path: str, schema: T.StructType = RAW_SCHEMA,
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """Raw signal files (Parquet) under ``path`` as a stream; the schema is declared."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(path)


def cook_stream(raw_stream: DataFrame, dim: DataFrame, key_side: str = "fact",
                curves: Mapping[int, Curve] | None = None,
                broadcast_max_bytes: int = DEFAULT_BROADCAST_MAX_BYTES) -> DataFrame:
    """Streaming counterpart of ``cook_signals``.

    The dimension is a static (batch) frame: its bounded size check runs once when the query
    is defined, and the join is a stream-static broadcast probe (no shuffle of the stream).
    Beyond the budget the stream is shuffle-joined with the static side.
    """
    return enrich_halflife(score_signals(raw_stream, curves), dim_current(dim), key_side,
                           broadcast_max_bytes)


def start_cook_stream(raw_stream: DataFrame, dim: DataFrame, output_path: str,
                      checkpoint_path: str, key_side: str = "fact",
                      available_now: bool = True,
                      processing_time: str | None = None,
                      on_start: Callable[[StreamingQuery], None] | None = None
                      ) -> StreamingQuery:
    """Start the incremental job writing Parquet partitioned by ``date, hour``."""
    writer = (cook_stream(raw_stream, dim, key_side).writeStream
              .format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint_path)
              .partitionBy(*PARTITION_COLUMNS))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    query = writer.start(output_path)
    if on_start:
        on_start(query)
    return query


def start_cook_batches(raw_stream: DataFrame, read_dim: Callable[[SparkSession], DataFrame], table: str,
                       checkpoint_path: str, name: str = "cook", key_side: str = "fact",
                       curves: Mapping[int, Curve] | None = None,
                       broadcast_max_bytes: int = DEFAULT_BROADCAST_MAX_BYTES,
                       available_now: bool = True, processing_time: str | None = None) -> StreamingQuery:
    """Start the incremental job with the dimension read per micro-batch, into a table that
    ``create_batched_table`` made.

    Each micro-batch calls ``read_dim``, measures what it gets and joins as the batch job would: a
    dimension that outgrows the broadcast budget between two batches is shuffle-joined from then
    on. A batch is known by ``name`` and its number; one that is replayed is not appended again.
    """
    def cook(batch: DataFrame, number: int) -> None:
        dim = read_dim(batch.sparkSession)
        append_once(cook_signals(batch, dim, key_side, curves, broadcast_max_bytes), table,
                    f"{name}-{number:012d}")

    writer = raw_stream.writeStream.foreachBatch(cook).option("checkpointLocation", checkpoint_path)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
