"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is forced with the ``noop`` sink (full computation, nothing collected) unless it
is itself a write. The headline value is the published baseline's comparison point: score
20,000,000 generated string signals with the speed-test curve and overwrite a two-column
table, timing only the write action (input staged as a Parquet table beforehand).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from sigscore import registry as R  # noqa: E402
from sigscore.operators import (cook_signals, count_rows, dim_duplicate_keys,  # noqa: E402
                                lookup_halflife, score_signals, score_simple)
from sigscore.plans.job import JobConfig, run_hour  # noqa: E402
from sigscore.schemas import PARTITION_COLUMNS, SCORED_SCHEMA  # noqa: E402
from sigscore.session import build_session, scratch_path, unique_name  # noqa: E402
from sigscore.sinks import tables as W  # noqa: E402
from sigscore.sources import fixtures as X  # noqa: E402
from sigscore.sources.generator import generate_signals  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
BASELINE_ROWS = int(os.environ.get("BENCH_BASELINE_ROWS", "20000000"))
# Optional: a folder for Spark's event log (stage and task times, read offline; no UI).
EVENT_LOG_DIR = os.environ.get("BENCH_EVENT_LOG_DIR")


def _sf_value(path: str) -> float | str:
    tail = os.path.basename(path)
    try:
        return float(tail.replace("sf", ""))
    except ValueError:
        return tail


def generated_events(spark, n: int, parts: int):
    """``events``-shaped rows for the large-scale runs of the flagship (bench only).

    30 days of timestamps; one event type ("view", subtype 2) holds a third of all rows, the
    rest spread over the other four, so the hot-key path has something to split.
    """
    ident = F.col("id")
    others = F.array(*[F.lit(t) for t in ("click", "purchase", "signup", "error")])
    hot = F.pmod(F.xxhash64(ident), F.lit(3)) == 0
    return spark.range(0, n, 1, parts).select(
        ident.alias("event_id"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
         + F.make_dt_interval(secs=F.pmod(ident * 7919, F.lit(30 * 86400)).cast("int")))
        .alias("ts"),
        F.pmod(ident, F.lit(100_003)).alias("user_id"),
        F.when(hot, F.lit("view"))
        .otherwise(F.element_at(others, (F.pmod(F.xxhash64(ident, F.lit(1)), F.lit(4)) + 1)
                                .cast("int"))).alias("event_type"),
        F.round(F.rand(3) * 490, 2).alias("value"))


def _noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def _timed(fn) -> float:
    t0 = time.perf_counter()
    fn()
    return round(time.perf_counter() - t0, 3)


def main() -> None:
    extra = ({"spark.eventLog.enabled": "true", "spark.eventLog.dir": EVENT_LOG_DIR}
             if EVENT_LOG_DIR else None)
    spark = build_session(f"local[{CPUS}]", max(CPUS, 8), "sigscore-bench", extra)
    dim = X.subtype_dim(spark)
    raw = X.raw_signals(spark, SF_DIR)
    times: dict[str, float] = {}

    _noop(cook_signals(X.raw_signals(spark, SF_DIR), dim))  # warm-up (JIT, file listing)

    times["cook_signals"] = _timed(lambda: _noop(cook_signals(raw, dim)))
    times["score_signals"] = _timed(lambda: _noop(score_signals(raw)))
    times["scan_partition"] = _timed(lambda: _noop(
        X.raw_signals(spark, SF_DIR, R.PART_DATE, R.PART_HOUR)))
    times["count_rows"] = _timed(lambda: count_rows(raw).collect())
    times["lookup_halflife"] = _timed(lambda: lookup_halflife(dim, raw).collect())
    times["dim_duplicate_keys"] = _timed(lambda: dim_duplicate_keys(dim, raw).collect())
    simple_str = X.simple_signals(spark, SF_DIR, as_strings=True)
    times["score_simple"] = _timed(lambda: _noop(score_simple(simple_str)))

    def save_cooked():
        name = unique_name("bench_cooked")
        W.save_table(cook_signals(raw, dim), name, fmt="parquet", path=scratch_path(spark, name))
    times["save_table"] = _timed(save_cooked)

    def append_partitioned():
        name = unique_name("bench_part")
        W.create_table(spark, name, SCORED_SCHEMA, "parquet", PARTITION_COLUMNS,
                       scratch_path(spark, name))
        W.append(spark, cook_signals(raw, dim), name)
    times["append_partitioned"] = _timed(append_partitioned)

    # The hourly job on a staged raw table (staging not timed).
    raw_name = unique_name("bench_raw")
    W.save_table(raw, raw_name, fmt="parquet", partition_by=PARTITION_COLUMNS,
                 path=scratch_path(spark, raw_name))
    target = unique_name("bench_target")
    W.create_table(spark, target, SCORED_SCHEMA, "parquet", PARTITION_COLUMNS,
                   scratch_path(spark, target))
    cfg = JobConfig(source_table=raw_name, target_table=target, dimension=dim)
    times["run_hour"] = _timed(lambda: run_hour(spark, cfg, R.PART_DATE, R.PART_HOUR))

    def score_and_save(source: str) -> None:
        name = unique_name("bench_scored")
        W.score_and_save(spark.table(source), name, path=scratch_path(spark, name))

    sf_strings = unique_name("bench_simple_str")
    W.save_table(simple_str, sf_strings, path=scratch_path(spark, sf_strings))
    times["score_and_save_sf"] = _timed(lambda: score_and_save(sf_strings))

    # The flagship at 20 M rows: raw signals staged as a table (not timed), then the job's
    # transform (read, score, join) into the noop sink or a Parquet table.
    big_name = unique_name("bench_big_raw")
    W.save_table(X.raw_signals_from_events(generated_events(spark, BASELINE_ROWS, CPUS * 2)),
                 big_name, path=scratch_path(spark, big_name))
    big_raw = spark.table(big_name)
    times["cook_signals_20m"] = _timed(lambda: _noop(cook_signals(big_raw, dim)))
    times["cook_signals_20m_skew_split"] = _timed(lambda: _noop(
        cook_signals(big_raw, dim, broadcast_max_bytes=0)))

    def save_big():
        name = unique_name("bench_big_cooked")
        W.save_table(cook_signals(big_raw, dim), name, fmt="parquet",
                     path=scratch_path(spark, name))
    times["cook_and_save_20m"] = _timed(save_big)

    gen_name = unique_name("bench_generated")
    W.save_table(generate_signals(spark, BASELINE_ROWS, seed=5, num_partitions=CPUS * 2,
                                  as_strings=True),
                 gen_name, path=scratch_path(spark, gen_name))
    runs = [_timed(lambda: score_and_save(gen_name)) for _ in range(2)]
    headline = min(runs)
    times["score_and_save_20m"] = headline

    print(json.dumps({
        "metric": "score_and_save_20M_rows_write_sec",
        "value": headline,
        "unit": "sec",
        "rows": BASELINE_ROWS,
        "rows_per_sec": round(BASELINE_ROWS / headline) if headline else None,
        "cores": CPUS,
        "baseline_sec": 13,
        "score_and_save_runs": runs,
        "queries": times,
        "sf": _sf_value(SF_DIR),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
