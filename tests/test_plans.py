"""Physical plans: broadcast probe without shuffling the fact, pushdown, pruning, no Python."""


from sigscore.operators import cook_signals, select_score_inputs
from sigscore.plans.inspect import check_plan, plan_text
from sigscore.schemas import PARTITION_COLUMNS
from sigscore.session import scratch_path, unique_name
from sigscore.sinks import tables as W
from sigscore.sources import fixtures as X
from sigscore.sources.tables import scan_partition

from conftest import SF_SMALL


def test_cook_is_one_broadcast_probe(spark):
    df = cook_signals(X.raw_signals(spark, SF_SMALL), X.subtype_dim(spark))
    df.collect()  # the final adaptive plan carries the codegen stages
    text = check_plan(df, present=["BroadcastHashJoin", "LeftOuter", "isFinalPlan=true",
                                   "codegen id"],
                      absent=["BatchEvalPython", "ArrowEvalPython", "SortMergeJoin"])
    # The only exchange is the broadcast of the dimension: the fact is never shuffled.
    assert "Exchange hashpartitioning" not in text
    assert "BroadcastExchange" in text


def test_shuffle_join_equals_broadcast(spark):
    raw = X.raw_signals(spark, SF_SMALL)
    dim = X.subtype_dim(spark)
    a = cook_signals(raw, dim)
    b = cook_signals(raw, dim, broadcast_max_bytes=0)
    b.collect()
    check_plan(b, present=["SortMergeJoin"], absent=["BroadcastHashJoin"])
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    c = cook_signals(raw, dim, key_side="dim", broadcast_max_bytes=0)
    d = cook_signals(raw, dim, key_side="dim")
    assert c.exceptAll(d).count() == 0 and d.exceptAll(c).count() == 0


def test_measured_size_is_exact_and_bounded(spark):
    from sigscore.operators.sizing import fits_broadcast, measured_size
    df = spark.createDataFrame([(1, "ab", 2.0), (2, None, None), (3, "\u00e9", 1.0)],
                               "k long, s string, x double")
    row_fixed = 8 + 8 + 8 + 8  # header, long, string slot, double
    assert measured_size(df, 10_000) == (3, 3 * row_fixed + 2 + 0 + 2)  # é is 2 bytes
    assert measured_size(df, 3 * row_fixed + 3) is None  # one byte short
    assert fits_broadcast(df, 10_000) and not fits_broadcast(df, 0)
    assert not fits_broadcast(df, -1)
    nested = spark.createDataFrame([([1, 2],)], "a array<int>")
    assert measured_size(nested, 1000) == (1, 8 + 8 + len("[1,2]"))


def test_exchange_counts(spark):
    from sigscore.plans.inspect import exchange_count
    raw, dim = X.raw_signals(spark, SF_SMALL), X.subtype_dim(spark)
    assert exchange_count(cook_signals(raw, dim)) == 0
    # Past the budget: the fact and the dimension are each shuffled once on the key.
    assert exchange_count(cook_signals(raw, dim, broadcast_max_bytes=0)) == 2


def test_size_measure_sends_one_row_per_task(spark):
    from sigscore.operators.sizing import fits_broadcast
    assert not fits_broadcast(spark.range(0, 100_000, 1, 8), 1000)
    text = plan_text(spark.range(0, 100_000, 1, 8).groupBy().count())
    assert "Limit" not in text


def test_column_pruning_reaches_scan(spark):
    df = select_score_inputs(X.raw_signals(spark, SF_SMALL))
    text = plan_text(df)
    read_schema = [l for l in text.splitlines() if l.startswith("ReadSchema")][0]
    assert "props" not in read_schema and "user_id" not in read_schema
    assert "event_id" in read_schema and "value" in read_schema


def test_fixture_hour_scan_pushes_ts_range(spark):
    df = X.raw_signals(spark, SF_SMALL, "2024-01-02", 3)
    check_plan(df, present=["PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts,",
                            "LessThan(ts,"])


def test_partition_pruning_on_partitioned_table(spark):
    name = unique_name("t_raw")
    W.save_table(X.raw_signals(spark, SF_SMALL), name, fmt="parquet",
                 partition_by=PARTITION_COLUMNS, path=scratch_path(spark, name))
    df = scan_partition(spark, name, "2024-01-02", "03")
    text = check_plan(df, present=["PartitionFilters: [isnotnull(date", "(hour"])
    assert df.count() == X.raw_signals(spark, SF_SMALL, "2024-01-02", 3).count()
    # Pruning settles the predicate entirely: no row-level filter remains above the scan.
    assert "Filter (" not in text


def test_count_is_partial_then_final(spark):
    from sigscore.operators import count_rows
    text = plan_text(count_rows(X.raw_signals(spark, SF_SMALL)))
    assert text.count("HashAggregate") >= 2


def test_current_dimension_filter_reaches_the_scan(spark):
    from sigscore.operators import dim_current
    from sigscore.sources import read_dimension
    path = scratch_path(spark, "dim_parquet")
    X.subtype_dim(spark).write.parquet(path)
    df = dim_current(read_dimension(spark, spark.read.parquet(path)))
    check_plan(df, present=["PushedFilters: [IsNotNull(scd_is_active), "
                            "IsNotNull(scd_is_deleted), EqualTo(scd_is_active,1), "
                            "EqualTo(scd_is_deleted,0)]"])
    assert sorted(r.meta_past_id for r in df.collect()) == [1, 2, 4, 4]


def test_join_inner_alias_beyond_budget_equals_broadcast(spark):
    from sigscore.operators import join_inner_alias
    left = X.raw_signals(spark, SF_SMALL).select("root_id", "meta_past_id")
    dim = X.subtype_dim(spark)
    a = join_inner_alias(left, dim)
    b = join_inner_alias(left, dim, broadcast_max_bytes=0)
    assert a.columns == b.columns == ["root_id", "l_meta_past_id", "r_meta_past_id",
                                      "meta_pat_id", "meta_past_halflife", "scd_is_active",
                                      "scd_is_deleted"]
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    both = join_inner_alias(dim, dim)
    assert "l_meta_pat_id" in both.columns and "r_meta_pat_id" in both.columns


def test_partitioned_write_rebalance_is_optional(spark):
    from sigscore.sinks import tables as W
    cooked = cook_signals(X.raw_signals(spark, SF_SMALL), X.subtype_dim(spark))
    assert "REBALANCE_PARTITIONS_BY_COL" in plan_text(W._rebalanced(cooked, PARTITION_COLUMNS),
                                                      "simple")
    a, b = unique_name("t_reb"), unique_name("t_noreb")
    W.save_table(cooked, a, fmt="parquet", partition_by=PARTITION_COLUMNS,
                 path=scratch_path(spark, a))
    W.save_table(cooked, b, fmt="parquet", partition_by=PARTITION_COLUMNS,
                 path=scratch_path(spark, b), rebalance=False)
    ta, tb = spark.table(a), spark.table(b)
    assert ta.exceptAll(tb).count() == 0 and tb.exceptAll(ta).count() == 0
