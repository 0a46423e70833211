"""Swap on success, reversible text, batches appended once, quarantine, checked loads, sized files,
and the plans of the split curves, the cooked preview and the dimension filter."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF_SMALL
from sigscore.functions.text import escape_breaks, unescape_breaks
from sigscore.operators import cook_signals, preview_cooked, preview_rows, with_score_by_subtype
from sigscore.operators.sizing import lookup_join, within_keys
from sigscore.plans.inspect import plan_text
from sigscore.registry import saturating_curve
from sigscore.schemas import SCORED_COLUMNS, SCORED_SCHEMA, SIMPLE_SCHEMA
from sigscore.session import scratch_path, unique_name
from sigscore.sinks import tables as W
from sigscore.sources import delimited as D
from sigscore.sources import fixtures as X

def boom(kind):
    return F.raise_error(F.lit("simulated failure")).cast(kind)



def _ids(spark, lo, hi, **more):
    df = spark.range(lo, hi)
    return df.select("id", *[v.alias(k) for k, v in more.items()])


def _folders(spark, path):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return sorted(x.getPath().getName() for x in fs.listStatus(p)) if fs.exists(p) else []


# ---------------------------------------------------------------- swap on success
@pytest.mark.parametrize("fmt, parts, external", [("parquet", (), True), ("orc", ("k",), True),
                                                  ("csv", (), False), ("parquet", ("k",), False)])
def test_failed_replacement_leaves_the_old_table(spark, fmt, parts, external):
    name = unique_name("t_swap")
    path = scratch_path(spark, name) if external else None
    k = (F.col("id") % 3).cast("int")
    W.save_table(_ids(spark, 0, 50, k=k), name, fmt=fmt, partition_by=parts, path=path)
    # fails in the last task, after others have written their files
    bad = _ids(spark, 0, 5000, k=k).withColumn("id", F.when(F.col("id") == 4999, boom("long"))
                                               .otherwise(F.col("id")))
    with pytest.raises(Exception, match="simulated failure"):
        W.save_table(bad, name, fmt=fmt, partition_by=parts, path=path)
    assert spark.table(name).agg(F.sum("id"), F.count("*")).first() == (1225, 50)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith(name + "__")]
    W.save_table(_ids(spark, 50, 60, k=k), name, fmt=fmt, partition_by=parts, path=path)
    assert sorted(r["id"] for r in spark.table(name).collect()) == list(range(50, 60))
    if external:
        assert len(_folders(spark, path)) == 1  # the version before is gone


def test_replacement_may_read_what_it_replaces_and_change_its_shape(spark):
    name = unique_name("t_self")
    W.save_table(_ids(spark, 0, 10), name, path=scratch_path(spark, name))
    W.save_table(spark.table(name).select((F.col("id") * 2).alias("twice")), name, fmt="orc")
    assert spark.table(name).columns == ["twice"]
    assert spark.table(name).agg(F.sum("twice")).first()[0] == 90


def test_driver_lost_between_the_two_names(spark):
    name = unique_name("t_lost")
    W.save_table(_ids(spark, 0, 10), name)
    W._rename(spark, name, f"{name}__prev")        # ... and no further
    W.finish_swap(spark, name)
    assert spark.table(name).count() == 10
    W.save_table(_ids(spark, 0, 3), f"{name}__prev")
    W.save_table(_ids(spark, 0, 7), name)          # the new one has the name: the old one goes
    assert spark.table(name).count() == 7 and not spark.catalog.tableExists(f"{name}__prev")


# ---------------------------------------------------------------- reversible text
TEXTS = [None, "", " ", "\n", "\r", "\r\n", "\\", "\\n", "\\\\n", "\\\\\n", "\\N", "\\r\\", '"', '""', '"a","b"\n',
         ",", " edge ", "\ttab\t", "a\nb\rc\\", "é漢\u2028\u0085", "'", "#", "\\\\", "n", "\\s"]


def test_codec_round_trip(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string")
    escaped = df.select("i", "t", escape_breaks("t").alias("e"))
    for r in escaped.select("t", "e", unescape_breaks("e").alias("back")).collect():
        assert r["back"] == r["t"] and "\n" not in (r["e"] or "") and "\r" not in (r["e"] or "")


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.none() | st.text(alphabet='\\nrN\n\r", \t\'#é', max_size=8),
                          st.none() | st.text(alphabet="\\N\n\" a", max_size=5)), min_size=1, max_size=40))
def test_any_text_round_trips_in_files(spark, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, t string, u string")
    path = scratch_path(spark, "texts")
    W.write_csv_files(df, path, partition_by=())
    assert sorted(map(tuple, W.read_csv_files(spark, path, df.schema).collect())) == \
        [(i, *r) for i, r in enumerate(rows)]
    assert spark.read.text(path).count() == len(rows)  # a record is a line


def test_text_round_trips_in_csv_tables(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string")
    want = sorted(enumerate(TEXTS))
    made, created = unique_name("t_csv"), unique_name("t_csv")
    W.save_table(df.where("i % 2 = 0"), made, fmt="csv")
    W.append(spark, df.where("i % 2 = 1"), made)
    assert sorted(map(tuple, W.read_table(spark, made).collect())) == want
    W.create_table(spark, created, df.schema, "csv", ())
    W.overwrite_rows(spark, df, created)
    W.overwrite_rows(spark, W.read_table(spark, made), created)
    assert sorted(map(tuple, W.read_table(spark, created).collect())) == want


# ---------------------------------------------------------------- batches, loads, quarantine
def _cooked(spark):
    raw = X.raw_signals(spark, SF_SMALL).where(F.col("date") < dt.date(2024, 1, 3))
    return cook_signals(raw, X.subtype_dim(spark))


def test_a_batch_is_appended_once_whatever_happens_between(spark):
    name = unique_name("t_once")
    W.create_batched_table(spark, name, SCORED_SCHEMA, location=scratch_path(spark, name))
    cooked = _cooked(spark)
    n = cooked.count()
    assert W.append_once(cooked, name, "7") == n > 0
    assert W.append_once(cooked, name, "7") == 0
    W.overwrite_rows(spark, cooked.withColumn("batch", F.lit("8")), name)  # written, never committed
    assert W.append_once(cooked, name, "8") == n
    with pytest.raises(Exception):
        W.append_once(cooked.withColumn("score", boom("double")), name, "9")
    assert W.append_once(cooked.limit(3), name, "9") == 3
    assert spark.table(name).count() == 2 * n + 3
    assert {(r["batch"], r["rows"]) for r in spark.table(f"{name}__batches").collect()} == \
        {("7", n), ("8", n), ("9", 3)}


def test_load_of_a_partition_checks_its_counts(spark):
    name = unique_name("t_load")
    W.create_table(spark, name, SCORED_SCHEMA, "parquet", location=scratch_path(spark, name))
    hour = _cooked(spark).where((F.col("date") == dt.date(2024, 1, 2)) & (F.col("hour") == 5))
    staged, n = scratch_path(spark, "staged"), hour.count()
    W.write_csv_files(hour.drop("date", "hour"), staged, partition_by=())
    assert D.load_csv_partition(spark, staged, name, "2024-01-02", 5, ours=True) == n > 0
    spark.createDataFrame([("too,few",)], "value string").write.mode("append").text(staged)
    with pytest.raises(ValueError, match=f"{n + 1} lines"):
        D.load_csv_partition(spark, staged, name, "2024-01-02", 5, mode="DROPMALFORMED")
    assert spark.table(name).count() == n


def test_quarantine_keeps_every_record(spark):
    lines = ["1,2,3", "4,5,6", "7,8", "9,10,11,12", "x,1,2", "", "13,,15"]
    path, aside = scratch_path(spark, "mixed"), scratch_path(spark, "aside")
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(path)
    name = unique_name("t_good")
    W.create_table(spark, name, SIMPLE_SCHEMA, "parquet", ())
    assert D.load_csv_quarantine(spark, path, name, aside) == (3, 3)
    assert sorted(map(tuple, spark.table(name).collect())) == [(1, 2, 3), (4, 5, 6), (13, None, 15)]
    bad = {r[0] for r in D.read_quarantine(spark, SIMPLE_SCHEMA, aside).collect()}
    assert bad == {"7,8", "9,10,11,12", "x,1,2"}


def test_compaction_touches_only_scattered_partitions(spark):
    name = unique_name("t_compact")
    W.create_table(spark, name, SCORED_SCHEMA, "parquet", location=scratch_path(spark, name))
    cooked = _cooked(spark).where(F.col("hour") < 4)
    one = (F.col("date") == dt.date(2024, 1, 1)) & (F.col("hour") == 1)
    W.append(spark, cooked, name)
    W.append(spark, cooked.where(one), name)
    files = spark.table(name).groupBy("date", "hour").agg(
        F.count_distinct("_metadata.file_path").alias("n"), F.min("_metadata.file_path").alias("f"))
    before = {tuple(r)[:2]: r["f"] for r in files.where("n = 1").collect()}
    assert files.where("n > 1").count() == 1
    rows = sorted(map(str, spark.table(name).collect()))
    assert W.compact(spark, name) == 1 and W.compact(spark, name) == 0
    spark.catalog.refreshTable(name)
    assert sorted(map(str, spark.table(name).collect())) == rows
    after = {tuple(r)[:2]: r["f"] for r in spark.table(name).groupBy("date", "hour").agg(
        F.min("_metadata.file_path").alias("f")).collect()}
    assert all(after[k] == f for k, f in before.items())


# ---------------------------------------------------------------- stream, curves, preview, filter
def test_dimension_may_outgrow_the_budget_between_batches(spark, monkeypatch):
    from sigscore.operators import enrich
    from sigscore.streaming.hourly import read_raw_stream, start_cook_batches
    joins = []

    def seen(fact, dim, *a, **k):
        out = lookup_join(fact, dim, *a, **k)
        joins.append("Broadcast" in plan_text(out, "simple"))
        return out

    monkeypatch.setattr(enrich, "lookup_join", seen)
    raw, dim = X.raw_signals(spark, SF_SMALL), X.subtype_dim(spark)
    grown = dim.unionByName(spark.range(1000, 3000).select(
        *[F.col("id").cast(f.dataType).alias(f.name) if f.name == "meta_past_id" else
          F.lit(1 if f.name == "scd_is_active" else 0).cast(f.dataType).alias(f.name)
          for f in dim.schema.fields]))
    landing, ckpt, name = scratch_path(spark, "land"), scratch_path(spark, "ck"), unique_name("t_stream")
    W.create_batched_table(spark, name, SCORED_SCHEMA, location=scratch_path(spark, name))
    for i, (part, read) in enumerate([("root_id % 2 = 0", lambda s: dim), ("root_id % 2 = 1", lambda s: grown)]):
        raw.where(part).write.parquet(f"{landing}/b={i}")
        start_cook_batches(read_raw_stream(spark, f"{landing}/*"), read, name, ckpt,
                           broadcast_max_bytes=1000).awaitTermination()
    assert joins == [True, False]
    got, want = spark.table(name).select(*SCORED_COLUMNS), cook_signals(raw, dim)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_python_curves_see_only_their_subtype(spark):
    path = scratch_path(spark, "raw_curves")
    X.raw_signals(spark, SF_SMALL).write.parquet(path)
    raw = spark.read.parquet(path)
    scored = with_score_by_subtype(raw, {3: saturating_curve})
    assert scored.count() == raw.count()
    text = plan_text(scored)
    assert text.count("ArrowEvalPython") >= 1 and "EqualTo(meta_past_id,3)" in text and "Exchange" not in text
    eaten = spark.sparkContext.accumulator(0)

    @F.pandas_udf("double")
    def counting(x):
        eaten.add(len(x))
        return x

    with_score_by_subtype(raw, {3: counting}).agg(F.sum("score")).collect()
    assert eaten.value == raw.where("meta_past_id = 3 AND technical_value IS NOT NULL "
                                    "AND cust_relevance IS NOT NULL").count() > 0


def test_preview_joins_only_the_first_signals(spark):
    path = scratch_path(spark, "raw_preview")
    X.raw_signals(spark, SF_SMALL).write.parquet(path)
    raw, dim = spark.read.parquet(path), X.subtype_dim(spark)
    got = preview_cooked(raw, dim, n=20)
    want = preview_rows(cook_signals(raw, dim), ["root_id", "meta_past_halflife"], 20)
    assert got.collect() == want.collect()
    assert "LessThanOrEqual(root_id," in plan_text(got)
    assert preview_cooked(raw.limit(5), dim, n=20).count() >= 5
    ties = raw.limit(30).withColumn("root_id", F.lit(None).cast("long"))
    assert preview_cooked(ties, dim, n=20).count() == 20


def test_dimension_beyond_the_budget_is_cut_to_the_facts_keys(spark):
    path = scratch_path(spark, "big_dim")
    spark.range(0, 100_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v")).write.parquet(path)
    dim = spark.read.parquet(path)
    fact = spark.range(50).select((F.col("id") % 7 + 40_000).alias("f")).unionAll(
        spark.range(1).select(F.lit(None).cast("long")))
    joined = lookup_join(fact, dim, "f", "k", broadcast_max_bytes=0)
    assert "In(k" in plan_text(joined) or "k IN" in plan_text(joined)
    assert joined.count() == 51 and joined.where("v = 2 * f").count() == 50
    assert within_keys(dim, "k", fact, "f").count() == 7
    many = spark.range(5000).select((F.col("id") + 20_000).alias("f"))
    assert within_keys(dim, "k", many, "f").count() == 5000
    assert "GreaterThanOrEqual(k,20000)" in plan_text(within_keys(dim, "k", many, "f"))
    assert within_keys(dim, "k", fact.limit(0), "f").count() == 0
