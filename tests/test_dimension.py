"""Dimension operators on the versioned subtype rows."""

from sigscore.operators import (dim_columns, dim_columns_wide, dim_current, dim_duplicate_keys,
                                lookup_halflife, select_columns)
from sigscore.sources import fixtures as X

from conftest import SF_SMALL


def test_dimension_projections(spark):
    dim = X.subtype_dim(spark)
    assert dim_columns(dim).columns == ["meta_past_id", "meta_past_halflife", "scd_is_active",
                                        "scd_is_deleted"]
    assert dim_columns_wide(dim).columns == ["meta_past_id", "meta_pat_id",
                                             "meta_past_halflife", "scd_is_active",
                                             "scd_is_deleted"]
    assert select_columns(dim, ["scd_is_deleted", "meta_past_id"]).columns == [
        "scd_is_deleted", "meta_past_id"]


def test_current_versions(spark):
    rows = sorted(tuple(r) for r in dim_current(X.subtype_dim(spark))
                  .select("meta_past_id", "meta_past_halflife").collect())
    assert rows == [(1, 24), (2, 48), (4, 12), (4, 36)]


def test_lookup_by_list_and_by_frame_agree(spark):
    dim = X.subtype_dim(spark)
    by_list = sorted((tuple(r) for r in lookup_halflife(dim, [2, 3, 4, 9, 2]).collect()),
                     key=repr)
    assert by_list == sorted([(2, 48), (3, None), (4, 12), (4, 36), (9, None)], key=repr)
    ids = spark.createDataFrame([(2,), (3,), (4,), (9,), (2,)], "meta_past_id bigint")
    assert sorted((tuple(r) for r in lookup_halflife(dim, ids).collect()), key=repr) == by_list


def test_duplicate_keys(spark):
    dim = X.subtype_dim(spark)
    assert [tuple(r) for r in dim_duplicate_keys(dim).collect()] == [(4, 2)]
    raw = X.raw_signals(spark, SF_SMALL)
    n4 = raw.where("meta_past_id = 4").count()
    got = dim_duplicate_keys(dim, raw).collect()
    assert [tuple(r) for r in got] == [(4, 2, n4, n4)]
