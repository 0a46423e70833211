"""The Spark SQL functions equal the Column functions and are inlined (no Python, no UDF)."""

from pyspark.sql import functions as F

from sigscore.functions import add_ten, hfc, is_blank, normalise_text, score_expr, speedtest
from sigscore.functions.sql import register_sql_functions
from sigscore.plans.inspect import plan_text
from sigscore.sources import fixtures as X

from conftest import SF_SMALL


def test_sql_functions_equal_column_functions(spark):
    names = register_sql_functions(spark)
    assert set(names) >= {"speedtest_score", "hfc_score", "signal_score"}
    raw = X.raw_signals(spark, SF_SMALL)
    raw.createOrReplaceTempView("raw_for_sql")
    via_sql = spark.sql(
        "SELECT root_id, signal_score(technical_value, cust_relevance, meta_past_id) AS s, "
        "speedtest_score(technical_value * cust_relevance) AS st, "
        "hfc_score(technical_value * cust_relevance) AS h, "
        "add_ten(CAST(cpe_port_id AS INT)) AS t, is_blank(trigger) AS b, "
        "normalise_text(concat(' ', lower(trigger), '\\t')) AS n FROM raw_for_sql")
    x = F.col("technical_value") * F.col("cust_relevance")
    via_cols = raw.select(
        "root_id", score_expr().alias("s"), speedtest(x).alias("st"), hfc(x).alias("h"),
        add_ten(F.col("cpe_port_id").cast("int")).alias("t"), is_blank("trigger").alias("b"),
        normalise_text(F.concat(F.lit(" "), F.lower("trigger"), F.lit("\t"))).alias("n"))
    assert via_sql.exceptAll(via_cols).count() == 0 and via_cols.exceptAll(via_sql).count() == 0
    assert via_sql.where("n = trigger").count() == via_sql.count()
    text = plan_text(via_sql)
    assert "EvalPython" not in text and "ATAN" in text
