from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sigscore.functions.text import is_blank, normalise_text, trim_blanks
from sigscore.plans.job import is_blank_arg, normalise_arg

NBSP = " "
LINE_SEP = " "


def test_is_blank(spark):
    vals = [None, "", "   ", "\t\n", " x ", NBSP, "a", "\x00\x1f "]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = [r[0] for r in df.select(is_blank("s")).collect()]
    # U+00A0 is above U+0020: not blank, as with a JVM String.trim.
    assert got == [True, True, True, True, False, False, False, True]
    assert [is_blank_arg(v) for v in vals] == got


def test_normalise_text(spark):
    vals = [" dev ", "\tTest\n", "na", "a " + NBSP, "x " + LINE_SEP, "  "]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = [r[0] for r in df.select(normalise_text(F.col("s"))).collect()]
    # Only characters up to U+0020 are stripped, and only at the very ends.
    assert got == ["DEV", "TEST", "NA", "A " + NBSP, "X " + LINE_SEP, ""]
    assert [normalise_arg(v) for v in vals] == got


_BLANKS = "".join(chr(c) for c in range(0x21))
texts = st.text(alphabet=st.one_of(st.sampled_from(list(_BLANKS + "  \u0085 ")),
                                   st.characters(blacklist_categories=("Cs",))),
                max_size=30)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.one_of(st.none(), texts), min_size=1, max_size=40))
def test_trim_and_blank_match_python(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = df.select(trim_blanks("s").alias("t"), is_blank("s").alias("b")).collect()
    for v, row in zip(values, got):
        if v is None:
            assert row.t is None and row.b is True
        else:
            assert row.t == v.strip(_BLANKS), repr(v)
            assert row.b == (v.strip(_BLANKS) == ""), repr(v)
