import math

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from popcorr.functions import kpi
from popcorr.operators.joins import salted_join_many


def ladder(r):
    if r is None or math.isnan(r):
        return "NEUTRAL"
    for name, bound in kpi.SIGNAL_LADDER:
        if r >= bound:
            return name
    return kpi.SIGNAL_BELOW_LADDER


@settings(max_examples=5, deadline=None)
@given(st.lists(st.one_of(st.none(), st.floats(min_value=-1.0, max_value=1.0),
                          st.sampled_from([0.5, 0.2, -0.2, -0.5, float("nan")])), min_size=1, max_size=200))
def test_signal_ladder_matches_reference_rule(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, r double")
    got = {r.i: r.s for r in df.select("i", kpi.signal_label("r").alias("s")).collect()}
    assert [got[i] for i in range(len(values))] == [ladder(v) for v in values]


def test_salted_join_equals_plain_join(spark):
    # one hot key holding most of the rows
    big = spark.range(5000).select(F.col("id"), F.when(F.col("id") < 3500, F.lit("HOT"))
                                   .otherwise((F.col("id") % 7).cast("string")).alias("k"))
    small = spark.range(40).select((F.col("id") % 8).cast("string").alias("k"), F.col("id").alias("v"))
    small = small.unionByName(spark.range(3).select(F.lit("HOT").alias("k"), F.col("id").alias("v")))
    plain = sorted(tuple(r) for r in big.join(small, "k").select("id", "k", "v").collect())
    salted = sorted(tuple(r) for r in salted_join_many(big, small, "k", ["id"], salts=16)
                    .select("id", "k", "v").collect())
    assert plain == salted and len(plain) > 0
