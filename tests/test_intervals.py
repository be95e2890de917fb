import pytest
from compare import duck, same
from pyspark.sql import functions as F

from lectern.operators import intervals as iv
from lectern.plans import intervals as plan


def frame(spark, rows):
    df = spark.createDataFrame(rows, "g string, b_s double, e_s double")
    return df.select("g", iv.millis(F.col("b_s")).alias("b"), iv.millis(F.col("e_s")).alias("e"), F.lit(1).alias("_t"))


def got(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("bucket", [1, 1000, iv.BUCKET_MS])
def test_edge_cases(spark, bucket):
    nan, inf = float("nan"), float("inf")
    df = frame(spark, [("a", 0.0, 1.0), ("a", 1.0, 2.0), ("a", 3.0, 9.0), ("a", 4.0, 5.0), ("a", 3.0, 9.0), ("a", 12.0, 13.0),
                       ("a", None, 11.0), ("a", 11.0, None), ("a", 11.0, 10.0), ("a", 10.5, 10.5), ("a", nan, 11.0), ("a", 9.0, inf),
                       ("b", 5.0, 5.0), (None, 0.0, 1.0), (None, 2.0, 3.0), ("c", 1.0, 2.0)])
    assert got(iv.gaps(df, ["g"], "b", "e", bucket)) == sorted([("a", 2000, 3000), ("a", 9000, 12000), (None, 1000, 2000)], key=repr)
    assert got(iv.periods(df, ["g"], "b", "e", bucket)) == sorted(
        [("a", 0, 2000), ("a", 3000, 9000), ("a", 12000, 13000), (None, 0, 1000), (None, 2000, 3000), ("c", 1000, 2000)], key=repr
    )


def test_empty(spark):
    df = frame(spark, [])
    assert got(iv.gaps(df, ["g"], "b", "e")) == [] == got(iv.periods(df, ["g"], "b", "e"))


@pytest.mark.parametrize("q", sorted(plan.QUERIES))
def test_oracle(spark, sf, q):
    assert same(plan.QUERIES[q](spark, sf), plan.ORACLE[q], duck(sf)) > 0
