"""A total order without one task."""

import random

from pyspark.sql import functions as F

from labelmill.operators import ordering


def test_numbered(spark):
    draw = random.Random(3)
    rows = [(draw.choice([None, 1, 1, 1, 2, draw.randint(0, 99)]), k, f"t{k % 7}") for k in range(3000)]
    df = spark.createDataFrame(rows, "a int, b long, c string").repartition(7)
    got = ordering.numbered(df, F.col("a").desc_nulls_first(), F.col("b").asc(), name="place")
    assert got.columns == ["a", "b", "c", "place"]
    want = sorted(rows, key=lambda r: (r[0] is not None, -(r[0] or 0), r[1]))
    assert [(r.a, r.b, r.c) for r in sorted(got.collect(), key=lambda r: r.place)] == want
    assert sorted(r.place for r in got.collect()) == list(range(3000))


def test_ties_repeated_rows_and_nothing(spark):
    df = spark.createDataFrame([(1, "x")] * 50 + [(0, None)], "a int, c string")
    assert sorted(r.n for r in ordering.numbered(df, "a", name="n").collect()) == list(range(51))
    assert ordering.numbered(df, "a", name="n").filter("a = 0").first().n == 0
    assert ordering.numbered(df.filter("a > 1"), "a").collect() == []
