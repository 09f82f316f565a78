"""The split row number equals row_number() over a window, for hot groups and NULL keys too."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerspark.functions.numbering import mark_hot, row_number


def windowed(df, P, O):
    return df.withColumn("rn", F.row_number().over(Window.partitionBy(*P).orderBy(*O)))


def test_matches_window_with_hot_group_and_null_keys(spark):
    rnd = random.Random(7)
    rows = [(1, 1, rnd.randint(0, 10_000), float(i)) for i in range(3000)]            # hot group
    rows += [(rnd.randint(2, 60), rnd.randint(1, 3), rnd.randint(0, 10_000), float(i)) for i in range(2000)]
    rows += [(None, 1, rnd.randint(0, 500), float(i)) for i in range(50)]
    rows += [(None, None, None, float(i)) for i in range(5)] + [(1, 1, None, float(-i)) for i in range(1, 4)]
    df = spark.createDataFrame(rows, "g1 long, g2 int, o1 long, o2 double")
    for width in (1, 64, 100_000):
        got = row_number(df, ["g1", "g2"], ["o1", "o2"], F.floor(F.col("o1") / width), "rn")
        assert sorted(map(str, got.collect())) == sorted(map(str, windowed(df, ["g1", "g2"], ["o1", "o2"]).collect()))


def test_hot_group_is_cut(spark):
    df = spark.createDataFrame([(1, i) for i in range(3000)], "g long, o long")
    buckets = df.groupBy("g", F.floor(F.col("o") / 100)).count()
    assert buckets.count() == 30 and buckets.agg(F.max("count")).first()[0] == 100
    assert "Python" not in row_number(df, ["g"], ["o"], F.floor(F.col("o") / 100))._jdf.queryExecution().toString()


def test_only_hot_groups_are_cut(spark):
    rnd = random.Random(8)
    rows = [(1, 1, rnd.randint(0, 10_000), float(i)) for i in range(3000)] + [(None, 1, rnd.randint(0, 500), float(i)) for i in range(1200)]
    rows += [(rnd.randint(2, 60), rnd.randint(1, 3), rnd.randint(0, 10_000), float(i)) for i in range(2000)]
    rows += [(None, None, None, float(i)) for i in range(5)] + [(1, 1, None, float(-i)) for i in range(1, 4)]
    df = spark.createDataFrame(rows, "g1 long, g2 int, o1 long, o2 double")
    marked = mark_hot(df, ["g1"], rows=1000)   # by a part of the group's columns
    assert {tuple(r) for r in marked.select("g1", "_hot").distinct().collect() if r._hot} == {(1, True), (None, True)}
    assert marked.count() == len(rows)
    got = row_number(marked, ["g1", "g2"], ["o1", "o2"], F.floor(F.col("o1") / 64), "rn", hot="_hot").drop("_hot")
    assert sorted(map(str, got.collect())) == sorted(map(str, windowed(df, ["g1", "g2"], ["o1", "o2"]).collect()))
    none = row_number(mark_hot(df, ["g1"]), ["g1", "g2"], ["o1", "o2"], F.floor(F.col("o1") / 64), "rn", hot="_hot").drop("_hot")
    assert sorted(map(str, none.collect())) == sorted(map(str, got.collect()))
