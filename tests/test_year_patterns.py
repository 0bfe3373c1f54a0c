"""Participation patterns of two tables that are split alike."""

import contextlib
import io

from pyspark.sql import functions as F

from wavefold.operators import participation as pa


def test_patterns_are_not_read_from_a_union(spark):
    """Spark takes the union of two tables split by uid as split by uid, and may then run it in more partitions."""
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        keys = spark.range(40).select(F.col("id").alias("uid")).where("uid % 2 = 0").distinct()
        rows = spark.range(40).select(F.col("id").alias("uid")).join(keys, "uid", "left_anti")
        years = lambda *ys: rows.select("uid", F.explode(F.array(*[F.lit(y) for y in ys])).alias("year"))
        pats = pa.year_patterns(years(2003, 2012), years(2016, 2021))
        with contextlib.redirect_stdout(io.StringIO()) as text:
            pats.explain()
        assert "Union" not in text.getvalue()
        assert {(r.pattern, r["count"]) for r in pats.groupBy("pattern").count().collect()} == {("[2003, 2012, 2016, 2021]", 20)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)


def test_null_and_repeated_keys_and_years(spark):
    long = spark.createDataFrame([(1, 2003), (1, 2003), (1, 2016), (None, 2003), (2, None)], "uid long, year int")
    labels = spark.createDataFrame([(1, 2016), (None, 2003), (None, None), (3, 2021)], "uid long, year int")
    got = {r.uid: (r.n_years, r.years, r.pattern) for r in pa.year_patterns(long, labels).collect()}
    assert got == {1: (4, [2003, 2003, 2016, 2016], "[2003, 2003, 2016, 2016]"), None: (2, [2003, 2003], "[2003, 2003]"),
                   2: (0, [], "[]"), 3: (1, [2021], "[2021]")}
