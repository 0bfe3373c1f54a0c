"""Scenario tables: the same rows as a list, only changed rows, means from the baseline."""

from pyspark.sql import functions as F

from wavefold.operators import scenarios as sc

SCEN = [sc.Scenario("f", "1", True, True), sc.Scenario("f", "9", False, True), sc.Scenario("g", "x y", False, True)]
ROWS = [(1, 2016, 1, 1, "x y"), (2, 2016, None, 2, "z"), (3, 2021, 9, None, None), (3, 2021, 9, None, None), (4, None, None, None, "z")]
SHAPE = "uid int, year int, f_03 int, f_12 int, g_12 string"


def brute(changed):
    out = []
    for uid, year, f3, f12, g in ROWS:
        for name, now in (("f@1", (1 if f3 is not None else None, 1 if f12 is not None else None, g)),
                          ("f@9", (f3, 9 if f12 is not None else None, g)), ("g@x_y", (f3, f12, "x y" if g is not None else None))):
            if not changed or now != (f3, f12, g):
                out.append((uid, year, *now, name))
    return sorted(out, key=repr)


def score(df):
    return df.withColumn("prediction", (F.col("f_12") * 10 + F.coalesce("f_03", F.lit(0)) + F.length(F.coalesce("g_12", F.lit("")))).cast("double"))


def test_rows_of_list_table_and_salted_join(spark, monkeypatch):
    df = spark.createDataFrame(ROWS, SHAPE)
    cat = spark.createDataFrame([("f", "1", True, True), ("f", "9", False, True), ("g", "x y", False, True)],
                                "feature_name string, category string, year_03 boolean, year_12 boolean")
    for bound in (sc.BROADCAST_SCENARIOS, 1):
        monkeypatch.setattr(sc, "BROADCAST_SCENARIOS", bound)
        for scenarios in (SCEN, sc.scenario_table(cat)):
            for changed in (False, True):
                got = sc.override(df, scenarios, changed=changed)
                assert got.columns == [*df.columns, "feature_category"]
                assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(changed)


def test_ids_are_those_of_the_list(spark):
    names = ["a b", "c.d,e/f", "(g)", "é"]
    cat = spark.createDataFrame([("f", n, True, True) for n in names], "feature_name string, category string, year_03 boolean, year_12 boolean")
    for only in (False, True):
        table = {r.category: (r.feature_category, r.y03) for r in sc.scenario_table(cat, only).collect()}
        assert table == {n: (sc.scenario_id("f", n, "_12" if only else ""), not only) for n in names}


def test_categories_of_another_type_and_unknown_features_go(spark):
    df = spark.createDataFrame(ROWS, SHAPE)
    table = spark.createDataFrame([("f", "1", True, True, "a"), ("f", "one", True, True, "b"), ("h", "1", True, True, "c"),
                                   ("g", "one", True, True, "d")], sc.TABLE)
    assert sorted(r.feature_category for r in sc.valid_table(df, table).collect()) == ["a", "d"]
    assert sc.override(df, table.where("false")).collect() == []


def test_means_equal_full_expansion(spark):
    df = spark.createDataFrame(ROWS, SHAPE)
    full = {(r.feature_category, r.year): (r.n, r.mean) for r in score(sc.override(df, SCEN)).groupBy("feature_category", "year").agg(
        F.count(F.lit(1)).alias("n"), F.avg("prediction").alias("mean")).collect()}
    changed = {(r.feature_category, r.year): r["count"] for r in sc.override(df, SCEN, changed=True).groupBy("feature_category", "year").count().collect()}
    seen = []
    got = sc.delta_means(df, SCEN, lambda x: seen.append(x) or score(x)).collect()
    assert {(r.feature_category, r.year): (r.n, r.mean_predicted) for r in got} == full and len(got) == 9
    assert {(r.feature_category, r.year): r.n_scored for r in got if r.n_scored} == changed
    assert len(seen) == 2
    assert sc.delta_means(df.where("false"), SCEN, score).collect() == [] == sc.delta_means(df, [], score).collect()
