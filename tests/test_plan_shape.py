"""Physical-plan properties that matter at scale (checked on the smallest tables)."""

import contextlib
import io as _io

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def plan_text(df) -> str:
    buf = _io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", ["group_stats_multi_key", "group_peaks_troughs", "softmax_blend",
                                  "fairness", "rmse_subgroups", "poisson_bootstrap_se", "scenario_override",
                                  "first_row_per_key", "wide_to_long", "winsorize_q99",
                                  "qcut_codes"])
def test_no_single_partition_exchange(spark, name):
    text = plan_text(E.queries()[name](spark, SF))
    assert "SinglePartition" not in text, name


def test_filters_and_projection_reach_the_scan(spark):
    text = plan_text(E.queries()["pivot_relative_change"](spark, SF))
    assert "GreaterThanOrEqual(o_orderdate" in text
    text = plan_text(E.queries()["group_peaks_per_order"](spark, SF))
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double>" in text


def test_scenarios_expand_after_the_joins(spark):
    from wavefold.operators import scenarios as sc
    from wavefold.plans.fixtures import fixture
    f = fixture(spark, SF, "f_features")
    rows = fixture(spark, SF, "f_labels").select("uid", "year").join(f, "uid")
    text = plan_text(sc.override(rows, [sc.Scenario("edu_gru", "BUILDING", False, True)]))
    # above the expansion the rows meet the scenario table, broadcast; they are not shuffled, and no scenario is a literal
    above = text[:text.index("Generate")]
    assert above.count("Join") == 1 and "BroadcastHashJoin" in above and "Exchange" not in above
    assert "BUILDING" not in text


def test_scenarios_that_do_not_fit_are_listed(spark):
    from wavefold.operators import scenarios as sc
    df = spark.createDataFrame([(1, "a#b", 5, None)], "uid int, brand_12 string, n_12 int, n_03 int")
    asked = [sc.Scenario("brand", "Brand#12", False, True), sc.Scenario("n", "7", True, True),
             sc.Scenario("n", "seven", True, True), sc.Scenario("gone", "x", True, True)]
    good, errors = sc.split_valid(df, asked)
    assert good == asked[:2]
    assert sorted((r.feature, r.error) for r in errors.collect()) == [("gone", "no such feature"), ("n", "not a int")]
    rows = {r.feature_category: r for r in sc.override(df, good).collect()}
    assert rows["brand@Brand#12"].brand_12 == "Brand#12" and rows["n@7"].n_12 == 7 and rows["n@7"].n_03 is None
