import logging

import pytest
from conftest import by_sample

from cohortweave.operators.risk import RiskRule, risk_matrix, risk_report


def table(spark, values):
    return spark.createDataFrame([(f"{i:02d}", v) for i, v in enumerate(values, 1)], "sample_ID string, x_mean double")


def classes(spark, values, method, **settings):
    rule = RiskRule(method, "x_mean", "x_risk", **settings)
    found = by_sample(risk_matrix(table(spark, values), [rule]))
    return [found[f"{i:02d}"] for i in range(1, len(values) + 1)]


TEN = [float(i) for i in range(1, 11)]
EIGHT = TEN[:8]


def test_percentile(spark):
    assert classes(spark, TEN, "percentile", high=90) == [0.0] * 9 + [1.0]
    assert classes(spark, TEN, "percentile", low=10) == [1.0] + [0.0] * 9
    assert classes(spark, TEN, "percentile", high=90, low=10) == [1.0] + [0.0] * 8 + [1.0]
    assert classes(spark, TEN, "percentile", cutoffs=(50,)) == [0] * 5 + [1] * 5
    assert classes(spark, [*TEN, None], "percentile", cutoffs=(50, 90), labels=("l", "m", "h")) == ["l"] * 5 + ["m"] * 4 + ["h", None]


def test_threshold(spark):
    assert classes(spark, [1.0, 5.0, 9.0, None], "threshold", high=5) == [0.0, 0.0, 1.0, None]
    assert classes(spark, [1.0, 5.0, 9.0], "threshold", low=5) == [1.0, 0.0, 0.0]
    assert classes(spark, [1.0, 5.0, 9.0], "threshold") == [0.0, 0.0, 0.0]
    assert classes(spark, [1.0, 5.0, 9.0, None], "threshold", cutoffs=(1, 5)) == [0, 1, 2, None]
    assert classes(spark, [1.0, 9.0], "threshold", cutoffs=(5,), labels=("a", "b")) == ["a", "b"]


def test_quantile_bins(spark):
    assert classes(spark, EIGHT, "quantile_bin", n=4) == [0, 0, 1, 1, 2, 2, 3, 3]
    assert classes(spark, EIGHT, "quantile_bin", n=4, high=1, low=1) == [1, 1, 0, 0, 0, 0, 1, 1]
    assert classes(spark, [*EIGHT, None], "quantile_bin", n=2, labels=("lo", "hi")) == ["lo"] * 4 + ["hi"] * 4 + [None]
    # Equal edges are dropped: 0 0 0 0 1 2 in quarters leaves two bins.
    assert classes(spark, [0.0] * 4 + [1.0, 2.0], "quantile_bin", n=4) == [0, 0, 0, 0, 1, 1]
    assert classes(spark, [0.0] * 4 + [1.0, 2.0], "quantile_bin", n=4, high=1) == [0, 0, 0, 0, 1, 1]
    assert classes(spark, [3.0] * 5, "quantile_bin", n=4) == [None] * 5
    assert classes(spark, [3.0] * 5, "quantile_bin", n=4, high=1) == [None] * 5


def test_quantile_bins_follow_pandas(spark):
    import random

    import pandas as pd

    rng = random.Random(5)
    values = [float(rng.choice([0, 0, 0, 1, 2, 2, rng.randint(0, 30)])) for _ in range(300)]
    for n in (4, 10):
        expected = pd.qcut(pd.Series(values), n, labels=False, duplicates="drop")
        assert classes(spark, values, "quantile_bin", n=n) == [int(b) for b in expected]


def test_all_missing(spark):
    for settings in ({"method": "percentile", "high": 90}, {"method": "quantile_bin", "n": 4}, {"method": "percentile", "cutoffs": (50,)}):
        assert classes(spark, [None, None], **settings) == [None, None]


def test_matrix_skips_absent_columns(spark, caplog):
    df = table(spark, TEN)
    with caplog.at_level(logging.WARNING):
        matrix = risk_matrix(df, [RiskRule("threshold", "absent", "a_risk", high=1), RiskRule("threshold", "x_mean", "x_risk", high=5)])
    assert matrix.columns == ["sample_ID", "x_risk"] and "absent" in caplog.text
    assert risk_matrix(df, []).columns == ["sample_ID"]
    with pytest.raises(ValueError):
        RiskRule("magic", "x_mean", "x_risk")


def test_text_columns_are_read_as_numbers(spark):
    df = spark.createDataFrame([("1", "5"), ("2", "x"), ("3", "9")], "sample_ID string, x_mean string")
    assert by_sample(risk_matrix(df, [RiskRule("percentile", "x_mean", "r", high=50)])) == {"1": 0.0, "2": None, "3": 1.0}


def test_report(spark):
    rules = [RiskRule("percentile", "x_mean", "p", high=90), RiskRule("quantile_bin", "x_mean", "q", n=2, labels=("lo", "hi")),
             RiskRule("threshold", "x_mean", "t", cutoffs=(5, 100))]
    lines = {(r.output_col, r.entry, r.label): r.value for r in risk_report(table(spark, [*TEN, None]), rules).collect()}
    assert lines == {
        ("p", "n_na", ""): 1, ("p", "class", "0.0"): 9, ("p", "class", "1.0"): 1, ("p", "high_cutoff", ""): pytest.approx(9.1),
        ("q", "n_na", ""): 1, ("q", "class", "lo"): 5, ("q", "class", "hi"): 5, ("q", "n_bins", ""): 2,
        ("q", "bin_edge", "0"): 1, ("q", "bin_edge", "1"): 5.5, ("q", "bin_edge", "2"): 10,
        ("t", "n_na", ""): 1, ("t", "class", "0"): 5, ("t", "class", "1"): 5, ("t", "cutoff", "5"): 5, ("t", "cutoff", "100"): 100}


def test_rule_from_settings():
    rule = RiskRule.for_phenotype("BMI", {"method": "percentile", "stat": "median", "cutoffs": [50]})
    assert (rule.source_col, rule.output_col, rule.cutoffs) == ("BMI_median", "BMI_risk", (50,))
