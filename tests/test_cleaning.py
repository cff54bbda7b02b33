import statistics

import pytest
from pyspark.sql import functions as F

from cohortweave.operators import clean as C
from cohortweave.operators import quantiles as Q
from cohortweave.operators import reported as R


def values(df, phenotype="ALT"):
    return [r.value for r in df.where(F.col("phenotype") == phenotype).orderBy("sample_ID").collect()]


def alt(long_of, texts, phenotype="ALT", data_type="quantitative"):
    return long_of([(f"P{i:02d}", data_type, phenotype, t, "2020-01-01") for i, t in enumerate(texts)])


def test_iqr(long_of):
    long = alt(long_of, ["10", "12", "11", "10.5", "9999"])
    capped = values(C.outlier_filter(long))
    assert capped[:4] == ["10.0", "12.0", "11.0", "10.5"] and float(capped[4]) == 12 + 1.5 * 1.5
    assert values(C.outlier_filter(long, C.OutlierRule("iqr", "remove"))) == ["10.0", "12.0", "11.0", "10.5", None]
    assert values(C.outlier_filter(long, C.OutlierRule("none"))) == ["10", "12", "11", "10.5", "9999"]


def test_zscore(long_of):
    data = [10.0, 11.0, 9.0, 10.0, 40.0]
    mean, sd = statistics.mean(data), statistics.stdev(data)
    long = alt(long_of, [str(d) for d in data])
    rule = C.OutlierRule("zscore", "cap", zscore_sd=1.5)
    assert float(values(C.outlier_filter(long, rule))[4]) == pytest.approx(mean + 1.5 * sd)
    assert values(C.outlier_filter(long, C.OutlierRule("zscore", "remove", zscore_sd=1.5)))[3:] == ["10.0", None]


def test_single_row_has_no_spread(long_of):
    long = alt(long_of, ["7"])
    assert values(C.outlier_filter(long, C.OutlierRule("zscore", "cap"))) == ["7.0"]
    assert values(C.outlier_filter(long, C.OutlierRule("zscore", "remove"))) == [None]
    assert values(C.scale_filter(long, "zscore")) == ["0.0"]


def test_text_and_untouched_groups(long_of):
    long = alt(long_of, ["1", "2", "high"]).unionByName(alt(long_of, ["low", "high"], "GRADE")).unionByName(
        alt(long_of, ["1", "500"], "SEX", "categorical"))
    done = C.outlier_filter(long)
    assert values(done) == ["1.0", "2.0", None]  # text among numbers becomes missing
    assert values(done, "GRADE") == ["low", "high"]  # a group without numbers is left alone
    assert values(done, "SEX") == ["1", "500"]
    assert values(C.outlier_filter(long, phenotypes=["OTHER"])) == ["1", "2", "high"]


def test_report_counts_numbers(long_of):
    long = alt(long_of, ["28", "29", "30", "31", "9999", "x"])
    capped = C.outlier_report(long).first()
    assert (capped.n_total, capped.n_capped, capped.n_removed) == (6, 1, 0)
    removed = C.outlier_report(long, C.OutlierRule("iqr", "remove")).first()
    assert (removed.n_total, removed.n_capped, removed.n_removed) == (6, 0, 1)


def test_scaling(long_of):
    long = alt(long_of, ["1", "2", "3"]).unionByName(alt(long_of, ["5", "5"], "FLAT"))
    assert values(C.scale_filter(long, "zscore")) == ["-1.0", "0.0", "1.0"]
    assert values(C.scale_filter(long, "minmax")) == ["0.0", "0.5", "1.0"]
    assert values(C.scale_filter(long, "zscore"), "FLAT") == ["0.0", "0.0"]
    assert values(C.scale_filter(long, "minmax"), "FLAT") == ["0.0", "0.0"]
    assert values(C.scale_filter(long, "other")) == ["1", "2", "3"]


def test_batch_rules(long_of):
    long = alt(long_of, ["10", "12", "11", "10.5", "9999"]).unionByName(
        alt(long_of, ["10", "12", "11", "10.5", "9999"], "AST")).unionByName(alt(long_of, ["1", "100"], "RAW"))
    done = C.outlier_filter_batch(long, {
        "ALT": C.OutlierRule("iqr", "cap"), "AST": C.OutlierRule("iqr", "remove"), "RAW": C.OutlierRule("none")})
    assert values(done)[4] == "14.25" and values(done, "AST")[4] is None and values(done, "RAW") == ["1", "100"]


def test_quantiles_equal_percentile(spark):
    import random

    rng = random.Random(7)
    rows = [("one", 4.0)] + [("flat", 2.5)] * 50 + [("skew", rng.choice([0.0, 0.0, rng.lognormvariate(0, 3)])) for _ in range(999)]
    rows += [("signed", rng.gauss(0, 5)) for _ in range(1000)] + [("none", None), (None, 1.0)]
    rows += [("far", x) for x in (0.0, -0.0, -1e300, 1e300, 5e-324, float("inf"), float("-inf"), 3.9999999999999996)]
    df = spark.createDataFrame(rows, "k string, x double")
    ps = [0.0, 0.05, 0.25, 0.5, 0.75, 0.99, 1.0]
    found = {r.k: (r.n, r.quantiles) for r in Q.exact_quantiles(df, ["k"], F.col("x"), ps).collect()}
    plain = df.dropna().groupBy("k").agg(F.count("x").alias("n"), F.percentile("x", ps).alias("q"))
    plain = {r.k: (r.n, r.q) for r in plain.collect()}
    assert set(found) == set(plain) == {"one", "flat", "skew", "signed", "far"}
    for key, (n, quantiles) in plain.items():
        assert found[key][0] == n and found[key][1] == pytest.approx(quantiles, rel=1e-12, nan_ok=True)


def test_column_quantiles(spark):
    df = spark.range(1, 102).selectExpr("double(id) AS a", "string(id * 2) AS b", "CAST(null AS double) AS c")
    row = Q.column_quantiles(df, {"a": [0.5, 0.1], "b": [1.0], "c": [0.5]}).first()
    assert row.a.q == [51.0, 11.0] and row.a.n == 101 and row.b.q == [202.0]
    assert row.c is None or row.c.q is None or row.c.q == [None]


def test_crowded_group_is_spread_and_answers_alike_alone(spark):
    """Two million values close to each other: no partition holds a large part of them, and other groups change nothing."""
    crowded = spark.range(2_000_000).selectExpr("'pH' AS k", "7.4 + pmod(xxhash64(id), 1000003) * 1e-12 AS x")
    small = spark.range(500).selectExpr("concat('g', id % 50) AS k", "rand(3) AS x")
    alone = Q.exact_quantiles(crowded, ["k"], F.col("x"), [0.1, 0.25, 0.5, 0.9]).first()
    beside = Q.exact_quantiles(crowded.union(small), ["k"], F.col("x"), [0.1, 0.25, 0.5, 0.9]).where("k = 'pH'").first()
    assert alone.n == 2_000_000 and alone == beside
    counts = crowded.groupBy("k", "x").count().repartitionByRange(8, "k", "x").groupBy(F.spark_partition_id()).count()
    most, total = counts.agg(F.max("count"), F.sum("count")).first()
    assert most < total / 4


@pytest.mark.parametrize("method, mode, scale", [
    ("iqr", "cap", "zscore"), ("iqr", "remove", "minmax"), ("zscore", "remove", None), ("zscore", "cap", "zscore"), ("none", "cap", "minmax")])
def test_one_go_equals_the_steps_and_their_reports(long_of, method, mode, scale):
    rows = [(f"P{i:02d}", "quantitative", p, t, "2020-01-01") for p, texts in {
        "ALT": ["10", "12", "11", "10.5", "9999", "x", None], "ONE": ["7"], "SAME": ["3", "3", "3"], "NONE": ["a", None],
        None: ["4"]}.items() for i, t in enumerate(texts)] + [("P1", "coded", "ALT", "E11", None), (None, "quantitative", "ALT", "12", None)]
    long = long_of(rows)
    rule = C.OutlierRule(method, mode, zscore_sd=1.5)
    done = R.clean_with_reports(long, rule, scale)

    def told(df):
        out = []
        for r in df.collect():
            cells = [float(c) if name == "value" and c not in (None, "x", "a", "E11") else c for name, c in r.asDict().items()]
            out.append(tuple(f"{c:.9g}" if isinstance(c, float) else str(c) for c in cells))
        return sorted(out)

    stepped = C.outlier_filter(long, rule)
    assert told(done.rows) == told(C.scale_filter(stepped, scale) if scale else stepped)
    assert done.rows.schema["value"].dataType == long.schema["value"].dataType
    if method != "none":
        assert told(done.outliers) == told(C.outlier_report(long, rule))
    else:
        assert done.outliers.isEmpty()
    assert told(done.scales.drop("method")) == told(C.scale_stats(stepped).select("phenotype", "n", "mean", "sd", "lo", "hi"))


def test_one_go_reads_the_rows_twice(spark, long_of, tmp_path):
    path = str(tmp_path / "long")
    long_of([(f"P{i}", "quantitative", "ALT", str(i % 5), None) for i in range(50)]).write.parquet(path)
    done = R.clean_with_reports(spark.read.parquet(path), C.OutlierRule(), "zscore")
    plan = done.rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2  # the rows and the settings of phenotypes
    for report in (done.outliers, done.scales):
        assert path not in str(report.inputFiles())
    assert C.outlier_report(spark.read.parquet(path)).inputFiles() != done.outliers.inputFiles()
    assert done.rows.where("value IS NULL").isEmpty()
