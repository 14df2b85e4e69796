"""Distributed positions, quantiles and metrics against brute force, with one value holding a third of the rows."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ebbwatch.operators import metrics as M
from ebbwatch.operators import ranks, reports, splits

RNG = random.Random(7)
ROWS = [
    (i, "hot" if i % 3 == 0 else RNG.choice("ab"), 0.5 if i % 3 == 1 else round(RNG.uniform(-3, 900), 3), RNG.random() < 0.3, round(RNG.random(), 2))
    for i in range(900)
]


@pytest.fixture(scope="module")
def data(spark):
    rows = [(i, g, float(v), int(y), 0.5 if i % 3 == 2 else p) for i, g, v, y, p in ROWS]
    return spark.createDataFrame(rows, "id long, g string, v double, y int, p double").repartition(5)


def test_hashed_positions(data):
    expected = data.select(
        "id", F.row_number().over(Window.partitionBy("g").orderBy(F.md5(F.col("id").cast("string")), "id")).alias("position")
    )
    got = ranks.hashed_positions(data, "id", ["g"], digits=1).select("id", "position")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))
    whole = ranks.hashed_positions(data, "id")
    assert sorted(r.position for r in whole.collect()) == list(range(1, 901))
    assert {r.position_of for r in whole.collect()} == {900}


def test_rank_within(data):
    expected = data.select("id", F.rank().over(Window.partitionBy("g").orderBy(F.desc("v"))).alias("rank"))
    got = ranks.rank_within(data, "g", "v").select("id", F.col("rank").cast("int").alias("rank"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))


@pytest.mark.parametrize("probs", [(0.0, 0.25, 0.5, 0.75, 1.0), (0.1, 0.333, 0.9)])
def test_exact_quantiles(data, probs):
    pdf = data.toPandas()
    linear = {(r.feature, r.prob): r.value for r in ranks.exact_quantiles(data, ["v", "p"], probs).collect()}
    disc = {(r.feature, r.prob): r.value for r in ranks.exact_quantiles(data, ["v", "p"], probs, "disc").collect()}
    for c in ("v", "p"):
        ordered = np.sort(pdf[c].to_numpy())
        for q in probs:
            assert linear[c, q] == pytest.approx(np.quantile(ordered, q), abs=1e-12)
            assert disc[c, q] == ordered[max(int(np.ceil(len(ordered) * q)) - 1, 0)]
    with pytest.raises(ValueError):
        ranks.exact_quantiles(data, ["v"], probs, "nearest")


def brute_auc(pdf):
    pos, neg = pdf[pdf.y == 1].p.to_numpy(), pdf[pdf.y == 0].p.to_numpy()
    wins = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    return wins / (len(pos) * len(neg))


def test_auc_ks_and_goals(data, spark):
    pdf = data.toPandas()
    assert M.auc_roc(data, "y", "p").collect()[0].auc_roc == pytest.approx(brute_auc(pdf))
    groups = {r.g: r.auc_roc for r in M.grouped_auc(data, "y", "p", "g").collect()}
    for g, part in pdf.groupby("g"):
        assert groups[g] == pytest.approx(brute_auc(part))
    gaps = [abs((pdf[pdf.y == 1].p >= t).mean() - (pdf[pdf.y == 0].p >= t).mean()) for t in pdf.p.unique()]
    assert M.ks_statistic(data, "y", "p").collect()[0].ks == pytest.approx(max(gaps))
    found = {r.metric: r.value for r in M.binary_metrics(data, "y", "p").collect()}
    predicted = (pdf.p >= 0.5).astype(int)
    assert found["accuracy"] == pytest.approx((predicted == pdf.y).mean())
    assert found["recall"] == pytest.approx(predicted[pdf.y == 1].mean())
    assert found["gini"] == pytest.approx(2 * found["auc_roc"] - 1)
    goals = {r.metric: r.reached for r in M.metric_goals(M.binary_metrics(data, "y", "p")).collect()}
    assert goals == {m: found[m] > g for m, g in (("auc_roc", 0.85), ("recall", 0.75), ("precision", 0.65), ("f1", 0.7))}


def test_auc_matches_spark_evaluator(data):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    evaluator = BinaryClassificationEvaluator(rawPredictionCol="p", labelCol="y", numBins=0)
    assert M.auc_roc(data, "y", "p").collect()[0].auc_roc == pytest.approx(evaluator.evaluate(data))
    assert M.auc_pr(data, "y", "p").collect()[0].auc_pr == pytest.approx(evaluator.setMetricName("areaUnderPR").evaluate(data))


def test_lift_equals_ntile(data):
    tile = F.ntile(10).over(Window.orderBy(F.desc("p"), F.md5(F.col("id").cast("string")), "id"))
    expected = data.withColumn("tile", tile).groupBy("tile").agg(F.count("*").alias("n"), F.sum("y").alias("c"))
    got = M.lift_table(data.where("id < 895"), "id", "y", "p").collect()
    expected = data.where("id < 895").withColumn("tile", tile).groupBy("tile").agg(F.count("*").alias("n"), F.sum("y").alias("c"))
    assert sorted((r.tile, r.n, r.n_churn) for r in got) == sorted((r.tile, r.n, r.c) for r in expected.collect())


def test_report_handles_empty_classes(spark):
    counts = spark.createDataFrame([(0, 0, 5, 0)], "tp long, fp long, tn long, fn long")
    rows = {r.class_name: r for r in M.class_report(counts).collect()}
    assert rows["1"].precision == rows["1"].recall == rows["1"].f1 == 0.0
    assert rows["0"].f1 == 1.0 and rows["accuracy"].f1 == 1.0 and rows["macro avg"].f1 == 0.5


def test_business_impact(spark):
    counts = spark.createDataFrame([(100, 30, 600, 20)], "tp long, fp long, tn long, fn long")
    row = M.business_impact(counts).collect()[0]
    factor = 50_000 / 750
    assert (row.tp_portfolio, row.fn_portfolio, row.fp_portfolio) == (int(100 * factor), int(20 * factor), int(30 * factor))
    assert row.retained == int(int(100 * factor) * 0.25) and row.income == row.retained * 3_000_000
    assert row.roi == pytest.approx((row.income - 200_000_000) / 200_000_000)


def test_splits(data):
    parts = splits.split_stratified(data, "id", "y", splits.THREE_WAY)
    counts = {(r.y, r.part): r["count"] for r in parts.groupBy("y", "part").count().collect()}
    for y, n in data.toPandas().y.value_counts().items():
        assert counts[y, "train"] == int(n * 0.85 * (1 - 0.176))
        assert counts[y, "train"] + counts[y, "validation"] == int(n * 0.85)
    first = {r.id: r.part for r in splits.split_by_hash(data, "id").collect()}
    again = {r.id: r.part for r in splits.split_by_hash(data.repartition(11), "id").collect()}
    assert first == again and 0.7 < sum(p == "train" for p in first.values()) / 900 < 0.9
    assert {r.fold for r in splits.add_fold(data, "id", 5).select("fold").collect()} == set(range(5))


def test_expand_counts(spark):
    df = spark.createDataFrame([("a", 7), ("b", 0), ("c", 1), ("d", None)], "k string, n int")
    got = splits.expand_counts(df, "k", "n", chunk=3)
    assert sorted((r.k, r.item) for r in got.collect()) == [("a", i) for i in range(1, 8)] + [("c", 1)]


def test_describe(data):
    pdf = data.toPandas()
    row = {r.feature: r for r in reports.describe(data, ["v"]).collect()}["v"]
    want = pdf.v.describe()
    assert [row.n, row["mean"], row["std"], row["min"], row.q25, row.q50, row.q75, row["max"]] == pytest.approx(list(want))


def test_histogram_density_sums_to_one(data):
    rows = reports.class_histogram(data, "y", "v", bins=30).toPandas()
    for y, part in rows.groupby("label"):
        values = pd.Series(data.where(f"y = {y}").toPandas().v)
        width = (values.max() - values.min()) / 30
        assert (part.density * width).sum() == pytest.approx(1.0)
        assert part.n.sum() == len(values)


def test_anonymize(spark):
    df = spark.createDataFrame([(1, "call 555-1234 or mail a.b@c.de now")], "id int, t string")
    row = reports.anonymize(df, "id", "t", "s").collect()[0]
    assert len(row.id) == 64 and row.t == "call ###-#### or mail <mail> now"


def test_ranks_keep_null_groups_and_values(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), (None, 2.0), ("a", 3.0), (None, None)], "g string, v double")
    got = sorted(((r.g, r.v, r["rank"]) for r in ranks.rank_within(df, "g", "v").collect()), key=str)
    assert got == sorted([("a", 3.0, 1), ("a", 1.0, 2), ("a", None, 3), (None, 2.0, 1), (None, None, 2)], key=str)


def test_small_values_spread_over_bins(spark):
    from ebbwatch.functions.scalar import monotone_bin

    df = spark.range(1_000_000).select((F.rand(5) / 1000).alias("x"))
    n, largest = df.groupBy(monotone_bin("x").alias("b")).agg(F.count("*").alias("n")).agg(F.count("*"), F.max("n")).first()
    assert n > 5_000 and largest < 1_000
    odd = [float("-inf"), -2.0, -1e-300, 0.0, 5e-324, 1e-300, 1.0, 1.5, 1e308, float("inf"), float("nan")]
    rows = spark.createDataFrame([(i, x) for i, x in enumerate([None, *odd])], "i int, x double").select("i", monotone_bin("x").alias("b"))
    bins = [r.b for r in rows.orderBy("i").collect()]
    assert bins[0] is None and bins[1:] == sorted(set(bins[1:]))


def test_empty_test_set_has_no_impact(spark):
    from ebbwatch.operators.metrics import business_impact

    none = spark.createDataFrame([(0, 0, 0, 0)], "tp long, fp long, tn long, fn long")
    assert business_impact(none).first().roi is None


def test_crowded_values_spread_over_windows(spark):
    """A million different scores inside [0.5000, 0.5002]: totals stay exact and no window holds a large part of them."""
    from ebbwatch.functions.scalar import monotone_bin

    df = spark.range(1_000_000).select((F.lit(0.5) + F.col("id") * 2e-10).alias("x"), F.lit(1).cast("bigint").alias("n"))
    largest = df.groupBy(monotone_bin("x", ranks.FINE_PER_OCTAVE).alias("b")).agg(F.count("*").alias("n")).agg(F.count("*"), F.max("n")).first()
    assert largest[0] > 1_000 and largest[1] < 3_000
    found = ranks.running_totals(df, "x", ["n"], descending=True)
    wrong = found.where(F.round((F.col("x") - 0.5) / 2e-10) != 999_999 - F.col("n_before"))
    assert wrong.count() == 0 and found.where("n_all != 1000000").count() == 0


def test_heavy_join_equals_a_join_and_splits_the_heavy_key(spark):
    from ebbwatch.operators.skew import heavy_join

    rows = spark.range(40_000).selectExpr("id", "if(id % 10 < 9, 7, id % 300) k", "if(id % 3 = 0, null, 'x') o")
    table = spark.range(250).selectExpr("id k", "if(id % 2 = 0, null, 'x') o", "id * 2 v").union(spark.createDataFrame([(None, None, -1)], "k long, o string, v long"))
    rows = rows.union(spark.createDataFrame([(-1, None, None)], "id long, k long, o string"))
    for how in ("inner", "left"):
        got = heavy_join(rows, table, ["k", "o"], how=how)
        want = rows.alias("a").join(table.alias("b"), F.expr("a.k <=> b.k and a.o <=> b.o"), how).select("a.*", "b.v")
        assert got.select("id", "k", "o", "v").exceptAll(want).count() == 0 and got.count() == want.count()
    place = F.pmod(F.xxhash64("id", "k", "o"), F.lit(64))
    sizes = [r["count"] for r in rows.where("k = 7").groupBy(place).count().collect()]
    assert len(sizes) == 64 and max(sizes) < 1.5 * sorted(sizes)[32]
    with pytest.raises(ValueError):
        heavy_join(rows, table, ["k"], how="outer")
