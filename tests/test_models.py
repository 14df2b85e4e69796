"""Feature stages, models and explanations by invariants and planted signals."""

import random

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbwatch.operators import explain as E
from ebbwatch.operators import features as FT
from ebbwatch.operators import grown as G
from ebbwatch.operators import models as M
from ebbwatch.operators import networks as N


@pytest.fixture(scope="module")
def planted(spark):
    rng = random.Random(3)
    rows = []
    for i in range(600):
        a, b, c = rng.gauss(0, 1), rng.gauss(0, 1), rng.gauss(0, 1)
        rows.append((i, a, b if i % 17 else None, c, rng.choice(["north", "south", "south"]), int(a + 0.1 * rng.gauss(0, 1) > 0.8)))
    return spark.createDataFrame(rows, "id long, a double, b double, c double, region string, churn_label int").repartition(4)


@pytest.fixture(scope="module")
def vectors(planted):
    return FT.FeatureSet(["a", "b", "c"], ["region"]).fit_transform(planted).cache()


def test_feature_set_needs_a_fit(planted):
    with pytest.raises(RuntimeError):
        FT.FeatureSet(["a"], ["region"]).transform(planted)


def test_feature_set(planted, vectors):
    assert vectors.count() == 600
    assert FT.vector_names(vectors) == ["a_imp", "b_imp", "c_imp", "region_ohe_south", "region_ohe_north"]
    means = vectors.select(vector_to_array("features").alias("v")).agg(*[F.avg(F.get("v", F.lit(i))).alias(f"m{i}") for i in range(5)]).collect()[0]
    assert max(abs(m) for m in means) < 1e-9


def test_unseen_category_is_all_zeros(spark, planted):
    model = FT.FeatureSet(["a"], ["region"]).fit(planted).model
    new = spark.createDataFrame([(1, 0.0, "nowhere", 0), (2, 0.0, None, 0)], "id long, a double, region string, churn_label int")
    assert [vector_to_array_row.v for vector_to_array_row in model.transform(new).select(vector_to_array("region_ohe").alias("v")).collect()] == [[0.0, 0.0]] * 2


def test_exact_median(spark):
    df = spark.createDataFrame([(1, 1, 10.0), (2, 3, None), (3, None, 30.0), (4, 9, 20.0)], "id int, a int, b double")
    rows = {r.id: r for r in FT.impute_exact_median(df, ["a", "b"]).collect()}
    assert rows[3].a_imp == 3 and rows[2].b_imp == 20.0 and rows[1].a_imp == 1


@pytest.mark.parametrize("kind,settings", [("random_forest", {"numTrees": 10}), ("gbt", {"maxIter": 5}), ("logistic", {"maxIter": 20})])
def test_planted_signal_is_found(vectors, kind, settings):
    model = M.fit_classifier(vectors, kind, **settings)
    scored = M.score_customers(model, vectors).cache()
    metrics = {r.metric: r.value for r in M.evaluate(scored).collect()}
    assert metrics["auc_roc"] > 0.9
    rows = scored.select("churn_probability", "churn_risk_level", vector_to_array("probability").alias("p")).collect()
    assert len(rows) == 600 and all(0 <= r.churn_probability <= 1 and sum(r.p) == pytest.approx(1) for r in rows)
    assert all((r.churn_risk_level == "ALTO") == (r.churn_probability >= 0.7) for r in rows)


def test_forest_keeps_the_nodes_of_its_rows(vectors):
    kept = M.fit_classifier(vectors, "random_forest", numTrees=10)
    assert kept.getCacheNodeIds()
    plain = M.fit_classifier(vectors, "random_forest", numTrees=10, cacheNodeIds=False)
    assert [t.toDebugString.split("\n")[1:] for t in kept.trees] == [t.toDebugString.split("\n")[1:] for t in plain.trees]


def test_unknown_model_type():
    with pytest.raises(ValueError, match="unknown model type"):
        M.classifier("xgboost")


def test_cross_validation_and_search(vectors):
    found = M.cross_validate(vectors, "logistic", "id", folds=3, grid={"regParam": [0.01, 10.0]}, maxIter=10)
    assert found.avgMetrics[0] > 0.9 and found.bestModel.getRegParam() == 0.01
    tuned = M.tune_search(vectors, "logistic", "id", {"regParam": [0.01], "elasticNetParam": [0.0]}, candidates=2)
    assert tuned.validationMetrics[0] > 0.9


def test_forests_of_several_depths_come_from_one_fit(vectors, monkeypatch):
    grid = {"maxDepth": [2, 5, 3], "numTrees": [4, 7]}
    shape = lambda model: [t.toDebugString.split("\n")[1:] for t in model.trees]
    estimator = M.classifier("random_forest", minInstancesPerNode=1)
    settings = M._grid(estimator, grid)
    for i, model in estimator.fitMultiple(vectors, settings):
        plain = RandomForestClassifier.fit(estimator, vectors, settings[i])
        assert shape(model) == shape(plain)
        told = [[list(r.rawPrediction) for r in m.transform(vectors).orderBy("id").collect()] for m in (model, plain)]
        assert told[0] == told[1]
    fits, fit = [], RandomForestClassifier._fit
    monkeypatch.setattr(RandomForestClassifier, "_fit", lambda self, df: fits.append(1) or fit(self, df))
    found = M.cross_validate(vectors, "random_forest", "id", folds=3, grid=grid)
    assert len(found.avgMetrics) == 6 and len(fits) == 3 * 2 + 1


def test_grown_trees_are_those_of_spark(vectors, monkeypatch):
    # Without draws of rows and features nothing is left to chance.
    monkeypatch.setattr(G, "BLOCK_ROWS", 250)
    forest = M.classifier("random_forest", bootstrap=False, featureSubsetStrategy="all", numTrees=2, maxDepth=4, minInstancesPerNode=2)
    plain = forest.fit(vectors)
    cut = forest.fit(vectors, {forest.maxDepth: 2})
    grown = forest.on_binned_rows(1).fit(vectors)
    shape = lambda model: [t.toDebugString.split("\n")[1:] for t in model.trees]
    assert shape(grown) == shape(plain) and shape(grown.grown.at(2)) == shape(cut)
    told = [[[*r.rawPrediction, *r.probability] for r in m.transform(vectors).orderBy("id").collect()] for m in (plain, grown)]
    assert np.allclose(*told) and np.allclose(grown.featureImportances.toArray(), plain.featureImportances.toArray())


def test_counts_of_nodes_alone_and_together(monkeypatch):
    rng = np.random.default_rng(1)
    codes, sizes = rng.integers(0, 64, (6, 500)).astype(np.uint8), np.array([120, 0, 80, 150])
    rows, weight = rng.permutation(500)[:350].astype(np.int32), rng.integers(1, 5, 350).astype(np.uint8)
    features = np.array([[0, 3], [1, 2], [5, 0], [4, 3]])
    told = []
    for segment in (1, 1 << 20):
        monkeypatch.setattr(G, "SEGMENT_ROWS", segment)
        told.append(G._counts(codes, features, rows, weight, sizes, 64))
    assert (told[0] == told[1]).all()
    assert told[0][2, 0, 9] == weight[120:200][codes[5][rows[120:200]] == 9].sum() and (told[0].sum(axis=2)[:, 0] == [weight[:120].sum(), 0, weight[120:200].sum(), weight[200:].sum()]).all()


def test_large_grid_searches_grow_their_forests(vectors, monkeypatch):
    fits, fit = [], RandomForestClassifier._fit
    monkeypatch.setattr(RandomForestClassifier, "_fit", lambda self, df: fits.append(df.count()) or fit(self, df))
    monkeypatch.setattr(M, "GROWN_FROM", 200, raising=False)
    found = M.cross_validate(vectors, "random_forest", "id", folds=2, grid={"maxDepth": [2, 4], "numTrees": [3, 5]}, minInstancesPerNode=1)
    assert max(fits) == 2 and len(found.avgMetrics) == 4 and min(found.avgMetrics) > 0.9
    best = found.bestModel
    assert best.getNumTrees in (3, 5) and len({t.toDebugString.split("\n", 1)[1] for t in best.trees}) > 1
    M.fit_classifier(vectors, "random_forest", numTrees=3)
    assert fits[-1] == 600


def test_only_plain_large_tables_are_grown(vectors):
    forest = M.classifier("random_forest", numTrees=2)
    grow = lambda df, rows=600, **settings: G.grow(forest.copy({forest.getParam(k): v for k, v in settings.items()}), df, rows, {})
    assert grow(vectors) is not None and grow(vectors, 601) is None and grow(vectors, impurity="entropy") is None
    labelled = lambda c: vectors.withColumn("churn_label", c)
    for odd in (F.col("id") % 3, F.lit(0), F.when(F.col("id") != 5, F.col("churn_label"))):
        assert grow(labelled(odd)) is None


def test_bootstrap_is_poisson():
    counts = G.bootstrap(400_000, 42, 100, 7, 0)
    assert counts.mean() == pytest.approx(1, abs=0.01) and counts.var() == pytest.approx(1, abs=0.02)
    assert np.bincount(counts)[:4] / len(counts) == pytest.approx([0.3679, 0.3679, 0.1839, 0.0613], abs=0.004)
    assert (counts == G.bootstrap(400_000, 42, 100, 7, 0)).all() and (counts != G.bootstrap(400_000, 42, 100, 8, 0)).any()


def test_boosted_with_weights_and_early_stop(vectors):
    held = vectors.withColumn("held", F.col("id") % 5 == 0)
    model = M.train_boosted_weighted(held, "held", maxIter=30)
    assert model.getNumTrees < 30
    assert {r.metric: r.value for r in M.evaluate(M.score_customers(model, vectors)).collect()}["auc_roc"] > 0.9


def test_large_tables_are_dealt_evenly_to_boosted_trees(vectors, spark, monkeypatch):
    given, fit = [], GBTClassifier._fit
    monkeypatch.setattr(GBTClassifier, "_fit", lambda self, df: given.append(df) or fit(self, df))
    cores = spark.sparkContext.defaultParallelism
    uneven = vectors.repartition(cores + 1).withColumn("held", F.col("id") % 5 == 0)
    plain = M.fit_classifier(uneven, "gbt", maxIter=3)
    assert given[0].rdd.getNumPartitions() == cores + 1
    monkeypatch.setattr(M, "DEALT_FROM", 600, raising=False)
    model = M.fit_classifier(uneven, "gbt", maxIter=3)
    M.train_boosted_weighted(uneven, "held", maxIter=3)
    monkeypatch.setattr(M, "DEALT_ROWS", -(-600 // (2 * cores)), raising=False)
    M.fit_classifier(uneven, "gbt", maxIter=1)
    for df, parts in zip(given[1:], (cores, cores, 2 * cores), strict=True):
        sizes = df.rdd.glom().map(len).collect()
        assert len(sizes) == parts and sum(sizes) == 600 and max(sizes) - min(sizes) <= cores + 1
    told = [[r.p for r in m.transform(vectors).orderBy("id").select(vector_to_array("probability").alias("p")).collect()] for m in (plain, model)]
    assert np.allclose(*told)


def test_replication_balances_classes(planted):
    counts = {r.churn_label: r["count"] for r in M.replicate_positives(planted, "churn_label").groupBy("churn_label").count().collect()}
    assert 0.8 < counts[1] / counts[0] < 1.25


def test_network(vectors, spark):
    model = M.train_mlp(vectors, 5, hidden=(6,), label="churn_label", max_iter=40)
    assert {r.metric: r.value for r in M.evaluate(M.score_customers(model, vectors)).collect()}["auc_roc"] > 0.9
    ranked = E.importance_rank(E.mlp_input_importance(spark, model, FT.vector_names(vectors)), top=None).collect()
    assert ranked[0].feature == "a_imp" and ranked[0].relative == 1.0 and len(ranked) == 5


def _inputs(spark, negatives=96, positives=32):
    """Rows that come twice; three copies of the positives make 384 rows, whole blocks of Spark's network."""
    rows = [(i // 2 % 48 / 10 - 2.0, float(i // 2 % 7), int(i >= 2 * negatives)) for i in range(2 * (negatives + positives))]
    return FT.assembler(["a", "b"], "features").transform(spark.createDataFrame(rows, "a double, b double, y int")).coalesce(1)


def test_network_on_distinct_rows_is_the_network_on_all_rows(spark, monkeypatch):
    df = _inputs(spark)
    plain = M.train_mlp(df, 2, hidden=(5, 3), label="y", max_iter=15)
    passes = []
    monkeypatch.setattr(N, "weighted_rows", lambda *a, made=N.weighted_rows: passes.append(made(*a)) or passes[-1])
    monkeypatch.setattr(M, "WEIGHTED_FROM", 0)
    model = M.train_mlp(df, 2, hidden=(5, 3), label="y", max_iter=15)
    assert model.weights.toArray() == pytest.approx(plain.weights.toArray(), rel=1e-6, abs=1e-6)
    given = passes[0].agg(F.count("*"), F.sum("weight")).first()
    assert (given[0], given[1]) == (128, 384)
    scores = M.score_customers(model, df).select("churn_probability").collect()
    assert [r[0] for r in scores] == pytest.approx([r[0] for r in M.score_customers(plain, df).select("churn_probability").collect()])
    unbalanced = M.train_mlp(df, 2, hidden=(5,), label="y", max_iter=10, balance=False).weights.toArray()
    monkeypatch.setattr(M, "WEIGHTED_FROM", 1 << 60)
    assert unbalanced == pytest.approx(M.train_mlp(df, 2, hidden=(5,), label="y", max_iter=10, balance=False).weights.toArray(), abs=1e-6)


def test_network_on_distinct_rows_refuses_what_the_network_refuses(spark, monkeypatch):
    monkeypatch.setattr(M, "WEIGHTED_FROM", 0)
    for label in (F.lit(2), F.lit(None).cast("int")):
        with pytest.raises(Exception, match="labels must be whole numbers"):
            M.train_mlp(_inputs(spark).withColumn("y", label), 2, hidden=(3,), label="y", max_iter=2)


def test_descent_stops():
    bowl = lambda x: (float(x @ x), 2 * x)
    found, values = N.minimize(bowl, np.array([3.0, -4.0]), 50)
    assert np.abs(found).max() < 1e-6 and len(values) < 10 and values == sorted(values, reverse=True)
    start = np.array([3.0, -4.0])
    assert len(N.minimize(bowl, start, 0)[1]) == 1
    # no step: the value is never a number away from the start
    stays, values = N.minimize(lambda x: (25.0 if (x == start).all() else np.nan, 2 * x), start, 50)
    assert list(stays) == [3.0, -4.0] and values == [25.0]


def test_text_classifier(spark):
    rows = [(f"quiero cerrar la cuenta {i}" if i % 2 else f"muy contento con el banco {i}", i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, "text string, y int")
    scored = M.score_customers(M.text_classifier("y", maxIter=10).fit(df), df)
    assert M.evaluate(scored, "y").where("metric = 'accuracy'").collect()[0].value == 1.0


def test_saved_model_scores_the_same(vectors, planted, tmp_path):
    from pyspark.ml import PipelineModel

    features = FT.FeatureSet(["a", "b", "c"], ["region"]).fit(planted)
    model = PipelineModel(stages=[*features.model.stages, M.fit_classifier(vectors, "logistic", maxIter=10)])
    M.save_model(model, str(tmp_path / "m"))
    before = {r.id: r.churn_probability for r in M.score_customers(model, planted).collect()}
    after = {r.id: r.churn_probability for r in M.score_customers(M.load_model(str(tmp_path / "m")), planted).collect()}
    assert before == after
    schema = T.StructType([planted.schema[n] for n in ("a", "b", "c", "region")])
    row = planted.orderBy("id").first()
    one = M.score_rows(model, planted.sparkSession, [row.asDict()], schema).collect()[0]
    assert one.churn_probability == pytest.approx(before[row.id])


def test_permutation_importance_ranks_the_signal_first(vectors):
    model = M.fit_classifier(vectors, "random_forest", numTrees=10)
    rows = {r.feature: r.importance for r in E.permutation_importance(model, vectors, "id", "churn_label", FT.vector_names(vectors)).collect()}
    assert max(rows, key=rows.get) == "a_imp" and rows["a_imp"] > 0.2 and abs(rows["region_ohe_north"]) < 0.05


def test_linear_contributions(spark):
    df = spark.createDataFrame([(0.0, 5.0), (2.0, 5.0), (4.0, None)], "a double, b double")
    rows = {r.feature: r.importance for r in E.linear_contributions(df, [("a", 3.0), ("b", 100.0)]).collect()}
    assert rows == {"a": pytest.approx(4.0), "b": 0.0}


def test_pca_finds_the_main_direction(spark):
    from pyspark.ml.functions import array_to_vector

    rng = random.Random(1)
    rows = [(10 + t, 20 + t + rng.gauss(0, 0.01), rng.gauss(0, 0.01)) for t in (rng.gauss(0, 1) for _ in range(200))]
    df = spark.createDataFrame(rows, "a double, b double, c double").select(array_to_vector(F.array("a", "b", "c")).alias("v"))
    projected, model = FT.pca(df, "v")
    assert model.explainedVariance[0] > 0.99
    mean = projected.select(F.avg(F.get(vector_to_array("components"), F.lit(0))).alias("m")).collect()[0].m
    assert abs(mean) < 1e-9


def test_hybrid_features(spark):
    df = spark.createDataFrame([(1.0, 2, [0.1] * 40)], "a double, b int, e array<double>")
    size = lambda d: len(FT.hybrid_features(df, ["a", "b"], "e", d).collect()[0].features)
    assert (size(None), size(32)) == (42, 34)
