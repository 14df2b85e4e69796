"""Shapley values of tree ensembles against the definition, and that they add up to the predictions."""

from inspect import signature
from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ebbwatch.operators import attribution as A


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.range(600).selectExpr(
        "id", "cast(id % 7 as double) a", "cast((id * 37) % 101 as double) b", "cast((id * 13) % 29 as double) c",
        "concat('k', (id * 31) % 5) kind",
    )
    score = F.col("a") + F.col("b") / 20 + F.when(F.col("kind").isin("k1", "k4"), 3) .otherwise(0) + F.when(F.col("c") > 10, 2).otherwise(0)
    df = df.withColumn("label", (score > 8).cast("double"))
    df = StringIndexer(inputCol="kind", outputCol="kind_at").fit(df).transform(df)
    return VectorAssembler(inputCols=["a", "b", "c", "kind_at"], outputCol="features").transform(df).cache()


def expected(nodes, tree, known, x, value, cover, at=0):
    """The tree's prediction when only some features are known: the others go both ways by the share of rows."""
    n = nodes[tree][at]
    if n.left < 0:
        return value(n)
    goes_left = x[n.feature] in n.cuts if n.categories >= 0 else x[n.feature] <= n.cuts[0]
    sides = [(n.left, goes_left), (n.right, not goes_left)]
    if n.feature in known:
        return expected(nodes, tree, known, x, value, cover, next(c for c, went in sides if went))
    return sum(
        cover(nodes[tree][c]) / cover(n) * expected(nodes, tree, known, x, value, cover, c) for c, _ in sides
    )


@pytest.mark.parametrize("kind", ["forest", "boosted"])
def test_values_equal_the_definition_and_add_up(spark, rows, kind):
    if kind == "forest":
        model = RandomForestClassifier(numTrees=4, maxDepth=5, seed=1).fit(rows)
        weights, value, cover = [0.25] * 4, (lambda n: n.stats[1] / sum(n.stats)), (lambda n: sum(n.stats))
        shown = vector_to_array("probability")[1]
    else:
        model = GBTClassifier(maxIter=4, maxDepth=4, seed=1).fit(rows)
        weights, value, cover = model.treeWeights, (lambda n: n.prediction), (lambda n: n.stats[0])
        shown = vector_to_array("rawPrediction")[1]
    table = A.node_table(model).collect()
    assert any(n.categories >= 0 for n in table)
    nodes = {t: {n.id: n for n in table if n.tree == t} for t in {n.tree for n in table}}
    found = {r.id: r for r in A.tree_contributions(model, rows, "id", batch_rows=100).collect()}
    want = {r.id: r for r in model.transform(rows).select("id", shown.alias("p"), vector_to_array("features").alias("x")).collect()}
    assert len(found) == 600
    for i, r in found.items():
        assert abs(r.base + sum(r.contributions) - want[i].p) < 1e-9
    for i in range(0, 600, 67):
        x = want[i].x
        f = lambda s: sum(w * expected(nodes, t, s, x, value, cover) for t, w in enumerate(weights))  # noqa: B023, E731
        assert abs(f(set()) - found[i].base) < 1e-9
        for j in range(4):
            others = [k for k in range(4) if k != j]
            phi = sum(
                factorial(n) * factorial(3 - n) / factorial(4) * (f({*s, j}) - f(set(s)))
                for n in range(4)
                for s in combinations(others, n)
            )
            assert abs(phi - found[i].contributions[j]) < 1e-9


def test_mean_values_nulls_and_other_models(spark, rows):
    model = GBTClassifier(maxIter=2, maxDepth=3, seed=1).fit(rows)
    some = rows.select("id", F.when(F.col("id") % 3 > 0, F.col("features")).alias("features"))
    found = A.tree_contributions(model, some, "id")
    got = found.collect()
    assert [r.contributions is None for r in sorted(got)] == [i % 3 == 0 for i in range(600)]
    means = {r.feature: r.importance for r in A.mean_contributions(found, ["a", "b", "c", "kind"]).collect()}
    x = np.abs([r.contributions for r in got if r.contributions is not None]).mean(axis=0)
    assert np.allclose([means[n] for n in ("a", "b", "c", "kind")], x, atol=1e-12)
    assert A.tree_contributions(model, some.limit(0), "id").count() == 0
    with pytest.raises(TypeError):
        A.flatten(LogisticRegression(maxIter=1).fit(rows))


def test_patterns_are_worked_out_once_for_an_arrow_batch(rows):
    model = RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=3, maxDepth=3, seed=1).fit(rows)
    ensemble = A.flatten(model)
    x = np.array([list(r.features) for r in rows.limit(60).collect()])
    pieces = np.concatenate([A.shapley_values(ensemble, x[i : i + 7]) for i in range(0, len(x), 7)])
    assert np.allclose(pieces, A.shapley_values(ensemble, x), atol=1e-12)
    assert signature(A.tree_contributions).parameters["batch_rows"].default >= 10_000
