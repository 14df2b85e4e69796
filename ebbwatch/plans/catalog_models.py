"""Feature vectors, models and explanations."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from ebbwatch import constants as K
from ebbwatch.functions import scalar as S
from ebbwatch.operators import attribution as A
from ebbwatch.operators import explain as E
from ebbwatch.operators import features as FT
from ebbwatch.operators import models as M
from ebbwatch.operators import splits
from ebbwatch.operators.metrics import binary_metrics
from ebbwatch.plans import jobs
from ebbwatch.plans import oracle as O
from ebbwatch.plans.catalog_text import DENSE, TEXT_DIM, TEXTS, customer_intent
from ebbwatch.plans.registry import gold, micro_text, query, silver, six
from ebbwatch.sources.snapshot import behaviour, customer_raw
from ebbwatch.sources.storage import materialize, read_table, scratch_path, spread

d = O.d


def training(spark, folder, text: bool = False):
    """Gold table with its split, written to the shared folder."""
    intent = customer_intent(spark, folder) if text else None
    return jobs.training_table(customer_raw(spark, folder), intent)


def _fitted_features(spark, folder):
    """Vectors of all rows, written once; the feature stages see the training part only."""
    rows = training(spark, folder)
    features = FT.FeatureSet().fit(rows.where("part = 'train'"))
    vectors = features.transform(rows).select("customer_id", "part", "churn_label", "features_raw", "features")
    return materialize(vectors, "vectors")


# --------------------------------------------------------------------------------------- features


def _index_sql(c: str) -> str:
    return f"{c}_i AS (SELECT {c}, row_number() OVER (ORDER BY n DESC, {c}) - 1 AS idx FROM (SELECT {c}, count(*) AS n FROM silver GROUP BY 1))"


@query(
    "string_index",
    f"""WITH {O.SILVER}, {_index_sql('region')}, {_index_sql('segment')}
    SELECT customer_id, region_i.idx::double AS region_idx, segment_i.idx::double AS segment_idx
    FROM silver JOIN region_i USING (region) JOIN segment_i USING (segment)""",
)
def string_index(spark, folder):
    rows = silver(spark, folder).select("customer_id", *K.CATEGORICAL_FEATURES)
    return FT.encoding_stages()[0].fit(rows).transform(rows).select("customer_id", "region_idx", "segment_idx")


def _hot_sql(idx: str, size: str) -> str:
    return f"array_to_string(list_transform(generate_series(0, cast({size} AS int) - 1), lambda i: CASE WHEN i = {idx} THEN '1' ELSE '0' END), '')"


@query(
    "one_hot",
    f"""WITH {O.SILVER}, {_index_sql('region')}, {_index_sql('segment')},
    rs AS (SELECT count(*) AS n FROM region_i), ss AS (SELECT count(*) AS n FROM segment_i)
    SELECT customer_id, {_hot_sql('region_i.idx', 'rs.n')} AS region_hot, {_hot_sql('segment_i.idx', 'ss.n')} AS segment_hot
    FROM silver JOIN region_i USING (region) JOIN segment_i USING (segment) CROSS JOIN rs CROSS JOIN ss""",
)
def one_hot(spark, folder):
    indexer, encoder = FT.encoding_stages()
    rows = silver(spark, folder).select("customer_id", *K.CATEGORICAL_FEATURES)
    indexed = indexer.fit(rows).transform(rows)
    encoded = encoder.fit(indexed).transform(indexed)
    bits = lambda c: F.array_join(F.transform(vector_to_array(c), lambda x: x.cast("int").cast("string")), "")
    return encoded.select("customer_id", bits("region_ohe").alias("region_hot"), bits("segment_ohe").alias("segment_hot"))


_NUMERIC = list(K.NUMERIC_FEATURES)


@query(
    "impute_median",
    f"WITH {O.GOLD}, m AS (SELECT "
    + ", ".join(f"quantile_disc({c}, 0.5) AS {c}" for c in _NUMERIC)
    + " FROM gold) SELECT customer_id, "
    + ", ".join(f"coalesce(gold.{c}, m.{c}) AS {c}_imp" for c in _NUMERIC)
    + " FROM gold CROSS JOIN m",
)
def impute_median(spark, folder):
    rows = FT.impute_exact_median(gold(spark, folder), _NUMERIC)
    return rows.select("customer_id", *[f"{c}_imp" for c in _NUMERIC])


@query(
    "assemble",
    f"WITH {O.GOLD}, m AS (SELECT "
    + ", ".join(f"quantile_disc({c}, 0.5) AS {c}" for c in _NUMERIC)
    + " FROM gold) SELECT customer_id, array_to_string(["
    + ", ".join(O.micro(f"coalesce(gold.{c}, m.{c})::double") for c in _NUMERIC)
    + "], ',') AS features FROM gold CROSS JOIN m",
)
def assemble(spark, folder):
    """The contents of the assembled vectors."""
    filled = FT.impute_exact_median(gold(spark, folder), _NUMERIC)
    vectors = FT.assembler([f"{c}_imp" for c in _NUMERIC]).transform(filled)
    return vectors.select("customer_id", micro_text(vector_to_array("features_raw")).alias("features"))


_SCALED = ("age", "tenure_months", "n_products", "monthly_transactions", "nps_score")


def _z(c: str) -> str:
    return O.six(f"CASE WHEN sd_{c} > 0 THEN ({c} - mean_{c}) / sd_{c} ELSE {d('0.0')} END")


@query(
    "standardize",
    f"WITH {O.SILVER}, m AS (SELECT "
    + ", ".join(f"avg({c}) AS mean_{c}, stddev_samp({c}) AS sd_{c}" for c in _SCALED)
    + " FROM silver) SELECT customer_id, "
    + ", ".join(f"{_z(c)} AS z_{c}" for c in _SCALED)
    + " FROM silver CROSS JOIN m",
)
def standardize(spark, folder):
    vectors = FT.assembler(_SCALED).transform(silver(spark, folder).select("customer_id", *_SCALED))
    scaled = FT.scaler().fit(vectors).transform(vectors)
    cells = vector_to_array("features")
    return scaled.select("customer_id", *[six(F.get(cells, F.lit(i))).alias(f"z_{c}") for i, c in enumerate(_SCALED)])


@query("feature_encoding")
def feature_encoding(spark, folder):
    """All feature steps, fitted on the training part and applied to every row."""
    rows = _fitted_features(spark, folder)
    return rows.select("customer_id", "part", vector_to_array("features").alias("features"))


@query("pca_2d")
def pca_2d(spark, folder):
    vectors = read_table(spark, folder, "embeddings").select(
        "vec_id", "label", array_to_vector(F.col("embedding").cast("array<double>")).alias("features")
    )
    projected, model = FT.pca(vectors, "features", k=2)
    xy = vector_to_array("components")
    share = [float(v) for v in model.explainedVariance]
    return projected.select(
        "vec_id", "label", F.abs(F.get(xy, F.lit(0))).alias("abs_x"), F.abs(F.get(xy, F.lit(1))).alias("abs_y"),
        F.lit(share[0]).alias("variance_x"), F.lit(share[1]).alias("variance_y"),
    )


def _hybrid(spark, folder, dims=None):
    rows = behaviour(spark, folder).join(customer_intent(spark, folder).select("customer_id", "embedding"), "customer_id")
    return FT.hybrid_features(rows, K.BEHAVIOUR_FEATURES, "embedding", dims, output="hybrid")


@query(
    "hybrid_features",
    f"""WITH {O.BEHAVIOUR}, {TEXTS}, {DENSE}, km AS (SELECT customer_id, pos, avg(x) AS x FROM dense GROUP BY 1, 2),
    ke AS (SELECT customer_id, list({O.micro('x')} ORDER BY pos) AS e FROM km GROUP BY 1),
    kb AS (SELECT customer_id, [{', '.join(O.micro(c + '::double') for c in K.BEHAVIOUR_FEATURES)}] AS b FROM behaviour)
    SELECT customer_id, array_to_string(list_concat(b, e), ',') AS whole, array_to_string(list_concat(b, e[1:32]), ',') AS narrow
    FROM kb JOIN ke USING (customer_id)""",
)
def hybrid_features(spark, folder):
    """Vectors of customers with text, with the whole embedding and with its first 32 entries."""
    whole, narrow = _hybrid(spark, folder), _hybrid(spark, folder, 32)
    cells = lambda c: micro_text(vector_to_array(c))
    return whole.select("customer_id", cells("hybrid").alias("whole")).join(
        narrow.select("customer_id", cells("hybrid").alias("narrow")), "customer_id"
    )


# ----------------------------------------------------------------------------------------- models


def _train_and_evaluate(spark, folder, kind, **settings):
    rows = training(spark, folder)
    model = jobs.fit_model(rows, kind, with_intent=False, **settings)
    scores = M.score_customers(model, rows.where("part = 'test'"))
    return M.evaluate(scores).withColumn("model", F.lit(kind))


@query("train_random_forest")
def train_random_forest(spark, folder):
    return _train_and_evaluate(spark, folder, "random_forest")


@query("train_gbt")
def train_gbt(spark, folder):
    return _train_and_evaluate(spark, folder, "gbt")


@query("train_logistic")
def train_logistic(spark, folder):
    return _train_and_evaluate(spark, folder, "logistic")


@query("cross_validate")
def cross_validate(spark, folder):
    """Mean AUC of each setting of the whole grid over five hash folds."""
    rows = _fitted_features(spark, folder).where("part = 'train'")
    found = M.cross_validate(rows, "random_forest", "customer_id", folds=5)
    lines = [
        ({p.name: v for p, v in setting.items()}, float(auc)) for setting, auc in zip(found.getEstimatorParamMaps(), found.avgMetrics)
    ]
    return spark.createDataFrame(
        [(int(s["maxDepth"]), int(s["numTrees"]), a) for s, a in lines], "max_depth int, num_trees int, mean_auc double"
    )


@query("tune_search")
def tune_search(spark, folder):
    rows = _fitted_features(spark, folder).where("part = 'train'")
    found = M.tune_search(rows, "logistic", "customer_id", candidates=3)
    lines = [(s["regParam"], s["elasticNetParam"], a) for s, a in zip(found.settings, found.validationMetrics, strict=True)]
    return spark.createDataFrame(lines, "reg_param double, elastic_net double, auc double")


@query("train_boosted_weighted")
def train_boosted_weighted(spark, folder):
    rows = _fitted_features(spark, folder)
    held_out = S.hash_bucket("customer_id", 100, salt="held:") < 20
    train = rows.where("part = 'train'").withColumn("held_out", held_out)
    model = M.train_boosted_weighted(train, "held_out")
    scores = M.score_customers(model, rows.where("part = 'test'"))
    return M.evaluate(scores).withColumn("n_trees", F.lit(model.getNumTrees))


def _behaviour_vectors(spark, folder):
    rows = splits.split_by_hash(behaviour(spark, folder), "customer_id")
    written = materialize(rows, "behaviour")
    vectors = FT.assembler(K.BEHAVIOUR_FEATURES).transform(written)
    scaler = FT.scaler().fit(vectors.where("part = 'train'"))
    return materialize(scaler.transform(vectors), "behaviour-vectors")


def _network(rows):
    return M.train_mlp(rows.where("part = 'train'"), len(K.BEHAVIOUR_FEATURES))


@query("train_mlp")
def train_mlp(spark, folder):
    rows = _behaviour_vectors(spark, folder)
    model = _network(rows)
    scores = M.score_customers(model, rows.where("part = 'test'"))
    return binary_metrics(scores, "churn", "churn_probability")


@query("train_mlp_hybrid")
def train_mlp_hybrid(spark, folder):
    """Network on tabular and text features together, for customers with text; fitted on the training part."""
    rows = splits.split_by_hash(_hybrid(spark, folder).select("customer_id", "churn", "hybrid"), "customer_id")
    rows = materialize(rows, "hybrid")
    scaler = FT.scaler("hybrid", "features").fit(rows.where("part = 'train'"))
    scaled = materialize(scaler.transform(rows), "hybrid-vectors")
    model = M.train_mlp(scaled.where("part = 'train'"), len(K.BEHAVIOUR_FEATURES) + TEXT_DIM, hidden=(128, 64))
    return M.score_customers(model, scaled).select("customer_id", "part", "churn", "churn_probability", "prediction")


def _labelled_documents(spark, folder):
    docs = spread(read_table(spark, folder, "documents").select("doc_id", "text"))
    labels = read_table(spark, folder, "labels")
    return splits.split_by_hash(docs.join(labels, "doc_id"), "doc_id")


@query("train_text_classifier")
def train_text_classifier(spark, folder):
    rows = materialize(_labelled_documents(spark, folder), "labelled-documents")
    model = M.text_classifier("quality").fit(rows.where("part = 'train'"))
    scores = M.score_customers(model, rows.where("part = 'test'"))
    return binary_metrics(scores, "quality", "churn_probability")


@query("positive_probability")
def positive_probability(spark, folder):
    rows = training(spark, folder)
    model = jobs.fit_model(rows, "logistic", with_intent=False)
    return model.transform(rows).select("customer_id", FT.positive_probability().alias("churn_probability"))


@query("score_customers")
def score_customers(spark, folder):
    rows = training(spark, folder)
    model = jobs.fit_model(rows, "random_forest", with_intent=False)
    return M.score_customers(model, rows).select("customer_id", "churn_probability", "churn_risk_level", "recommended_action")


@query("predict_one")
def predict_one(spark, folder):
    """Network score, band and action of each row; one literal row takes the same path."""
    rows = _behaviour_vectors(spark, folder)
    scores = M.score_customers(_network(rows), rows)
    p = "churn_probability"
    return scores.select(
        "customer_id", p, S.band(p, K.NETWORK_CUTS, K.NETWORK_LABELS).alias("riesgo"), S.band(p, K.NETWORK_CUTS, K.NETWORK_ACTIONS).alias("accion")
    )


@query("save_load_model", f"WITH {O.SILVER} SELECT customer_id, true AS equal FROM silver")
def save_load_model(spark, folder):
    """Whether a model and its saved copy give every customer the same score."""
    rows = training(spark, folder)
    model = jobs.fit_model(rows, "logistic", with_intent=False)
    path = scratch_path(spark, "model")
    M.save_model(model, path)
    again = M.load_model(path)
    first = M.score_customers(model, rows).select("customer_id", F.col("churn_probability").alias("before"))
    second = M.score_customers(again, rows).select("customer_id", F.col("churn_probability").alias("after"))
    return first.join(second, "customer_id").select("customer_id", (F.col("before") == F.col("after")).alias("equal"))


@query("end_to_end")
def end_to_end(spark, folder):
    run = jobs.run_churn_job(customer_raw(spark, folder), customer_intent(spark, folder))
    return run.scores.drop("gold_ts")


@query("text_clusters")
def text_clusters(spark, folder):
    """Customers clustered by their mean text vector, with the silhouette of the clustering."""
    rows = customer_intent(spark, folder).select("customer_id", array_to_vector("embedding").alias("features"))
    rows = materialize(rows, "customer-vectors")
    assigned, _ = M.cluster_vectors(rows, "features", k=5)
    silhouette = ClusteringEvaluator(predictionCol="cluster", featuresCol="features").evaluate(assigned)
    return assigned.select("customer_id", "cluster", F.lit(float(silhouette)).alias("silhouette"))


# ------------------------------------------------------------------------------------ explanations

_VIP_WEIGHTS = [(c, w / level) for c, w, level in K.VIP_LINEAR_TERMS]


def _contribution_sql(c: str, w: str, level: str) -> str:
    weight = f"({d(w)} / {d(level)})"
    return f"SELECT '{c}' AS feature, {O.six(f'avg(abs({weight} * ({c} - mean_{c})))')} AS importance FROM silver CROSS JOIN m"


_VIP_SQL = (
    ("avg_balance_6m", "0.30", "1000000.0"), ("clv_score", "0.25", "1000000.0"), ("n_products", "0.20", "8.0"),
    ("tenure_months", "0.15", "360.0"), ("monthly_transactions", "0.10", "50.0"),
)


@query(
    "linear_contributions",
    f"WITH {O.SILVER}, m AS (SELECT " + ", ".join(f"avg({c}::double) AS mean_{c}" for c, _, _ in _VIP_SQL) + " FROM silver) "
    + " UNION ALL ".join(_contribution_sql(*t) for t in _VIP_SQL),
)
def linear_contributions(spark, folder):
    """Attribution of the linear VIP score, whose weights are known."""
    rated = E.linear_contributions(silver(spark, folder), _VIP_WEIGHTS)
    return rated.select("feature", six("importance").alias("importance"))


@query("model_contributions")
def model_contributions(spark, folder):
    """Attribution of the fitted logistic model, ten largest."""
    rows = _fitted_features(spark, folder)
    model: LogisticRegressionModel = M.fit_classifier(rows.where("part = 'train'"), "logistic")
    rated = E.vector_contributions(rows, model.coefficients.toArray(), FT.vector_names(rows))
    return E.importance_rank(rated)


@query("tree_importance")
def tree_importance(spark, folder):
    rows = _fitted_features(spark, folder)
    model = M.fit_classifier(rows.where("part = 'train'"), "random_forest")
    return E.tree_importance(spark, model, FT.vector_names(rows))


@query("boosted_importance")
def boosted_importance(spark, folder):
    """Split importance of the boosted, weighted trees."""
    rows = _fitted_features(spark, folder)
    return E.tree_importance(spark, _boosted(rows), FT.vector_names(rows))


def _boosted(rows):
    held_out = S.hash_bucket("customer_id", 100, salt="held:") < 20
    return M.train_boosted_weighted(rows.where("part = 'train'").withColumn("held_out", held_out), "held_out")


@query("forest_contributions")
def forest_contributions(spark, folder):
    """Features by the mean absolute Shapley value of the forest's probability over all customers."""
    rows = _fitted_features(spark, folder)
    model = M.fit_classifier(rows.where("part = 'train'"), "random_forest", numTrees=50)
    return E.importance_rank(A.mean_contributions(A.tree_contributions(model, rows, "customer_id"), FT.vector_names(rows)), top=None)


@query(
    "boosted_contributions",
    f"""WITH {O.SILVER} SELECT customer_id, true AS adds_up, true AS has_reason FROM silver""",
)
def boosted_contributions(spark, folder):
    """For every customer whether base and contributions add up to the margin of the boosted model, and whether the
    strongest of them points where the margin lies from the base."""
    rows = _fitted_features(spark, folder)
    model = _boosted(rows)
    values = A.tree_contributions(model, rows, "customer_id")
    margins = model.transform(rows).select(F.col("customer_id").alias("of"), F.get(vector_to_array("rawPrediction"), F.lit(1)).alias("margin"))
    total = F.aggregate("contributions", F.lit(0.0), lambda s, x: s + x)
    gap = F.col("margin") - F.col("base")
    pointing = F.exists("contributions", lambda x: x * F.signum(gap) > 0) | (F.abs(gap) < 1e-9)
    joined = values.join(margins, F.col("customer_id") == F.col("of"))
    return joined.select("customer_id", (F.abs(total - gap) < 1e-9).alias("adds_up"), pointing.alias("has_reason"))


@query(
    "importance_rank",
    f"WITH {O.SILVER}, m AS (SELECT " + ", ".join(f"avg({c}::double) AS mean_{c}" for c, _, _ in _VIP_SQL) + " FROM silver), c AS ("
    + " UNION ALL ".join(_contribution_sql(*t) for t in _VIP_SQL)
    + f") SELECT feature, importance, {O.six('importance / (max(importance) OVER ())')} AS relative FROM c",
)
def importance_rank(spark, folder):
    """Inputs of the linear VIP score by importance, with their share of the largest."""
    ranked = E.importance_rank(linear_contributions(spark, folder))
    return ranked.withColumn("relative", six("relative"))


@query("permutation_importance")
def permutation_importance(spark, folder):
    rows = _behaviour_vectors(spark, folder)
    model = M.fit_classifier(rows.where("part = 'train'"), "random_forest", "churn")
    return E.permutation_importance(model, rows.where("part = 'test'"), "customer_id", "churn", K.BEHAVIOUR_FEATURES)


@query("mlp_input_importance")
def mlp_input_importance(spark, folder):
    rows = _behaviour_vectors(spark, folder)
    return E.importance_rank(E.mlp_input_importance(spark, _network(rows), K.BEHAVIOUR_FEATURES), top=None)
