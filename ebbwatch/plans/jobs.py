"""Whole jobs: from the raw table to exported scores."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbwatch import constants as K
from ebbwatch.operators import models
from ebbwatch.operators.features import FeatureSet
from ebbwatch.operators.quality import raw_to_silver
from ebbwatch.operators.reports import executive_summary
from ebbwatch.operators.scoring import add_vip, join_intent, silver_to_gold
from ebbwatch.operators.splits import split_by_hash
from ebbwatch.sources.storage import export_scores, materialize, scratch_path


@dataclass
class ChurnRun:
    """What an end-to-end run leaves behind; the frames are lazy over the exported table."""

    scores: DataFrame
    metrics: DataFrame
    summary: DataFrame
    model: PipelineModel
    path: str


def training_table(raw: DataFrame, intent: DataFrame | None, label: str = "gold") -> DataFrame:
    """Gold rows with text intent and their train / test part, written once.

    Training reads the rows many times, so the lineage is cut at this table.
    """
    silver = raw_to_silver(raw)
    if intent is None:
        silver = silver.withColumn("churn_intent_score", F.lit(0.0))
    else:
        silver = join_intent(silver, intent)
    gold = silver_to_gold(silver)
    return materialize(split_by_hash(gold, "customer_id"), label)


def fit_model(gold: DataFrame, kind: str, with_intent: bool = True, search: bool = False, **settings) -> PipelineModel:
    """Feature stages and classifier, fitted on the training part only; ``search`` takes the best of the grid.

    The vectors are written before training: iterations then start from a plain scan instead of
    carrying the plan of all feature stages in every task.
    """
    numeric = [*K.NUMERIC_FEATURES, "churn_intent_score"] if with_intent else list(K.NUMERIC_FEATURES)
    train = gold.where("part = 'train'")
    features = FeatureSet(numeric).fit(train)
    vectors = materialize(features.transform(train).select("customer_id", "churn_label", "features"), "vectors")
    if search:
        fitted = models.cross_validate(vectors, kind, "customer_id", **settings).bestModel
    else:
        fitted = models.fit_classifier(vectors, kind, **settings)
    return PipelineModel(stages=[*features.model.stages, fitted])


def run_churn_job(
    raw: DataFrame,
    intent: DataFrame | None = None,
    kind: str = "random_forest",
    path: str | None = None,
    search: bool = False,
    **settings,
) -> ChurnRun:
    """Silver, text join, gold, features, training, evaluation, scoring, VIP, export, summary."""
    spark: SparkSession = raw.sparkSession
    gold = training_table(raw, intent)
    model = fit_model(gold, kind, with_intent=intent is not None, search=search, **settings)
    scored = add_vip(models.score_customers(model, gold), "linear")
    path = path or scratch_path(spark, "churn-vip-scores")
    export_scores(scored, path, [*K.EXPORT_COLUMNS, "part", "churn_label", "churn_intent_score"], partition_by=["region"])
    scores = spark.read.parquet(path)
    metrics = models.evaluate(scores.where("part = 'test'"))
    return ChurnRun(scores, metrics, executive_summary(scores), model, path)
