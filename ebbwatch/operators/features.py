"""Feature vectors: indexing, encoding, imputation, assembly, scaling, reduction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    PCA,
    Imputer,
    OneHotEncoder,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
    VectorSlicer,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbwatch import constants as K
from ebbwatch.operators.ranks import exact_quantiles


def encoding_stages(categorical: Sequence[str] = K.CATEGORICAL_FEATURES) -> list:
    """Index by frequency, then one-hot; a value not seen at fit time encodes as all zeros."""
    indexer = StringIndexer(
        inputCols=list(categorical), outputCols=[f"{c}_idx" for c in categorical], handleInvalid="keep"
    )
    encoder = OneHotEncoder(
        inputCols=[f"{c}_idx" for c in categorical], outputCols=[f"{c}_ohe" for c in categorical], dropLast=True
    )
    return [indexer, encoder]


def imputer(numeric: Sequence[str] = K.NUMERIC_FEATURES, relative_error: float = 0.001) -> Imputer:
    """Median imputation with Spark's bounded quantile sketch."""
    return Imputer(
        inputCols=list(numeric), outputCols=[f"{c}_imp" for c in numeric], strategy="median", relativeError=relative_error
    )


def assembler(columns: Sequence[str], output: str = "features_raw") -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid="skip")


def scaler(source: str = "features_raw", output: str = "features") -> StandardScaler:
    return StandardScaler(inputCol=source, outputCol=output, withMean=True, withStd=True)


def feature_stages(
    numeric: Sequence[str] = K.NUMERIC_FEATURES, categorical: Sequence[str] = K.CATEGORICAL_FEATURES
) -> Pipeline:
    """The five steps as one estimator."""
    columns = [f"{c}_imp" for c in numeric] + [f"{c}_ohe" for c in categorical]
    return Pipeline(stages=[*encoding_stages(categorical), imputer(numeric), assembler(columns), scaler()])


class FeatureSet:
    """A feature estimator that remembers what it was fitted on.

    ``numeric`` and ``categorical`` are the model inputs. ``fit`` is meant for training rows only;
    scoring rows go through ``transform``.
    """

    def __init__(self, numeric: Sequence[str] = K.NUMERIC_FEATURES, categorical: Sequence[str] = K.CATEGORICAL_FEATURES):
        self.numeric, self.categorical = list(numeric), list(categorical)
        self.model: PipelineModel | None = None

    def fit(self, df: DataFrame) -> FeatureSet:
        self.model = feature_stages(self.numeric, self.categorical).fit(df)
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        if self.model is None:
            raise RuntimeError("the feature set is not fitted; call fit() first")
        return self.model.transform(df)

    def fit_transform(self, df: DataFrame) -> DataFrame:
        return self.fit(df).transform(df)


def vector_names(df: DataFrame, column: str = "features_raw") -> list[str]:
    """Names of the vector's entries from the assembler's metadata."""
    groups = df.schema[column].metadata["ml_attr"]["attrs"]
    entries = sorted((a["idx"], a["name"]) for group in groups.values() for a in group)
    return [name for _, name in entries]


def impute_exact_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls replaced by the exact lower median of their column.

    The medians are one small row, read as a scalar subquery; ints stay ints.
    """
    medians = exact_quantiles(df, columns, [0.5], kind="disc")
    packed = medians.agg(F.map_from_entries(F.collect_list(F.struct("feature", "value"))).alias("m")).scalar()
    types = dict(df.dtypes)
    filled = df.withColumn("_medians", packed)
    return filled.withColumns(
        {f"{c}_imp": F.coalesce(F.col(c), F.col("_medians")[c].cast(types[c])) for c in columns}
    ).drop("_medians")


def centred(df: DataFrame, column: str) -> DataFrame:
    """Vector column minus its mean; the mean is one vector, read as a scalar subquery."""
    mean = df.agg(vector_to_array(Summarizer.mean(F.col(column))).alias("m")).scalar()
    shifted = F.zip_with(vector_to_array(column), F.col("_mean"), lambda x, m: x - m)
    return df.withColumn("_mean", mean).withColumn(column, array_to_vector(shifted)).drop("_mean")


def pca(df: DataFrame, column: str, k: int = 2, output: str = "components"):
    """Principal components of centred vectors: the projected frame and the fitted model."""
    shifted = centred(df, column)
    model = PCA(k=k, inputCol=column, outputCol=output).fit(shifted)
    return model.transform(shifted), model


def hybrid_features(
    df: DataFrame, tabular: Sequence[str], embedding: str, dims: int | None = None, output: str = "features"
) -> DataFrame:
    """Tabular columns and an embedding (or its first ``dims`` entries) in one vector."""
    rows = df.withColumn("_vector", array_to_vector(F.col(embedding).cast("array<double>")))
    source = "_vector"
    if dims is not None:
        rows = VectorSlicer(inputCol="_vector", outputCol="_slice", indices=list(range(dims))).transform(rows)
        source = "_slice"
    joined = VectorAssembler(inputCols=[*tabular, source], outputCol=output, handleInvalid="skip").transform(rows)
    return joined.drop("_vector", "_slice")


def positive_probability(column: str = "probability") -> Column:
    return F.get(vector_to_array(column), F.lit(1))
