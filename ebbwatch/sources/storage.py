"""Where tables are read from and where intermediate tables and checkpoints go."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """A small table over all cores: rows of a scan with fewer splits than cores are dealt anew, others stay.

    What is small is told by the splits, so a table that fills the cores is never moved.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def read_typed(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", **options) -> DataFrame:
    """Read a table with a fixed schema: no inference pass, missing columns come back null."""
    return spark.read.format(fmt).schema(schema).options(**options).load(path)


def read_optional(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read a Parquet table that may be missing; a missing one is an empty frame of its schema."""
    try:
        return read_typed(spark, path, schema)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared checkpoint folder of the session.

    A local session without one gets a temporary folder. A cluster session without one is an
    error, because a folder of one machine is invisible to the others.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    name = f"{label}-{uuid.uuid4().hex}"
    if shared:
        return f"{shared.rstrip('/')}/ebbwatch/{name}"
    if spark.sparkContext.master.startswith("local"):
        return f"{tempfile.mkdtemp(prefix='ebbwatch-')}/{name}"
    raise ValueError("set spark.checkpoint.dir to a folder that all executors share")


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    files: int | None = None,
    mode: str = "overwrite",
    fmt: str = "parquet",
) -> None:
    """Write a table; ``files`` sets the number of output files, ``partition_by`` the folders.

    Without ``files`` the layout of the plan is kept and adaptive execution sizes the tasks. A
    folder column is not used as the only shuffle key: one value may hold most of the rows.
    """
    if files is not None:
        df = df.repartition(files)
    writer = df.write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage at a written table, which outlives lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def project_available(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    return df.select(*[name for name in wanted if name in df.columns])


def export_scores(df: DataFrame, path: str, wanted: Sequence[str], partition_by: Sequence[str] = (), files=None) -> None:
    write_table(project_available(df, wanted), path, partition_by, files)
