"""Small text files in whatever store Spark reads: numbered, written whole, never overwritten."""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class VersionTaken(RuntimeError):
    """Another writer published this version first."""


def _store(spark: SparkSession, path: str):
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; a missing folder has none."""
    store, path = _store(spark, folder)
    if not store.exists(path(folder)):
        return []
    return sorted(s.getPath().getName() for s in store.listStatus(path(folder)))


def delete(spark: SparkSession, target: str) -> None:
    store, path = _store(spark, target)
    store.delete(path(target), True)


def _name(version: int) -> str:
    return f"v{version:012d}.json"


def latest(spark: SparkSession, folder: str) -> int | None:
    """The highest published version."""
    found = [int(n[1:13]) for n in names_in(spark, folder) if n.startswith("v") and n.endswith(".json")]
    return max(found, default=None)


def read(spark: SparkSession, folder: str, version: int) -> dict:
    store, path = _store(spark, folder)
    stream = store.open(path(f"{folder}/{_name(version)}"))
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def publish(spark: SparkSession, folder: str, version: int, content: dict) -> None:
    """Write a version under a name of its own and give it its number, unless that is taken.

    Readers see a version whole or not at all. Of two writers that prepare the same version one is told
    ``VersionTaken``; its files stay unreferenced.
    """
    store, path = _store(spark, folder)
    hidden, target = path(f"{folder}/_{uuid.uuid4().hex}"), path(f"{folder}/{_name(version)}")
    out = store.create(hidden, False)
    try:
        out.write(bytearray(json.dumps(content).encode()))
    finally:
        out.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(store.makeQualified(hidden), store.makeQualified(target), options)
    except Py4JJavaError as error:
        store.delete(hidden, False)
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            raise VersionTaken(_name(version)) from error
        raise
