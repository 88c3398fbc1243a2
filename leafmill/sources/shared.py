"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, else the context's checkpoint folder, else, on a local master only, a private folder."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        given = spark.sparkContext._jsc.sc().getCheckpointDir()
        named = given.get() if given.isDefined() else None
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not _own:
        _own.append(tempfile.mkdtemp(prefix="leafmill-"))
        atexit.register(shutil.rmtree, _own[0], True)
    return f"file://{_own[0]}"


def fresh_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"


def stage(rows: DataFrame, tag: str) -> DataFrame:
    """``rows`` written once and read back: cuts lineage, fixes what may not change from reading to reading."""
    spark, path = rows.sparkSession, fresh_path(rows.sparkSession, tag)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def local_path(uri: str) -> str:
    """A mounted folder's path without ``file:``."""
    return uri.removeprefix("file://") if uri.startswith("file://") else uri.removeprefix("file:")
