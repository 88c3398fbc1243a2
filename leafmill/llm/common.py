"""Helpers shared by the training-data operators.

``stage`` is the only place that writes intermediate tables.  They go to the folder named by
``spark.checkpoint.dir`` (shared by driver and executors); a private temporary folder is used
only where that setting is absent and the master is local, as in tests on one machine.
"""

from __future__ import annotations

import atexit
import gc
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text handled at once by the vectorised operators: bounds their temporary arrays.
CHUNK_BYTES = 1 << 20

_own: list[str] = []
_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def prepare(spark: SparkSession) -> SparkSession:
    """Keep Arrow batches to a few MB of ordinary documents, and this package on the workers' path."""
    path = spark.sparkContext.environment.get("PYTHONPATH", "")
    if _ROOT not in path.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [_ROOT, path]))
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > 2000:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def wrapped(docs: DataFrame) -> DataFrame:
    """doc_id, text and ``rest`` (all other columns, doc_id too): no name of theirs can clash with a step's."""
    return docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("rest"))


def unwrapped(frame: DataFrame, docs: DataFrame, **changed: Column) -> DataFrame:
    """The columns of ``docs`` from a frame that ``wrapped`` began, some replaced."""
    own = lambda c: changed[c] if c in changed else F.col("text") if c == "text" else F.col("rest").getField(c)
    return frame.select(*[own(c).alias(c) for c in docs.columns])


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``, else the context's checkpoint folder.

    Without either a private folder is made, on a local master only: executors of a cluster don't see it.
    """
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


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner drop shuffle files of plans that are no longer referenced."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def stage(df: DataFrame, tag: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = fresh_path(spark, tag)
    df.write.parquet(path)
    schema = df.schema
    del df
    release_shuffles(spark)
    staged = spark.read.schema(schema).parquet(path)
    staged._staged_at = path
    return staged


def unstage(df: DataFrame) -> None:
    """Delete a table that ``stage`` wrote, once nothing reads it any more."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df._staged_at)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def text_chunks(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most ``limit`` bytes of text, or one row that is longer."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pa.compute.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        start, total = 0, 0
        for row, size in enumerate(sizes.tolist()):
            if total and total + size > limit:
                yield batch.slice(start, row - start)
                start, total = row, 0
            total += size
        yield batch.slice(start)


def text_bytes(column: pa.Array):
    """(bytes of all texts one after the other, offsets) of a string column; null is empty."""
    import numpy as np

    column = column.fill_null("")
    wide = column.cast(pa.large_string())
    offsets = np.frombuffer(wide.buffers()[1], np.int64)[wide.offset : wide.offset + len(wide) + 1]
    data = wide.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]] if len(offsets) else raw[:0], offsets - (offsets[0] if len(offsets) else 0)


import pyarrow.compute  # noqa: E402,F401  pa.compute is used above
