"""Names that begin with other names, found in one pass over both in order."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.sources.shared import stage


def _nested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds to each name the lengths of the heads before it in the partition that it begins with.

    In order a head stands before all that begins with it, so the heads that hold at a place are a
    stack of ever longer strings.
    """
    stack: list[str] = []
    for batch in batches:
        lengths = []
        for string, is_name in zip(batch.column("s").to_pylist(), batch.column("is_name").to_pylist()):
            while stack and not string.startswith(stack[-1]):
                stack.pop()
            lengths.append([len(h) for h in stack] if is_name else None)
            if not is_name and (not stack or stack[-1] != string):
                stack.append(string)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lengths, pa.list_(pa.int32()))], [*batch.schema.names, "lengths"])


def prefix_matches(heads: DataFrame, names: DataFrame) -> DataFrame:
    """``names`` (name and more) with each ``head`` of ``heads`` (head) that the name begins with.

    Heads and names are dealt once, to range partitions of their common order, and every partition
    is read once.  A head of an earlier partition holds in a later one only if the later one's
    first string begins with it: these are a few strings for each partition, looked up apart.
    Empty and null strings match nothing; equal heads count once, equal names are rows of their own.
    """
    columns = names.columns
    rows = names.where(F.length("name") > 0).select(F.col("name").alias("s"), F.lit(True).alias("is_name"), F.struct(*columns).alias("row"))
    asked = heads.where(F.length("head") > 0).select("head").distinct().select(F.col("head").alias("s"), F.lit(False).alias("is_name"), F.lit(None).cast(rows.schema["row"].dataType).alias("row"))
    both = rows.unionByName(asked).withColumn("spread", F.monotonically_increasing_id())  # many equal names are several partitions
    ordered = both.repartitionByRange("s", "is_name", "spread").sortWithinPartitions("s", "is_name", "spread").withColumn("part", F.spark_partition_id())
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ordered.schema)
    found = stage(ordered.mapInArrow(_nested, f"{schema}, lengths array<int>"), "prefixes")
    # one row for each partition, and one for each prefix of its first string
    first = found.groupBy("part").agg(F.min("s").alias("first"))
    starts = first.select(F.col("part").alias("later"), "first", F.explode(F.sequence(F.lit(1), F.length("first"))).alias("n"))
    begun = found.where(~F.col("is_name")).select(F.col("s").alias("head"), "part")
    held = starts.join(begun, F.left("first", F.col("n")) == F.col("head")).where(F.col("part") < F.col("later"))
    held = held.groupBy(F.col("later").alias("part"), "first").agg(F.collect_set("n").alias("before"))
    given = found.where("is_name").join(held, "part", "left")
    # a head that stands in the partition itself is in the stack
    more = F.filter(F.coalesce("before", F.array().cast("array<int>")), lambda n: F.left("s", n) == F.left("first", n))
    return given.select("row", "s", F.explode(F.array_union("lengths", more)).alias("n")).select("row.*", F.left("s", F.col("n")).alias("head"))
