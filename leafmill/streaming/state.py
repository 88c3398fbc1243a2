"""Streaming forms of resume and of the circuit breaker."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from leafmill.operators.progress import breaker_step


def new_files(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """Rows of Parquet files that no earlier run of the query (its checkpoint) has read."""
    return spark.readStream.schema(schema).parquet(folder)


def run_available(stream: DataFrame, target: str, checkpoint: str) -> None:
    """Process what is there and stop; a repeated call goes on where the last one ended."""
    stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start().awaitTermination()


def restart(checkpoint: str) -> str:
    """A checkpoint beside the old one: the query begins from the start, what was there stays to be looked at."""
    import uuid

    return f"{checkpoint.rstrip('/')}-{uuid.uuid4().hex[:8]}"


def as_completed(stream: DataFrame, take: object, checkpoint: str) -> None:
    """Give ``take(batch, number)`` the rows in the order in which they are completed, batch by batch."""
    stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def error_rates(events: DataFrame, width: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """Calls and failures by key and window; rows later than the watermark are left out."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width), "key").agg(F.count(F.lit(1)).alias("calls"), F.count_if(~F.col("ok")).alias("failures")).select("key", F.col("window.start").alias("start"), "calls", "failures")


def circuit_breaker(calls: DataFrame) -> DataFrame:
    """State of each key after each micro-batch: consecutive failures and, while banned, until when."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        consecutive, until = state.get if state.exists else (0, None)
        until = None if until is None or pd.isna(until) else pd.Timestamp(until)
        rows = pd.concat(list(batches)).sort_values(["ts", "call"])
        for row in rows.itertuples(index=False):
            consecutive, until, _ = breaker_step(consecutive, until, row.ts, row.ok)
        state.update((consecutive, until))
        yield pd.DataFrame({"key": [key[0]], "consecutive": [consecutive], "disabled_until": [until]})

    return calls.groupBy("key").applyInPandasWithState(step, "key long, consecutive int, disabled_until timestamp", "consecutive int, disabled_until timestamp", "append", GroupStateTimeout.NoTimeout)
