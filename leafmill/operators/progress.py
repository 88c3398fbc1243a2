"""Progress and call state as an append-only event log."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafmill.operators.ranks import with_place

# Errors and statuses of calls that are worth repeating.
RETRYABLE_ERRORS = ["SSLError", "ConnectionError", "TimeoutError", "NameResolutionError", "UNEXPECTED_EOF"]
RETRYABLE_STATUS = [429, 500, 502, 503, 504]
#: Consecutive failures that disable a key, and for how many seconds.
FAILURES, DISABLED = 5, 300


def latest(events: DataFrame, keys: list[str], order: list[str], columns: list[str]) -> DataFrame:
    """The last event's columns for each key (aggregated map-side)."""
    last = events.groupBy(*keys).agg(F.max(F.struct(*order, *columns)).alias("last"))
    return last.select(*keys, *[F.col(f"last.{c}").alias(c) for c in columns])


def pending(wanted: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    return wanted.join(done, keys, "left_anti")


def all_results(stored: DataFrame, fresh: DataFrame, keys: list[str]) -> DataFrame:
    """Fresh page results and the stored ones of pages that were skipped; columns that one side lacks are null there."""
    return fresh.withColumn("skipped", F.lit(False)).unionByName(stored.join(fresh.select(*keys), keys, "left_anti").withColumn("skipped", F.lit(True)), allowMissingColumns=True)


def progress_summary(state: DataFrame, group: str) -> DataFrame:
    is_ = lambda s: F.count_if(F.col("status") == s)
    rows = state.groupBy(group).agg(F.count(F.lit(1)).alias("total"), is_("completed").alias("completed"), is_("failed").alias("failed"), is_("pending").alias("pending"))
    return rows.withColumns({"percent": F.when(F.col("total") == 0, 0.0).otherwise(F.col("completed") * 100.0 / F.col("total")), "step_status": F.when(F.col("completed") == F.col("total"), "completed").otherwise("in_progress")})


def resume_check(documents: DataFrame) -> DataFrame:
    """Why a document counts as done or not: the first reason that holds."""
    rate = F.col("completed_pages") / F.greatest("total_pages", F.lit(1))
    reason = F.when(~F.col("listed"), "not_listed").when(F.col("md_bytes").isNull(), "no_output").when(F.col("md_bytes") < 500, "too_small").when((F.col("total_pages") > 0) & (rate < 0.9), "incomplete").otherwise("ok")
    return documents.withColumn("reason", reason).withColumn("valid", F.col("reason") == "ok")


def retryable(error: Column, status: Column) -> Column:
    by_error = error.rlike("|".join(RETRYABLE_ERRORS))
    by_status = (status.isin(RETRYABLE_STATUS) | (status >= 500)) & ~F.coalesce(error.contains("DataInspectionFailed"), F.lit(False))
    return F.coalesce(by_error, F.lit(False)) | F.coalesce(by_status, F.lit(False))


def blocked(error: Column) -> Column:
    return F.coalesce(error.contains("DataInspectionFailed") & error.contains("inappropriate"), F.lit(False))


def key_health(calls: DataFrame) -> DataFrame:
    """Calls (key, ts, ok, latency) by key; the success rate is 1 and the latency 0 where there are none."""
    ok = F.col("ok")
    return calls.groupBy("key").agg(F.count(F.lit(1)).alias("calls"), F.count_if(ok).alias("successes"), F.count_if(~ok).alias("failures"), F.coalesce(F.sum(F.when(ok, F.col("latency"))) / F.greatest(F.count_if(ok), F.lit(1)), F.lit(0.0)).alias("avg_latency")).withColumn(
        "success_rate", F.col("successes") / F.greatest("calls", F.lit(1))
    )


def consecutive_failures(calls: DataFrame) -> DataFrame:
    """Each call with the failures since the key's last success."""
    order = Window.partitionBy("key").orderBy("ts", "call")
    run = calls.withColumn("run", F.sum(F.when(F.col("ok"), 1).otherwise(0)).over(order))
    return run.withColumn("consecutive", F.sum(F.when(F.col("ok"), 0).otherwise(1)).over(Window.partitionBy("key", "run").orderBy("ts", "call"))).drop("run")


def key_ranks(health: DataFrame) -> DataFrame:
    """Keys with their place by success rate, then fewest consecutive failures, then name."""
    return with_place(health.select("key", "success_rate", "consecutive"), F.desc("success_rate"), F.asc("consecutive"), F.asc("key")).select("key", "place")


def chosen_key(health: DataFrame, now: Column) -> DataFrame:
    """One row: the key to use at ``now``, and whether it was banned (rows: key, success_rate, consecutive, disabled_until).

    The best-ranked key without a running ban; if all are banned, the one whose ban ends first.
    """
    free = F.col("disabled_until").isNull() | (F.col("disabled_until") < now)
    rank = F.struct((-F.col("success_rate")).alias("r"), F.col("consecutive").alias("c"), F.col("key").alias("k"))
    sums = health.agg(F.min(F.when(free, rank)).alias("best"), F.min(F.when(~free, F.struct("disabled_until", "key"))).alias("first"))
    return sums.select(F.coalesce("best.k", "first.key").alias("key"), F.col("best").isNull().alias("forced"))


def invalidations(state: DataFrame, check: DataFrame, keys: list[str]) -> DataFrame:
    """Events that take completed documents back to pending: those whose ``resume_check`` failed."""
    bad = check.where(~F.col("valid")).select(*keys, F.col("reason").alias("error"))
    return state.where(F.col("status") == "completed").join(bad, keys).withColumn("status", F.lit("pending"))


def after_invalidation(pages: DataFrame, invalidated: DataFrame, keys: list[str]) -> DataFrame:
    """Page states without those of invalidated documents; counters are derived from what is left."""
    return pages.join(invalidated.select(*keys).distinct(), keys, "left_anti")


def overall_status(steps: DataFrame) -> DataFrame:
    """One row over step states (step, status): ``completed``, ``failed``, ``in_progress`` or ``pending``."""
    any_ = lambda s: F.count_if(F.col("status") == s)
    status = F.when(any_("failed") > 0, "failed").when((any_("completed") == F.count(F.lit(1))) & (F.count(F.lit(1)) > 0), "completed").when(any_("completed") + any_("in_progress") > 0, "in_progress").otherwise("pending")
    return steps.agg(F.count(F.lit(1)).alias("steps"), any_("completed").alias("completed"), status.alias("status"))


def completion_rates(done: DataFrame, group: str, at: str, total: Column) -> DataFrame:
    """After each completion of a group (``at`` in seconds): how many are done, how fast, and the seconds left."""
    order = Window.partitionBy(group).orderBy(at, "item")
    rows = done.withColumns({"done": F.row_number().over(order), "elapsed": F.col(at) - F.min(at).over(Window.partitionBy(group)), "total": total})
    rate = F.when(F.col("elapsed") > 0, F.col("done") / F.col("elapsed"))
    return rows.withColumn("rate", F.coalesce(rate, F.lit(0.0))).withColumn("seconds_left", F.when(F.col("rate") > 0, (F.col("total") - F.col("done")) / F.col("rate")))


def recorded(calls: DataFrame, known: DataFrame) -> DataFrame:
    """Calls of known keys; what is recorded for any other key is left out."""
    return calls.join(known.select("key").distinct(), "key", "left_semi")


_BREAKER = "key long, call long, ts timestamp, consecutive int, disabled boolean, disabled_until timestamp, banned boolean"


def breaker_step(consecutive: int, until: pd.Timestamp | None, ts: pd.Timestamp, ok: bool):
    """(consecutive, until, banned) after a call that ended at ``ts``.

    A ban that has expired is lifted first.  A success lifts any ban; a failure beyond the limit
    begins it anew, also for calls that were under way when it began (``banned``).
    """
    if until is not None and ts > until:
        consecutive, until = 0, None
    banned = until is not None
    if ok:
        return 0, None, banned
    consecutive += 1
    return consecutive, ts + pd.Timedelta(seconds=DISABLED) if consecutive >= FAILURES else until, banned


def circuit_breaker(calls: DataFrame) -> DataFrame:
    """Replay of each key's calls in order: bans of DISABLED seconds after FAILURES failures in a row.

    A key's calls are one group; they arrive sorted and in Arrow batches, and only the state is
    carried from batch to batch.
    """

    def run(batches):
        key, state = None, (0, None)
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                if row.key != key:
                    key, state = row.key, (0, None)
                consecutive, until, banned = breaker_step(*state, row.ts, row.ok)
                state = (consecutive, until)
                out.append((row.key, row.call, row.ts, consecutive, until is not None, until, banned))
            yield pd.DataFrame(out, columns=["key", "call", "ts", "consecutive", "disabled", "disabled_until", "banned"])

    rows = calls.select("key", "call", "ts", "ok")
    return rows.repartition("key").sortWithinPartitions("key", "ts", "call").mapInPandas(run, _BREAKER)


def step_states(events: DataFrame) -> DataFrame:
    """Status and times of each step from events (step, status, ts)."""
    first = lambda s: F.min(F.when(F.col("status") == s, F.col("ts")))
    return events.groupBy("step").agg(first("in_progress").alias("started"), F.max(F.when(F.col("status") == "completed", F.col("ts"))).alias("finished"), F.max_by("status", F.struct("ts", "event")).alias("status"))
