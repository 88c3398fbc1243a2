"""Live progress: an exactly-once event log, and the state of documents and pages kept by a stateful stream."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from leafmill.sources.files import append_events

#: The store that stateful processors with several variables need.
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE = "step long, pdf long, status string, done long, failed long"
DOCUMENT = "status string, at long, event long, pages array<struct<page_num: long, status: string, at: long, event: long>>"


def log_events(stream: DataFrame, folder: str, checkpoint: str, late: str = "1 hour") -> None:
    """What is there of a stream of events (event, step, pdf, page_num, status, error, ts), as the log of ``append_events``.

    An event that comes twice within ``late`` is taken once; a batch that is run again, after a
    failure, writes its own folder again.
    """
    once = stream.withWatermark("ts", late).dropDuplicatesWithinWatermark(["event"])
    once.writeStream.foreachBatch(lambda batch, number: append_events(batch, folder, number)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def logged(spark: SparkSession, folder: str) -> DataFrame:
    """All events of the log; none before the first batch."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.parquet(folder).drop("batch")
    except AnalysisException:
        return spark.createDataFrame([], "step string, pdf string, page_num int, status string, error string, ts timestamp")


class Progress(StatefulProcessor):
    """State of one document of one step.

    ``document``: its status with the order of the event that set it, and ``pages``, the newest status
    of each page, likewise; ``errors``: the errors since it was last completed.  Events may come in
    any order, the newest (ts, event) counts.  A call of the store costs far more than a row, so a
    batch's rows are folded first: the document is read once and written once, errors are added at once.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.document = handle.getValueState("document", DOCUMENT)
        self.errors = handle.getListState("errors", "error string, at long, event long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803  the interface's names
        known = self.document.get()
        newest = None if known is None or known[1] is None else (known[1], known[2], known[0])
        pages = {} if known is None else {p[0]: (p[2], p[3], p[1]) for p in known[3]}
        errors = []
        for row in rows:
            at = (row.at, row.event, row.status)
            if row.page_num is None:
                newest = at if newest is None or at[:2] > newest[:2] else newest
            elif row.page_num not in pages or at[:2] > pages[row.page_num][:2]:
                pages[row.page_num] = at
            if row.error is not None:
                errors.append((row.error, row.at, row.event))
        status, at, event = (None, None, None) if newest is None else (newest[2], *newest[:2])
        self.document.update((status, at, event, [(n, p[2], p[0], p[1]) for n, p in pages.items()]))
        if status == "completed":
            later = lambda found: [tuple(e) for e in found if (e[1], e[2]) > newest[:2]]
            errors = later(errors)
            if known is not None and self.errors.exists():
                errors = later(self.errors.get()) + errors
                self.errors.clear()
        if errors:
            self.errors.appendList(errors)
        states = [p[2] for p in pages.values()]
        yield Row(step=key[0], pdf=key[1], status=status, done=states.count("completed"), failed=states.count("failed"))

    def close(self) -> None:
        pass


def live(stream: DataFrame) -> DataFrame:
    """step, pdf, status, done, failed of each document after each batch, from events (step, pdf, page_num, event, status, error, ts).

    Documents are the groups, so that a step of any size is spread over all tasks.
    """
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    events = stream.select("step", "pdf", "page_num", "event", "status", "error", F.coalesce(F.unix_micros("ts"), F.lit(-(1 << 62))).alias("at"))
    return events.groupBy("step", "pdf").transformWithState(statefulProcessor=Progress(), outputStructType=STATE, outputMode="Update", timeMode="None")


def run_live(stream: DataFrame, checkpoint: str) -> None:
    """Take in what is there; the state stays in the checkpoint, from which ``documents`` and the others read it.

    A checkpoint's state keeps the number of its partitions, and each costs a store and a worker in every
    batch: a new one gets two for each core, if the session's setting isn't lower.
    """
    conf = stream.sparkSession.conf
    setting = conf.get("spark.sql.shuffle.partitions")
    conf.set("spark.sql.shuffle.partitions", min(int(setting), 2 * stream.sparkSession.sparkContext.defaultParallelism))
    try:  # the query takes a copy of the settings when it starts
        query = live(stream).writeStream.format("noop").outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        conf.set("spark.sql.shuffle.partitions", setting)
    query.awaitTermination()


def _state(spark: SparkSession, checkpoint: str, variable: str) -> DataFrame:
    return spark.read.format("statestore").option("stateVarName", variable).load(checkpoint)


def documents(spark: SparkSession, checkpoint: str) -> DataFrame:
    """step, pdf, status of every document with an event of its own: ``where`` gives the pending, completed and failed lists."""
    return _state(spark, checkpoint, "document").where("value.at IS NOT NULL").select("key.step", "key.pdf", "value.status")


def pages(spark: SparkSession, checkpoint: str) -> DataFrame:
    """step, pdf, page_num, status of every page."""
    return _state(spark, checkpoint, "document").select("key.step", "key.pdf", F.explode("value.pages").alias("page")).select("step", "pdf", "page.page_num", "page.status")


def errors(spark: SparkSession, checkpoint: str) -> DataFrame:
    """step, pdf, error since the document was last completed."""
    return _state(spark, checkpoint, "errors").select("key.step", "key.pdf", "list_element.error")


def is_completed(state: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """``wanted`` with ``completed``: whether the state has it so; false for what it doesn't know."""
    done = state.where("status = 'completed'").select(*keys).distinct().withColumn("completed", F.lit(True))
    return wanted.join(done, keys, "left").fillna(False, ["completed"])
