"""Queries on what lies in files and in streams: logs, PDF pages, live state.  Their input is written from the tables first."""

from __future__ import annotations

from pyspark.sql import functions as F

from leafmill.catalog import progress, query
from leafmill.sources import files, pdf
from leafmill.sources.shared import fresh_path
from leafmill.sources.tables import table
from leafmill.streaming import live


@query("log_tail_files", """SELECT log, CAST(row_number() OVER (PARTITION BY log ORDER BY event_id) AS INTEGER) AS line_no, line FROM (SELECT *, row_number() OVER (PARTITION BY log ORDER BY event_id DESC) AS place FROM (SELECT 'user' || user_id % 50 || '.log' AS log, event_id, event_id || ' ' || event_type || ' ' || user_id AS line FROM events)) WHERE place <= 10""")
def log_tail_files(spark, sf_dir):
    """The last ten lines of each of 50 logs, read from the files' ends."""
    folder = fresh_path(spark, "logs")
    user = F.col("user_id")
    line = F.concat_ws(" ", F.col("event_id").cast("string"), "event_type", user.cast("string"))
    events = table(spark, sf_dir, "events").select((user % 50).alias("k"), "event_id", line.alias("line"))
    lines = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("event_id", "line"))), lambda x: x["line"]), "\n")
    texts = events.groupBy("k").agg(F.concat(lines, F.lit("\n")).alias("content"))
    files.write_files(texts.select(F.concat(F.lit("user"), F.col("k").cast("string"), F.lit(".log")).alias("name"), "content"), folder)
    return files.file_tails(spark, folder, n=10).select("log", "line_no", "line")


@query("processing_log", """SELECT row_number() OVER (ORDER BY kind, line_no) AS place, line FROM (SELECT kind, row_number() OVER (PARTITION BY kind ORDER BY event_id) AS line_no, CAST(event_id AS VARCHAR) AS line FROM (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY event_id DESC) AS place FROM (SELECT CASE WHEN event_type = 'error' THEN 2 ELSE 1 END AS kind, event_id FROM events)) WHERE place <= 1000
 UNION ALL SELECT 1, 0, '== convert.log ==' UNION ALL SELECT 2, 0, '== errors.log ==')""")
def processing_log(spark, sf_dir):
    """One log from the last 1,000 lines of two, each under its name."""
    folder = fresh_path(spark, "logs")
    events = table(spark, sf_dir, "events").select(F.when(F.col("event_type") == "error", "errors").otherwise("convert").alias("name"), "event_id")
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("event_id")), lambda x: x.cast("string")), "\n")
    files.write_files(events.groupBy("name").agg(ids.alias("content")).select(F.concat("name", F.lit(".log")).alias("name"), "content"), folder)
    return files.processing_log(files.file_tails(spark, folder), ["convert.log", "errors.log"])


@query("pdf_pages", "SELECT CAST(conv_id AS VARCHAR) AS pdf, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS INTEGER) AS page_num, text FROM conversations")
def pdf_pages(spark, sf_dir):
    """Conversations written as PDF files and read back page by page."""
    return _read_pages(spark, _pdf_folder(spark, sf_dir)).select("pdf", "page_num", F.col("content").cast("string").alias("text"))


@query("pdf_page_counts", "SELECT CAST(conv_id AS VARCHAR) AS pdf, CAST(count(*) AS INTEGER) AS total_pages FROM conversations GROUP BY conv_id")
def pdf_page_counts(spark, sf_dir):
    return files.with_page_counts(files.binary_files(spark, _pdf_folder(spark, sf_dir))).select("pdf", "total_pages")


def _pdf_folder(spark, sf_dir):
    folder = fresh_path(spark, "pdfs")
    texts = F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda x: F.coalesce(x["text"], F.lit("")))
    rows = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(texts.alias("texts"))
    files.write_files(rows.select(F.concat(F.col("conv_id").cast("string"), F.lit(".pdf")).alias("name"), files.pdf_of_texts("texts").alias("content")), folder)
    return folder


def _read_pages(spark, folder):
    pdf.register(spark)
    return spark.read.format("pdf_pages").load(folder)


_EVENTS = f"SELECT event_id AS event, event_id % 4 AS step, user_id AS pdf, CASE WHEN event_id % 3 = 0 THEN event_id % 7 END AS page_num, {progress._STATUS} AS status, CASE event_type WHEN 'error' THEN 'TimeoutError' END AS error, ts FROM events"


def _event_files(spark, sf_dir, twice=False):
    """The events as a folder of Parquet files that a stream can read."""
    k = F.col("event_id")
    status = F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "purchase", "completed").otherwise("pending")
    rows = table(spark, sf_dir, "events").select(k.alias("event"), (k % 4).alias("step"), F.col("user_id").alias("pdf"), F.when(k % 3 == 0, k % 7).alias("page_num"), status.alias("status"), F.when(F.col("event_type") == "error", "TimeoutError").alias("error"), F.col("ts").cast("timestamp").alias("ts"))
    folder = fresh_path(spark, "events")
    (rows.unionByName(rows) if twice else rows).write.parquet(folder)
    return spark.readStream.schema(rows.schema).parquet(folder)


@query("progress_log", f"SELECT step, status, count(*) AS events, count(DISTINCT pdf) AS pdfs, count(error) AS errors FROM ({_EVENTS}) GROUP BY step, status")
def progress_log(spark, sf_dir):
    """Every event is streamed twice, and is in the log once."""
    folder, checkpoint = fresh_path(spark, "log"), fresh_path(spark, "log-checkpoint")
    live.log_events(_event_files(spark, sf_dir, twice=True), folder, checkpoint)
    return live.logged(spark, folder).groupBy("step", "status").agg(F.count(F.lit(1)).alias("events"), F.count_distinct("pdf").alias("pdfs"), F.count("error").alias("errors"))


_LATEST = "SELECT step, pdf, {key}status FROM (SELECT *, row_number() OVER (PARTITION BY step, pdf{by} ORDER BY ts DESC, event DESC) AS place FROM (" + _EVENTS + ") WHERE page_num IS {kind}) WHERE place = 1"


def _live(spark, sf_dir):
    checkpoint = fresh_path(spark, "live")
    live.run_live(_event_files(spark, sf_dir), checkpoint)
    return checkpoint


@query("live_documents", _LATEST.format(key="", by="", kind="NULL"))
def live_documents(spark, sf_dir):
    """Statuses of documents as the stream's state has them."""
    return live.documents(spark, _live(spark, sf_dir))


@query("live_pages", _LATEST.format(key="page_num, ", by=", page_num", kind="NOT NULL"))
def live_pages(spark, sf_dir):
    return live.pages(spark, _live(spark, sf_dir))
