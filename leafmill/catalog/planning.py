"""Queries on chunk plans.  A source is a document; 40 of its texts are a page."""

from __future__ import annotations

from pyspark.sql import functions as F

from leafmill.catalog import query
from leafmill.plans import chunks
from leafmill.sources.tables import table

_DOCS = "SELECT l_suppkey AS pdf_no, 'doc' || l_suppkey AS pdf, count(*) AS total_pages, sum(l_quantity) / 200.0::DOUBLE AS size_mb FROM lineitem GROUP BY l_suppkey"
_PLAN = f"""SELECT pdf, total_pages, size_mb, CASE WHEN big AND raw > 1 THEN 'split' ELSE 'skip' END AS status, CAST(CASE WHEN big AND raw > 1 THEN ceil(total_pages / per) ELSE 1 END AS INTEGER) AS chunks,
 CAST(CASE WHEN big AND raw > 1 AND ceil(total_pages / per) > 1 THEN per ELSE total_pages END AS INTEGER) AS pages_per_chunk
 FROM (SELECT *, ceil(total_pages / greatest(raw, 1)) AS per, total_pages > 50 OR size_mb > 50 AS big FROM (SELECT *, greatest(ceil(total_pages / 50), floor((size_mb + 49) / 50)) AS raw FROM ({_DOCS})))"""
_CHUNKS = f"""SELECT pdf, pdf || '_part' || (i + 1) || 'of' || chunks || '.pdf' AS chunk, CAST(i + 1 AS INTEGER) AS chunk_idx, chunks AS total_chunks, CAST(i * pages_per_chunk + 1 AS INTEGER) AS start_page,
 CAST(least((i + 1) * pages_per_chunk, total_pages) AS INTEGER) AS end_page, CAST(least((i + 1) * pages_per_chunk, total_pages) - i * pages_per_chunk AS INTEGER) AS pages
 FROM (SELECT *, unnest(generate_series(0, chunks - 1)) AS i FROM ({_PLAN}) WHERE status = 'split')"""


def _plan(spark, sf_dir):
    docs = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("total_pages"), (F.sum("l_quantity") / 200.0).alias("size_mb"))
    return chunks.split_plan(docs.select(F.concat(F.lit("doc"), F.col("l_suppkey").cast("string")).alias("pdf"), "total_pages", "size_mb"))


@query("split_plan", _PLAN)
def split_plan(spark, sf_dir):
    return _plan(spark, sf_dir)


@query("split_chunks", _CHUNKS)
def split_chunks(spark, sf_dir):
    return chunks.chunk_ranges(_plan(spark, sf_dir))


@query("split_statistics", f"SELECT count(*) AS total_pdfs, count_if(status = 'split') AS split_pdfs, count_if(status = 'skip') AS skipped_pdfs, count_if(status = 'error') AS failed_pdfs, CAST(coalesce(sum(CASE WHEN status = 'split' THEN chunks END), 0) AS BIGINT) AS total_chunks FROM ({_PLAN})")
def split_statistics(spark, sf_dir):
    return chunks.split_statistics(_plan(spark, sf_dir))


@query("expected_documents", f"SELECT pdf FROM ({_PLAN})")
def expected_documents(spark, sf_dir):
    plan = _plan(spark, sf_dir)
    return chunks.expected_documents(chunks.chunk_ranges(plan), plan.where(F.col("status") == "skip"))
