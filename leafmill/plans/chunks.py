"""Splitting of large documents into page-bounded chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def split_plan(documents: DataFrame, threshold: int = 50, max_pages: int = 50, max_mb: int = 50) -> DataFrame:
    """``documents`` (pdf, size_mb, total_pages) with status, chunks and pages_per_chunk.

    A document without a readable page count is an ``error`` row.  Chunks that would begin behind
    the last page aren't planned.
    """
    pages, size = F.col("total_pages"), F.col("size_mb")
    raw = F.greatest(F.ceil(pages / max_pages), F.floor((size + (max_mb - 1)) / max_mb))
    per = F.ceil(pages / F.greatest(raw, F.lit(1)))
    large = (pages > threshold) | (size > max_mb)
    chunks = F.when(large & (raw > 1), F.ceil(pages / per)).otherwise(1)
    status = F.when(pages.isNull() | (pages < 1), "error").when(large & (raw > 1), "split").otherwise("skip")
    ok = status != "error"
    return documents.withColumns({"status": status, "chunks": F.when(ok, chunks).otherwise(0).cast("int"), "pages_per_chunk": F.when(ok & (chunks > 1), per).otherwise(pages).cast("int")})


def chunk_ranges(plan: DataFrame) -> DataFrame:
    """One row for each chunk of the split documents: first and last page, counted from 1."""
    rows = plan.where(F.col("status") == "split").withColumn("i", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    start = F.col("i") * F.col("pages_per_chunk") + 1
    end = F.least((F.col("i") + 1) * F.col("pages_per_chunk"), F.col("total_pages"))
    name = F.concat("pdf", F.lit("_part"), (F.col("i") + 1).cast("string"), F.lit("of"), F.col("chunks").cast("string"), F.lit(".pdf"))
    return rows.select("pdf", name.alias("chunk"), (F.col("i") + 1).alias("chunk_idx"), F.col("chunks").alias("total_chunks"), start.alias("start_page"), end.cast("int").alias("end_page"), (end - start + 1).cast("int").alias("pages"))


def split_statistics(plan: DataFrame) -> DataFrame:
    is_ = lambda s: F.count_if(F.col("status") == s)
    return plan.agg(F.count(F.lit(1)).alias("total_pdfs"), is_("split").alias("split_pdfs"), is_("skip").alias("skipped_pdfs"), is_("error").alias("failed_pdfs"), F.coalesce(F.sum(F.when(F.col("status") == "split", F.col("chunks"))), F.lit(0)).alias("total_chunks"))


def expected_documents(chunks: DataFrame, direct: DataFrame) -> DataFrame:
    """Distinct documents behind chunks and direct conversions."""
    return chunks.select("pdf").unionByName(direct.select("pdf")).distinct()
