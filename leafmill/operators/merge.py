"""Merging of chunk results into documents."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

# Where a page number stands in Markdown (before it, the number, behind it), and its digits.
NUMBERED = (
    (re.compile(r"(\[Page )(\d+)(\])"), 0),
    (re.compile(r"(?m)(^## Page )(\d+)($)"), 0),
    (re.compile(r"(!\[[^\]\n]*\]\(images/page_)(\d+)(\.png\))"), 3),
    (re.compile(r"(yaml_metadata/[^\s()\[\]]*?_page)(\d+)(\.yaml)"), 0),
)
#: A chunk's text shorter than this is announced.
THIN = 100


def with_offsets(plan: DataFrame, results: DataFrame) -> DataFrame:
    """Chunk plan rows with whether their result is there and the pages before them.

    ``page_offset`` comes from the plan and holds where chunks are missing; ``legacy_offset`` sums the
    pages of the chunks that are there.
    """
    rows = plan.join(results.select("chunk", F.lit(True).alias("there")), "chunk", "left").withColumn("there", F.coalesce("there", F.lit(False)))
    before = Window.partitionBy("pdf").orderBy("chunk_idx").rowsBetween(Window.unboundedPreceding, -1)
    present = F.coalesce(F.sum(F.when(F.col("there"), F.col("pages")).otherwise(0)).over(before), F.lit(0))
    return rows.withColumns({"page_offset": F.col("start_page") - 1, "legacy_offset": present})


def renumbered(pages: DataFrame, chunks: DataFrame) -> DataFrame:
    """Pages of chunks (chunk, page_num, …) with their number in the document."""
    return pages.join(chunks.select("chunk", "pdf", "page_offset"), "chunk").withColumn("page_num", F.col("page_num") + F.col("page_offset")).drop("page_offset")


def shifted(text: str, offset: int) -> str:
    """Markdown of a chunk with all page numbers, image and metadata references moved by ``offset``."""
    for pattern, digits in NUMBERED:
        text = pattern.sub(lambda m: f"{m[1]}{int(m[2]) + offset:0{digits}d}{m[3]}", text)
    return text


@pandas_udf(StringType())
def renumbered_text(markdown: pd.Series, offset: pd.Series) -> pd.Series:
    return pd.Series([None if t is None else shifted(t, int(n)) for t, n in zip(markdown, offset)], dtype=object)


def thin_chunks(chunks: DataFrame) -> DataFrame:
    """Chunks (chunk, markdown) with hardly any text, and how much they have."""
    size = F.length(F.regexp_replace(F.coalesce("markdown", F.lit("")), r"^\s+|\s+$", ""))
    return chunks.withColumn("size", size).where(F.col("size") < THIN).select("chunk", "size")


def merge_summary(chunks: DataFrame, figures: DataFrame | None = None) -> DataFrame:
    """Documents with found and missing chunks; with ``figures`` (one row each, chunk) their number too."""
    rows = chunks
    if figures is not None:
        rows = chunks.join(figures.groupBy("chunk").agg(F.count(F.lit(1)).alias("n")), "chunk", "left")
    sums = [F.count(F.lit(1)).alias("chunks"), F.count_if("there").alias("found"), F.count_if(~F.col("there")).alias("missing"), F.coalesce(F.sum(F.when(F.col("there"), F.col("pages"))), F.lit(0)).alias("pages")]
    if figures is not None:
        sums.append(F.coalesce(F.sum(F.when(F.col("there"), F.col("n"))), F.lit(0)).alias("figures"))
    return rows.groupBy("pdf").agg(*sums)


def merge_totals(summary: DataFrame) -> DataFrame:
    """One row over ``merge_summary``: documents, whole ones, chunks, pages, figures."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    return summary.agg(F.count(F.lit(1)).alias("pdfs"), F.count_if(F.col("missing") == 0).alias("whole"), *[total(c) for c in ("chunks", "found", "missing", "pages", "figures") if c in summary.columns])


def metadata_name(name: Column, page: Column) -> Column:
    """The name of a metadata file with another page number; null without a page."""
    return F.concat(F.regexp_replace(name, r"_page\d+$", ""), F.lit("_page"), page.cast("string"))
