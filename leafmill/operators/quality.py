"""Page, document and corpus quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.functions import text as T

#: Page sizes in characters: below the first empty, then short, medium, long.
EMPTY, SHORT, MEDIUM = 10, 100, 500


def page_flags(pages: DataFrame, text: str = "text") -> DataFrame:
    """``pages`` with char_count and what the page holds."""
    t = F.col(text)
    # The patterns.  A sign that every match needs is looked for first: most pages have none and meet no pattern
    having = lambda sign, test: F.when(t.contains(sign), test).otherwise(F.when(t.isNotNull(), False))
    rows = having("|", t.rlike(r"(?d)\|.*\|.*\|"))
    return pages.withColumns(
        {
            "char_count": F.length(T.strip(t)).cast("long"),
            "has_table": rows & t.rlike(r"\|\s*:?-+:?\s*\|"),
            "has_table_strict": rows & t.rlike(r"\|-+\|"),
            "has_formula": having("$", t.rlike(r"(?s)\$\$.+?\$\$") | t.rlike(r"\$[^$]+\$")),
            "has_image": having("![", t.rlike(r"(?d)!\[.*?\]\(.*?\)")) | having("<", t.rlike("(?i)<figure>")),
            "has_code": having("```", t.rlike(r"(?s)```.*?```")),
        }
    )


def page_issues(text: Column) -> Column:
    """Names of what is wrong with a page's text."""
    size = F.length(T.strip(text))
    broken = F.length(text) - F.length(F.replace(text, F.lit("�"), F.lit("")))
    found = F.array(
        F.when(size < 10, "blank").when(size < 50, "short"),
        F.when((F.length(text) > 0) & (broken > F.length(text) * 0.05), "garbled"),
        F.when(text.rlike(r"(?d)(.)\1{10,}"), "repeated"),
    )
    return F.filter(found, lambda x: x.isNotNull())


def document_quality(pages: DataFrame, key: str) -> DataFrame:
    """One row for each document: page counts by size and content, score, review flag.

    ``pages`` has the columns of ``page_flags`` and ``issues``.
    """
    n = F.col("char_count")
    counted = pages.groupBy(F.col(key).alias("pdf")).agg(
        F.count(F.lit(1)).alias("total_pages"),
        F.sum("char_count").alias("char_count"),
        F.count_if(n < EMPTY).alias("empty_pages"),
        F.count_if((n >= EMPTY) & (n < SHORT)).alias("short_pages"),
        F.count_if((n >= SHORT) & (n < MEDIUM)).alias("medium_pages"),
        F.count_if(n >= MEDIUM).alias("long_pages"),
        F.count_if("has_table").alias("table_count"),
        F.count_if("has_formula").alias("formula_count"),
        F.count_if("has_image").alias("image_count"),
        F.count_if("has_code").alias("code_block_count"),
        F.sum(F.size("issues")).alias("issue_count"),
    )
    score = (F.col("medium_pages") + F.col("long_pages")) / F.col("total_pages") * F.lit(100.0)
    review = (F.col("empty_pages") / F.col("total_pages") > 0.2) | (F.col("issue_count") > F.col("total_pages") * 0.1)
    return counted.withColumns({"quality_score": score, "needs_review": review})


def corpus_quality(documents: DataFrame, compliance: DataFrame | None = None) -> DataFrame:
    """One row over ``document_quality`` rows; with ``compliance`` (pdf, compliant) the compliance rate in per cent too."""
    if compliance is not None:
        documents = documents.join(compliance.select("pdf", "compliant"), "pdf", "left")
    sums = ["total_pages", "char_count", "empty_pages", "short_pages", "medium_pages", "long_pages", "table_count", "formula_count", "image_count", "code_block_count"]
    total = documents.agg(
        F.count(F.lit(1)).alias("pdfs"),
        F.count_if(F.col("total_pages") > 0).alias("succeeded"),
        F.count_if("needs_review").alias("needing_review"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums],
        *([F.count_if("compliant").alias("compliant")] if compliance is not None else []),
    )
    if compliance is not None:
        total = total.withColumn("compliance_rate", T.rounded(F.col("compliant") * 100.0 / F.greatest("succeeded", F.lit(1)), 1))
    share = (F.col("medium_pages") + F.col("long_pages")) / F.greatest("total_pages", F.lit(1)) * 100.0
    return total.withColumn("overall_score", T.rounded(share, 1)).withColumn("rating", T.rating(F.col("overall_score")))


def compliant(markdown: Column, has_yaml: Column) -> Column:
    """Title, page marks and metadata are there."""
    return has_yaml & markdown.rlike("(?m)^# ") & markdown.rlike(r"(?m)^## Page \d+")
