"""Recovery of blocked pages and its merge into documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.operators.ranks import k_least

#: Pages named for each error.
MOST_PAGES = 10


def recovered_pages(pages: DataFrame, recovered: DataFrame, order: str = "section") -> DataFrame:
    """Pages (pdf, page_num, section) with recovered sections in place; pages that were missing are added.

    Of several recoveries of a page the first in ``order`` counts.
    """
    good = recovered.where("success").groupBy("pdf", "page_num").agg(F.min_by("section", order).alias("new"))
    rows = pages.join(good, ["pdf", "page_num"], "full")
    return rows.select("pdf", "page_num", F.coalesce("new", "section").alias("section"), F.col("new").isNotNull().alias("recovered"))


def blocked_pages(pages: DataFrame) -> DataFrame:
    """Pages (pdf, page_num, status, error) that a content check refused."""
    from leafmill.operators.progress import blocked

    return pages.where((F.col("status") == "failed") & blocked(F.col("error")))


def limited(pages: DataFrame, n: int, order: list[str]) -> DataFrame:
    """The first n pages in order; 0 is all."""
    return pages.orderBy(*order).limit(n) if n else pages


def still_failed(failed: DataFrame, recovered: DataFrame) -> DataFrame:
    """Failed pages of each document, and how many of them were recovered."""
    good = recovered.where("success").select("pdf", "page_num").distinct().withColumn("ok", F.lit(1))
    rows = failed.join(good, ["pdf", "page_num"], "left")
    return rows.groupBy("pdf").agg(F.count(F.lit(1)).alias("failed"), F.count("ok").alias("recovered"))


def failed_details(failed: DataFrame, recovered: DataFrame) -> DataFrame:
    """Failed pages that no recovery brought back, with their error."""
    return failed.join(recovered.where("success").select("pdf", "page_num").distinct(), ["pdf", "page_num"], "left_anti")


def recovery_errors(recovered: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Failed recoveries by error: how many, and the first MOST_PAGES in ``order`` as ``pdf page n``.

    Counts are combined map-side, and so are the first pages (``k_least``): however many failures
    an error has, no task reads them all.
    """
    failed = recovered.where(~F.col("success"))
    name = F.concat(F.col("pdf").cast("string"), F.lit(" page "), F.col("page_num").cast("string"))
    first = k_least(failed, ["error"], order or ["pdf", "page_num"], MOST_PAGES)
    named = F.transform(F.array_sort(F.collect_list(F.struct("place", name.alias("n")))), lambda x: x["n"])
    counted = failed.groupBy("error").agg(F.count(F.lit(1)).alias("failures"))
    listed = first.groupBy(F.col("error").alias("e")).agg(F.array_join(named, ", ").alias("pages"))
    return counted.join(listed, F.col("error").eqNullSafe(F.col("e"))).select("error", "failures", "pages")


def recovery_statistics(recovered: DataFrame) -> DataFrame:
    sums = recovered.agg(F.count(F.lit(1)).alias("total"), F.count_if("success").alias("succeeded"), F.count_if(~F.col("success")).alias("failed"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"), F.coalesce(F.sum("seconds"), F.lit(0.0)).alias("seconds"))
    return sums.withColumn("pages_per_second", F.when(F.col("seconds") > 0, F.col("total") / F.col("seconds")).otherwise(0.0))


def marked_failures(details: DataFrame, recovered: DataFrame, method: str, at: str) -> DataFrame:
    """``reports.page_details`` rows after a recovery: failures that were brought back are marked with method and time, and counted.

    ``recovery_info`` adds to the count of an earlier one, if ``details`` has the column.  A page
    that was recovered several times counts once; documents without a failure stay as they are.
    """
    pages = recovered.where("success").groupBy("pdf").agg(F.collect_set("page_num").alias("_pages"))
    rows = details.join(pages, "pdf", "left").withColumn("_pages", F.coalesce("_pages", F.array().cast("array<bigint>")))

    def mark(x):
        ok = F.array_contains("_pages", x["page_num"])
        return F.struct(x["page_num"].alias("page_num"), x["error"].alias("error"), ok.alias("recovered"), F.when(ok, method).alias("recovered_by"), F.when(ok, at).alias("recovered_at"))

    failures = F.transform("failures", mark)
    before = F.coalesce("recovery_info.pages_recovered", F.lit(0)) if "recovery_info" in details.columns else F.lit(0)
    n = F.size(F.filter(failures, lambda x: x["recovered"]))
    info = F.struct(F.lit(at).alias("recovery_date"), (before + n).cast("int").alias("pages_recovered"), F.lit(method).alias("recovery_method"))
    return rows.withColumns({"recovery_info": info, "failures": failures}).drop("_pages")


def recovery_report(recovered: DataFrame, model: str, concurrency: int, made: str, order: list[str]) -> DataFrame:
    """place, line of the JSON report of a recovery: every failure, the sums, and how it was run (see ``files.json_document``)."""
    from leafmill.sources.files import json_document

    errors = recovered.where(~F.col("success")).select(*order, "error")
    run = recovered.sparkSession.createDataFrame([(made, model, concurrency)], "timestamp string, model string, concurrency int")
    return json_document([("errors", errors, order)], [("stats", recovery_statistics(recovered)), ("run", run)])
