"""Indicators, costs and checks behind the reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.functions import text as T

# Prices in CNY for 1000 tokens, planning estimates.
PRICE_IN = PRICE_OUT = 0.02
PAGE_TOKENS_IN = 1500
RECOVERY_TOKENS, RECOVERY_USD_PER_TOKEN, CNY_PER_USD, RECOVERY_SECONDS = 40_000, 0.15 / 1_000_000, 7.2, 3.0


def confidence_tenths(level: Column) -> Column:
    """Confidence in tenths: whole numbers keep means exact at a limit."""
    return F.when(level == "high", 10).when(level == "low", 3).otherwise(6)


def confidence_score(level: Column) -> Column:
    return F.when(level == "high", 0.95).when(level == "low", 0.40).otherwise(0.70)


def completeness(level: Column) -> Column:
    return F.when(level == "high", "yes").when(level == "low", "no").otherwise("partial")


def kqi_metrics(pages: DataFrame, key: str) -> DataFrame:
    """Key indicators of each document from page rows (status, figures, metas, tables, formulas, confidence, tokens)."""
    ok = F.col("status") == "ok"
    counted = pages.groupBy(F.col(key).alias("pdf")).agg(
        F.count(F.lit(1)).alias("total_pages"),
        F.count_if(ok).alias("success_pages"),
        F.count_if(F.col("status") == "failed").alias("failed_pages"),
        F.count_if(F.col("status") == "skipped").alias("skipped_pages"),
        F.coalesce(F.sum(F.when(ok, F.col("figures"))), F.lit(0)).alias("figures"),
        F.coalesce(F.sum(F.when(ok, F.col("metas"))), F.lit(0)).alias("metas"),
        F.count_if(ok & (F.col("figures") > 0)).alias("pages_with_figures"),
        F.count_if(ok & (F.col("tables") > 0)).alias("pages_with_tables"),
        F.count_if(ok & (F.col("formulas") > 0)).alias("pages_with_formulas"),
        *[F.coalesce(F.sum(F.when(ok, F.col(c))), F.lit(0)).alias(c) for c in ("tokens", "tokens_input", "tokens_output") if c in pages.columns],
        F.coalesce(F.sum(F.when(ok, F.col("tables"))), F.lit(0)).alias("tables"),
        F.coalesce(F.sum(F.when(ok, F.col("formulas"))), F.lit(0)).alias("formulas"),
        F.coalesce(F.sum(F.when(F.col("confidence").isNotNull(), confidence_tenths(F.col("confidence")))), F.lit(0)).alias("confidence_tenths"),
        F.count("confidence").alias("rated"),
        F.count_if(F.col("confidence") == "high").alias("high_confidence"),
        F.count_if(F.col("confidence").isNotNull() & ~F.col("confidence").isin("high", "low")).alias("medium_confidence"),
        F.count_if(F.col("confidence") == "low").alias("low_confidence"),
    )
    rows = counted.withColumns(
        {
            "has_figures": F.col("figures") > 0,
            "insertion_rate": F.col("metas") / F.greatest("figures", F.lit(1)),
            "page_success_rate": F.col("success_pages") / F.greatest("total_pages", F.lit(1)),
            "figures_per_page": T.rounded(F.col("figures") / F.greatest("total_pages", F.lit(1)), 2),
            "success_rate": T.rounded(F.col("success_pages") / F.greatest("total_pages", F.lit(1)), 4),
            "avg_confidence": F.col("confidence_tenths") / (10.0 * F.greatest("rated", F.lit(1))),
        }
    )
    passed = {"insertion_pass": F.col("insertion_rate") >= 0.95, "confidence_pass": 100 * F.col("confidence_tenths") >= 850 * F.greatest("rated", F.lit(1)), "success_pass": F.col("page_success_rate") >= 0.98}
    complete = F.col("confidence_tenths") >= 6 * F.greatest("rated", F.lit(1))
    return rows.withColumns(passed).withColumns({"overall_pass": F.col("insertion_pass") & F.col("confidence_pass") & F.col("success_pass"), "complete_data_extraction": complete, "all_figures_have_metadata": F.col("metas") == F.col("figures"), "no_page_failures": F.col("failed_pages") == 0})


def page_details(pages: DataFrame, key: str) -> DataFrame:
    """Nested lists of each document: its failed pages with their errors, and every page's outcome, in page order.

    A document's pages are one list; documents have pages by the thousand at most.
    """
    ok = F.col("status") == "ok"
    failed = F.when(F.col("status") == "failed", F.struct("page_num", F.coalesce("error", F.lit("Unknown error")).alias("error")))
    each = F.struct("page_num", ok.alias("success"), F.when(ok, F.col("figures")).otherwise(0).alias("figures"), F.when(ok, F.col("tables")).otherwise(0).alias("tables"), F.when(ok, F.col("formulas")).otherwise(0).alias("formulas"))
    return pages.groupBy(F.col(key).alias("pdf")).agg(F.array_sort(F.collect_list(failed)).alias("failures"), F.array_sort(F.collect_list(each)).alias("page_results"))


def validation_yaml(kqi: DataFrame, details: DataFrame) -> DataFrame:
    """name, content of the validation file of each document."""
    from leafmill.sources.files import json_to_yaml

    measured = F.struct(*[c for c in kqi.columns if c != "pdf"])
    rows = kqi.join(details, "pdf")
    recovery = [F.col("recovery_info")] if "recovery_info" in details.columns else []
    content = F.to_json(F.struct(F.struct(F.col("pdf").alias("filename"), "total_pages").alias("document_info"), measured.alias("kqi_metrics"), F.col("failures").alias("failed_pages_detail"), F.col("page_results").alias("page_by_page_results"), *recovery))
    return rows.select(F.concat(F.col("pdf").cast("string"), F.lit(".validation.yaml")).alias("name"), json_to_yaml(content).alias("content"))


def task_quality(runs: DataFrame, pages: DataFrame) -> DataFrame:
    """One row: pages and figures of the runs, tables and formulas and failed pages from page states, success in per cent."""
    a = runs.select(F.col("pages").alias("pages"), F.col("figures").alias("figures"), *[F.lit(0).alias(c) for c in ("tables", "formulas", "failed_pages")])
    ok = F.col("status") == "ok"
    b = pages.select(F.lit(0).alias("pages"), F.lit(0).alias("figures"), F.when(ok, F.col("tables")).otherwise(0).alias("tables"), F.when(ok, F.col("formulas")).otherwise(0).alias("formulas"), (F.col("status") == "failed").cast("int").alias("failed_pages"))
    sums = a.unionByName(b).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("pages", "figures", "tables", "formulas", "failed_pages")])
    return sums.withColumn("success_rate", T.rounded((F.col("pages") - F.col("failed_pages")) * 100.0 / F.greatest("pages", F.lit(1)), 1))


def shown_rows(rows: DataFrame, order: list[Column | str], name: Column, n: int) -> DataFrame:
    """place, line of the first n names in order, and a line that says how many more there are."""
    names = rows.select(*[o.alias(f"o{i}") for i, o in enumerate(order)], name.alias("line")).orderBy(*[f"o{i}" for i in range(len(order))], "line").limit(n)
    listed = names.agg(F.array_sort(F.collect_list(F.struct(*[f"o{i}" for i in range(len(order))], "line"))).alias("l")).select(F.posexplode("l").alias("i", "x"))
    more = rows.agg((F.count(F.lit(1)) - n).alias("more")).where("more > 0").select(F.lit(n + 1).alias("place"), F.concat(F.lit("... and "), F.col("more").cast("string"), F.lit(" more")).alias("line"))
    return listed.select((F.col("i") + 1).alias("place"), F.col("x.line").alias("line")).unionByName(more)


def token_cost(tokens_in: Column, tokens_out: Column) -> Column:
    return tokens_in / 1000 * PRICE_IN + tokens_out / 1000 * PRICE_OUT


def batch_report(runs: DataFrame) -> DataFrame:
    """One row over runs (success, pages, figures, tokens_input, tokens_output, seconds)."""
    ok = F.col("success")
    total = lambda c: F.coalesce(F.sum(F.when(ok, F.col(c))), F.lit(0))
    sums = runs.agg(F.count(F.lit(1)).alias("pdfs"), F.count_if(ok).alias("succeeded"), total("pages").alias("pages"), total("figures").alias("figures"), total("tokens_input").alias("tokens_input"), total("tokens_output").alias("tokens_output"), total("seconds").alias("seconds"))
    return sums.withColumns({"cost": T.rounded(token_cost(F.col("tokens_input"), F.col("tokens_output")), 4), "success_rate": T.rounded(F.col("succeeded") * 100.0 / F.greatest("pdfs", F.lit(1)), 1)})


def task_cost(runs: DataFrame) -> DataFrame:
    """Estimated input and recorded output cost of all runs, and per page."""
    sums = runs.agg(F.coalesce(F.sum("pages"), F.lit(0)).alias("pages"), F.coalesce(F.sum("tokens_output"), F.lit(0)).alias("tokens_output"), F.coalesce(F.sum("seconds"), F.lit(0.0)).alias("seconds"))
    tokens_in, n = F.col("pages") * PAGE_TOKENS_IN, F.greatest("pages", F.lit(1))
    cost = token_cost(tokens_in, F.col("tokens_output"))
    return sums.withColumns({"tokens_input_estimate": tokens_in, "cost": T.rounded(cost, 2), "cost_per_page": T.rounded(cost / n, 4), "seconds_per_page": T.rounded(F.col("seconds") / n, 2)})


def recovery_estimate(pages: Column, concurrency: int = 10) -> dict[str, Column]:
    usd = pages * RECOVERY_TOKENS * RECOVERY_USD_PER_TOKEN
    return {"tokens": pages * RECOVERY_TOKENS, "usd": usd, "cny": usd * CNY_PER_USD, "seconds": pages / F.lit(float(concurrency)) * RECOVERY_SECONDS}


def delivery_checks(documents: DataFrame) -> DataFrame:
    """Issues and warnings of delivered documents (pdf, markdown, has_yaml): severity, check, message."""
    md = F.col("markdown")
    heads, figures = F.regexp_count(md, F.lit(r"(?m)^## Page \d+")), F.regexp_count(md, F.lit(r"### Fig(?:ure)?\.? \d+:"))
    bare = F.regexp_replace(F.regexp_replace(md, r"(?s)\$\$.*?\$\$", ""), r"\$[^$]+\$", "")
    marks = F.regexp_count(bare, F.lit(r"\\n"))
    finding = lambda severity, check, message: F.struct(F.lit(severity).alias("severity"), F.lit(check).alias("check"), message.alias("message"))
    found = F.array(
        F.when(~F.col("has_yaml"), finding("issue", "completeness", F.lit("no metadata"))),
        F.when(md.rlike("(?i)```json") | md.rlike('"body_text":'), finding("issue", "json", F.lit("JSON left in the text"))),
        F.when(md.rlike('"chart_type":'), finding("warning", "json", F.lit("chart metadata in the text"))),
        F.when(marks > 10 * F.greatest(F.floor(F.regexp_count(md, F.lit("```")) / 2), F.lit(1)), finding("warning", "newlines", F.concat(marks.cast("string"), F.lit(" newline marks")))),
        F.when(heads == 0, finding("warning", "pages", F.lit("no page heading"))),
        F.when(F.length(md) < 1000, finding("warning", "size", F.concat(F.length(md).cast("string"), F.lit(" characters")))),
    )
    rows = documents.select("pdf", F.explode(F.filter(found, lambda x: x.isNotNull())).alias("x"))
    return rows.select("pdf", "x.severity", "x.check", "x.message")


def metadata_checks(files: DataFrame) -> DataFrame:
    """Issues and warnings of metadata files (name, text): YAML that can't be read, or that holds nothing."""
    from leafmill.sources.files import yaml_read

    rows = files.where(~F.col("name").startswith("VALIDATION_REPORT")).withColumn("read", yaml_read("text")).withColumns({"error": F.col("read.error"), "json": F.col("read.json")})
    empty = F.col("error").isNull() & F.coalesce(F.col("json") == "null", F.col("json").isNull()) & (F.octet_length("text") > 10)
    found = F.when(F.col("error").isNotNull(), F.struct(F.lit("issue").alias("severity"), F.concat(F.lit("unreadable: "), "error").alias("message"))).when(empty, F.struct(F.lit("warning").alias("severity"), F.lit("nothing in it").alias("message")))
    # exploded, since a filter would be moved below and read every file again
    rows = rows.select("name", F.explode(F.filter(F.array(found), lambda x: x.isNotNull())).alias("x"))
    return rows.select(F.col("name").alias("pdf"), "x.severity", F.lit("yaml").alias("check"), "x.message")


def delivery_statistics(documents: DataFrame) -> DataFrame:
    md = F.col("markdown")
    return documents.agg(F.count(F.lit(1)).alias("documents"), F.sum(F.regexp_count(md, F.lit(r"(?m)^## Page \d+"))).alias("pages"), F.sum(F.regexp_count(md, F.lit(r"### Fig(?:ure)?\.? \d+:"))).alias("figures"), F.sum(F.length(md)).alias("chars"))


def check_summary(documents: DataFrame, findings: DataFrame, expected: int | Column) -> DataFrame:
    """One row: counts, whether the number of documents is the expected one, and whether all passed."""
    n = documents.select(F.lit("document").alias("kind"))
    f = findings.select(F.col("severity").alias("kind"))
    both = n.unionByName(f).agg(*[F.count_if(F.col("kind") == k).alias(f"{k}s") for k in ("document", "issue", "warning")])
    complete = F.col("documents") == expected
    return both.select("documents", "issues", "warnings", complete.alias("complete"), (complete & (F.col("issues") == 0)).alias("passed"))


def delivery_report(summary: DataFrame, findings: DataFrame, statistics: DataFrame, shown: int = 100) -> str:
    """JSON of a delivery check: its summary, the totals, and the first findings by severity and name."""
    import json

    s, t = summary.first().asDict(), statistics.first().asDict()
    rows = findings.orderBy("severity", "pdf", "check", "message").limit(shown).collect()
    return json.dumps({"passed": s["passed"], "summary": s, "statistics": t, "findings": [r.asDict() for r in rows], "more": max(s["issues"] + s["warnings"] - len(rows), 0)}, ensure_ascii=False)


def recommendations(row: DataFrame) -> DataFrame:
    """Messages for the row of ``corpus_quality``."""
    message = F.array(
        F.when(F.col("empty_pages") > 0, F.concat(F.lit("look at "), F.col("empty_pages").cast("string"), F.lit(" empty pages"))),
        F.when(F.col("needing_review") > 0, F.concat(F.lit("review "), F.col("needing_review").cast("string"), F.lit(" documents"))),
        F.when(F.col("overall_score") < 60, F.lit("convert again with more context")),
        F.when(F.col("table_count") == 0, F.lit("no tables were found")),
        F.when(F.col("succeeded") < F.col("pdfs"), F.lit("some documents failed")),
    )
    found = F.filter(message, lambda m: m.isNotNull())
    return row.select(F.posexplode(F.when(F.size(found) > 0, found).otherwise(F.array(F.lit("nothing to do")))).alias("i", "message")).select((F.col("i") + 1).alias("place"), "message")


def quality_report(total: DataFrame, documents: DataFrame, failures: DataFrame | None = None, seconds: float | None = None, top: int = 30, named: int = 20) -> str:
    """Markdown of a quality report: totals, sizes of pages, content, review, failures, resources, best documents, advice.

    ``total`` is the row of ``corpus_quality``, ``documents`` rows of ``document_quality``,
    ``failures`` (pdf, page_num, error, maybe kind: permanent or skipped) pages that stayed failed,
    of which the first ``top`` and ``named`` are listed.  Only the rows shown reach the driver.
    """
    t = total.first()
    n = max(t["total_pages"], 1)
    best_ = documents.orderBy(F.desc("quality_score"), "pdf").limit(top).collect()
    review = documents.where("needs_review").orderBy("pdf").limit(named).collect()
    bars = [f"- {k.removesuffix('_pages')}: {t[k]} {'█' * (t[k] * 20 // n)}{'░' * (20 - t[k] * 20 // n)}" for k in ("empty_pages", "short_pages", "medium_pages", "long_pages")]
    out = ["# Quality report", "", f"Documents: {t['pdfs']}, pages: {t['total_pages']}, score: {t['overall_score']} ({t['rating']})", "", "## Page sizes", "", *bars]
    out += ["", "## Content", "", *[f"- {k.removesuffix('_count')} pages: {t[k]}" for k in ("table_count", "formula_count", "image_count", "code_block_count")]]
    out += ["", "## Review", "", f"{t['needing_review']} of {t['pdfs']} documents", "", *[f"- {r['pdf']}" for r in review]]
    if t["needing_review"] > len(review):
        out.append(f"- ... and {t['needing_review'] - len(review)} more")
    if failures is not None:
        kinds = failures if "kind" in failures.columns else failures.withColumn("kind", F.lit("permanent"))
        many = {r["kind"]: r["count"] for r in kinds.groupBy("kind").count().collect()}  # two kinds
        out += ["", "## Failed pages", "", f"{many.get('permanent', 0)} for good, {many.get('skipped', 0)} refused by a content check"]
        for kind, heading, shown in (("permanent", "For good", top), ("skipped", "Refused", named)):
            rows = kinds.where(F.col("kind") == kind).orderBy("pdf", "page_num").limit(shown).collect()
            out += ["", f"### {heading}", "", *[f"- {str(r['pdf'])[:40]} page {r['page_num']}" + (f": {r['error'][:50]}" if kind == "permanent" else "") for r in rows]] if rows else []
            out += [f"- ... {many[kind]} in all"] if many.get(kind, 0) > shown else []
    if seconds is not None:
        out += ["", "## Resources", "", f"{seconds:.0f} s, {seconds / n:.2f} s a page, estimated cost {n * 2000 / 1000 * 0.008:.2f}"]
    out += ["", "## Documents", "", "| document | pages | score | review |", "|---|---|---|---|"]
    out += [f"| {r['pdf']} | {r['total_pages']} | {r['quality_score']:.1f} | {'yes' if r['needs_review'] else 'no'} |" for r in best_]
    if t["pdfs"] > top:
        out.append("| ... | | | |")
    advice = [r["message"] for r in recommendations(total).orderBy("place").collect()]  # five at most
    return "\n".join([*out, "", "## Advice", "", *[f"- {m}" for m in advice]]) + "\n"


def quality_json(total: DataFrame, documents: DataFrame, failed: DataFrame | None = None) -> DataFrame:
    """place, line of a quality report as JSON: documents to review, failed ones, and all totals (see ``files.json_document``)."""
    from leafmill.sources.files import json_document

    review = documents.where("needs_review").select(F.col("pdf").alias("item"))
    gone = failed.select(F.col("pdf").alias("item")) if failed is not None else review.limit(0)
    sums = total.select("pdfs", "succeeded", (F.col("pdfs") - F.col("succeeded")).alias("failed"), "total_pages", "overall_score")
    pages = total.select(*[F.col(f"{k}_pages").alias(k) for k in ("empty", "short", "medium", "long")])
    found = total.select(*[F.col(f"{k}_count").alias(f"{k}s") for k in ("table", "formula", "image", "code_block")])
    return json_document([("review_needed", review, ["item"]), ("failed_list", gone, ["item"])], [("totals", sums), ("content_distribution", pages), ("elements", found)])


def delivery_text(summary: DataFrame, findings: DataFrame, shown: int = 10) -> str:
    """What a delivery check prints: every kind's first ``shown`` findings, and how many more there are."""
    s = summary.first()
    out = [f"documents: {s['documents']}, complete: {'yes' if s['complete'] else 'no'}"]
    for kind, n in (("issue", s["issues"]), ("warning", s["warnings"])):
        rows = findings.where(F.col("severity") == kind).orderBy("pdf", "check", "message").limit(shown).collect()
        out += [f"{kind}s: {n}", *[f"  [{r['pdf']}] {r['check']}: {r['message']}" for r in rows], *([f"  ... and {n - len(rows)} more"] if n > len(rows) else [])]
    return "\n".join([*out, "all checks passed" if s["passed"] else f"failed with {s['issues']} issues"]) + "\n"


def task_reports(task: str, made: str, runs: DataFrame, pages: DataFrame, details: int = 50) -> dict[str, str]:
    """File name -> text of a task's reports: costs, quality, validation.  One row of sums and the first rows reach the driver."""
    import json

    cost = task_cost(runs).first().asDict()
    shown = runs.orderBy("pdf").limit(details).collect()
    q = task_quality(runs, pages).first()
    n = runs.agg(F.count(F.lit(1)).alias("n"), F.count_if("success").alias("ok")).first()
    table = [f"| {r['pdf']} | {r['pages']} | {r['figures']} | {'ok' if r['success'] else 'failed'} |" for r in shown[:30]] + (["| ... | | | |"] if n["n"] > 30 else [])
    quality = [f"# Quality of {task}", "", f"Made: {made}", "", "| measure | value |", "|---|---|", *[f"| {k} | {q[k]} |" for k in q.asDict()], "", "| document | pages | figures | status |", "|---|---|---|---|", *table]
    summary = {"documents": n["n"], "successful": n["ok"], "failed": n["n"] - n["ok"], "success_rate": round(n["ok"] / max(n["n"], 1) * 100, 1)}
    rows = [{"name": str(r["pdf"]), "success": r["success"]} for r in shown]
    return {
        "cost_summary.json": json.dumps({"task": task, "made": made, **cost, "details": [{"name": str(r["pdf"]), "pages": r["pages"], "seconds": r["seconds"]} for r in shown]}),
        "quality_report.md": "\n".join(quality) + "\n",
        "validation_result.json": json.dumps({"task": task, "made": made, "pdfs": rows, "summary": summary}),
    }
