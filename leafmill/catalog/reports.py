"""Queries on indicators, costs and checks.  A document's label rates it; orders stand for runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from leafmill.catalog import pages as page_queries
from leafmill.catalog import query
from leafmill.catalog.rendering import _DOC, documents
from leafmill.functions import text as T
from leafmill.operators import recover, reports
from leafmill.sources import files
from leafmill.sources.shared import stage
from leafmill.sources.tables import spread, table

_PAGES = """SELECT source AS pdf, CASE WHEN d.doc_id % 41 = 0 THEN 'failed' WHEN d.doc_id % 29 = 0 THEN 'skipped' ELSE 'ok' END AS status, d.doc_id % 3 AS figures, CASE WHEN d.doc_id % 17 = 0 THEN 0 ELSE d.doc_id % 3 END AS metas,
 d.doc_id % 2 AS tables, d.doc_id % 5 AS formulas, n_chars AS tokens, n_chars // 3 AS tokens_input, n_chars - n_chars // 3 AS tokens_output, CASE quality WHEN 1 THEN 'high' WHEN 0 THEN 'low' END AS confidence FROM documents d LEFT JOIN labels USING (doc_id)"""


def _pages(spark, sf_dir):
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    i = F.col("doc_id")
    status = F.when(i % 41 == 0, "failed").when(i % 29 == 0, "skipped").otherwise("ok")
    return d.select(F.col("source").alias("pdf"), status.alias("status"), (i % 3).alias("figures"), F.when(i % 17 == 0, 0).otherwise(i % 3).alias("metas"), (i % 2).alias("tables"), (i % 5).alias("formulas"), F.col("n_chars").alias("tokens"), F.floor(F.col("n_chars") / 3).alias("tokens_input"), (F.col("n_chars") - F.floor(F.col("n_chars") / 3)).alias("tokens_output"), F.when(F.col("quality") == 1, "high").when(F.col("quality") == 0, "low").alias("confidence"))


# the same pages with numbers and errors
_NUMBERED = _PAGES.replace("SELECT source AS pdf,", "SELECT source AS pdf, d.doc_id AS page_num, CASE WHEN d.doc_id % 82 = 0 THEN 'TimeoutError: read' END AS error,")


def _numbered(spark, sf_dir):
    i = F.col("doc_id")
    d = table(spark, sf_dir, "documents")
    status = F.when(i % 41 == 0, "failed").when(i % 29 == 0, "skipped").otherwise("ok")
    return d.select(F.col("source").alias("pdf"), i.alias("page_num"), F.when(i % 82 == 0, "TimeoutError: read").alias("error"), status.alias("status"), (i % 3).alias("figures"), (i % 2).alias("tables"), (i % 5).alias("formulas"))


_BIG = "CAST(coalesce(sum({}), 0) AS BIGINT)"
_COUNTS = f"""SELECT pdf, count(*) AS total_pages, count_if(status = 'ok') AS success_pages, count_if(status = 'failed') AS failed_pages, count_if(status = 'skipped') AS skipped_pages,
 {_BIG.format("CASE WHEN status = 'ok' THEN figures END")} AS figures, {_BIG.format("CASE WHEN status = 'ok' THEN metas END")} AS metas, count_if(status = 'ok' AND figures > 0) AS pages_with_figures, count_if(status = 'ok' AND tables > 0) AS pages_with_tables,
 count_if(status = 'ok' AND formulas > 0) AS pages_with_formulas, {', '.join(_BIG.format(f"CASE WHEN status = 'ok' THEN {c} END") + f" AS {c}" for c in ("tokens", "tokens_input", "tokens_output", "tables", "formulas"))}, {_BIG.format("CASE confidence WHEN 'high' THEN 10 WHEN 'low' THEN 3 END")} AS confidence_tenths, count(confidence) AS rated,
 count_if(confidence = 'high') AS high_confidence, count_if(confidence = 'medium') AS medium_confidence, count_if(confidence = 'low') AS low_confidence FROM ({_PAGES}) GROUP BY pdf"""
_KQI = f"""SELECT *, insertion_pass AND confidence_pass AND success_pass AS overall_pass, confidence_tenths >= 6 * greatest(rated, 1) AS complete_data_extraction, metas = figures AS all_figures_have_metadata, failed_pages = 0 AS no_page_failures FROM (SELECT *, insertion_rate >= 0.95::DOUBLE AS insertion_pass, 100 * confidence_tenths >= 850 * greatest(rated, 1) AS confidence_pass, page_success_rate >= 0.98::DOUBLE AS success_pass
 FROM (SELECT *, figures > 0 AS has_figures, metas / greatest(figures, 1) AS insertion_rate, success_pages / greatest(total_pages, 1) AS page_success_rate, floor(figures / greatest(total_pages, 1) * 100.0::DOUBLE + 0.5::DOUBLE) / 100.0::DOUBLE AS figures_per_page, floor(success_pages / greatest(total_pages, 1) * 10000.0::DOUBLE + 0.5::DOUBLE) / 10000.0::DOUBLE AS success_rate, confidence_tenths / (10.0::DOUBLE * greatest(rated, 1)) AS avg_confidence FROM ({_COUNTS})))"""


@query("kqi_metrics", _KQI)
def kqi_metrics(spark, sf_dir):
    return reports.kqi_metrics(_pages(spark, sf_dir), "pdf")


@query("confidence_levels", "SELECT doc_id, CASE quality WHEN 1 THEN 0.95 ELSE 0.40 END::DOUBLE AS score, CASE quality WHEN 1 THEN 'yes' ELSE 'no' END AS completeness FROM labels")
def confidence_levels(spark, sf_dir):
    level = F.when(F.col("quality") == 1, "high").otherwise("low")
    return table(spark, sf_dir, "labels").select("doc_id", reports.confidence_score(level).alias("score"), reports.completeness(level).alias("completeness"))


@query("validation_summary", f"SELECT count(*) AS documents, count_if(overall_pass) AS passed, count_if(NOT overall_pass) AS failed, floor(count(CASE WHEN overall_pass THEN 1 END) * 100.0::DOUBLE / greatest(count(*), 1) * 10.0::DOUBLE + 0.5::DOUBLE) / 10.0::DOUBLE AS pass_rate FROM ({_KQI})")
def validation_summary(spark, sf_dir):
    rows = kqi_metrics(spark, sf_dir)
    n, ok = F.count(F.lit(1)), F.count_if("overall_pass")
    return rows.agg(n.alias("documents"), ok.alias("passed"), F.count_if(~F.col("overall_pass")).alias("failed"), T.rounded(ok * 100.0 / F.greatest(n, F.lit(1)), 1).alias("pass_rate"))


_RUNS = "SELECT o_custkey AS pdf, o_orderstatus <> 'F' AS success, o_orderkey % 40 AS pages, o_orderkey % 7 AS figures, o_orderkey % 1000 * 10 AS tokens_input, o_orderkey % 100 * 10 AS tokens_output, CAST(o_orderkey % 90 AS DOUBLE) AS seconds FROM orders"


def _runs(spark, sf_dir):
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("pdf"), (F.col("o_orderstatus") != "F").alias("success"), (k % 40).alias("pages"), (k % 7).alias("figures"), (k % 1000 * 10).alias("tokens_input"), (k % 100 * 10).alias("tokens_output"), (k % 90).cast("double").alias("seconds"))


_COST = "(tokens_input / 1000 * 0.02::DOUBLE + tokens_output / 1000 * 0.02::DOUBLE)"


@query("token_cost", f"SELECT pdf, {_BIG.format('tokens_input')} AS tokens_in, {_BIG.format('tokens_output')} AS tokens_out, sum(tokens_input) / 1000 * 0.02::DOUBLE + sum(tokens_output) / 1000 * 0.02::DOUBLE AS cost FROM ({_RUNS}) GROUP BY pdf")
def token_cost(spark, sf_dir):
    sums = _runs(spark, sf_dir).groupBy("pdf").agg(F.sum("tokens_input").alias("tokens_in"), F.sum("tokens_output").alias("tokens_out"))
    return sums.withColumn("cost", reports.token_cost(F.col("tokens_in"), F.col("tokens_out")))


_OK = "CASE WHEN success THEN {} END"


@query("batch_report", f"SELECT *, floor({_COST} * 10000.0::DOUBLE + 0.5::DOUBLE) / 10000.0::DOUBLE AS cost, floor(succeeded * 100.0::DOUBLE / greatest(pdfs, 1) * 10.0::DOUBLE + 0.5::DOUBLE) / 10.0::DOUBLE AS success_rate FROM (SELECT count(*) AS pdfs, count_if(success) AS succeeded, {', '.join(f'{_BIG.format(_OK.format(c))} AS {c}' for c in ('pages', 'figures', 'tokens_input', 'tokens_output'))}, coalesce(sum({_OK.format('seconds')}), 0) AS seconds FROM ({_RUNS}))")
def batch_report(spark, sf_dir):
    return reports.batch_report(_runs(spark, sf_dir))


@query("task_cost", f"""SELECT *, floor(c * 100.0::DOUBLE + 0.5::DOUBLE) / 100.0::DOUBLE AS cost, floor(c / greatest(pages, 1) * 10000.0::DOUBLE + 0.5::DOUBLE) / 10000.0::DOUBLE AS cost_per_page, floor(seconds / greatest(pages, 1) * 100.0::DOUBLE + 0.5::DOUBLE) / 100.0::DOUBLE AS seconds_per_page
 FROM (SELECT *, tokens_input_estimate / 1000 * 0.02::DOUBLE + tokens_output / 1000 * 0.02::DOUBLE AS c FROM (SELECT {_BIG.format('pages')} AS pages, {_BIG.format('tokens_output')} AS tokens_output, sum(seconds) AS seconds, {_BIG.format('pages')} * 1500 AS tokens_input_estimate FROM ({_RUNS})))""".replace("SELECT *, floor(c *", "SELECT * EXCLUDE (c), floor(c *"))
def task_cost(spark, sf_dir):
    return reports.task_cost(_runs(spark, sf_dir))


@query("recovery_estimate", "SELECT source AS pdf, count(*) AS pages, count(*) * 40000 AS tokens, count(*) * 40000 * (0.15::DOUBLE / 1000000) AS usd, count(*) * 40000 * (0.15::DOUBLE / 1000000) * 7.2::DOUBLE AS cny, count(*) / 10.0::DOUBLE * 3.0::DOUBLE AS seconds FROM documents WHERE n_chars % 3 = 0 GROUP BY source")
def recovery_estimate(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").withColumn("status", F.when(F.col("n_chars") % 3 == 0, "failed").otherwise("ok")).where("status = 'failed'").groupBy(F.col("source").alias("pdf")).agg(F.count(F.lit(1)).alias("pages"))
    return rows.withColumns(reports.recovery_estimate(F.col("pages")))


_CHECKS = f"""SELECT pdf, f.severity, f."check", f.message FROM (SELECT pdf, unnest([x for x in [
 CASE WHEN CAST(pdf AS BIGINT) % 5 = 0 THEN {{'severity': 'issue', 'check': 'completeness', 'message': 'no metadata'}} END,
 CASE WHEN regexp_matches(markdown, '(?i)```json') OR contains(markdown, '"body_text":') THEN {{'severity': 'issue', 'check': 'json', 'message': 'JSON left in the text'}} END,
 CASE WHEN contains(markdown, '"chart_type":') THEN {{'severity': 'warning', 'check': 'json', 'message': 'chart metadata in the text'}} END,
 CASE WHEN NOT regexp_matches(markdown, '(?m)^## Page \\d+') THEN {{'severity': 'warning', 'check': 'pages', 'message': 'no page heading'}} END,
 CASE WHEN len(markdown) < 1000 THEN {{'severity': 'warning', 'check': 'size', 'message': len(markdown) || ' characters'}} END] if x IS NOT NULL]) AS f FROM ({_DOC}))"""


def _delivered(spark, sf_dir):
    return documents(spark, sf_dir).withColumn("has_yaml", F.col("pdf").cast("long") % 5 != 0)


@query("delivery_checks", _CHECKS)
def delivery_checks(spark, sf_dir):
    return reports.delivery_checks(_delivered(spark, sf_dir))


@query("delivery_statistics", f"SELECT count(*) AS documents, CAST(sum(len(regexp_extract_all(markdown, '(?m)^## Page \\d+'))) AS BIGINT) AS pages, CAST(sum(len(regexp_extract_all(markdown, '### Fig(?:ure)?\\.? \\d+:'))) AS BIGINT) AS figures, CAST(sum(len(markdown)) AS BIGINT) AS chars FROM ({_DOC})")
def delivery_statistics(spark, sf_dir):
    return reports.delivery_statistics(documents(spark, sf_dir))


@query("check_summary", f"SELECT documents, issues, warnings, documents = expected AS complete, documents = expected AND issues = 0 AS passed FROM (SELECT count(*) AS documents FROM ({_DOC})), (SELECT count_if(severity = 'issue') AS issues, count_if(severity = 'warning') AS warnings FROM ({_CHECKS})), (SELECT count(DISTINCT conv_id) AS expected FROM conversations)")
def check_summary(spark, sf_dir):
    d = _delivered(spark, sf_dir)
    expected = table(spark, sf_dir, "conversations").select("conv_id").distinct().count()
    return reports.check_summary(d, reports.delivery_checks(d), expected)


@query("document_without_metadata", f"SELECT pdf FROM ({_DOC}) WHERE CAST(pdf AS BIGINT) % 5 = 0")
def document_without_metadata(spark, sf_dir):
    d = documents(spark, sf_dir)
    return d.select("pdf").join(d.where(F.col("pdf").cast("long") % 5 != 0).select("pdf"), "pdf", "left_anti")


@query("durations", """SELECT o_orderkey, CASE WHEN s < 60 THEN s || 's' WHEN s < 3600 THEN s // 60 || 'm ' || s % 60 || 's' ELSE s // 3600 || 'h ' || s // 60 % 60 || 'm' END AS short, CASE WHEN s < 60 THEN s || 's' WHEN s < 3600 THEN s // 60 || 'm ' || s % 60 || 's' ELSE s // 3600 || 'h ' || s // 60 % 60 || 'm ' || s % 60 || 's' END AS long,
 epoch(o_orderdate + to_seconds(s)) - epoch(o_orderdate) AS elapsed, repeat('█', CAST(s % 21 AS INTEGER)) || repeat('░', CAST(20 - s % 21 AS INTEGER)) AS bar FROM (SELECT *, o_orderkey % 9000 AS s FROM orders)""")
def durations(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("s", F.col("o_orderkey") % 9000)
    later = F.timestamp_add("SECOND", F.col("s"), F.col("o_orderdate").cast("timestamp"))
    elapsed = (F.unix_seconds(later) - F.unix_seconds(F.col("o_orderdate").cast("timestamp"))).cast("double")
    return o.select("o_orderkey", T.duration_short(F.col("s")).alias("short"), T.duration_long(F.col("s")).alias("long"), elapsed.alias("elapsed"), T.bar((F.col("s") % 21) / F.lit(20.0)).alias("bar"))


@query("recommendations", f"""SELECT CAST(row_number() OVER (ORDER BY k) AS INTEGER) AS place, message FROM (SELECT unnest([1, 2, 3, 4, 5]) AS k, unnest([CASE WHEN empty_pages > 0 THEN 'look at ' || empty_pages || ' empty pages' END, CASE WHEN needing_review > 0 THEN 'review ' || needing_review || ' documents' END, CASE WHEN overall_score < 60 THEN 'convert again with more context' END,
 CASE WHEN table_count = 0 THEN 'no tables were found' END, CASE WHEN succeeded < pdfs THEN 'some documents failed' END]) AS message FROM ({page_queries.CORPUS_SQL})) WHERE message IS NOT NULL""")
def recommendations(spark, sf_dir):
    return reports.recommendations(page_queries.corpus_quality(spark, sf_dir))


@query("top_documents", f"SELECT pdf, quality_score FROM ({page_queries._QUALITY}) ORDER BY quality_score DESC, pdf LIMIT 5")
def top_documents(spark, sf_dir):
    return page_queries.pdf_quality(spark, sf_dir).select("pdf", "quality_score").orderBy(F.desc("quality_score"), "pdf").limit(5)


@query("warnings_per_document", f"""SELECT pdf, "check", message FROM (SELECT *, row_number() OVER (PARTITION BY pdf ORDER BY "check", message) AS place FROM ({_CHECKS})) WHERE place <= 5""")
def warnings_per_document(spark, sf_dir):
    from pyspark.sql import Window

    place = F.row_number().over(Window.partitionBy("pdf").orderBy("check", "message"))
    return delivery_checks(spark, sf_dir).withColumn("place", place).where("place <= 5").select("pdf", "check", "message")


@query("masked_keys", "SELECT c_custkey, substring(c_name, 1, 8) || '...' || right(c_name, 4) AS masked FROM customer")
def masked_keys(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", T.masked_key(F.col("c_name")).alias("masked"))


@query("page_details", f"""SELECT pdf, string_agg(CASE WHEN status = 'failed' THEN page_num || ': ' || coalesce(error, 'Unknown error') END, ', ' ORDER BY page_num) AS failed, string_agg(page_num || CASE WHEN status = 'ok' THEN ' ok ' || figures || ' ' || tables || ' ' || formulas ELSE ' no 0 0 0' END, ', ' ORDER BY page_num) AS pages FROM ({_NUMBERED}) GROUP BY pdf""")
def page_details(spark, sf_dir):
    rows = reports.page_details(_numbered(spark, sf_dir), "pdf")
    failed = F.transform("failures", lambda x: F.concat(x["page_num"].cast("string"), F.lit(": "), x["error"]))
    each = lambda x: F.concat_ws(" ", x["page_num"].cast("string"), F.when(x["success"], "ok").otherwise("no"), *[x[c].cast("string") for c in ("figures", "tables", "formulas")])
    return rows.select("pdf", F.when(F.size("failures") > 0, F.array_join(failed, ", ")).alias("failed"), F.array_join(F.transform("page_results", each), ", ").alias("pages"))


_DETAILS = f"""SELECT pdf, string_agg(CASE WHEN status = 'failed' THEN page_num || ': ' || coalesce(error, 'Unknown error') END, ', ' ORDER BY page_num) AS failed, string_agg(page_num || CASE WHEN status = 'ok' THEN ' ok ' || figures || ' ' || tables || ' ' || formulas ELSE ' no 0 0 0' END, ', ' ORDER BY page_num) AS pages FROM ({_NUMBERED}) GROUP BY pdf"""
_MEASURES = ["total_pages", "success_pages", "failed_pages", "figures", "metas", "tables", "formulas", "tokens_input", "tokens_output", "rated", "insertion_rate", "avg_confidence", "success_rate", "overall_pass", "no_page_failures"]


@query("validation_files", f"""SELECT pdf || '.validation.yaml' AS name, pdf AS filename, total_pages AS document_pages, {', '.join(_MEASURES)}, failed, pages FROM ({_KQI}) JOIN ({_DETAILS}) USING (pdf)""")
def validation_files(spark, sf_dir):
    """The YAML files read back: document, measures, failed pages and every page's outcome."""
    made = reports.validation_yaml(kqi_metrics(spark, sf_dir), reports.page_details(_numbered(spark, sf_dir), "pdf"))
    kinds = dict(kqi_metrics(spark, sf_dir).dtypes)
    page = "page_num long, success boolean, figures long, tables long, formulas long"
    schema = f"document_info struct<filename:string,total_pages:long>, kqi_metrics struct<{','.join(f'{m}:{kinds[m]}' for m in _MEASURES)}>, failed_pages_detail array<struct<page_num:long,error:string>>, page_by_page_results array<struct<{page.replace(' ', ':').replace(',:', ',')}>>"
    rows = made.select("name", F.from_json(files.yaml_to_json("content"), schema).alias("v")).select("name", "v.*")
    failed = F.transform("failed_pages_detail", lambda x: F.concat(x["page_num"].cast("string"), F.lit(": "), x["error"]))
    each = lambda x: F.concat_ws(" ", x["page_num"].cast("string"), F.when(x["success"], "ok").otherwise("no"), *[x[c].cast("string") for c in ("figures", "tables", "formulas")])
    return rows.select("name", F.col("document_info.filename").alias("filename"), F.col("document_info.total_pages").alias("document_pages"), *[F.col(f"kqi_metrics.{m}").alias(m) for m in _MEASURES], F.when(F.size("failed_pages_detail") > 0, F.array_join(failed, ", ")).alias("failed"), F.array_join(F.transform("page_by_page_results", each), ", ").alias("pages"))


_BACK = "page_num % 4 = 0"


@query("recovered_validation", f"""SELECT pdf, string_agg(page_num || CASE WHEN {_BACK} THEN ' by second' ELSE ' open' END, ', ' ORDER BY page_num) AS failures, count_if({_BACK}) AS pages_recovered FROM ({_NUMBERED}) WHERE status = 'failed' GROUP BY pdf""")
def recovered_validation(spark, sf_dir):
    """Validation files after a recovery of some of the failed pages, each asked for twice, read back."""
    numbered = _numbered(spark, sf_dir)
    recovered = numbered.where("status = 'failed'").select("pdf", "page_num", F.expr(_BACK).alias("success"), F.explode(F.array(F.lit(1), F.lit(2))).alias("attempt"))
    details = recover.marked_failures(reports.page_details(numbered, "pdf"), recovered, "second", "2024-01-01")
    made = reports.validation_yaml(kqi_metrics(spark, sf_dir), details)
    schema = "document_info struct<filename:string>, failed_pages_detail array<struct<page_num:long,recovered:boolean,recovered_by:string,recovered_at:string>>, recovery_info struct<pages_recovered:long>"
    read = stage(made.select(files.yaml_to_json("content").alias("json")), "validation")  # the filter below would read each file again
    rows = read.select(F.from_json("json", schema).alias("v")).select("v.*").where(F.size("failed_pages_detail") > 0)
    line = lambda x: F.concat(x["page_num"].cast("string"), F.when(x["recovered"], F.concat(F.lit(" by "), x["recovered_by"])).otherwise(" open"))
    return rows.select(F.col("document_info.filename").alias("pdf"), F.array_join(F.transform("failed_pages_detail", line), ", ").alias("failures"), F.col("recovery_info.pages_recovered").alias("pages_recovered"))


_STATUS_JSON = "'\"totals\":{\"pdfs\":' || pdfs || ',\"succeeded\":' || succeeded || ',\"failed\":' || pdfs - succeeded || ',\"total_pages\":' || total_pages || ',\"overall_score\":' || overall_score || '},'"


@query("quality_json", f"""WITH c AS ({page_queries.CORPUS_SQL}), r AS (SELECT pdf, row_number() OVER (ORDER BY pdf) AS i, count(*) OVER () AS n FROM ({page_queries._QUALITY}) WHERE needs_review)
 SELECT row_number() OVER (ORDER BY section, i) AS place, line FROM (SELECT 1 AS section, i, '"' || pdf || '"' || CASE WHEN i < n THEN ',' ELSE '' END AS line FROM r UNION ALL SELECT 0, 0, '{{' UNION ALL SELECT 0, 1, '"review_needed":[' UNION ALL SELECT 2, 0, '],' UNION ALL SELECT 2, 1, '"failed_list":[' UNION ALL SELECT 2, 2, '],'
 UNION ALL SELECT 3, 0, {_STATUS_JSON} FROM c UNION ALL SELECT 4, 0, '"content_distribution":{{"empty":' || empty_pages || ',"short":' || short_pages || ',"medium":' || medium_pages || ',"long":' || long_pages || '}},' FROM c
 UNION ALL SELECT 5, 0, '"elements":{{"tables":' || table_count || ',"formulas":' || formula_count || ',"images":' || image_count || ',"code_blocks":' || code_block_count || '}}' FROM c UNION ALL SELECT 6, 0, '}}')""")
def quality_json(spark, sf_dir):
    return reports.quality_json(page_queries.corpus_quality(spark, sf_dir), page_queries.pdf_quality(spark, sf_dir))


@query("first_warnings", f"""SELECT CAST(place AS INTEGER) AS place, line FROM (SELECT row_number() OVER (ORDER BY pdf, "check", message) AS place, '[' || pdf || '] ' || "check" || ': ' || message AS line FROM ({_CHECKS}) WHERE severity = 'warning') WHERE place <= 10 UNION ALL SELECT 11, '... and ' || (count(*) - 10) || ' more' FROM ({_CHECKS}) WHERE severity = 'warning' HAVING count(*) > 10""")
def first_warnings(spark, sf_dir):
    rows = delivery_checks(spark, sf_dir).where("severity = 'warning'")
    return reports.shown_rows(rows, [F.col("pdf"), F.col("check"), F.col("message")], F.concat(F.lit("["), "pdf", F.lit("] "), "check", F.lit(": "), "message"), 10)


@query("recovery_preview", """SELECT CAST(place AS INTEGER) AS place, line FROM (SELECT row_number() OVER (ORDER BY source, doc_id) AS place, source || ' page ' || doc_id AS line FROM documents WHERE n_chars % 9 = 3) WHERE place <= 20 UNION ALL SELECT 21, '... and ' || (count(*) - 20) || ' more' FROM documents WHERE n_chars % 9 = 3 HAVING count(*) > 20""")
def recovery_preview(spark, sf_dir):
    """The first pages that a recovery would ask for, before it is run."""
    from leafmill.catalog.progress import _states

    blocked = recover.blocked_pages(_states(spark, sf_dir))
    return reports.shown_rows(blocked, [F.col("pdf"), F.col("page_num")], F.concat("pdf", F.lit(" page "), F.col("page_num").cast("string")), 20)


@query("task_quality", f"""SELECT *, floor((pages - failed_pages) * 100.0::DOUBLE / greatest(pages, 1) * 10.0::DOUBLE + 0.5::DOUBLE) / 10.0::DOUBLE AS success_rate FROM (SELECT * FROM (SELECT {_BIG.format('pages')} AS pages, {_BIG.format('figures')} AS figures FROM ({_RUNS})),
 (SELECT {_BIG.format("CASE WHEN status = 'ok' THEN tables END")} AS tables, {_BIG.format("CASE WHEN status = 'ok' THEN formulas END")} AS formulas, count_if(status = 'failed') AS failed_pages FROM ({_PAGES})))""")
def task_quality(spark, sf_dir):
    return reports.task_quality(_runs(spark, sf_dir), _pages(spark, sf_dir)).withColumn("failed_pages", F.col("failed_pages").cast("long"))


@query("shown_documents", f"SELECT CAST(place AS INTEGER) AS place, line FROM (SELECT row_number() OVER (ORDER BY pdf) AS place, pdf AS line FROM ({page_queries._PDF})) WHERE place <= 3 UNION ALL SELECT 4, '... and ' || (count(*) - 3) || ' more' FROM ({page_queries._PDF}) HAVING count(*) > 3")
def shown_documents(spark, sf_dir):
    return reports.shown_rows(page_queries.pdf_quality(spark, sf_dir), [F.col("pdf")], F.col("pdf"), 3)


_YAML = "CASE c_custkey % 4 WHEN 0 THEN 'a: ' || c_custkey WHEN 1 THEN 'a: [1, ' || c_custkey WHEN 2 THEN '# ' || c_name || ' only a comment' ELSE '' END"


@query("metadata_checks", """SELECT c_name AS pdf, CASE c_custkey % 4 WHEN 1 THEN 'issue' ELSE 'warning' END AS severity, 'yaml' AS "check", CASE c_custkey % 4 WHEN 1 THEN 'unreadable' ELSE 'nothing in it' END AS message FROM customer WHERE c_custkey % 4 IN (1, 2)""")
def metadata_checks(spark, sf_dir):
    k = F.col("c_custkey") % 4
    text = F.when(k == 0, F.concat(F.lit("a: "), F.col("c_custkey").cast("string"))).when(k == 1, F.concat(F.lit("a: [1, "), F.col("c_custkey").cast("string"))).when(k == 2, F.concat(F.lit("# "), "c_name", F.lit(" only a comment"))).otherwise("")
    found = reports.metadata_checks(spread(table(spark, sf_dir, "customer")).select(F.col("c_name").alias("name"), text.alias("text")))
    return found.withColumn("message", F.regexp_replace("message", ":.*", ""))
