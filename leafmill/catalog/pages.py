"""Queries on pages: quality, context, classification."""

from __future__ import annotations

from pyspark.sql import functions as F

from leafmill.catalog import query
from leafmill.functions import text as T
from leafmill.operators import context, quality
from leafmill.operators.ranks import with_place
from leafmill.sources.tables import table

# a page without a text is an empty page
_TEXTS = "(SELECT doc_id, source, coalesce(text, '') AS text FROM documents)"
_STRIP = r"regexp_replace(text, '^\s+|\s+$', '', 'g')"
# The patterns of page flags, as in operators.quality
_FLAGS = rf"""SELECT doc_id, source, text, len({_STRIP}) AS char_count,
 regexp_matches(text, '\|.*\|.*\|') AND regexp_matches(text, '\|\s*:?-+:?\s*\|') AS has_table,
 regexp_matches(text, '\|.*\|.*\|') AND regexp_matches(text, '\|-+\|') AS has_table_strict,
 regexp_matches(text, '(?s)\$\$.+?\$\$') OR regexp_matches(text, '\$[^$]+\$') AS has_formula,
 regexp_matches(text, '!\[.*?\]\(.*?\)') OR regexp_matches(text, '(?i)<figure>') AS has_image,
 regexp_matches(text, '(?s)```.*?```') AS has_code FROM {_TEXTS}"""
_ISSUES = rf"""SELECT doc_id, source, [x for x in [CASE WHEN len({_STRIP}) < 10 THEN 'blank' WHEN len({_STRIP}) < 50 THEN 'short' END,
 CASE WHEN len(text) > 0 AND len(text) - len(replace(text, chr(65533), '')) > len(text) * 0.05 THEN 'garbled' END,
 CASE WHEN EXISTS (SELECT 1 FROM (SELECT lead(i, 1, n + 1) OVER (ORDER BY i) - i AS run, ch FROM (SELECT i, c[i] AS ch, len(c) AS n FROM (SELECT c, unnest(generate_series(1, len(c))) AS i FROM (SELECT string_split(text, '') AS c)) WHERE i = 1 OR c[i] <> c[i - 1])) WHERE run >= 11 AND ch <> chr(10)) THEN 'repeated' END] if x IS NOT NULL] AS issues
 FROM {_TEXTS}"""
_PDF = f"""SELECT source AS pdf, count(*) AS total_pages, CAST(sum(char_count) AS BIGINT) AS char_count, count_if(char_count < 10) AS empty_pages, count_if(char_count >= 10 AND char_count < 100) AS short_pages,
 count_if(char_count >= 100 AND char_count < 500) AS medium_pages, count_if(char_count >= 500) AS long_pages, count_if(has_table) AS table_count, count_if(has_formula) AS formula_count,
 count_if(has_image) AS image_count, count_if(has_code) AS code_block_count FROM ({_FLAGS}) GROUP BY source"""
_QUALITY = f"""SELECT p.*, coalesce(i.issue_count, 0) AS issue_count, (medium_pages + long_pages) / total_pages * 100.0::DOUBLE AS quality_score,
 empty_pages / total_pages > 0.2 OR coalesce(i.issue_count, 0) > total_pages * 0.1 AS needs_review
 FROM ({_PDF}) p LEFT JOIN (SELECT source, CAST(sum(len(issues)) AS BIGINT) AS issue_count FROM ({_ISSUES}) GROUP BY source) i ON p.pdf = i.source"""


def _pages(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "source", F.coalesce("text", F.lit("")).alias("text"))


def _quality(spark, sf_dir):
    rows = quality.page_flags(_pages(spark, sf_dir)).withColumn("issues", quality.page_issues(F.col("text")))
    return quality.document_quality(rows, "source")


@query("page_flags", f"SELECT * EXCLUDE (text) FROM ({_FLAGS})")
def page_flags(spark, sf_dir):
    return quality.page_flags(_pages(spark, sf_dir)).drop("text")


@query("page_issues", f"SELECT doc_id, source, array_to_string(issues, ',') AS issues FROM ({_ISSUES})")
def page_issues(spark, sf_dir):
    return _pages(spark, sf_dir).select("doc_id", "source", F.array_join(quality.page_issues(F.col("text")), ",").alias("issues"))


@query("pdf_quality", _QUALITY)
def pdf_quality(spark, sf_dir):
    return _quality(spark, sf_dir)


_SUMS = ", ".join(f"CAST(coalesce(sum({c}), 0) AS BIGINT) AS {c}" for c in "total_pages char_count empty_pages short_pages medium_pages long_pages table_count formula_count image_count code_block_count".split())
_RATE = "CASE WHEN {s} >= 90 THEN 'Excellent' WHEN {s} >= 80 THEN 'Good' WHEN {s} >= 60 THEN 'Fair' WHEN {s} >= 40 THEN 'Poor' ELSE 'Very Poor' END"
_SCORE = "floor((medium_pages + long_pages) / greatest(total_pages, 1) * 100.0::DOUBLE * 10.0::DOUBLE + 0.5::DOUBLE) / 10.0::DOUBLE"


CORPUS_SQL = f"SELECT *, {_SCORE} AS overall_score, {_RATE.format(s=_SCORE)} AS rating FROM (SELECT count(*) AS pdfs, count_if(total_pages > 0) AS succeeded, count_if(needs_review) AS needing_review, {_SUMS} FROM ({_QUALITY}))"


@query("corpus_quality", CORPUS_SQL)
def corpus_quality(spark, sf_dir):
    return quality.corpus_quality(_quality(spark, sf_dir))


@query("quality_rating", f"SELECT pdf, quality_score, {_RATE.format(s='quality_score')} AS rating, row_number() OVER (ORDER BY quality_score DESC, pdf) AS place FROM ({_QUALITY})")
def quality_rating(spark, sf_dir):
    rows = _quality(spark, sf_dir).select("pdf", "quality_score", T.rating(F.col("quality_score")).alias("rating"))
    return with_place(rows, F.desc("quality_score"), F.asc("pdf"))


@query("corpus_compliance", f"SELECT pdfs, compliant, floor(compliant * 100.0::DOUBLE / greatest(succeeded, 1) * 10.0::DOUBLE + 0.5::DOUBLE) / 10.0::DOUBLE AS compliance_rate FROM (SELECT count(*) AS pdfs, count_if(total_pages > 0) AS succeeded, count_if(char_count % 3 = 0) AS compliant FROM ({_QUALITY}))")
def corpus_compliance(spark, sf_dir):
    rows = _quality(spark, sf_dir)
    return quality.corpus_quality(rows, rows.select("pdf", (F.col("char_count") % 3 == 0).alias("compliant"))).select("pdfs", "compliant", "compliance_rate")


_REF = r"(?i)((?:Figure|Fig\.?|Table|Chart)\s*\d+[^.]*\.)"


def _cut(c: str, n: int) -> str:
    if not n:
        return c
    refs = f"array_to_string(regexp_extract_all({c}, '{_REF}', 1), ' ')"
    return f"CASE WHEN len({c}) <= {n} THEN {c} WHEN len({refs}) > 0 AND len({refs}) < {n} AND {n} - len({refs}) - 20 > 50 THEN substring({c}, 1, {n} - len({refs}) - 20) || '...' || chr(10) || '[Refs: ' || {refs} || ']' ELSE substring({c}, 1, {n}) || '...' END"


_NEAR = """SELECT conv_id, turn + 1 AS page_num, text, max(text) OVER (PARTITION BY conv_id ORDER BY turn RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING) AS prev_text,
 max(text) OVER (PARTITION BY conv_id ORDER BY turn RANGE BETWEEN 1 FOLLOWING AND 1 FOLLOWING) AS next_text FROM conversations"""


def _context_sql(mode: str) -> str:
    parts = [f"CASE WHEN coalesce(len({c}), 0) = 0 THEN 'N/A' ELSE {_cut(c, n)} END AS {k}_context" for (k, c), n in zip((("prev", "prev_text"), ("current", "text"), ("next", "next_text")), context.MODES[mode])]
    return f"SELECT conv_id, page_num, {', '.join(parts)} FROM ({_NEAR})"


def _near(spark, sf_dir):
    pages = table(spark, sf_dir, "conversations").select("conv_id", (F.col("turn") + 1).alias("page_num"), "text")
    return context.neighbours(pages, "conv_id", "page_num", "text")


for _mode in context.MODES:

    @query(f"context_{_mode}", _context_sql(_mode))
    def _context(spark, sf_dir, mode=_mode):
        return context.context_window(_near(spark, sf_dir), mode).select("conv_id", "page_num", "prev_context", "current_context", "next_context")


@query("truncate_with_refs", f"SELECT doc_id, {_cut('text', 500)} AS cut500, {_cut('text', 100)} AS cut100 FROM documents")
def truncate_with_refs(spark, sf_dir):
    t = F.col("text")
    return table(spark, sf_dir, "documents").select("doc_id", T.truncate_with_references(t, 500).alias("cut500"), T.truncate_with_references(t, 100).alias("cut100"))


_IND = "(?i)(?:" + "|".join(T.INDICATORS).replace("'", "''") + ")"


@query("chart_indicators", f"SELECT doc_id, coalesce(regexp_matches(text, '{_IND}'), false) AS has_indicators FROM documents")
def chart_indicators(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.has_indicators(F.col("text")).alias("has_indicators"))


@query("prompt_routing", f"SELECT conv_id, page_num, CASE WHEN coalesce(regexp_matches(text, '{_IND}'), false) OR coalesce(regexp_matches(prev_text, '{_IND}'), false) OR coalesce(regexp_matches(next_text, '{_IND}'), false) THEN 'enhanced' ELSE 'simple' END AS prompt_mode FROM ({_NEAR})")
def prompt_routing(spark, sf_dir):
    return _near(spark, sf_dir).select("conv_id", "page_num", context.prompt_mode(F.col("text"), F.col("prev_text"), F.col("next_text")).alias("prompt_mode"))


@query("simple_prompts", f"SELECT conv_id, page_num, 'Page ' || page_num || chr(10) || 'Before: ' || substring(coalesce(prev_text, 'N/A'), 1, 100) || chr(10) || 'Text: ' || substring(coalesce(text, 'N/A'), 1, 300) || chr(10) || 'After: ' || substring(coalesce(next_text, 'N/A'), 1, 100) || chr(10) || 'Answer with JSON.' AS prompt FROM ({_NEAR})")
def simple_prompts(spark, sf_dir):
    return _near(spark, sf_dir).select("conv_id", "page_num", context.simple_prompt(F.col("page_num"), F.col("text"), F.col("prev_text"), F.col("next_text")).alias("prompt"))


_TASKS = " || chr(10) || ".join(["'" + f"{i}. {t}".replace("'", "''") + "'" for i, t in enumerate(context.TASKS, 1)])


@query("routed_prompts", f"""SELECT conv_id, page_num, CASE WHEN coalesce(regexp_matches(text, '{_IND}'), false) OR coalesce(regexp_matches(prev_text, '{_IND}'), false) OR coalesce(regexp_matches(next_text, '{_IND}'), false)
 THEN 'Page ' || page_num || chr(10) || 'Before: ' || coalesce(prev_text, 'N/A') || chr(10) || 'After: ' || coalesce(next_text, 'N/A') || chr(10) || {_TASKS} || chr(10) || 'Answer with JSON.'
 ELSE 'Page ' || page_num || chr(10) || 'Before: ' || substring(coalesce(prev_text, 'N/A'), 1, 100) || chr(10) || 'Text: ' || substring(coalesce(text, 'N/A'), 1, 300) || chr(10) || 'After: ' || substring(coalesce(next_text, 'N/A'), 1, 100) || chr(10) || 'Answer with JSON.' END AS prompt FROM ({_NEAR})""")
def routed_prompts(spark, sf_dir):
    page, text, prev, following = (F.col(c) for c in ("page_num", "text", "prev_text", "next_text"))
    return _near(spark, sf_dir).select("conv_id", "page_num", context.prompt(context.prompt_mode(text, prev, following), page, text, prev, following).alias("prompt"))


@query("page_cost_estimate", "SELECT source AS pdf, count(*) AS pages, floor(count(*) * 2000 / 1000 * 0.008::DOUBLE * 100.0::DOUBLE + 0.5::DOUBLE) / 100.0::DOUBLE AS cost FROM documents GROUP BY source")
def page_cost_estimate(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").groupBy(F.col("source").alias("pdf")).agg(F.count(F.lit(1)).alias("pages"))
    return rows.withColumn("cost", T.rounded(F.col("pages") * 2000 / 1000 * 0.008, 2))
