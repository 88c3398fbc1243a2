"""Queries on Markdown clean-up, over Markdown rendered from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from leafmill.catalog import query
from leafmill.catalog.rendering import _DOC, documents
from leafmill.functions import text as T
from leafmill.operators import clean
from leafmill.sources.tables import table

# a text with runs of newlines and blanks at line ends, made from each document
_ROUGH = "replace(replace(text, '. ', '.' || repeat(chr(10), 4) || ' '), ', ', ',  ' || chr(10))"


def _rough():
    return F.replace(F.replace(F.col("text"), F.lit(". "), F.lit(".\n\n\n\n ")), F.lit(", "), F.lit(",  \n"))


@query("merge_blank_lines", f"SELECT doc_id, regexp_replace(t, '\\n{{4,}}', chr(10) || chr(10) || chr(10), 'g') AS text, CAST(len(regexp_extract_all(t, '\\n{{4,}}')) AS INTEGER) AS fixes FROM (SELECT doc_id, {_ROUGH} AS t FROM documents)")
def merge_blank_lines(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.squeeze_blank_lines(_rough()).alias("text"), F.regexp_count(_rough(), F.lit(r"\n{4,}")).alias("fixes"))


@query("rstrip_lines", f"SELECT doc_id, array_to_string([regexp_replace(l, '[ \\t\\r\\f\\v]+$', '') for l in string_split({_ROUGH}, chr(10))], chr(10)) AS text FROM documents")
def rstrip_lines(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.rstrip_lines(_rough()).alias("text"))


_LINES = f"SELECT pdf, i AS line_no, l[i] AS line FROM (SELECT pdf, l, unnest(generate_series(1, len(l))) AS i FROM (SELECT pdf, string_split(markdown, chr(10)) AS l FROM ({_DOC})))"
_HEADS = rf"""SELECT pdf, CAST(line_no AS INTEGER) AS line_no, CAST(len(regexp_extract(line, '^(#{{1,6}})', 1)) AS INTEGER) AS level, regexp_replace(regexp_extract(line, '^#{{1,6}}\s+(.+)$', 1), '^\s+|\s+$', '', 'g') AS title FROM ({_LINES}) WHERE regexp_matches(line, '^#{{1,6}}\s+.+$')"""
_SLUG = r"regexp_replace(regexp_replace(lower(title), '[^\p{L}\p{N}_\s-]', '', 'g'), '\s+', '-', 'g')"


@query("heading_audit", f"SELECT pdf, line_no, level, title, coalesce(lead(line_no) OVER w = line_no + 1 AND lead(level) OVER w > level, false) AS orphan, coalesce(level - lag(level) OVER w > 1, false) AS jump FROM ({_HEADS}) WINDOW w AS (PARTITION BY pdf ORDER BY line_no)")
def heading_audit(spark, sf_dir):
    return clean.heading_audit(documents(spark, sf_dir))


_TOC = f"SELECT pdf, string_agg(repeat('  ', level - 2) || '- [' || title || '](#' || {_SLUG} || ')', chr(10) ORDER BY line_no) AS toc FROM ({_HEADS}) WHERE level > 1 GROUP BY pdf"


@query("toc", _TOC)
def toc(spark, sf_dir):
    return clean.contents(documents(spark, sf_dir))


@query("toc_inserted", f"SELECT pdf, substring(markdown, 1, n) || chr(10) || chr(10) || '## Contents' || chr(10) || chr(10) || toc || chr(10) || chr(10) || '---' || chr(10) || substring(markdown, n + 1) AS markdown FROM (SELECT *, len(regexp_extract(markdown, '(?m)^# .+$')) AS n FROM ({_DOC}) JOIN ({_TOC}) USING (pdf))")
def toc_inserted(spark, sf_dir):
    return clean.with_contents(documents(spark, sf_dir))


_LINKED = "'# ' || d.source || chr(10) || '## Part ' || d.doc_id || chr(10) || 'See [a](#part-' || (d.doc_id // 2) * 2 || ') [b](https://x.org/' || d.doc_id || ') [c](img/' || d.doc_id || '.png)'"


def _linked(spark, sf_dir):
    n = F.col("doc_id").cast("string")
    even = (F.floor(F.col("doc_id") / 2) * 2).cast("string")
    md = F.concat(F.lit("# "), "source", F.lit("\n## Part "), n, F.lit("\nSee [a](#part-"), even, F.lit(") [b](https://x.org/"), n, F.lit(") [c](img/"), n, F.lit(".png)"))
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("pdf"), md.alias("markdown"))


@query("link_check", """SELECT doc_id AS pdf, 1 AS link_no, 'a' AS label, '#part-' || (doc_id // 2) * 2 AS target, CASE WHEN doc_id % 2 = 0 THEN 'anchor' ELSE 'broken' END AS kind FROM documents
 UNION ALL SELECT doc_id, 2, 'b', 'https://x.org/' || doc_id, 'external' FROM documents UNION ALL SELECT doc_id, 3, 'c', 'img/' || doc_id || '.png', 'relative' FROM documents""")
def link_check(spark, sf_dir):
    return clean.link_check(_linked(spark, sf_dir))


@query("latex_formulas", """SELECT doc_id AS pdf, 1 AS formula_no, 'block' AS kind, '\\frac{a}{' || doc_id || '}' AS formula, false AS missing_argument, false AS unbalanced FROM documents
 UNION ALL SELECT doc_id, 2, 'block', '\\frac ', true, false FROM documents UNION ALL SELECT doc_id, 3, 'inline', 'x_{' || doc_id || ')', false, true FROM documents""")
def latex_formulas(spark, sf_dir):
    n = F.col("doc_id").cast("string")
    md = F.concat(F.lit("a $$\\frac{a}{"), n, F.lit("}$$ b $x_{"), n, F.lit(")$ c $$\\frac $$ d"))
    return clean.formulas(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("pdf"), md.alias("markdown")))


@query("literal_newlines", r"""SELECT doc_id, 'a' || chr(10) || doc_id || ' $x\nabla$ ```' || chr(10) || 'k\n' || chr(10) || '``` b' || chr(10) || 'c' AS text, 3 AS loose FROM documents""")
def literal_newlines(spark, sf_dir):
    md = F.concat(F.lit("a\\n"), F.col("doc_id").cast("string"), F.lit(" $x\\nabla$ ```\nk\\n\n``` b\\nc"))
    return table(spark, sf_dir, "documents").select("doc_id", clean.newline_marks(md).alias("text"), clean.loose_newline_marks(md).alias("loose"))


@query("align_tables", """SELECT n_nationkey, '| key ' || repeat(' ', greatest(len(CAST(n_regionkey AS VARCHAR)) - 3, 0)) || '| ' || rpad('name', CAST(greatest(len(n_name), 4) AS INTEGER), ' ') || ' |' || chr(10) || '| :-- | ' || repeat('-', greatest(len(n_name), 4)) || ' |' || chr(10)
 || '| ' || rpad(CAST(n_regionkey AS VARCHAR), 3, ' ') || ' | ' || rpad(n_name, CAST(greatest(len(n_name), 4) AS INTEGER), ' ') || ' |' AS markdown FROM nation""")
def align_tables(spark, sf_dir):
    md = F.concat(F.lit("|key|name|\n|:---|---|\n|"), F.col("n_regionkey").cast("string"), F.lit("|"), "n_name", F.lit("|"))
    return table(spark, sf_dir, "nation").select("n_nationkey", clean.align_tables(md).alias("markdown"))


@query("json_blocks", "SELECT n_nationkey, 'before' || chr(10) || n_name || chr(10) || 'more' || chr(10) || 'after' AS markdown FROM nation")
def json_blocks(spark, sf_dir):
    answer = F.to_json(F.struct(F.lit(1).alias("page_number"), F.concat("n_name", F.lit("\nmore")).alias("body_text")))
    md = F.concat(F.lit("before\n```json\n"), answer, F.lit("\n```\nafter"))
    return table(spark, sf_dir, "nation").select("n_nationkey", clean.clean_json(md).alias("markdown"))


# every shape of left-over JSON, one after the other, around a document's own words
_NAME = "regexp_replace(n_name, '[^A-Za-z]', '', 'g')"


def _left(spark, sf_dir):
    n, k = F.regexp_replace("n_name", "[^A-Za-z]", ""), F.col("n_nationkey") % 8
    shape = (
        F.when(k == 0, F.concat(F.lit('a\n```json\n{"body_text": "'), n, F.lit('\\nx"}\n```\nb')))
        .when(k == 1, F.concat(F.lit('```json\n{"body_text": "", "content": "'), n, F.lit('"}\n```')))
        .when(k == 2, F.concat(F.lit("```json\n{"), n, F.lit("\n```")))
        .when(k == 3, F.concat(F.lit('x\n```json\n{\n  "page_number": 3,\n  "tables": [],\n  "body_text": "'), n, F.lit(' \\"q\\", \\tz",\n\n## Page 4\n\ny')))
        .when(k == 4, F.concat(F.lit('"tables": [],\n"page_number": 4,\n'), n))
        .when(k == 5, F.concat(F.lit('"body_text": "'), n, F.lit('\\nw",\nmore",\n## Page 2')))
        .when(k == 6, F.concat(F.lit("a\n```json\n{\n\n"), n))
        .otherwise(F.concat(F.lit("```json\n[1]\n```"), n))
    )
    return table(spark, sf_dir, "nation").select("n_nationkey", shape.alias("markdown"))


@query("json_leftovers", f"""SELECT n_nationkey, CASE n_nationkey % 8 WHEN 0 THEN 'a' || chr(10) || {_NAME} || chr(10) || 'x' || chr(10) || 'b' WHEN 1 THEN '' WHEN 2 THEN '```json' || chr(10) || '{{' || {_NAME} || chr(10) || '```'
 WHEN 3 THEN 'x' || chr(10) || {_NAME} || ' "q", ' || chr(9) || 'z' || chr(10) || chr(10) || '## Page 4' || chr(10) || chr(10) || 'y' WHEN 4 THEN {_NAME} WHEN 5 THEN {_NAME} || chr(10) || 'w",' || chr(10) || 'more' || chr(10) || '## Page 2' WHEN 6 THEN 'a' || chr(10) || chr(10) || chr(10) || {_NAME} ELSE {_NAME} END AS markdown FROM nation""")
def json_leftovers(spark, sf_dir):
    return _left(spark, sf_dir).select("n_nationkey", clean.clean_json("markdown").alias("markdown"))


# the rendered documents with their tables aligned, their runs of blank lines cut and their lines trimmed
_WIDTH = "greatest(len({}), {})"
_CLEANED = _DOC.replace("'| role | size |' || chr(10) || '|---|---|' || chr(10) || '| ' || role || ' | ' || len(text) || ' |' || chr(10)", "'| ' || rpad('role', CAST(greatest(len(role), 4) AS INTEGER), ' ') || ' | ' || rpad('size', CAST(greatest(len(CAST(len(text) AS VARCHAR)), 4) AS INTEGER), ' ') || ' |' || chr(10) || '| ' || repeat('-', greatest(len(role), 4)) || ' | ' || repeat('-', greatest(len(CAST(len(text) AS VARCHAR)), 4)) || ' |' || chr(10) || '| ' || rpad(role, CAST(greatest(len(role), 4) AS INTEGER), ' ') || ' | ' || rpad(CAST(len(text) AS VARCHAR), CAST(greatest(len(CAST(len(text) AS VARCHAR)), 4) AS INTEGER), ' ') || ' |' || chr(10)")
_TRIMMED = "array_to_string([regexp_replace(l, '[ \\t\\r\\f\\v]+$', '') for l in string_split(regexp_replace(markdown, '\\n{4,}', chr(10) || chr(10) || chr(10), 'g'), chr(10))], chr(10))"


@query("cleaned_documents", f"SELECT pdf, {_TRIMMED} AS markdown FROM ({_CLEANED})")
def cleaned_documents(spark, sf_dir):
    return clean.cleaned(documents(spark, sf_dir))


def _damaged(spark, sf_dir):
    """Documents with a formula, links, newline marks and answers in them."""
    n = F.col("doc_id").cast("string")
    md = F.concat(F.lit("# "), "source", F.lit("\n## Part "), n, F.lit("\n### Sub\n\\n `x` [a](#nowhere) [b](img.png) $(]$\n```json\n{\"body_text\": \"B\"}\n```\n|a|b|\n|---|---|\n|1|2|\n\n\n\n\nend"))
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("pdf"), md.alias("markdown"))


@query("clean_details", "SELECT doc_id AS pdf, 'json: 1|newline marks: 1|blank lines: 1|tables: 1' AS fixes, 0 AS grown FROM documents")
def clean_details(spark, sf_dir):
    rows = clean.cleaned(_damaged(spark, sf_dir), details=True)
    return rows.select("pdf", F.array_join("fixes", "|").alias("fixes"), (F.col("size_after") > F.col("size_before")).cast("int").alias("grown"))


@query("clean_warnings", """SELECT doc_id AS pdf, unnest([1, 2, 3, 4, 5]) AS place, unnest(['formula', 'heading', 'heading', 'link', 'link']) AS kind, unnest(['brackets: (]', 'no text below: ' || source, 'no text below: Part ' || doc_id, 'broken: #nowhere', 'relative: img.png']) AS message FROM documents""")
def clean_warnings(spark, sf_dir):
    return clean.warnings(_damaged(spark, sf_dir)).where("place <= 5")


@query("clean_totals", "SELECT count(*) AS files, count(*) * 4 AS fixes, count(*) * 5 AS warnings, 0 AS contents FROM documents")
def clean_totals(spark, sf_dir):
    rows = _damaged(spark, sf_dir)
    return clean.clean_totals(clean.cleaned(rows, details=True), clean.warnings(rows))


_BEFORE = r"""E'# ' || source || E'\n## Part ' || doc_id || E'\n### Sub\n\\n `x` [a](#nowhere) [b](img.png) $(]$\n```json\n{"body_text": "B"}\n```\n|a|b|\n|---|---|\n|1|2|\n\n\n\n\nend'"""
_AFTER = r"""E'# ' || source || E'\n## Part ' || doc_id || E'\n### Sub\n\n `x` [a](#nowhere) [b](img.png) $(]$\nB\n| a   | b   |\n| --- | --- |\n| 1   | 2   |\n\n\nend'"""


@query("clean_report", f"""SELECT doc_id AS pdf, '| ' || substring(CAST(doc_id AS VARCHAR), 1, 30) || ' | ' || len({_BEFORE}) || ' | ' || len({_AFTER}) || ' | json: 1, newline marks: 1, blank lines: 1, tables: 1 |' AS line FROM documents""")
def clean_report(spark, sf_dir):
    return clean.clean_report(clean.cleaned(_damaged(spark, sf_dir), details=True))


@query("cleaned_damage", f"SELECT doc_id AS pdf, {_AFTER} AS markdown FROM documents")
def cleaned_damage(spark, sf_dir):
    return clean.cleaned(_damaged(spark, sf_dir)).select("pdf", "markdown")
