"""Queries on model answers, made from the tables and damaged on purpose."""

from __future__ import annotations

from pyspark.sql import functions as F

from leafmill.catalog import query
from leafmill.functions import text as T
from leafmill.operators import parse
from leafmill.sources import providers
from leafmill.sources.tables import table


def _raw(spark, sf_dir):
    """Answers with and without fence, whole, with LaTeX escapes, cut off, and as a list."""
    p = table(spark, sf_dir, "part")
    size = F.col("p_size")
    series = F.when(size % 4 == 0, F.array(F.struct(F.lit("a").alias("x"), F.lit(1.5).alias("Total"), F.col("p_brand").alias("Brand"))))
    points = F.when(size % 6 == 1, F.array(F.lit(3), size))
    axes = F.when(size % 5 == 2, F.struct(F.lit("year").alias("x_axis")))
    figure = F.struct(F.when(size % 2 == 0, F.concat(F.lit("Figure "), size.cast("string"))).alias("figure_number"), F.when(size % 3 == 0, F.col("p_name")).alias("caption"), F.when(size % 5 == 0, "high").when(size % 5 == 1, "low").alias("extraction_confidence"), series.alias("data_series"), points.alias("data_points"), axes.alias("axes"), F.when(size % 3 == 1, F.array("p_brand", F.lit("b"))).alias("key_elements"), F.col("p_type").alias("visual_description"))
    body = F.to_json(F.struct(size.alias("page_number"), F.col("p_brand").alias("body_text"), F.array(figure, figure).alias("figures"), F.array(F.lit("MARK")).alias("formulas")))
    damaged = F.when(size % 7 == 0, F.replace(body, F.lit("MARK"), F.lit("\\alpha"))).when(size % 7 == 1, F.substring(body, 1, 40)).when(size % 7 == 2, F.concat(F.lit('["\\alpha", '), size.cast("string"), F.lit("]"))).otherwise(body)
    raw = F.when(size % 2 == 0, F.concat(F.lit("Here it is:\n```json\n"), damaged, F.lit("\n```\n"))).otherwise(damaged)
    return p.select("p_partkey", "p_size", raw.alias("raw"))


@query("parse_model_json", """SELECT p_partkey, NOT bad AS parsed, CASE WHEN NOT bad THEN p_size ELSE -1 END AS page_number, CASE WHEN NOT bad THEN p_brand WHEN p_size % 2 = 0 THEN 'Here it is:' || chr(10) || '```json' || chr(10) || damaged || chr(10) || '```' || chr(10) ELSE damaged END AS body_text,
 CASE WHEN bad THEN NULL WHEN p_size % 7 = 0 THEN '\\alpha' ELSE 'MARK' END AS formula FROM (SELECT *, p_size % 7 IN (1, 2) AS bad, CASE p_size % 7 WHEN 1 THEN substring('{"page_number":' || p_size || ',"body_text":"' || p_brand || '","figures"', 1, 40) ELSE '["\\alpha", ' || p_size || ']' END AS damaged FROM part)""")
def parse_model_json(spark, sf_dir):
    rows = parse.answers(_raw(spark, sf_dir))
    return rows.select("p_partkey", "parsed", F.coalesce("answer.page_number", F.lit(-1)).alias("page_number"), F.col("answer.body_text").alias("body_text"), F.get("answer.formulas", F.lit(0)).alias("formula"))


@query("parse_failures", "SELECT p_partkey, p_size % 7 AS why FROM part WHERE p_size % 7 IN (1, 2)")
def parse_failures(spark, sf_dir):
    return parse.answers(_raw(spark, sf_dir)).where("NOT parsed").select("p_partkey", (F.col("p_size") % 7).alias("why"))


_YES = "CASE WHEN {} THEN 'yes' ELSE 'no' END"
_FIGURES = f"""SELECT p_partkey, i AS ordinal, number AS figure_number, number AS reference, CASE WHEN p_size % 3 = 0 THEN p_name ELSE 'Untitled' END AS chart_title, 'figure' AS image_type, 'unknown' AS chart_type, p_size AS page_number, 'images/page_' || lpad(CAST(p_size AS VARCHAR), 3, '0') || '.png' AS image_path,
 p_type AS description, substring(p_type, 1, 200) AS summary, '' AS key_insight, CASE WHEN p_size % 3 = 1 THEN p_brand || '|b' ELSE '' END AS key_elements, '' AS text_labels, CASE WHEN p_size % 5 = 2 THEN '{{"x_axis":"year"}}' ELSE '{parse.NO_AXES}' END AS axes,
 CASE WHEN p_size % 4 = 0 THEN '{{"x":"a","Total":1.5,"Brand":"' || p_brand || '"}}' WHEN p_size % 6 = 1 THEN '{{"series_name":"Main Data","data_points":[3,' || p_size || '],"trend":"N/A"}}' ELSE '' END AS data_series, p_size % 4 = 0 OR p_size % 6 = 1 AS has_quantitative_data,
 '{parse.NO_STATISTICS}' AS statistics, '{parse.NO_DESIGN}' AS visual_design, CASE p_size % 5 WHEN 0 THEN 'high' WHEN 1 THEN 'low' ELSE 'medium' END AS confidence, CASE p_size % 5 WHEN 0 THEN 0.95 WHEN 1 THEN 0.4 ELSE 0.7 END::DOUBLE AS confidence_score, CASE p_size % 5 WHEN 0 THEN 'yes' WHEN 1 THEN 'no' ELSE 'partial' END AS complete,
 {_YES.format("p_size % 4 = 0 OR p_size % 6 = 1")} AS values_extracted, '' AS uncertainties, CASE WHEN p_size % 6 = 1 THEN 2 ELSE 0 END AS points_visible, {_YES.format("p_size % 2 = 0")} AS number_found, 'no' AS type_found, {_YES.format("p_size % 5 = 2")} AS axes_labelled, {_YES.format("p_size % 4 = 0 OR p_size % 6 = 1")} AS points_extracted, {_YES.format("p_size % 5 <> 0")} AS needs_a_look
 FROM (SELECT *, CASE WHEN p_size % 2 = 0 THEN 'Figure ' || p_size ELSE 'Figure ' || i END AS number FROM (SELECT *, unnest([1, 2]) AS i FROM part WHERE p_size % 7 NOT IN (1, 2)))"""


def _figures(spark, sf_dir):
    return parse.figure_metadata(parse.answers(_raw(spark, sf_dir)), ["p_partkey"])


@query("figure_metadata", _FIGURES)
def figure_metadata(spark, sf_dir):
    rows = _figures(spark, sf_dir)
    return rows.withColumns({c: F.array_join(c, "|") for c, t in rows.dtypes if t.startswith("array")})


@query("series_values", """SELECT p_partkey, ordinal, 1 AS "row", name, CASE name WHEN 'x' THEN 'a' WHEN 'Total' THEN '1.5' ELSE p_brand END AS value FROM (SELECT p_partkey, p_brand, unnest([1, 2]) AS ordinal FROM part WHERE p_size % 4 = 0 AND p_size % 7 NOT IN (1, 2)), (SELECT unnest(['x', 'Total', 'Brand']) AS name)""")
def series_values(spark, sf_dir):
    return parse.series_values(_figures(spark, sf_dir), ["p_partkey", "ordinal"])


@query("figure_titles", f"SELECT p_partkey, figure_number, arg_min(chart_title, ordinal) AS title FROM ({_FIGURES}) GROUP BY ALL")
def figure_titles(spark, sf_dir):
    return parse.first_titles(_figures(spark, sf_dir), ["p_partkey"])


@query("answer_text", """SELECT p_partkey, CASE p_size % 4 WHEN 3 THEN 'plain ' || p_name ELSE p_name END AS text FROM part""")
def answer_text(spark, sf_dir):
    name, k = F.col("p_name"), F.col("p_size") % 4
    shape = F.when(k == 0, F.to_json(F.array(F.struct(name.alias("text"))))).when(k == 1, F.to_json(F.struct(name.alias("text")))).when(k == 2, F.to_json(F.array(name))).otherwise(F.concat(F.lit("plain "), name))
    return table(spark, sf_dir, "part").select("p_partkey", parse.answer_text(shape).alias("text"))


@query("fillable_tables", "SELECT p_partkey FROM part WHERE (p_size % 3 = 0 AND p_partkey % 2 = 0)")
def fillable_tables(spark, sf_dir):
    kind = F.when(F.col("p_size") % 3 == 0, "data_table").otherwise("chart")
    return table(spark, sf_dir, "part").where(parse.fillable(kind, F.col("p_partkey") % 2 == 1)).select("p_partkey")


@query("page_model_stub", "SELECT conv_id AS pdf, turn + 1 AS page_num, 'ok' AS status, true AS parsed, text AS body_text FROM conversations")
def page_model_stub(spark, sf_dir):
    pages = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("pdf"), (F.col("turn") + 1).alias("page_num"), "text")
    asked = providers.ask(pages, providers.EchoModel(), concurrency=6, documents=4)
    return parse.answers(asked).select("pdf", "page_num", "status", "parsed", F.col("answer.body_text").alias("body_text"))


def _refused(pdf, page_num, text):
    """A model that refuses short pages."""
    if len(text or "") < 200:
        raise ValueError("DataInspectionFailed: inappropriate content")
    return f"read: {text}"


@query("recovery_provider", """SELECT conv_id AS pdf, turn + 1 AS page_num, len(text) >= 200 AS success, CASE WHEN len(text) >= 200 THEN 'read: ' || text END AS section, CASE WHEN len(text) < 200 THEN 'ValueError: DataInspectionFailed: inappropriate content' END AS error FROM conversations""")
def recovery_provider(spark, sf_dir):
    pages = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("pdf"), (F.col("turn") + 1).alias("page_num"), "text")
    return providers.recover(pages, _refused)


@query("image_text", "SELECT conv_id AS pdf, turn + 1 AS page_num, reverse(CAST(conv_id AS VARCHAR) || '-' || turn) AS text FROM conversations")
def image_text(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    image = F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).cast("binary")
    return providers.read_images(c.select(F.col("conv_id").alias("pdf"), (F.col("turn") + 1).alias("page_num"), image.alias("image")), lambda b: b.decode()[::-1])


@query("data_uris", "SELECT c_custkey, 'data:image/png;base64,' || base64(encode(repeat(c_name, 9))) AS uri, 'page_' || lpad(CAST(c_custkey AS VARCHAR), CAST(greatest(len(CAST(c_custkey AS VARCHAR)), 3) AS INTEGER), '0') || '.png' AS image FROM customer")
def data_uris(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", T.data_uri(F.repeat("c_name", 9).cast("binary")).alias("uri"), T.image_name(F.col("c_custkey")).alias("image"))
