"""Model answers as typed records."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from leafmill.functions import text as T
from leafmill.operators.reports import completeness, confidence_score

#: Parts whose shape is the model's own (series, points, axes, statistics, design) stay JSON texts.
ANSWER = (
    "page_number int, has_figures boolean, body_text string, formulas array<string>, footnotes array<string>, "
    "tables array<struct<table_number:string,caption:string,markdown:string>>, "
    "figures array<struct<figure_number:string,caption:string,chart_title:string,image_type:string,chart_type:string,description:string,content_description:string,visual_description:string,key_insight:string,"
    "extraction_confidence:string,has_quantitative_data:boolean,has_data:boolean,trend:string,key_elements:array<string>,text_labels:array<string>,uncertainties:array<string>,data_points:array<string>,data_series:array<string>,"
    "axes:string,statistics:string,statistical_info:string,visual_design:string>>"
)
# What stands for parts that an answer leaves out, and the longest summary and fallback body.
NO_AXES = '{"x_axis":{"label":"N/A","unit":"N/A","range":"N/A"},"y_axis":{"label":"N/A","unit":"N/A","range":"N/A"}}'
NO_STATISTICS = '{"sample_size":"N/A","statistical_tests":[],"confidence_intervals":[],"p_values":[],"notes":"No statistical data extracted"}'
NO_DESIGN = '{"color_scheme":[],"legend_present":false,"grid_lines":"N/A","annotations":[]}'
SUMMARY, FALLBACK = 200, 500
# Fixed value: the kind of a chart that has none.
UNKNOWN = "unknown"

_escape = re.compile(r'\\(?:(["\\/])|([bfnrt])(?![A-Za-z])|(u[0-9a-fA-F]{4})|\Z)|\\')
_fence = re.compile(r"```json\s*(.*?)\s*```", re.S)
_read = StructType([StructField("json", StringType()), StructField("parsed", BooleanType())])


def repaired(text: str) -> str:
    """JSON with backslashes doubled that begin no valid escape, as in LaTeX commands."""
    return _escape.sub(lambda m: m[0] if m.lastindex or m.end() == len(text) else "\\\\", text)


def answer_text(raw: Column) -> Column:
    """The text of an answer that is a string, an object with ``text``, or a list of either."""
    value = F.try_parse_json(raw)
    return F.coalesce(F.try_variant_get(value, "$[0].text", "string"), F.try_variant_get(value, "$.text", "string"), F.try_variant_get(value, "$[0]", "string"), raw)


def record(raw: str | None) -> tuple[str, bool]:
    """(a JSON object, whether it is the answer's own).

    What stands in the first fence, else the whole answer, is parsed as it is, and with repaired
    escapes where that fails.  Anything but an object is unparsed: a record is made whose body is
    the beginning of the answer as it was given.
    """
    fenced = _fence.search(raw or "")
    text = fenced[1] if fenced else raw or ""
    for attempt in (text, repaired(text)):
        try:
            if isinstance(json.loads(attempt), dict):
                return attempt, True
        except ValueError:
            continue
    return json.dumps({"body_text": (raw or "")[:FALLBACK], "tables": [], "figures": [], "formulas": [], "footnotes": []}, ensure_ascii=False), False


@pandas_udf(_read)
def _records(raw: pd.Series) -> pd.DataFrame:
    return pd.DataFrame(raw.map(record).tolist(), columns=["json", "parsed"])


def answers(frame: DataFrame, raw: str = "raw") -> DataFrame:
    """``frame`` with ``answer`` (a struct) and ``parsed``; each answer is read once, in one Arrow pass."""
    rows = frame.withColumn("_read", _records(raw))
    return rows.withColumns({"parsed": F.col("_read.parsed"), "answer": F.from_json(F.col("_read.json"), ANSWER)}).drop("_read")


def figure_metadata(frame: DataFrame, keys: list[str], page: str | None = None) -> DataFrame:
    """One row for each figure of an answer, in six groups of columns, defaults filled in.

    Names that prompts use for the same thing are taken in turn.  ``page`` names the page column;
    the page number of the answer is taken without it.
    """
    number = F.col(page).cast("int") if page else F.col("answer.page_number")
    # the outer form: Spark would else test the size of the array below the Arrow pass, and read each answer twice
    rows = frame.select(*keys, number.alias("_page"), F.posexplode_outer("answer.figures").alias("i", "f")).where("i IS NOT NULL")
    f = lambda n: F.col(f"f.{n}")
    none = F.array().cast("array<string>")
    items = lambda n: F.coalesce(f(n), none)
    yes = lambda c: F.when(c, "yes").otherwise("no")
    ordinal = F.col("i") + 1
    level = F.coalesce(f("extraction_confidence"), F.lit("medium"))
    points, series = items("data_points"), items("data_series")
    main = F.to_json(F.struct(F.lit("Main Data").alias("series_name"), F.transform(points, lambda p: F.coalesce(F.try_parse_json(p), p.cast("variant"))).alias("data_points"), F.coalesce(f("trend"), F.lit(T.MISSING)).alias("trend")))
    has_points = F.size(points) > 0
    quantitative = F.coalesce(f("has_quantitative_data"), F.lit(False)) | F.coalesce(f("has_data"), F.lit(False)) | (F.size(series) > 0) | has_points
    label = F.coalesce(f("figure_number"), F.concat(F.lit("Figure "), ordinal.cast("string")))
    description = F.coalesce(f("content_description"), f("description"), f("visual_description"), F.lit(""))
    summary = F.coalesce(F.nullif(f("content_description"), F.lit("")), F.nullif(f("description"), F.lit("")), f("visual_description"), F.lit(""))
    return rows.select(
        *keys,
        # what it is
        ordinal.alias("ordinal"),
        label.alias("figure_number"),
        label.alias("reference"),
        F.coalesce(f("chart_title"), f("caption"), F.lit("Untitled")).alias("chart_title"),
        F.coalesce(f("image_type"), F.lit("figure")).alias("image_type"),
        F.coalesce(f("chart_type"), F.lit(UNKNOWN)).alias("chart_type"),
        F.col("_page").alias("page_number"),
        T.page_image(F.col("_page")).alias("image_path"),
        # what it shows
        description.alias("description"),
        F.substring(summary, 1, SUMMARY).alias("summary"),
        F.coalesce(f("key_insight"), F.lit("")).alias("key_insight"),
        items("key_elements").alias("key_elements"),
        items("text_labels").alias("text_labels"),
        # its data
        F.coalesce(f("axes"), F.lit(NO_AXES)).alias("axes"),
        F.when(F.size(series) > 0, series).when(has_points, F.array(main)).otherwise(none).alias("data_series"),
        quantitative.alias("has_quantitative_data"),
        # statistics and design
        F.coalesce(f("statistics"), f("statistical_info"), F.lit(NO_STATISTICS)).alias("statistics"),
        F.coalesce(f("visual_design"), F.lit(NO_DESIGN)).alias("visual_design"),
        # how far it can be trusted
        level.alias("confidence"),
        confidence_score(level).alias("confidence_score"),
        completeness(level).alias("complete"),
        yes(quantitative).alias("values_extracted"),
        items("uncertainties").alias("uncertainties"),
        F.size(points).alias("points_visible"),
        yes(F.length(F.coalesce(f("figure_number"), F.lit(""))) > 0).alias("number_found"),
        yes(F.length(F.coalesce(f("image_type"), F.lit(""))) > 0).alias("type_found"),
        yes(f("axes").isNotNull()).alias("axes_labelled"),
        yes(has_points | (F.size(series) > 0)).alias("points_extracted"),
        yes(level != "high").alias("needs_a_look"),
    )


def series_values(figures: DataFrame, keys: list[str], series: str = "data_series") -> DataFrame:
    """One row for each value of series in row form: row, name (``x`` or a column), value as text."""
    rows = figures.select(*keys, F.posexplode(series).alias("r", "one"))
    cells = rows.select(*keys, (F.col("r") + 1).alias("row"), F.explode(F.from_json("one", "map<string,string>")).alias("name", "value"))
    return cells.where(~F.col("name").isin("series_name", "data_points", "trend"))


def fillable(image_type: Column, has_series: Column, force: bool = False) -> Column:
    """Whether metadata is a table whose series may be filled."""
    return image_type.isin("data_table", "table") & (F.lit(force) | ~has_series)


def first_titles(figures: DataFrame, keys: list[str]) -> DataFrame:
    """Title of the first figure with each number."""
    return figures.groupBy(*keys, "figure_number").agg(F.min_by("chart_title", "ordinal").alias("title"))
