"""Markdown tables as rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.functions import text as T

# The sign of a heading of a table, and the word it begins with.
HEADING, WORD = "###", "Table"


def _named_runs(pages: DataFrame, keys: list[str], text: str, is_row: Callable[[Column], Column]) -> DataFrame:
    """keys, ordinal, heading and lines of each run of rows that stands below a table's heading.

    Lines are told apart one by one: headings, empty lines, rows, others.  A heading, maybe some
    empty lines, and then rows up to the first line that is none make a table.
    """
    split = pages.select(*keys, F.split(text, "\n").alias("lines"))
    heading = lambda line: F.ltrim(F.substring_index(line, HEADING, -1))
    kind = lambda line: F.when(line.contains(HEADING) & heading(line).startswith(WORD), "t").when(line == "", " ").when(is_row(line), "r").otherwise("o")
    told = split.withColumn("signs", F.transform("lines", kind)).withColumn("kinds", F.array_join("signs", ""))
    # from the array: to find a place in a string all of it is counted
    headings = F.filter(F.transform("signs", lambda sign, i: F.when(sign == "t", i + 1)), lambda i: i.isNotNull())

    def run(i: Column) -> Column:
        behind = F.substring("kinds", i + 1, F.length("kinds"))
        rows = F.ltrim(behind)
        begin = i + 1 + F.length(behind) - F.length(rows)
        return F.struct(heading(F.get("lines", i - 1)).alias("heading"), F.slice("lines", begin, F.length(rows) - F.length(F.ltrim(rows, F.lit("r")))).alias("lines"))

    found = told.select(*keys, F.posexplode(F.filter(F.transform(headings, run), lambda t: F.size(t["lines"]) > 0)).alias("i", "t"))
    return found.select(*keys, (F.col("i") + 1).alias("ordinal"), F.col("t.heading").alias("heading"), F.col("t.lines").alias("lines"))


def glued_headers(text: Column) -> Column:
    """Markdown with the header that stands on a table's title line moved to a line of its own."""
    return F.regexp_replace(text, r"(?m)^(###\s*Table[^\n|]*?)[ \t]*(\|[^\n]*\|)[ \t]*\n(?=\|)", "$1\n\n$2\n")


def tables(pages: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """One row for each table under a ``### Table`` title: ordinal, title, headers, rows, row_count."""
    found = _named_runs(pages, keys, text, lambda line: line.startswith("|"))
    rows = found.select(*keys, "ordinal", T.strip(F.col("heading")).alias("title"), "lines")
    separated = F.get("lines", F.lit(1)).rlike(r"^\|[\s\-:|]+\|")
    first = F.when(separated, 3).otherwise(2)
    data = F.filter(F.transform(F.slice("lines", first, F.greatest(F.size("lines"), F.lit(1))), T.cells), lambda c: F.size(c) > 1)
    shaped = rows.select(*keys, "ordinal", "title", T.cells(F.get("lines", F.lit(0))).alias("headers"), data.alias("rows"))
    return shaped.withColumn("row_count", F.size("rows"))


def titled_tables(pages: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """Tables as the check of metadata reads them: ordinal, figure_number (before the first colon), title, headers, row_count.

    Rows begin and end with a bar; empty cells are dropped, and rows that have no other.
    """
    found = _named_runs(pages, keys, text, lambda line: line.startswith("|") & line.endswith("|") & (F.length(line) > 2))
    full = lambda line: F.filter(F.transform(F.split(line, r"\|"), T.strip), lambda c: F.length(c) > 0)
    number = F.substring_index("heading", ":", 1)
    title = F.substring(F.col("heading"), F.length(number) + 2, F.length("heading"))
    rows = found.where(F.size("lines") >= 2).select(*keys, "ordinal", T.strip(number).alias("figure_number"), T.strip(title).alias("title"), "lines")
    data = F.filter(F.transform(F.slice("lines", F.lit(3), F.greatest(F.size("lines"), F.lit(1))), full), lambda c: F.size(c) > 0)
    shown = rows.withColumn("title", F.when(F.col("title") == "", F.col("figure_number")).otherwise(F.col("title")))
    return shown.select(*keys, "ordinal", "figure_number", "title", full(F.get("lines", F.lit(0))).alias("headers"), F.size(data).alias("row_count"))


def table_cells(found: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each cell of ``tables``: row, col, header (``x`` for the first column), raw, num, kind."""
    rows = found.select(*keys, "ordinal", "headers", F.posexplode("rows").alias("r", "cells"))
    cells = rows.select(*keys, "ordinal", "headers", (F.col("r") + 1).alias("row"), F.posexplode("cells").alias("c", "raw"))
    header = F.when(F.col("c") == 0, "x").otherwise(F.coalesce(F.get("headers", F.col("c")), F.concat(F.lit("col_"), F.col("c").cast("string"))))
    return cells.select(*keys, "ordinal", "row", (F.col("c") + 1).alias("col"), header.alias("header"), "raw", T.number(F.col("raw")).alias("num"), T.number_kind(F.col("raw")).alias("kind"))


def column_widths(found: DataFrame, keys: list[str]) -> DataFrame:
    """Widest cell of each column, headers included, 3 at least."""
    every = found.select(*keys, "ordinal", F.explode(F.concat(F.array("headers"), "rows")).alias("cells"))
    cells = every.select(*keys, "ordinal", F.posexplode("cells").alias("c", "raw"))
    return cells.groupBy(*keys, "ordinal", (F.col("c") + 1).alias("col")).agg(F.greatest(F.max(F.length("raw")), F.lit(3)).alias("width"))


def preview(series: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """A Markdown table of rows (x and further columns, sorted) for each key; whole numbers without a point."""
    shown = lambda c: F.when(F.col(c).isNull(), "").when(F.col(c) == F.floor(c), F.floor(c).cast("string")).otherwise(F.col(c).cast("string"))
    line = F.concat(F.lit("| "), F.concat_ws(" | ", F.col("x"), *[shown(c) for c in sorted(columns)]), F.lit(" |"))
    head = "| x | " + " | ".join(sorted(columns)) + " |\n|" + "---|" * (len(columns) + 1)
    rows = series.select(*keys, F.struct("row", line.alias("line")).alias("l"))
    return rows.groupBy(*keys).agg(F.concat(F.lit(head + "\n"), F.array_join(F.transform(F.array_sort(F.collect_list("l")), lambda x: x["line"]), "\n")).alias("markdown"))


def series_rows(series: Column) -> Column:
    """Rows in an array of structs with ``data_points``: the points' sum if the first has any, else the array's length."""
    points = F.aggregate(F.transform(series, lambda s: F.coalesce(F.size(s["data_points"]), F.lit(0))), F.lit(0), lambda a, b: a + b)
    return F.when(F.get(series, F.lit(0))["data_points"].isNotNull(), points).otherwise(F.size(series))


def series_columns(rows: Column) -> Column:
    """Column names of an array of maps: ``x`` first, the rest sorted."""
    names = F.array_distinct(F.flatten(F.transform(rows, lambda r: F.map_keys(r))))
    return F.concat(F.array(F.lit("x")), F.array_sort(F.filter(names, lambda n: n != "x")))
