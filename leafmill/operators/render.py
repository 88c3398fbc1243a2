"""Markdown rendering of page records, and splitting it into pages again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.functions import text as T


def table_markdown(headers: list[str], rows: Column) -> Column:
    """A Markdown table of an array of string arrays."""
    head = "| " + " | ".join(headers) + " |\n|" + "---|" * len(headers)
    lines = F.transform(rows, lambda r: F.concat(F.lit("| "), F.array_join(r, " | "), F.lit(" |")))
    return F.concat(F.lit(head + "\n"), F.array_join(lines, "\n"), F.lit("\n"))


def page_section(page: Column, body: Column, tables: Column, formulas: Column, figures: Column, notes: Column) -> Column:
    """Section of one page: body, tables (title, markdown), formulas, figures (ref, title, description), footnotes."""
    optional = lambda size, text: F.when(F.size(size) > 0, text).otherwise("")
    shown_tables = F.array_join(F.transform(tables, lambda t: F.concat(F.lit("### "), t["title"], F.lit("\n\n"), t["markdown"], F.lit("\n"))), "")
    shown_formulas = F.concat(F.lit("**Formulas**\n\n"), F.array_join(F.transform(formulas, lambda f: F.concat(F.lit("$$"), f, F.lit("$$\n"))), ""), F.lit("\n"))
    shown_figures = F.array_join(F.transform(figures, lambda f: F.concat(F.lit("### "), f["ref"], F.lit(": "), F.coalesce(f["title"], F.lit("Untitled")), F.lit("\n\n"), f["description"], F.lit("\n\n"))), "")
    shown_notes = F.concat(F.lit("---\n"), F.array_join(F.transform(notes, lambda n, i: F.concat(F.lit("[^"), (i + 1).cast("string"), F.lit("]: "), n, F.lit("\n"))), ""))
    head = F.concat(F.lit("## Page "), page.cast("string"), F.lit("\n\n"))
    return F.concat(head, F.when(F.length(T.strip(body)) > 0, F.concat(body, F.lit("\n\n"))).otherwise(""), optional(tables, shown_tables), optional(formulas, shown_formulas), optional(figures, shown_figures), optional(notes, shown_notes))


def document_markdown(sections: DataFrame, key: str, page: str, section: str, made: str, model: str | None = None, counts: dict[str, str] | None = None) -> DataFrame:
    """One row for each document: title, date, model, totals, then the sections in page order.

    ``made`` is the date text; ``counts`` names columns of whole numbers that are summed, each with
    the word it is shown under.
    """
    counts = counts or {}
    ordered = F.array_sort(F.collect_list(F.struct(F.col(page).alias("p"), F.col(section).alias("s"))))
    body = F.array_join(F.transform(ordered, lambda x: x["s"]), "\n")
    head = F.concat(F.lit("# "), F.col("pdf"), F.lit(f"\n\nConverted: {made}" + (f"\n\nModel: {model}" if model else "") + "\n\nPages: "), F.col("n").cast("string"), *[part for c, word in counts.items() for part in (F.lit(f", {word}: "), F.col(f"_{c}").cast("string"))], F.lit("\n\n---\n\n"))
    return sections.groupBy(F.col(key).cast("string").alias("pdf")).agg(F.count(F.lit(1)).alias("n"), body.alias("body"), *[F.coalesce(F.sum(c), F.lit(0)).alias(f"_{c}") for c in counts]).select("pdf", F.concat(head, "body").alias("markdown"))


def split_pages(documents: DataFrame, key: str = "pdf", markdown: str = "markdown") -> DataFrame:
    """Pages of documents: their number in the marker, their ordinal and text; blank pages are left out."""
    marks = F.regexp_extract_all(F.col(markdown), F.lit(r"(?m)^## Page (\d+)"), F.lit(1))
    parts = F.slice(F.split(F.col(markdown), r"(?m)^## Page \d+", -1), 2, F.greatest(F.size(marks), F.lit(1)))
    rows = documents.select(key, F.posexplode(F.arrays_zip(marks.alias("mark"), parts.alias("part"))).alias("i", "x"))
    pages = rows.select(key, F.col("x.mark").cast("int").alias("page_num"), F.col("i"), T.strip(F.col("x.part")).alias("text")).where(F.length("text") > 0)
    return pages.select(key, "page_num", (F.col("i") + 1).alias("ordinal"), "text")
