"""Matching of metadata with tables, of names with names, and the updates that follow."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

from leafmill.functions import text as T
from leafmill.operators.prefixes import prefix_matches
from leafmill.sources.shared import stage

#: Bytes of filled texts that a task gives out in the mean, and bytes of the files that share a copy of their text.
TASK_BYTES, COPY_BYTES = 8 << 20, 16 << 20


@pandas_udf(DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp ratio of lower-cased strings; not symmetric."""
    return pd.Series([SequenceMatcher(None, (x or "").lower(), (y or "").lower()).ratio() for x, y in zip(a, b)], dtype=float)


def table_scores(charts: DataFrame, tables: DataFrame) -> DataFrame:
    """Pairs of charts (chart, page_num, title, elements, figure_number) and tables (table, page_num,
    table_title, headers) on pages at most one apart, with a score."""
    near = charts.withColumn("at", F.explode(F.array(F.col("page_num") - 1, F.col("page_num"), F.col("page_num") + 1)))
    return _scored(near.join(tables.withColumnRenamed("page_num", "at"), ["pdf", "at"]))


def _scored(pairs: DataFrame) -> DataFrame:
    contents = T.jaccard(T.keywords(F.array_join("headers", " ")), T.keywords(F.array_join("elements", " ")))
    titles = T.jaccard(T.keywords(F.col("title")), T.keywords(F.col("table_title")))
    titled = F.length(F.coalesce("title", F.lit(""))) > 0
    pairs = pairs.withColumns({"by_words": titles, "by_content": contents, "by_text": similarity("title", "table_title")})
    numbered = F.when(F.instr(F.lower("table_title"), F.lower("figure_number")) > 0, 1.0).otherwise(0.0)
    full = 0.4 * F.col("by_text") + 0.3 * F.col("by_words") + 0.3 * F.col("by_content")
    return pairs.withColumns({"score": F.when(titled, full).otherwise(0.6 * F.col("by_content") + 0.4 * numbered), "limit": F.when(titled, 0.2).otherwise(0.15)})


def best_tables(scored: DataFrame) -> DataFrame:
    """The best table of each chart if it reaches its limit or is the only candidate."""
    by_chart = Window.partitionBy("pdf", "chart")
    ranked = scored.withColumns({"place": F.row_number().over(by_chart.orderBy(F.desc("score"), "at", "table")), "candidates": F.count(F.lit(1)).over(by_chart)})
    return ranked.where((F.col("place") == 1) & ((F.col("score") >= F.col("limit")) | (F.col("candidates") == 1)))


def whole_document_candidates(charts: DataFrame, tables: DataFrame, scored: DataFrame) -> DataFrame:
    """Pairs of charts that found no table near their page with all tables of their document, to be scored."""
    return charts.join(scored.select("pdf", "chart").distinct(), ["pdf", "chart"], "left_anti").join(tables.withColumnRenamed("page_num", "at"), "pdf")


def matched_tables(charts: DataFrame, tables: DataFrame) -> DataFrame:
    """The best table of each chart: on its page or a page beside it, else anywhere in the document."""
    near = table_scores(charts, tables)
    far = _scored(whole_document_candidates(charts, tables, near))
    return best_tables(near).unionByName(best_tables(far))


def _status(force: bool, usable: Column) -> Column:
    from leafmill.operators.parse import fillable

    wanted = fillable(F.coalesce("image_type", F.lit("")), F.col("has_series"), force)
    return F.when(F.col("json").isNull(), "failed").when(~wanted, "skipped").when(usable, "filled").otherwise("failed")


def fill_status(metadata: DataFrame, found: DataFrame, force: bool = False) -> DataFrame:
    """Metadata files (name, json, image_type, has_series) with ``status``: filled, skipped or failed, and ``filled`` (JSON; else null).

    ``found`` (name, series: JSON rows of the matching table) has at most one row for each file.
    Unreadable metadata (null) fails, metadata of anything but tables and tables that have a
    series already are skipped unless ``force``, and a table without a match or rows fails.
    """
    from leafmill.sources.files import with_series

    rows = metadata.join(found, "name", "left").withColumn("status", _status(force, F.col("series").isNotNull() & (F.col("series") != "[]")))
    return rows.withColumn("filled", F.when(F.col("status") == "filled", with_series("json", F.coalesce("series", F.lit("[]"))))).drop("series")


def fill_statuses(metadata: DataFrame, found: DataFrame, series: DataFrame, force: bool = False) -> DataFrame:
    """``fill_from_tables`` without the texts: metadata with ``table``, ``status`` and the ``size`` of the table's rows."""
    usable = series.where(F.col("series") != "[]").select("table", F.octet_length("series").cast("long").alias("size"))
    rows = metadata.join(found, "name", "left").join(usable, "table", "left")
    return rows.withColumn("status", _status(force, F.col("size").isNotNull()))


def fill_from_tables(metadata: DataFrame, found: DataFrame, series: DataFrame, force: bool = False) -> DataFrame:
    """``fill_status`` where many files share a table: ``found`` (name, table), ``series`` (table, series), a row for each.

    A table's rows are read and written once for each text they go into, not for each file, and
    only the last join, which shuffles none of its output, has a copy for each file.  That join is
    dealt by the bytes it gives out: a copy of a text goes to files of about ``COPY_BYTES`` in all,
    and there is a task for each ``TASK_BYTES``, since what writes the rows may hold a task's texts
    at once.  Copies are made in two steps, so that no task makes and sorts all of a text's.
    """
    from leafmill.sources.files import with_series

    series = stage(series, "series")
    rows = stage(fill_statuses(metadata, found, series, force), "fills")
    n = F.count(F.lit(1))
    asked = rows.where("status = 'filled'").groupBy("json", "table").agg(n.alias("files"), (n * (F.max("size") + F.octet_length("json"))).alias("bytes"))
    split = asked.withColumn("parts", F.least("files", F.ceil(F.col("bytes") / COPY_BYTES)))
    parts = split.withColumns({"groups": F.ceil(F.sqrt("parts")), "copied": F.ceil(F.col("parts") * F.col("bytes") / F.col("files"))})
    total = parts.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("files", "bytes", "groups", "copied")]).first()
    cores = rows.sparkSession.sparkContext.defaultParallelism
    tasks, groups = max(cores, min(total.files, -(-total.bytes // TASK_BYTES))), max(cores, min(total.groups, -(-total.copied // COPY_BYTES)))
    made = parts.join(series.hint("merge"), "table").select("json", "table", "parts", "groups", with_series("json", "series").alias("filled"))
    grouped = made.withColumn("_group", F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1))).repartition(groups, "json", "table", "_group")
    dealt = grouped.withColumn("_part", F.explode(F.sequence("_group", F.col("parts") - 1, "groups"))).select("json", "table", "_part", "filled")
    # a file without a text asks for a part below zero, which no text has
    part = F.when(F.col("status") == "filled", F.pmod(F.xxhash64("name"), F.col("parts"))).otherwise(-1 - F.pmod(F.xxhash64("name"), F.lit(tasks)))
    keys = ["json", "table", "_part"]
    files = rows.join(parts.select("json", "table", "parts"), ["json", "table"], "left").withColumn("_part", part).drop("parts", "size")
    return files.repartition(tasks, *keys).join(dealt.repartition(tasks, *keys).hint("merge"), keys, "left").drop("_part", "table")


def by_prefix(deliveries: DataFrame, chunks: DataFrame) -> DataFrame:
    """Pairs of deliveries (base) and chunks (chunk) whose normal name begins with the base's."""
    asked = deliveries.withColumn("head", T.normal_name(F.col("base")))
    found = prefix_matches(asked.select("head"), chunks.withColumn("name", T.normal_name(F.col("chunk"))))
    return asked.join(found, "head").drop("head", "name")


def by_short_name(chunks: DataFrame, deliveries: DataFrame) -> DataFrame:
    """The delivery of each chunk: mutual prefix of 20 characters first, else equal first 15; the first by name.

    Only the first delivery of each key is joined, so no pairs beyond one a chunk and key are made.
    Both sides grow alike, so neither is broadcast, whatever their files' sizes promise.
    """
    c = chunks.withColumn("c", T.alnum_name(F.col("chunk")))
    d = deliveries.withColumn("d", T.alnum_name(F.col("delivery")))
    begins = lambda name: F.explode(F.transform(F.sequence(F.lit(1), F.least(F.length(name), F.lit(20))), lambda n: F.col(name).substr(F.lit(1), n)))

    def met(c: DataFrame, c_key: Column, d: DataFrame, d_key: Column, tier: int) -> DataFrame:
        first = d.select(d_key.alias("k"), "delivery").where(F.length("k") > 0).groupBy("k").agg(F.min("delivery").alias("delivery"))
        return c.select(c_key.alias("k"), "chunk").where(F.length("k") > 0).join(first.hint("merge"), "k").select("chunk", "delivery", F.lit(tier).alias("tier"))

    every = met(c, F.substring("c", 1, 20), d, F.substring("d", 1, 20), 1)
    # one name shorter than 20 characters is a prefix of the other
    every = every.unionByName(met(c.where(F.length("c") < 20), F.col("c"), d, begins("d"), 1))
    every = every.unionByName(met(c, begins("c"), d.where(F.length("d") < 20), F.col("d"), 1))
    every = every.unionByName(met(c, F.substring("c", 1, 15), d, F.substring("d", 1, 15), 2))
    found = every.groupBy("chunk").agg(F.min(F.struct("tier", "delivery")).alias("m"))
    return found.select("chunk", "m.delivery", "m.tier")


def synced(figures: DataFrame, updates: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Figures with the series of their first update; ``updated`` says whether there is one."""
    first = updates.groupBy(*keys).agg(F.min_by("series", order).alias("new"))
    rows = figures.join(first, keys, "left")
    return rows.withColumns({"series": F.coalesce("new", "series"), "updated": F.col("new").isNotNull()}).drop("new")


def merged_figures(old: DataFrame, new: DataFrame, offset: Column) -> DataFrame:
    """Old figures whose (figure, page + offset) has a non-empty new series; the last of equal keys wins."""
    shifted = new.withColumn("page_num", F.col("page_num") + offset).where(F.length(F.coalesce("series", F.lit(""))) > 0)
    last = shifted.groupBy("figure", "page_num").agg(F.max_by("series", "position").alias("new"))
    return old.join(last, ["figure", "page_num"], "left").withColumns({"series": F.coalesce("new", "series"), "updated": F.col("new").isNotNull()}).drop("new")


def verify_tables(metadata: DataFrame, tables: DataFrame, keys: list[str]) -> DataFrame:
    """Status of each metadata row (keys, file, figure_number, page_num, rows) against the Markdown tables near its page.

    ``tables`` has keys, page_num, ordinal, figure_number, row_count.  The first table on the pages
    p - 1, p, p + 1 is compared, or the first whose number contains the metadata's.
    """
    near = metadata.withColumn("at", F.explode(F.array(F.col("page_num") - 1, F.col("page_num"), F.col("page_num") + 1)))
    found = tables.select(*keys, F.col("page_num").alias("at"), "ordinal", F.col("figure_number").alias("number"), "row_count")
    wanted = F.lower(F.coalesce("figure_number", F.lit("")))
    other = ~((F.length(wanted) > 0) & (F.instr(F.lower("number"), wanted) > 0))
    pairs = near.join(found, [*keys, "at"]).groupBy(*keys, "file").agg(F.min(F.struct(other.alias("other"), "at", "ordinal", "row_count")).alias("m"))
    rows = metadata.join(pairs.select(*keys, "file", F.col("m.row_count").alias("table_rows"), F.col("m.at").alias("table_page")), [*keys, "file"], "left")
    return rows.withColumn("status", verify_status(F.col("rows"), F.col("table_rows")))


def in_chunks(metadata: DataFrame, documents: DataFrame) -> DataFrame:
    """Metadata files (chunk, file) of chunks that have a Markdown text of their own name."""
    return metadata.join(documents.select("chunk", "markdown"), "chunk")


def verify_status(metadata_rows: Column, table_rows: Column) -> Column:
    """PASS, PARTIAL, EMPTY or FAIL for row counts of metadata (null: unreadable) and Markdown (null: no table)."""
    return F.when(metadata_rows.isNull(), "FAIL").when(metadata_rows == 0, "EMPTY").when(metadata_rows == table_rows, "PASS").otherwise("PARTIAL")


def change_counts(rows: DataFrame, kind: str) -> DataFrame:
    """One row: how many figures were looked at, changed and left by a fill, sync or update (``updated``)."""
    return rows.agg(F.lit(kind).alias("kind"), F.count(F.lit(1)).alias("seen"), F.count_if("updated").alias("changed"), F.count_if(~F.col("updated")).alias("left"))


def status_summary(rows: DataFrame) -> DataFrame:
    is_ = lambda s: F.count_if(F.col("status") == s)
    counted = rows.agg(F.count(F.lit(1)).alias("total"), is_("PASS").alias("passed"), is_("PARTIAL").alias("partial"), is_("EMPTY").alias("empty"), is_("FAIL").alias("failed"))
    return counted.withColumn("pass_rate", (F.col("passed") + F.col("partial")) * 100.0 / F.greatest("total", F.lit(1)))
