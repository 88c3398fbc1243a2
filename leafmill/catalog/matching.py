"""Queries on tables and matching."""

from __future__ import annotations

from pyspark.sql import functions as F

from leafmill.catalog import query
from leafmill.functions import text as T
from leafmill.operators import match, render, similar, tables
from leafmill.sources.tables import table

# customers of a nation as a Markdown table on the nation's page
_KEYS = ["pdf", "page_num"]


def _pages(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    row = F.struct(F.col("c_custkey").alias("k"), F.array("c_name", F.concat(F.lit("$"), F.floor("c_acctbal").cast("string")), "c_mktsegment").alias("r"))
    rows = c.groupBy("c_nationkey").agg(F.transform(F.array_sort(F.collect_list(row)), lambda x: x["r"]).alias("rows"))
    md = F.concat(F.lit("intro\n\n### Table "), F.col("c_nationkey").cast("string"), F.lit(": customers\n\n"), render.table_markdown(["name", "balance", "segment"], F.col("rows")), F.lit("\nend"))
    return rows.select(F.lit("bank").alias("pdf"), F.col("c_nationkey").alias("page_num"), md.alias("text"))


def _tables(spark, sf_dir):
    return tables.tables(_pages(spark, sf_dir), _KEYS)


_PLACE = "row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey)"


@query("md_tables", "SELECT 'bank' AS pdf, c_nationkey AS page_num, 1 AS ordinal, 'Table ' || c_nationkey || ': customers' AS title, 'name,balance,segment' AS headers, CAST(count(*) AS INTEGER) AS row_count FROM customer GROUP BY c_nationkey")
def md_tables(spark, sf_dir):
    return _tables(spark, sf_dir).select(*_KEYS, "ordinal", "title", F.array_join("headers", ",").alias("headers"), "row_count")


@query("md_table_cells", f"""SELECT 'bank' AS pdf, c_nationkey AS page_num, 1 AS ordinal, CAST(p AS INTEGER) AS "row", c AS col, CASE c WHEN 1 THEN 'x' WHEN 2 THEN 'balance' ELSE 'segment' END AS header, CASE c WHEN 1 THEN c_name WHEN 2 THEN '$' || b ELSE c_mktsegment END AS raw,
 CASE WHEN c = 2 THEN CAST(b AS DOUBLE) END AS num, CASE WHEN c = 2 THEN 'int' ELSE 'text' END AS kind FROM (SELECT *, CAST(floor(c_acctbal) AS BIGINT) AS b, {_PLACE} AS p, unnest([1, 2, 3]) AS c FROM customer)""")
def md_table_cells(spark, sf_dir):
    return tables.table_cells(_tables(spark, sf_dir), _KEYS)


@query("column_widths", "SELECT 'bank' AS pdf, c_nationkey AS page_num, 1 AS ordinal, c AS col, CAST(max(CASE c WHEN 1 THEN greatest(len(c_name), 4) WHEN 2 THEN greatest(len('$' || CAST(floor(c_acctbal) AS BIGINT)), 7) ELSE greatest(len(c_mktsegment), 7) END) AS INTEGER) AS width FROM (SELECT *, unnest([1, 2, 3]) AS c FROM customer) GROUP BY c_nationkey, c")
def column_widths(spark, sf_dir):
    return tables.column_widths(_tables(spark, sf_dir), _KEYS)


_VALUE = "CASE p_partkey % 7 WHEN 0 THEN '' WHEN 1 THEN '$' || p_partkey || ',000' WHEN 2 THEN p_size || '%' WHEN 3 THEN p_size || '.5' WHEN 4 THEN 'n/a' WHEN 5 THEN '-' || p_size ELSE '1e' || p_size END"


@query("number_coercion", f"SELECT p_partkey, {_VALUE} AS raw, CASE p_partkey % 7 WHEN 1 THEN p_partkey * 1000.0 WHEN 2 THEN p_size WHEN 3 THEN p_size + 0.5 WHEN 5 THEN -p_size END::DOUBLE AS num, CASE p_partkey % 7 WHEN 1 THEN 'int' WHEN 2 THEN 'float' WHEN 3 THEN 'float' WHEN 5 THEN 'int' ELSE 'text' END AS kind FROM part")
def number_coercion(spark, sf_dir):
    size = F.col("p_size").cast("string")
    k = F.col("p_partkey") % 7
    raw = F.when(k == 0, "").when(k == 1, F.concat(F.lit("$"), F.col("p_partkey").cast("string"), F.lit(",000"))).when(k == 2, F.concat(size, F.lit("%"))).when(k == 3, F.concat(size, F.lit(".5"))).when(k == 4, "n/a").when(k == 5, F.concat(F.lit("-"), size)).otherwise(F.concat(F.lit("1e"), size))
    return table(spark, sf_dir, "part").select("p_partkey", raw.alias("raw")).select("p_partkey", "raw", T.number(F.col("raw")).alias("num"), T.number_kind(F.col("raw")).alias("kind"))


@query("table_preview", """SELECT n_regionkey, '| x | key | name_size |' || chr(10) || '|---|---|---|' || chr(10) || string_agg('| ' || n_name || ' | ' || n_nationkey || ' | ' || CASE WHEN len(n_name) % 2 = 0 THEN CAST(len(n_name) // 2 AS VARCHAR) ELSE CAST(len(n_name) / 2 AS VARCHAR) END || ' |', chr(10) ORDER BY n_nationkey) AS markdown
 FROM nation GROUP BY n_regionkey""")
def table_preview(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    rows = n.select("n_regionkey", F.col("n_nationkey").alias("row"), F.col("n_name").alias("x"), F.col("n_nationkey").cast("double").alias("key"), (F.length("n_name") / 2).alias("name_size"))
    return tables.preview(rows, ["n_regionkey"], ["key", "name_size"])


_WORDS = r"list_distinct(list_filter(regexp_split_to_array(lower(regexp_replace(text, '[^\p{L}\p{N}_\s]', ' ', 'g')), '\s+'), lambda w: len(w) > 2))"
_PAIRS = f"""SELECT item_id, doc_id, count(*) AS shared, count(*) / (any_value(nl) + any_value(nr) - count(*)) AS score FROM
 (SELECT item_id, len(w) AS nl, unnest(w) AS w FROM (SELECT item_id, {_WORDS} AS w FROM benchmark)) JOIN (SELECT doc_id, len(w) AS nr, unnest(w) AS w FROM (SELECT doc_id, {_WORDS} AS w FROM documents)) USING (w) GROUP BY item_id, doc_id"""


def _sides(spark, sf_dir):
    return table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"), "item_id", "doc_id", "text", "text"


@query("keyword_jaccard", _PAIRS)
def keyword_jaccard(spark, sf_dir):
    return similar.keyword_pairs(*_sides(spark, sf_dir))


@query("best_match_topk", f"SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS place FROM ({_PAIRS})) WHERE place <= 3")
def best_match_topk(spark, sf_dir):
    return similar.best_matches(*_sides(spark, sf_dir), 3)


@query("string_similarity")
def string_similarity(spark, sf_dir):
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select("n_name", "r_name", match.similarity("n_name", "r_name").alias("similarity"))


@query("fill_match", "SELECT s_suppkey AS chart, s_nationkey AS \"table\" FROM supplier")
def fill_match(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    charts = s.select(F.lit("bank").alias("pdf"), F.col("s_suppkey").alias("chart"), F.col("s_nationkey").alias("page_num"), F.lit("").alias("title"), F.array(F.lit("balance"), F.lit("segment")).alias("elements"), F.concat(F.lit("Table "), F.col("s_nationkey").cast("string"), F.lit(":")).alias("figure_number"))
    found = _tables(spark, sf_dir).select("pdf", "page_num", F.col("page_num").alias("table"), F.col("title").alias("table_title"), "headers")
    return match.best_tables(match.table_scores(charts, found)).select("chart", "table")


@query("fill_match_titled")
def fill_match_titled(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    charts = s.select(F.lit("bank").alias("pdf"), F.col("s_suppkey").alias("chart"), F.col("s_nationkey").alias("page_num"), F.concat(F.lit("Customers of table "), F.col("s_nationkey").cast("string")).alias("title"), F.array(F.lit("balance")).alias("elements"), F.lit("").alias("figure_number"))
    found = _tables(spark, sf_dir).select("pdf", "page_num", F.col("page_num").alias("table"), F.col("title").alias("table_title"), "headers")
    return match.best_tables(match.table_scores(charts, found)).select("chart", "table", T.rounded(F.col("score"), 6).alias("score"))


@query("prefix_join", "SELECT DISTINCT n.n_nationkey, p_partkey FROM (SELECT n_nationkey, 'part' || n_nationkey AS base FROM nation) n JOIN (SELECT p_partkey, 'Part ' || p_partkey || '_part1of2' AS chunk FROM part) p ON starts_with(lower(regexp_replace(regexp_replace(chunk, '_part\\d+of\\d+', '', 'g'), '[_ -]', '', 'g')), base)")
def prefix_join(spark, sf_dir):
    bases = table(spark, sf_dir, "nation").select("n_nationkey", F.concat(F.lit("part"), F.col("n_nationkey").cast("string")).alias("base"))
    chunks = table(spark, sf_dir, "part").select("p_partkey", F.concat(F.lit("Part "), F.col("p_partkey").cast("string"), F.lit("_part1of2")).alias("chunk"))
    return match.by_prefix(bases, chunks).select("n_nationkey", "p_partkey").distinct()


_AL = "lower(regexp_replace(regexp_replace({c}, '_part\\d+of\\d+$', ''), '[^a-zA-Z0-9]', '', 'g'))"


@query("delivery_match", f"""SELECT chunk, delivery, CAST(tier AS INTEGER) AS tier FROM (SELECT *, row_number() OVER (PARTITION BY chunk ORDER BY tier, delivery) AS place FROM (SELECT chunk, delivery, CASE WHEN substring(c, 1, 20) = substring(d, 1, 20) OR (len(c) < 20 AND starts_with(substring(d, 1, 20), c)) OR (len(d) < 20 AND starts_with(substring(c, 1, 20), d)) THEN 1 WHEN substring(c, 1, 15) = substring(d, 1, 15) THEN 2 END AS tier
 FROM (SELECT chunk, {_AL.format(c='chunk')} AS c FROM (SELECT c_name || ' annual report_part1of3' AS chunk FROM customer)), (SELECT delivery, {_AL.format(c='delivery')} AS d FROM (SELECT DISTINCT substring(c_name, 1, 16) || '-annual' AS delivery FROM customer WHERE c_custkey % 2 = 0))) WHERE tier IS NOT NULL) WHERE place = 1""")
def delivery_match(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    chunks = c.select(F.concat("c_name", F.lit(" annual report_part1of3")).alias("chunk"))
    return match.by_short_name(chunks, c.where("c_custkey % 2 = 0").select(F.concat(F.substring("c_name", 1, 16), F.lit("-annual")).alias("delivery")).distinct())


_FIG = "SELECT o_custkey AS figure, o_orderkey % 50 AS page_num, o_orderkey AS position, o_orderpriority AS series FROM orders"


@query("sync_update", f"SELECT f.figure, f.page_num, f.position, coalesce(u.new, f.series) AS series, u.new IS NOT NULL AS updated FROM ({_FIG}) f LEFT JOIN (SELECT o_custkey AS figure, o_orderkey % 50 AS page_num, arg_min(o_orderstatus, o_orderkey) AS new FROM orders WHERE o_orderkey % 3 = 0 GROUP BY ALL) u USING (figure, page_num)")
def sync_update(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("figure"), (F.col("o_orderkey") % 50).alias("page_num"), F.col("o_orderkey").alias("position"), F.col("o_orderpriority").alias("series"), "o_orderstatus")
    updates = o.where("position % 3 = 0").select("figure", "page_num", "position", F.col("o_orderstatus").alias("series"))
    return match.synced(o.drop("o_orderstatus"), updates, ["figure", "page_num"], "position")


@query("merged_figures", f"SELECT f.figure, f.page_num, f.position, coalesce(u.new, f.series) AS series, u.new IS NOT NULL AS updated FROM ({_FIG}) f LEFT JOIN (SELECT o_custkey AS figure, o_orderkey % 50 + 5 AS page_num, arg_max(o_orderstatus, o_orderkey) AS new FROM orders WHERE o_orderkey % 4 = 0 GROUP BY ALL) u USING (figure, page_num)")
def merged_figures(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("figure"), (F.col("o_orderkey") % 50).alias("page_num"), F.col("o_orderkey").alias("position"), F.col("o_orderpriority").alias("series"), "o_orderstatus")
    new = o.where("position % 4 = 0").select("figure", "page_num", "position", F.col("o_orderstatus").alias("series"))
    return match.merged_figures(o.drop("o_orderstatus"), new, F.lit(5))


_VERIFY = """SELECT p_partkey, CASE WHEN m IS NULL THEN 'FAIL' WHEN m = 0 THEN 'EMPTY' WHEN t IS NULL THEN 'PARTIAL' WHEN m = t THEN 'PASS' ELSE 'PARTIAL' END AS status
 FROM (SELECT p_partkey, CASE WHEN p_partkey % 11 <> 0 THEN p_size % 5 END AS m, CASE WHEN p_partkey % 9 <> 0 THEN p_partkey % 5 END AS t FROM part)"""


def _verify(spark, sf_dir):
    m, t = F.when(F.col("p_partkey") % 11 != 0, F.col("p_size") % 5), F.when(F.col("p_partkey") % 9 != 0, F.col("p_partkey") % 5)
    return table(spark, sf_dir, "part").select("p_partkey", match.verify_status(m, t).alias("status"))


@query("verify_status", _VERIFY)
def verify_status(spark, sf_dir):
    return _verify(spark, sf_dir)


@query("verify_summary", f"SELECT *, (passed + partial) * 100.0::DOUBLE / greatest(total, 1) AS pass_rate FROM (SELECT count(*) AS total, count_if(status = 'PASS') AS passed, count_if(status = 'PARTIAL') AS partial, count_if(status = 'EMPTY') AS empty, count_if(status = 'FAIL') AS failed FROM ({_VERIFY}))")
def verify_summary(spark, sf_dir):
    return match.status_summary(_verify(spark, sf_dir))


@query("series_rows", "SELECT o_custkey, CAST(CASE WHEN first_flag THEN sum_lines ELSE n END AS INTEGER) AS rows FROM (SELECT o_custkey, count(*) AS n, sum(CASE WHEN o_orderkey % 2 = 0 THEN 2 ELSE 0 END) AS sum_lines, arg_min(o_orderkey, o_orderkey) % 2 = 0 AS first_flag FROM orders GROUP BY o_custkey)")
def series_rows(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    points = F.when(F.col("o_orderkey") % 2 == 0, F.array(F.lit(1), F.lit(2)))
    series = o.groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("o_orderkey", points.alias("data_points")))).alias("s"))
    return series.select("o_custkey", tables.series_rows(F.col("s")).alias("rows"))


@query("series_columns", "SELECT n_regionkey, 'x,' || string_agg(name, ',' ORDER BY name) AS columns FROM (SELECT DISTINCT n_regionkey, unnest(['v' || (n_nationkey % 3), 'total']) AS name FROM nation) GROUP BY n_regionkey")
def series_columns(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    row = F.create_map(F.concat(F.lit("v"), (F.col("n_nationkey") % 3).cast("string")), F.lit(1), F.lit("total"), F.lit(2), F.lit("x"), F.lit(3))
    rows = n.groupBy("n_regionkey").agg(F.collect_list(row).alias("rows"))
    return rows.select("n_regionkey", F.array_join(tables.series_columns(F.col("rows")), ",").alias("columns"))


# a document of pages with several tables, whose titles have numbers, colons, empty cells and rows without end
_SHEETS = """SELECT n_regionkey AS pdf, n_nationkey % 4 + 1 AS page_num, n_name, n_nationkey FROM nation"""


def _sheets(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    key = F.col("n_nationkey").cast("string")
    md = F.concat(F.lit("### Table "), key, F.lit(": of "), "n_name", F.lit("\n\n| name | | key |\n|---|---|---|\n| "), "n_name", F.lit(" | | "), key, F.lit(" |\n|  |  |\n"), F.when(F.col("n_nationkey") % 2 == 0, F.lit("| more | 1 |\n")).otherwise(F.lit("")), F.lit("\ntext\n"))
    rows = n.select(F.col("n_regionkey").alias("pdf"), (F.col("n_nationkey") % 4 + 1).alias("page_num"), "n_nationkey", md.alias("md"))
    texts = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", "md"))), lambda x: x["md"]), "\n")
    return tables.titled_tables(rows.groupBy("pdf", "page_num").agg(texts.alias("text")), _KEYS)


_TITLED = f"SELECT pdf, page_num, row_number() OVER (PARTITION BY pdf, page_num ORDER BY n_nationkey) AS ordinal, 'Table ' || n_nationkey AS figure_number, 'of ' || n_name AS title, 'name|key' AS headers, CASE WHEN n_nationkey % 2 = 0 THEN 2 ELSE 1 END AS row_count FROM ({_SHEETS})"


@query("titled_tables", f"SELECT pdf, page_num, CAST(ordinal AS INTEGER) AS ordinal, figure_number, title, headers, row_count FROM ({_TITLED})")
def titled_tables(spark, sf_dir):
    return _sheets(spark, sf_dir).withColumn("headers", F.array_join("headers", "|"))


_FILES = "SELECT n_regionkey AS pdf, 'Table_' || n_nationkey || '_page' || (n_nationkey % 5 + 1) || '.yaml' AS file, CASE WHEN n_nationkey % 3 = 0 THEN 'table ' || n_nationkey ELSE 'Table 99' END AS figure_number, n_nationkey % 5 + 1 AS page_num, CASE WHEN n_nationkey % 7 <> 6 THEN n_nationkey % 3 END AS rows FROM nation"


def _metadata(spark, sf_dir):
    k = F.col("n_nationkey")
    file = F.concat(F.lit("Table_"), k.cast("string"), F.lit("_page"), (k % 5 + 1).cast("string"), F.lit(".yaml"))
    rows = table(spark, sf_dir, "nation").select(F.col("n_regionkey").alias("pdf"), file.alias("file"), F.when(k % 3 == 0, F.concat(F.lit("table "), k.cast("string"))).otherwise("Table 99").alias("figure_number"), F.when(k % 7 != 6, k % 3).alias("rows"))
    return rows.withColumn("page_num", T.page_of_name(F.col("file")))


_NEAREST = f"""SELECT f.pdf, f.file, CASE WHEN rows IS NULL THEN 'FAIL' WHEN rows = 0 THEN 'EMPTY' WHEN t.row_count IS NULL THEN 'PARTIAL' WHEN rows = t.row_count THEN 'PASS' ELSE 'PARTIAL' END AS status, coalesce(t.page_num, -1) AS table_page FROM ({_FILES}) f LEFT JOIN
 (SELECT * FROM (SELECT f.pdf, f.file, t.page_num, t.row_count, row_number() OVER (PARTITION BY f.pdf, f.file ORDER BY contains(lower(t.figure_number), lower(f.figure_number)) DESC, t.page_num, t.ordinal) AS place FROM ({_FILES}) f JOIN ({_TITLED}) t ON f.pdf = t.pdf AND abs(f.page_num - t.page_num) <= 1) WHERE place = 1) t ON f.pdf = t.pdf AND f.file = t.file"""


@query("verify_tables", _NEAREST)
def verify_tables(spark, sf_dir):
    rows = match.verify_tables(_metadata(spark, sf_dir), _sheets(spark, sf_dir), ["pdf"])
    return rows.select("pdf", "file", "status", F.coalesce("table_page", F.lit(-1)).alias("table_page"))


@query("metadata_in_chunks", f"SELECT pdf AS chunk, file FROM ({_FILES}) WHERE pdf IN (SELECT r_regionkey FROM region WHERE r_regionkey % 2 = 0)")
def metadata_in_chunks(spark, sf_dir):
    documents = table(spark, sf_dir, "region").where("r_regionkey % 2 = 0").select(F.col("r_regionkey").alias("chunk"), F.col("r_name").alias("markdown"))
    return match.in_chunks(_metadata(spark, sf_dir).select(F.col("pdf").alias("chunk"), "file"), documents).select("chunk", "file")


@query("change_counts", f"SELECT 'sync' AS kind, count(*) AS seen, count_if(updated) AS changed, count_if(NOT updated) AS \"left\" FROM (SELECT u.new IS NOT NULL AS updated FROM ({_FIG}) f LEFT JOIN (SELECT o_custkey AS figure, o_orderkey % 50 AS page_num, arg_min(o_orderstatus, o_orderkey) AS new FROM orders WHERE o_orderkey % 3 = 0 GROUP BY ALL) u USING (figure, page_num))")
def change_counts(spark, sf_dir):
    return match.change_counts(sync_update(spark, sf_dir), "sync")


@query("fill_match_far", """SELECT s_suppkey AS chart, CASE WHEN s_suppkey % 3 = 0 THEN 100 + s_nationkey ELSE s_nationkey END AS asked, s_nationkey AS "table" FROM supplier WHERE s_nationkey IN (SELECT c_nationkey FROM customer)""")
def fill_match_far(spark, sf_dir):
    """Charts on pages without any table are matched with all tables of their document, by number."""
    s = table(spark, sf_dir, "supplier")
    asked = F.when(F.col("s_suppkey") % 3 == 0, F.col("s_nationkey") + 100).otherwise(F.col("s_nationkey"))
    charts = s.select(F.lit("bank").alias("pdf"), F.col("s_suppkey").alias("chart"), asked.alias("page_num"), F.lit("").alias("title"), F.array(F.lit("balance"), F.lit("segment")).alias("elements"), F.concat(F.lit("Table "), F.col("s_nationkey").cast("string"), F.lit(":")).alias("figure_number"))
    found = _tables(spark, sf_dir).select("pdf", "page_num", F.col("page_num").alias("table"), F.col("title").alias("table_title"), "headers")
    rows = match.matched_tables(charts, found).join(s.select(F.col("s_suppkey").alias("chart"), "s_nationkey"), "chart")
    return rows.join(found.select(F.col("table").alias("s_nationkey")), "s_nationkey", "left_semi").select("chart", F.col("page_num").alias("asked"), "table")


def _fills(spark, sf_dir):
    """Metadata files of suppliers, the tables found for them and the tables' rows."""
    s = table(spark, sf_dir, "supplier")
    charts = s.select(F.lit("bank").alias("pdf"), F.col("s_suppkey").alias("chart"), F.col("s_nationkey").alias("page_num"), F.lit("").alias("title"), F.array(F.lit("balance"), F.lit("segment")).alias("elements"), F.concat(F.lit("Table "), F.col("s_nationkey").cast("string"), F.lit(":")).alias("figure_number"))
    pages = _tables(spark, sf_dir)
    found = match.best_tables(match.table_scores(charts, pages.select("pdf", "page_num", F.col("page_num").alias("table"), F.col("title").alias("table_title"), "headers"))).where(F.col("at") == F.col("table"))
    rows = F.to_json(F.transform("rows", lambda r: F.struct(r[0].alias("x"), r[1].alias("balance"), r[2].alias("segment"))))
    series = pages.select(F.col("page_num").alias("table"), rows.alias("series"))
    k = F.col("s_suppkey") % 5
    kind = F.when(k == 1, "photo").otherwise("data_table")
    metadata = s.select(F.col("s_suppkey").alias("name"), F.when(k != 0, F.to_json(F.struct(kind.alias("image_type")))).alias("json"), kind.alias("image_type"), (k == 2).alias("has_series"))
    return metadata, found.select(F.col("chart").alias("name"), "table"), series


@query("fill_files", """SELECT s_suppkey AS file, status, CASE WHEN status = 'filled' THEN '{"image_type": "data_table", "data_extraction": {"data_series": [' || series || '], "has_quantitative_data": true}}' END AS filled FROM
 (SELECT s_suppkey, CASE WHEN s_suppkey % 5 = 0 THEN 'failed' WHEN s_suppkey % 5 = 1 OR s_suppkey % 5 = 2 THEN 'skipped' WHEN n IS NULL THEN 'failed' ELSE 'filled' END AS status, series FROM supplier LEFT JOIN
 (SELECT c_nationkey AS n, string_agg('{"x": "' || c_name || '", "balance": "$' || CAST(floor(c_acctbal) AS BIGINT) || '", "segment": "' || c_mktsegment || '"}', ', ' ORDER BY c_custkey) AS series FROM customer GROUP BY c_nationkey) ON n = s_nationkey)""")
def fill_files(spark, sf_dir):
    """Metadata files of suppliers filled with the rows of the table on their page: some unreadable, some no tables, some filled before."""
    return match.fill_from_tables(*_fills(spark, sf_dir)).select(F.col("name").alias("file"), "status", "filled")


@query("fill_counts", "SELECT count(*) AS total, count(CASE WHEN s % 5 IN (3, 4) AND n THEN 1 END) AS filled, count(CASE WHEN s % 5 IN (1, 2) THEN 1 END) AS skipped, count(CASE WHEN s % 5 = 0 OR (s % 5 IN (3, 4) AND NOT n) THEN 1 END) AS failed FROM (SELECT s_suppkey AS s, s_nationkey IN (SELECT c_nationkey FROM customer) AS n FROM supplier)")
def fill_counts(spark, sf_dir):
    is_ = lambda s: F.count_if(F.col("status") == s).alias(s)
    return match.fill_statuses(*_fills(spark, sf_dir)).agg(F.count(F.lit(1)).alias("total"), is_("filled"), is_("skipped"), is_("failed"))


@query("glued_headers", """SELECT n_nationkey, '### Table ' || n_nationkey || ': x' || chr(10) || chr(10) || '| a | b |' || chr(10) || '|---|---|' || chr(10) || '| 1 | 2 |' || chr(10) || CASE WHEN n_nationkey % 2 = 0 THEN '' ELSE '### Table 2 | c |' || chr(10) || 'no row' END AS text FROM nation""")
def glued_headers(spark, sf_dir):
    key = F.col("n_nationkey")
    text = F.concat(F.lit("### Table "), key.cast("string"), F.lit(": x | a | b |\n|---|---|\n| 1 | 2 |\n"), F.when(key % 2 == 0, "").otherwise("### Table 2 | c |\nno row"))
    return table(spark, sf_dir, "nation").select("n_nationkey", tables.glued_headers(text).alias("text"))


_CELL = "CASE p_partkey % 8 WHEN 0 THEN '£ ' || p_partkey || ',000' WHEN 1 THEN '-' || p_size || '.5%' WHEN 2 THEN ' N/A ' WHEN 3 THEN '' WHEN 4 THEN '–' WHEN 5 THEN p_size || '?' WHEN 6 THEN 'A–B,' || p_size || '—C' ELSE '1.2.3' END"


@query("numeric_cells", f"SELECT p_partkey, p_partkey % 8 IN (0, 1, 5) AS numeric, lower(replace(replace(replace(trim({_CELL}), ',', ''), '–', '-'), '—', '-')) AS normal FROM part")
def numeric_cells(spark, sf_dir):
    k, size = F.col("p_partkey"), F.col("p_size").cast("string")
    cell = F.when(k % 8 == 0, F.concat(F.lit("£ "), k.cast("string"), F.lit(",000"))).when(k % 8 == 1, F.concat(F.lit("-"), size, F.lit(".5%"))).when(k % 8 == 2, " N/A ").when(k % 8 == 3, "").when(k % 8 == 4, "–").when(k % 8 == 5, F.concat(size, F.lit("?"))).when(k % 8 == 6, F.concat(F.lit("A–B,"), size, F.lit("—C"))).otherwise("1.2.3")
    return table(spark, sf_dir, "part").select("p_partkey", T.is_numeric(cell).alias("numeric"), T.normal_value(cell).alias("normal"))
