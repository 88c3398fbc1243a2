"""Operator 5: benchmark decontamination by winnowing, in DataFrame operations only.

A window is ``SPAN`` consecutive words of a benchmark item (all its words, if there are fewer).
Every run of ``SPAN`` words, of an item or a document, has ``SPAN - GRAM + 1`` hashes of ``GRAM``
words; the smallest is its fingerprint, so a shared run always shares its fingerprint.  Where a
document's fingerprint is one of the benchmark's, the hit is extended to the run of words it
came from and compared word by word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm.common import prepare, stage, table, unwrapped, wrapped

SPAN, GRAM = 10, 5
#: Up to so many benchmark fingerprints are held in the plan of the document pass; more are joined.
IN_PLAN = 50_000
#: Up to so many bytes of distinct windows are broadcast; more are joined by shuffle.
BROADCAST_BYTES = 16 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Words of a text; null has none."""
    text = F.coalesce(text, F.lit(""))
    small = F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.array_remove(F.split(small, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def grams(words: str, size: int) -> Column:
    """Hash of each run of ``size`` words of an array column; none if there are fewer words."""
    n = F.size(words)
    shifted = [F.slice(words, i + 1, F.greatest(n, F.lit(1))).alias(f"w{i}") for i in range(size)]
    runs = F.slice(F.arrays_zip(*shifted), 1, F.greatest(n - (size - 1), F.lit(0)))
    return F.transform(runs, lambda run: F.xxhash64(run))


def pair_min(values: str, step: int) -> Column:
    """Smaller of each value and the one ``step`` places on."""
    return F.zip_with(values, F.slice(values, step + 1, F.greatest(F.size(values), F.lit(1))), lambda a, b: F.least(a, b))


def with_fingerprints(frame: DataFrame, short: list[int]) -> DataFrame:
    """``frame`` (column ``words``) with ``print``: the fingerprint of each run of SPAN words, and
    ``print_n``: the hash of each run of n words, for each short length n."""
    out = frame.withColumn("_h", grams("words", GRAM))
    out = out.withColumn("_m2", pair_min("_h", 1))
    out = out.withColumn("_m4", pair_min("_m2", 2))
    six = F.zip_with("_m4", F.slice("_m2", 5, F.greatest(F.size("_m2"), F.lit(1))), lambda a, b: F.least(a, b))
    out = out.withColumn("print", F.slice(six, 1, F.greatest(F.size("words") - (SPAN - 1), F.lit(0))))
    out = out.withColumns({f"print_{n}": grams("words", n) for n in short})
    return out.drop("_h", "_m2", "_m4")


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """Distinct (span, window, item_id).  Items without id or word have none."""
    items = benchmark.where(F.col("item_id").isNotNull()).select("item_id", words(F.col("text")).alias("words")).where(F.size("words") > 0)
    span = F.least(F.size("words"), F.lit(SPAN))
    starts = items.withColumn("span", span).select("item_id", "span", "words", F.explode(F.sequence(F.lit(1), F.size("words") - F.col("span") + 1)).alias("at"))
    return starts.select("span", F.array_join(F.slice("words", F.col("at"), F.col("span")), " ").alias("window"), "item_id").distinct()


def with_print(windows: DataFrame) -> DataFrame:
    """Distinct span, window, print of ``benchmark_windows``."""
    distinct = windows.select("span", "window").distinct().withColumn("words", F.split("window", " "))
    prints = with_fingerprints(distinct, list(range(1, SPAN)))
    own = F.element_at("print", 1)
    for n in range(1, SPAN):
        own = F.when(F.col("span") == n, F.element_at(f"print_{n}", 1)).otherwise(own)
    return prints.select("span", "window", own.alias("print"))


def candidates(prints: str, span: int, among) -> Column:
    """(start, span, window) of the runs of ``words`` whose fingerprint is one of the benchmark's."""
    marked = F.transform(prints, lambda p, at: F.when(among(p), at))
    hit = F.filter(marked, lambda at: at.isNotNull())
    return F.transform(hit, lambda at: F.struct(at.alias("start"), F.lit(span).alias("span"), F.array_join(F.slice("words", at + 1, span), " ").alias("window")))


def hits_by_text(documents: DataFrame, benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, _id, _th, n_words of each row; _id, _th, n_hit, n_items, items_sha256 of each text with a hit).

    Documents are read once, and only runs with a benchmark fingerprint leave that pass.  With
    more than ``IN_PLAN`` fingerprints the documents' distinct fingerprints are semi-joined by
    shuffle instead.
    """
    prepare(documents.sparkSession)
    held = stage(benchmark_windows(benchmark), "items")
    windows = stage(with_print(held), "windows")
    by_span = {r["span"]: r["n"] for r in windows.groupBy("span").agg(F.count_distinct("print").alias("n")).collect()}  # at most SPAN rows
    short = sorted(n for n in by_span if n < SPAN)
    columns = {SPAN: "print", **{n: f"print_{n}" for n in short}}
    base = documents.select("doc_id", F.coalesce("doc_id", F.lit(-(1 << 62))).alias("_id"), F.xxhash64("text").alias("_th"), words(F.col("text")).alias("words"))
    prints = with_fingerprints(base, short)
    spans = [n for n in columns if n in by_span]
    if sum(by_span.values()) <= IN_PLAN:
        wanted = {n: [] for n in spans}
        for r in windows.select("span", "print").distinct().collect():  # at most IN_PLAN rows
            wanted[r["span"]].append(r["print"])
        found = [candidates(columns[n], n, lambda p, n=n: p.isin(wanted[n])) for n in spans]
    else:
        tagged = lambda n: F.transform(F.array_distinct(columns[n]), lambda p: F.struct(F.lit(n).alias("span"), p.alias("print")))
        own = F.concat(*[tagged(n) for n in spans])
        shared = prints.select("_id", "_th", F.explode(own).alias("p")).select("_id", "_th", "p.*").join(windows.select("span", "print").distinct(), ["span", "print"], "left_semi")
        lists = shared.groupBy("_id", "_th").agg(*[F.collect_set(F.when(F.col("span") == n, F.col("print"))).alias(f"own_{n}") for n in spans])
        prints = prints.join(lists, ["_id", "_th"], "left")
        found = [candidates(columns[n], n, lambda p, n=n: F.array_contains(f"own_{n}", p)) for n in spans]
    runs = F.flatten(F.array(*[F.coalesce(f, F.array().cast("array<struct<start:int,span:int,window:string>>")) for f in found])) if found else F.array().cast("array<struct<start:int,span:int,window:string>>")
    passed = stage(prints.select("doc_id", "_id", "_th", F.size("words").cast("long").alias("n_words"), runs.alias("runs")), "runs")

    hits = passed.where(F.size("runs") > 0).select("_id", "_th", F.explode("runs").alias("run")).select("_id", "_th", "run.*").distinct()
    size = windows.agg(F.coalesce(F.sum(F.octet_length("window") + 16), F.lit(0))).first()[0]
    right = windows.select("span", "window")
    hits = stage(hits.join(F.broadcast(right) if size <= BROADCAST_BYTES else right, ["span", "window"]), "hits")
    covered = F.array_distinct(F.flatten(F.transform(F.collect_set(F.struct("start", "span")), lambda s: F.sequence(s["start"], s["start"] + s["span"] - 1))))
    n_hit = hits.groupBy("_id", "_th").agg(F.size(covered).cast("long").alias("n_hit"))
    # each text meets a window once, and an item once: a window of many items is no row of its own
    items = hits.select("_id", "_th", "span", "window").distinct().join(held, ["span", "window"]).select("_id", "_th", F.col("item_id").cast("string").alias("item")).distinct()
    items = items.groupBy("_id", "_th").agg(F.count(F.lit(1)).alias("n_items"), F.sha2(F.array_join(F.array_sort(F.collect_list("item")), ","), 256).alias("items_sha256"))
    each = n_hit.join(items, ["_id", "_th"])
    return passed.drop("runs"), each


def clean(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``documents``, all columns, that share no window with the benchmark.

    Null and empty texts share none and stay; repeated rows stay or go together.
    """
    _, each = hits_by_text(documents, benchmark)
    keyed = wrapped(documents).withColumns({"_id": F.coalesce("doc_id", F.lit(-(1 << 62))), "_th": F.xxhash64("text")})
    return unwrapped(keyed.join(each.select("_id", "_th").hint("shuffle_hash"), ["_id", "_th"], "left_anti"), documents)


def decontaminate(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for each row of ``documents``.

    Null and empty texts have no words; equal rows give equal rows; null ids are kept.  Items
    that share an id count once; items without id are left out.  A very long text is one row of
    word and hash arrays, about 50 bytes for each of its words.
    """
    passed, each = hits_by_text(documents, benchmark)
    joined = passed.join(each, ["_id", "_th"], "left")
    none = F.sha2(F.lit(""), 256)
    return joined.select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.coalesce("n_items", F.lit(0)).alias("n_items"), F.coalesce("items_sha256", none).alias("items_sha256"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
ORACLE_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
s AS (SELECT item_id, w, least(len(w), {SPAN}) AS n, unnest(generate_series(1, len(w) - least(len(w), {SPAN}) + 1)) AS i FROM b WHERE len(w) > 0),
v AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS win FROM s),
l AS (SELECT DISTINCT n FROM v),
p AS (SELECT r, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, l WHERE len(w) >= n),
x AS (SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS win FROM p),
h AS (SELECT r, i, x.n, v.item_id FROM x JOIN v ON x.n = v.n AND x.win = v.win),
c AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT DISTINCT r, unnest(generate_series(i, i + n - 1)) AS k FROM h) GROUP BY r),
t AS (SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM h) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (r) LEFT JOIN t USING (r)
"""
