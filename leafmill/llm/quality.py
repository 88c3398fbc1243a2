"""Operator 10: quality rules with distribution divergence, in DataFrame operations only.

Each document gives two histograms: its characters by class, and its words by common word, all
other words being one more bin.  The language references are the summed histograms of the rows of
a language that pass the base rules.  A document is kept if it passes the base rules and there is
a language to whose histograms both its Jensen-Shannon distances stay below their limits.
Languages below a minimum length are no reference; documents of fewer than MIN_JUDGED words are
judged by their characters alone.  A language that uses none of the listed words has all of its
reference in the bin of other words, and so have its documents.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm.common import prepare, stage, table

SPACES = " \t\n\x0b\x0c\r"
#: Character classes in the order in which they are counted; the rest are letters beyond ASCII and other signs.
SYMBOLS = "#*$%&|<>"
MARKS = ".,;:!?"
QUOTES = "'\"()[]{}-_/\\"
DIGITS = "0123456789"
#: Frequent function words of the languages at hand (fixed values).
COMMON = (
    "the of and to in a is that it on for was as be with at by this are an from or "
    "de la que el en y los del se las por un para con no una su al lo como más "
    "der die und den von zu das mit sich des auf für ist im dem nicht ein eine "
    "le les et des à en du une est pour qui dans sur au par pas plus ne ce"
).split()
COMMON = list(dict.fromkeys(COMMON))
MIN_WORDS = 50
#: A language without so many words in all rows is no reference.
MIN_REFERENCE = 2_000
#: The references are part of the plan; more languages than this are an error.
MAX_LANGUAGES = 200
#: Documents with fewer words than this are judged by their characters alone.
MIN_JUDGED = 80
#: Limits of the Jensen-Shannon distance (base 2, 0 to 1).
CHAR_LIMIT, WORD_LIMIT = 0.25, 0.28


def _count(text: str, signs: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, signs, ""))).cast("long")


def repeated(words: str) -> Column:
    """Words inside runs of three words that occur twice or more in the array column."""
    order = "_order"
    near = F.zip_with(F.slice(order, 1, F.greatest(F.size(order) - 1, F.lit(0))), F.slice(order, 2, F.greatest(F.size(order) - 1, F.lit(0))), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
    at = F.flatten(F.filter(near, lambda x: x.isNotNull()))
    covered = F.size(F.array_distinct(F.flatten(F.transform(at, lambda i: F.array(i, i + 1, i + 2)))))
    return F.when(F.size(order) > 1, covered).otherwise(0).cast("long")


def measures(docs: DataFrame, lang: str = "lang") -> DataFrame:
    """doc_id, lang, base columns, chars and common (histograms) for each row.

    ``|words| - 2`` hashes of three words are compared within the row; only rows with two equal
    hashes sort them.
    """
    given = docs.select("doc_id", F.col(lang).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    rows = given.withColumn("rest", F.regexp_replace("text", "[a-z]+", "")).withColumn("words", F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), ""))
    rows = rows.withColumn("_h", F.transform(F.slice(F.arrays_zip(F.col("words").alias("a"), F.slice("words", 2, F.greatest(F.size("words"), F.lit(1))).alias("b"), F.slice("words", 3, F.greatest(F.size("words"), F.lit(1))).alias("c")), 1, F.greatest(F.size("words") - 2, F.lit(0))), lambda t: F.xxhash64(t)))
    twice = F.size(F.array_distinct("_h")) < F.size("_h")
    rows = rows.withColumn("_order", F.when(twice, F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).otherwise(F.array().cast("array<struct<h:bigint,i:int>>")))
    rows = rows.withColumn("_lines", F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    lower, spaces, symbols = F.length("text") - F.length("rest"), _count("rest", SPACES), _count("rest", SYMBOLS)
    marks, quotes, digits = _count("rest", MARKS), _count("rest", QUOTES), _count("rest", DIGITS)
    capitals = _count("rest", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    counted = [lower.cast("long"), spaces, symbols, marks, quotes, digits, capitals]
    rows = rows.withColumn("_c", F.array(*counted)).withColumn("_cw", F.filter(F.transform("words", F.lower), lambda w: w.isin(COMMON)))
    common = F.transform(F.array(*map(F.lit, COMMON)), lambda c: (F.size("_cw") - F.size(F.array_remove("_cw", c))).cast("long"))
    whole = F.length("text").cast("long")
    total = F.aggregate("_c", F.lit(0).cast("long"), lambda a, b: a + b)
    return rows.select(
        "doc_id",
        "lang",
        F.size("words").cast("long").alias("n_words"),
        (whole - F.col("_c")[1]).alias("word_chars"),
        F.col("_c")[2].alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        repeated("words").alias("n_repeat_words"),
        F.concat("_c", F.array(whole - total)).alias("chars"),
        F.concat(common, F.array((F.size("words") - F.size("_cw")).cast("long"))).alias("common"),
        whole.alias("n_chars"),
    )


def references(measured: DataFrame) -> list[dict]:
    """Summed histograms by language of the rows that pass the base rules: one small row for each
    language (aggregated map-side), at most MAX_LANGUAGES."""
    sums = [F.sum(F.col("chars")[i]).alias(f"c{i}") for i in range(8)] + [F.sum(F.col("common")[i]).alias(f"w{i}") for i in range(len(COMMON) + 1)]
    rows = measured.where(F.col("lang").isNotNull() & ~base_failed()).groupBy("lang").agg(F.sum("n_words").alias("n"), *sums).where(F.col("n") >= MIN_REFERENCE).orderBy("lang").limit(MAX_LANGUAGES + 1).collect()
    if len(rows) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages have a reference: is lang a language?")
    return [{"chars": [r[f"c{i}"] for i in range(8)], "common": [r[f"w{i}"] for i in range(len(COMMON) + 1)]} for r in rows]


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def distance(counts: str, total: str, reference: list[int]) -> Column:
    """Jensen-Shannon distance (square root of the divergence in bits) of counts to a reference.

    ``total`` is a stored column: an expression in its place would be worked out for every bin.
    1 where either side is empty.
    """
    size = sum(reference)
    if not size:
        return F.lit(1.0)
    share = F.array(*[F.lit(x / size) for x in reference])
    part = lambda a, b: F.when(a > 0, a * F.log2(a / ((a + b) / 2))).otherwise(0.0)
    bits = F.zip_with(counts, share, lambda n, q: part(n / F.col(total), q) + part(q, n / F.col(total)))
    return F.when(F.col(total) > 0, F.sqrt(F.greatest(F.aggregate(bits, F.lit(0.0), lambda x, y: x + y) / 2, F.lit(0.0)))).otherwise(1.0)


def rated(measured: DataFrame) -> DataFrame:
    """``measured`` with ``char_distance``, ``word_distance`` (to the nearest reference; 0 without any) and ``kept``."""
    found = references(measured)
    rows = measured
    for kind, total in (("chars", "n_chars"), ("common", "n_words")):
        rows = rows.withColumn(f"d_{kind}", F.array(*[distance(kind, total, r[kind]) for r in found]) if found else F.array(F.lit(0.0)))
    near = F.zip_with("d_chars", "d_common", lambda c, w: (c <= CHAR_LIMIT) & ((F.col("n_words") < MIN_JUDGED) | (w <= WORD_LIMIT)))
    rows = rows.withColumns({"char_distance": F.array_min("d_chars"), "word_distance": F.array_min("d_common")})
    return rows.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & F.exists(near, lambda x: x))


def quality(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept.

    A null or empty text has no words and fails the base rules; a null lang gives no reference
    but is judged like any other; equal rows give equal rows.  The texts are read once; their
    histograms are written to the shared folder and read for the references and the verdicts.
    """
    prepare(docs.sparkSession)
    rows = rated(stage(measures(docs), "histograms"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "char_distance", "word_distance")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents")).drop("char_distance", "word_distance")


def _sql() -> str:
    words = "list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"
    lines = r"list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))"
    classes = [r"[a-z]", r"[\x20\x09-\x0D]", r"[#*$%&|<>]", r"[.,;:!?]", r"['\x22()\[\]{}\-_/\\]", r"[0-9]", r"[A-Z]"]
    counts = ", ".join(f"len(regexp_replace(t, '{c.replace(chr(39), chr(39) * 2)}', '', 'g'))" for c in classes)
    common = "[" + ", ".join(f"'{w}'" for w in COMMON) + "]"

    def least(kind: str) -> str:
        p, q = f"({kind}_p[i])", f"({kind}_q[i])"
        m = f"(({p} + {q}) / 2)"
        bits = f"list_sum([CASE WHEN {p} > 0 THEN {p} * log2({p} / {m}) ELSE 0 END + CASE WHEN {q} > 0 THEN {q} * log2({q} / {m}) ELSE 0 END for i in range(1, len({kind}_p) + 1)])"
        return f"CASE WHEN {kind}_n > 0 AND {kind}_m > 0 THEN sqrt(greatest({bits} / 2, 0)) ELSE 1 END"

    return f"""
WITH a AS (SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS t FROM documents),
b AS (SELECT r, doc_id, lang, {words} AS w, {lines} AS l, len(t) AS n, [{counts}] AS k FROM a),
c AS (SELECT *, list_transform(k, lambda x: n - x) AS h FROM b),
m AS (SELECT r, doc_id, lang, len(w) AS n_words, n - h[2] AS word_chars, h[3] AS n_symbols, len(l) - len(list_distinct(l)) AS n_dup_lines, w,
  list_append(h, n - list_sum(h)) AS c_h, list_filter([lower(x) for x in w], lambda x: list_contains({common}, x)) AS cw FROM c),
g AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS s FROM (SELECT r, w, unnest(generate_series(1, len(w) - 2)) AS i FROM m)),
d AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, s) AS n FROM g) WHERE n > 1),
e AS (SELECT r, count(DISTINCT j) AS n_repeat FROM (SELECT r, unnest([i, i + 1, i + 2]) AS j FROM d) GROUP BY r),
f0 AS (SELECT m.* EXCLUDE (w, cw), coalesce(n_repeat, 0) AS n_repeat_words, list_append([len(list_filter(cw, lambda x: x = y)) for y in {common}], n_words - len(cw)) AS w_h FROM m LEFT JOIN e USING (r)),
f AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f0),
u AS (SELECT lang, c_q, w_q, list_sum(c_q) AS c_m, list_sum(w_q) AS w_m FROM (SELECT lang, sum(n_words) AS n, [{", ".join(f"sum(c_h[{i + 1}])" for i in range(8))}] AS c_q, [{", ".join(f"sum(w_h[{i + 1}])" for i in range(len(COMMON) + 1))}] AS w_q FROM f WHERE lang IS NOT NULL AND NOT base_failed GROUP BY lang) WHERE n >= {MIN_REFERENCE}),
v AS (SELECT f.*, list_sum(c_h) AS c_n, list_sum(w_h) AS w_n, [x / list_sum(c_h) for x in c_h] AS c_p, [x / list_sum(w_h) for x in w_h] AS w_p FROM f),
z AS (SELECT r, bool_or({least("c")} <= {CHAR_LIMIT} AND (n_words < {MIN_JUDGED} OR {least("w")} <= {WORD_LIMIT})) AS near FROM (SELECT v.*, c_m, w_m, [x / c_m for x in c_q] AS c_q, [x / w_m for x in w_q] AS w_q FROM v, u) GROUP BY r),
y AS (SELECT v.*, coalesce(near, true) AS near FROM v LEFT JOIN z USING (r))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed, NOT base_failed AND near AS kept
FROM y
"""


ORACLE_SQL = _sql()
