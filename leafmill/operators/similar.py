"""Similarity of keyword sets over an inverted index, without a lower bound on the similarity."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leafmill.functions import text as T
from leafmill.operators.ranks import k_least
from leafmill.sources.shared import stage
from leafmill.sources.tables import spread

#: Part of an item's postings, rarest words first, that is counted before any pair is dropped.
FIRST = 0.5
#: Right rows, for each of the k, whose scores make the threshold.
PROMISING = 4


def word_sets(rows: DataFrame, key: str, text: str, name: str) -> DataFrame:
    """key (as ``name``), n and words of each row.  No filter here: it would be pushed below, and find the words twice."""
    texts = spread(rows.select(F.col(key).alias(name), F.col(text).alias("text")))
    return texts.select(name, T.keywords(F.col("text")).alias("words")).select(name, F.size("words").alias(f"n{name}"), "words")


def _postings(sets: DataFrame, name: str) -> DataFrame:
    return sets.select(name, f"n{name}", F.explode_outer("words").alias("word"))


def _score(shared: str):
    return F.col(shared) / (F.col("nl") + F.col("nr") - F.col(shared))


def keyword_pairs(left: DataFrame, right: DataFrame, left_id: str, right_id: str, left_text: str, right_text: str) -> DataFrame:
    """All pairs that share a keyword, with the shared words and the Jaccard similarity.

    One join on the inverted index of both sides, counted by pair; the counts are combined before
    they are shuffled.  Ids are taken to be distinct.
    """
    both = _postings(word_sets(left, left_id, left_text, "l"), "l").join(_postings(word_sets(right, right_id, right_text, "r"), "r"), "word")
    counted = both.groupBy("l", "nl", "r", "nr").agg(F.count(F.lit(1)).alias("shared"))
    return counted.select(F.col("l").alias(left_id), F.col("r").alias(right_id), "shared", _score("shared").alias("score"))


def whole_sets(pairs: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """Shared words and score of pairs (l, r) by their whole sets."""
    both = pairs.join(right, "r").join(left.select("l", "nl", F.col("words").alias("asked")), "l")
    return both.select("l", "r", "nl", "nr", F.size(F.array_intersect("asked", "words")).cast("long").alias("shared")).withColumn("score", _score("shared"))


def best_matches(left: DataFrame, right: DataFrame, left_id: str, right_id: str, left_text: str, right_text: str, k: int) -> DataFrame:
    """The k most similar right rows of each left row among those that share a keyword; ties to the smaller id.

    Exact, by upper bounds.  A left row's words are taken rarest first.  After those with the first
    half of its postings, the most promising right rows are compared as whole sets, and the k-th
    best of their scores is a threshold.  A right row that can't reach it even with all words left
    is dropped, and one that was not met at all is only looked for where it is short enough to
    reach it.  What is left is compared as whole sets.  A left row with fewer than k partners so
    far has no threshold and keeps all.
    """
    sets_r = stage(word_sets(right, right_id, right_text, "r"), "keywords")
    sets_l = word_sets(left, left_id, left_text, "l")
    postings_l, postings_r = _postings(sets_l, "l"), _postings(sets_r, "r")
    asked = postings_l.select("word").distinct()
    sizes = postings_r.join(asked, "word", "left_semi").groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    ordered = Window.partitionBy("l").orderBy("df", "word")
    known = postings_l.join(sizes, "word").withColumns({"upto": F.sum("df").over(ordered), "all": F.sum("df").over(Window.partitionBy("l"))})
    known = stage(known.withColumn("first", (F.col("upto") <= F.col("all") * FIRST) | (F.col("upto") == F.col("df"))), "ranked-words")
    rare, common = known.where("first"), known.where("NOT first")
    # what is left after the rare words, for every left row
    rest = known.groupBy("l", "nl").agg(F.count_if(~F.col("first")).alias("rest"))
    met = rare.select("l", "nl", "word").join(postings_r, "word").groupBy("l", "nl", "r", "nr").agg(F.count(F.lit(1)).alias("c"))
    met = stage(met.withColumn("score", _score("c")).drop("nl"), "partial-scores")
    promising = k_least(met.select("l", "r", (-F.col("score")).alias("worse")), ["l"], ["worse", "r"], PROMISING * k)
    exact = whole_sets(promising.select("l", "r"), sets_l, sets_r).select("l", "r", (-F.col("score")).alias("worse"))
    threshold = k_least(exact, ["l"], ["worse", "r"], k).groupBy("l").agg(F.max("place").alias("n"), F.max("worse").alias("worst"))
    limits = stage(rest.join(threshold, "l", "left").select("l", "nl", "rest", F.when(F.col("n") == k, -F.col("worst")).otherwise(0.0).alias("least")), "limits")
    at_most = F.col("c") + F.col("rest")
    reach = F.least(at_most, F.col("nr")) / (F.col("nl") + F.col("nr") - F.least(at_most, F.col("nr")))
    near = met.join(limits, "l").where(reach >= F.col("least") - 1e-12).select("l", "r")
    # a row met by common words only shares ``rest`` words at most: its size has to be small
    longest = F.when(F.col("least") > 0, F.floor(F.least(F.col("rest") * (1 + 1 / F.col("least")) - F.col("nl") + 1e-6, F.lit(2.0**30)))).otherwise(F.lit(1 << 30))
    wanted = common.select("l", "word").join(limits.select("l", longest.alias("longest")).where("longest > 0"), "l")
    # joined by word and power of two of the size, so that a common word's long rows are never touched
    wanted = wanted.withColumn("size", F.explode(F.sequence(F.lit(0), F.floor(F.log2("longest")).cast("int"))))
    sized = postings_r.withColumn("size", F.floor(F.log2("nr")).cast("int"))
    short = wanted.join(sized, ["word", "size"]).where(F.col("nr") <= F.col("longest")).select("l", "r")
    pairs = near.unionByName(short).distinct()
    scored = whole_sets(pairs, sets_l, sets_r)
    found = k_least(scored.select("l", "r", "shared", "score", (-F.col("score")).alias("worse")), ["l"], ["worse", "r"], k)
    return found.select(F.col("l").alias(left_id), F.col("r").alias(right_id), "shared", "score", "place")
