"""The corpus pipeline: raw documents to encoded training text.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the next stage's documents.  All stages but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm import bagminhash, decontaminate, language, repeats, sentencepieces
from leafmill.llm.common import stage, table, unwrapped, wrapped

#: Documents whose best language has a smaller posterior are rejected.
MIN_LANGUAGE_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a recognised language.  Null texts and texts without a letter go."""
    rated = language.identify(docs, language.fit(docs), keep=True)
    return unwrapped(rated.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= MIN_LANGUAGE_SCORE)), docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: the one with the least doc_id (null first).

    Texts without a word (null, empty) all stay; of equal doc_ids the one with the least text hash
    stays, repeated rows once.  A very long text is sketched as one slice.
    """
    return bagminhash.one_of_each(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that occur elsewhere; those with nothing else go.

    Texts that lose nothing stay as they are, null and empty ones too.  Repeated rows and ties lose
    the passage at every place.  A very long text is parsed as one slice.
    """
    cut = repeats.without_repeats(docs, keep=True)
    touched = F.col("n_removed") > 0
    left = ~touched | F.col("kept").rlike(r"[^\x20\x09-\x0D]")
    changed = {"text": F.when(touched, F.col("kept")).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(touched, F.length("kept").cast("long")).otherwise(F.col("rest.n_chars"))
    return unwrapped(cut.where(left), docs, **changed)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark.

    A null or empty text has none and stays; repeated rows stay or go together; an empty
    benchmark takes nothing away.  A very long text is one row of word and hash arrays.
    """
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their piece ids (little-endian uint32), the number of ids, and whether decoding gives the text back.

    A null text is encoded like an empty one; repeated rows give equal rows; very long texts are
    streamed.  Columns of the documents that are named like one of the three new ones are
    replaced by it.
    """
    encoded = sentencepieces.encode_and_decode(wrapped(docs))
    made = ["piece_ids", "n_pieces", "round_trip"]
    own = [F.col("text") if c == "text" else F.col("rest").getField(c).alias(c) for c in docs.columns if c not in made]
    return encoded.select(*own, "piece_ids", (F.octet_length("piece_ids") / 4).cast("long").alias("n_pieces"), F.col("decoded").eqNullSafe(F.coalesce("text", F.lit(""))).alias("round_trip"))


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("suffix_dedup", suffix_dedup),
    ("decontamination", decontamination),
    ("sentencepiece", sentencepiece),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs


#: The stages hash, search and tokenise beyond what SQL expresses.
ORACLE_SQL = None
