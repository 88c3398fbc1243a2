"""Operator 9: language identification by multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased (A-Z), ASCII other than letters becomes a blank, and each character of the
text gives four features: the n-grams of 1 to 4 characters (code points) that begin there, hashed
to ``BUCKETS`` buckets.  A batch of documents is a sparse count matrix in row order (all features of a
document side by side); its product with the broadcast log-probability matrix is a gather and a
segmented sum.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm.common import prepare, stage, table, text_bytes, text_chunks, wrapped
from leafmill.llm.hashing import mix

BITS = 15
BUCKETS = 1 << BITS
SIZES = (1, 2, 3, 4)
#: The classifier is fitted on at most about this many labelled documents (by a hash of doc_id).
TRAIN_DOCS = 20_000
#: Languages of one broadcast matrix (33 MB); with more labels there are several, read one after the other.
BLOCK = 256
#: Languages that a task counts at once.
HELD = 64
#: Characters whose features and log-probabilities are held at once, times the languages of a block.
SLICE = 1 << 22
UNKNOWN = "und"
_letter = re.compile(r"[^\W\d_]")
_fold = np.full(128, 32, np.uint32)
_fold[97:123] = np.arange(97, 123)
_fold[65:91] = np.arange(97, 123)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def characters(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(folded code points of UTF-8 texts, first one of each document and the end)."""
    points = np.frombuffer(raw.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    begun = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    return np.where(points < 128, _fold[np.minimum(points, 127)], points), begun[offsets]


def features(points: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Buckets of shape [characters, sizes]; blanks follow the end of each document."""
    pad = max(SIZES) - 1
    n, sizes = len(offsets) - 1, np.diff(offsets)
    flat = np.full(int(offsets[-1]) + pad * (n + 1), 32, np.uint64)
    place = np.arange(int(offsets[-1])) + np.repeat(pad * np.arange(n), sizes)
    flat[place] = points
    out = np.empty((len(place), len(SIZES)), np.int32)
    gram = np.zeros(len(flat), np.uint64)
    for k, size in enumerate(SIZES):
        gram[: len(flat) - size + 1] = gram[: len(flat) - size + 1] * _BASE + flat[size - 1 :] + np.uint64(1)
        out[:, k] = mix(gram[place]) >> np.uint64(64 - BITS)
    return out


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> dict:
    """Log-probabilities learned from the rows with a label that are not held out.

    All of them up to ``train_docs``; beyond that about ``train_docs`` of them, drawn by a 64-bit
    hash of doc_id (rows that share a doc_id are drawn together).  A null text teaches the prior only.

    Each task counts n-grams by language in one array; Spark adds the arrays' entries up.  The
    driver makes the matrix BLOCK languages at a time, however many labels the drawn documents have.
    """
    spark = prepare(docs.sparkSession)
    labelled = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    total = labelled.count()
    share = min(1.0, train_docs / max(total, 1))
    drawn = labelled.where(F.xxhash64("doc_id") < F.lit(int(share * 2**64) - 2**63)) if share < 1 else labelled

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        documents: dict[str, int] = {}

        def counted() -> Iterator[pa.RecordBatch]:
            for lang, own in counts.items():
                at = np.flatnonzero(own)
                at, n = np.append(at, -1), np.append(own[at], documents[lang])
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at, pa.int32()), pa.array(n, pa.int64())], ["lang", "bucket", "n"])
            counts.clear()
            documents.clear()

        for chunk in text_chunks(batches):
            points, offsets = characters(*text_bytes(chunk.column("text")))
            grams = features(points, offsets)
            for row, lang in enumerate(chunk.column("lang").to_pylist()):
                if len(counts) >= HELD and lang not in counts:
                    yield from counted()
                own = counts.setdefault(lang, np.zeros(BUCKETS, np.int64))
                own += np.bincount(grams[offsets[row] : offsets[row + 1]].ravel(), minlength=BUCKETS)
                documents[lang] = documents.get(lang, 0) + 1
        yield from counted()

    parts = drawn.select("lang", "text").repartition(16).mapInArrow(run, "lang string, bucket int, n long")
    found = stage(parts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")), "language-counts")
    known = sorted((r.lang, r.n) for r in found.where("bucket = -1").collect())  # a row for each label of the drawn documents
    langs, documents = [x for x, _ in known], np.array([n for _, n in known], float)
    prior = np.log((documents + 1) / (documents.sum() + len(langs))) if langs else documents

    def matrix(own: list[str]) -> np.ndarray:
        counts = np.zeros((BUCKETS, len(own)))
        rows = found.where((F.col("bucket") >= 0) & F.col("lang").between(own[0], own[-1])).toPandas()
        counts[rows["bucket"].to_numpy(), np.searchsorted(np.array(own, object), rows["lang"].to_numpy(object))] = rows["n"].to_numpy()
        return np.log((counts + 0.1) / (counts.sum(0) + 0.1 * BUCKETS)).astype(np.float32)

    tables = [spark.sparkContext.broadcast(matrix(langs[i : i + BLOCK])) for i in range(0, len(langs), BLOCK)]
    return {"langs": langs, "documents": int(documents.sum()), "prior": prior, "tables": tables}


def totals(grams: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Sum of the log-probabilities of each document's n-grams, by language; gathered in slices of SLICE entries."""
    out = np.zeros((len(offsets) - 1, table.shape[1]))
    step = max(SLICE // max(table.shape[1], 1), 1)
    for begin in range(0, len(grams), step):
        end = min(begin + step, len(grams))
        first = int(np.searchsorted(offsets, begin, "right")) - 1
        last = int(np.searchsorted(offsets, end, "left"))
        edges = np.clip(offsets[first : last + 1], begin, end) - begin
        full = np.flatnonzero(np.diff(edges) > 0)
        for k in range(grams.shape[1]):
            out[first + full] += np.add.reduceat(table[grams[begin:end, k]], edges[full], axis=0, dtype=np.float64)
    return out


def score(raw: np.ndarray, offsets: np.ndarray, prior: np.ndarray, tables) -> tuple[np.ndarray, np.ndarray]:
    """(number of the likeliest language, its posterior) of each document; ``tables`` gives the matrix blocks in order."""
    points, offsets = characters(raw, offsets)
    grams = features(points, offsets)
    best = np.zeros(len(offsets) - 1, np.int64)
    high, rest, begin = np.full(len(best), -np.inf), np.zeros(len(best)), 0  # rest: sum of odds against the highest
    for table in tables:
        own = prior[begin : begin + table.shape[1]] + totals(grams, offsets, table)
        top = own.max(1)
        rest = rest * np.exp(np.minimum(high - np.maximum(high, top), 0.0)) + np.exp(own - np.maximum(high, top)[:, None]).sum(1)
        best = np.where(top > high, begin + own.argmax(1), best)
        high, begin = np.maximum(high, top), begin + table.shape[1]
    return best, 1 / rest


def identify(docs: DataFrame, fitted: dict, keep: bool = False) -> DataFrame:
    """doc_id, held_out, lang_pred, score for each row; with ``keep``, text and ``rest`` (see ``wrapped``) too.

    ``und`` with score 0 for a null text, one without a letter, or when nothing was learned.  A
    null doc_id is not held out.  A very long text is one slice of its own, its features taking
    about 50 bytes for each character, whatever the number of languages.  One pass, no shuffle.
    """
    spark = prepare(docs.sparkSession)
    given = wrapped(docs) if keep else docs.select("doc_id", "text")
    rows = given.withColumn("held_out", held_out())
    names = [*given.columns, "held_out", "lang_pred", "score"] if keep else ["doc_id", "held_out", "lang_pred", "score"]
    full = rows.withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0)})
    langs, prior, shared = fitted["langs"], fitted["prior"], fitted["tables"]

    def blocks():
        for block in shared:
            yield block.value
            if len(shared) > 1:  # a worker holds one block at a time and reads it again for the next texts
                block.__dict__.pop("_value", None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names_of = np.array([*langs, UNKNOWN], object)
        for chunk in text_chunks(batches, limit=1 << 19):
            texts = chunk.column("text").to_pylist()
            readable = np.array([bool(t and _letter.search(t)) for t in texts])
            best, value = np.full(len(texts), len(names_of) - 1), np.zeros(len(texts))
            if langs and readable.any():
                likeliest, posterior = score(*text_bytes(chunk.column("text")), prior, blocks())
                best, value = np.where(readable, likeliest, best), np.where(readable, posterior, 0.0)
            made = {"lang_pred": pa.array(names_of[best].tolist(), pa.string()), "score": pa.array(value)}
            yield pa.RecordBatch.from_arrays([made[c] if c in made else chunk.column(c) for c in names], names)

    return rows.mapInArrow(run, full.select(*names).schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, fit(docs))
