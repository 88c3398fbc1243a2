"""Exact top-k by inner product: exhaustive term-at-a-time accumulation.

Vectors are sparse rows of integer weights by component.  Candidates are dealt to stripes of
bounded size and queries to shards; a stripe builds postings (component: rows and weights) and
every query of a shard scatters its weighted postings into a dense array of scores, of which a
partition selection keeps the best.  The bests of all stripes are merged by query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leafmill.llm.common import stage, table

#: Components are multiplied by this and rounded down.
SCALE = 256
#: Candidates of a stripe and queries of a shard, on average; a task holds one stripe and streams one shard.
STRIPE, SHARD = 16384, 16384
#: With fewer rows than the cores could share, stripes get smaller, down to this.
LEAST_STRIPE = 2048


def weights(embedding: Column, scale: int = SCALE) -> Column:
    """Integer weights of a vector; null for a vector that is null or has null or non-finite components."""
    sound = embedding.isNotNull() & F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(sound, F.transform(embedding, lambda x: F.floor(x.cast("double") * scale).cast("long")))


class Postings:
    """Weights by component over the rows of a stripe; a component that most rows have is one dense column."""

    def __init__(self, flat: np.ndarray, sizes: np.ndarray):
        self.n = len(sizes)
        ends = np.cumsum(sizes)
        row = np.repeat(np.arange(self.n), sizes)
        term = np.arange(len(flat)) - np.repeat(ends - sizes, sizes)
        used = flat != 0
        row, term, flat = row[used], term[used], flat[used]
        order = np.argsort(term, kind="stable")
        row, term, flat = row[order], term[order], flat[order]
        self.of = {}
        for d, begin, end in zip(*(x.tolist() for x in (lambda t, at: (t, at, np.append(at[1:], len(term))))(*np.unique(term, return_index=True)))):
            if 2 * (end - begin) > self.n:
                column = np.zeros(self.n, np.int64)
                column[row[begin:end]] = flat[begin:end]
                self.of[d] = None, column
            else:
                self.of[d] = row[begin:end], flat[begin:end]
        self.scores, self.product = np.zeros(self.n, np.int64), np.zeros(self.n, np.int64)

    def accumulate(self, query: np.ndarray) -> np.ndarray:
        """Scores of all rows for one query; the array is overwritten by the next call."""
        self.scores[:] = 0
        for d in np.flatnonzero(query).tolist():
            if d in self.of:
                rows, held = self.of[d]
                if rows is None:
                    np.multiply(held, query[d], out=self.product)
                    self.scores += self.product
                else:
                    self.scores[rows] += held * query[d]
        return self.scores


def best(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, highest first; of equal scores those in front."""
    k = min(k, len(scores))
    if not k:
        return np.zeros(0, np.int64)
    least = np.partition(scores, len(scores) - k)[len(scores) - k]
    above = np.flatnonzero(scores > least)
    places = np.concatenate([above, np.flatnonzero(scores == least)[: k - len(above)]])
    return places[np.lexsort((places, -scores[places]))]


def _scorer(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held, postings, ids, rows = None, [], None, None, None

        def close():
            nonlocal postings, ids, rows, held
            whole = pa.Table.from_batches(held).combine_chunks()
            lists = whole.column("weights").chunk(0) if whole.num_rows else pa.array([], pa.list_(pa.int64()))
            sizes = pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
            postings = Postings(lists.flatten().to_numpy(zero_copy_only=False), sizes)
            ids, rows = whole.column("vec_id").to_pylist(), whole.column("row").to_numpy()
            held = []

        for batch in batches:
            cells, asks = batch.column("cell").to_numpy(), batch.column("asks").to_numpy(zero_copy_only=False)
            edges = np.flatnonzero(np.append(True, (cells[1:] != cells[:-1]) | (asks[1:] != asks[:-1])))
            out = {"query_row": [], "query_id": [], "vec_id": [], "score": []}
            for begin, end in zip(edges.tolist(), [*edges[1:].tolist(), batch.num_rows]):
                part = batch.slice(begin, end - begin)
                if cells[begin] != cell:
                    cell, held, postings = cells[begin], [], None
                if not asks[begin]:
                    held.append(part)
                    continue
                if postings is None:
                    if not held:  # no candidate was dealt to this stripe
                        continue
                    close()
                for query_row, query_id, query in zip(part.column("row").to_pylist(), part.column("vec_id").to_pylist(), part.column("weights")):
                    scores = postings.accumulate(query.values.to_numpy(zero_copy_only=False))
                    places = [p for p in best(scores, k + 1).tolist() if rows[p] != query_row][:k]
                    out["query_row"] += [query_row] * len(places)
                    out["query_id"] += [query_id] * len(places)
                    out["vec_id"] += [ids[p] for p in places]
                    out["score"] += scores[places].tolist()
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in out.values()], list(out))

    return run


def top_k(vectors: DataFrame, asks: Column, k: int = 5, scale: int = SCALE, stripe: int = STRIPE, shard: int = SHARD) -> DataFrame:
    """query_id, rank, vec_id, score: the k candidates of highest inner product for every query.

    ``vectors`` has vec_id and embedding; the rows for which ``asks`` holds are the queries, all
    rows but the query's own the candidates.  Ties go to the smaller vec_id, a null one last.  A
    repeated row is a candidate of its copies and, as a query, answered once for each copy.
    Vectors that are null, or hold null or non-finite components, take no part; vectors of unequal
    length are compared on the components that both have; an empty one scores 0.  Scores have to
    fit in a long.  An empty table gives no rows, other columns are left out.
    """
    spark = vectors.sparkSession
    # written once, so that a row keeps its number however often it is read
    known = stage(vectors.select("vec_id", F.coalesce(asks, F.lit(False)).alias("asks"), weights(F.col("embedding"), scale).alias("weights")).where("weights IS NOT NULL").withColumn("row", F.monotonically_increasing_id()), "vectors")
    n, n_queries = known.count(), known.where("asks").count()
    stripes = max(-(-n // stripe), min(spark.sparkContext.defaultParallelism, -(-n // LEAST_STRIPE)), 1)
    shards = max(-(-n_queries // shard), 1)
    draw = F.xxhash64("row")
    candidates = known.withColumn("asks", F.lit(False)).withColumn("cell", F.explode(F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: F.pmod(draw, F.lit(stripes)) * shards + s)))
    queries = known.where("asks").withColumn("cell", F.explode(F.transform(F.sequence(F.lit(0), F.lit(stripes - 1)), lambda s: s * shards + F.pmod(draw, F.lit(shards)))))
    cells = candidates.unionByName(queries).repartition(stripes * shards, "cell").sortWithinPartitions("cell", "asks", F.asc_nulls_last("vec_id"))
    found = cells.mapInArrow(_scorer(k), "query_row long, query_id long, vec_id long, score long")
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


ORACLE_SQL = """
WITH known AS (SELECT vec_id, row_number() OVER () AS own, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS w FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT q.own, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.w, c.w) AS BIGINT) AS score FROM known q JOIN known c ON q.own <> c.own WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY own ORDER BY score DESC, vec_id NULLS LAST) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5"""
