"""Exact top-k against its SQL and against all pairs."""

import math

import duckdb
import numpy as np
from pyspark.sql import functions as F

from leafmill.llm import topk

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, k):
    known = [(v, [math.floor(256 * float(np.float32(x))) for x in e]) for v, e in rows if e is not None and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for i, (q, w) in enumerate(known):
        if q is None or q % 50:
            continue
        scored = sorted((-sum(a * b for a, b in zip(w, x)), v is None, v) for j, (v, x) in enumerate(known) if j != i)
        out += [(q, rank + 1, v, -s) for rank, (s, _, v) in enumerate(scored[:k])]
    return sorted(out, key=str)


def rows_of(seed, n):
    r = np.random.default_rng(seed)
    made = [(int(i), [float(x) if r.random() < 0.4 else 0.0 for x in r.normal(size=8)]) for i in range(n)]
    return made + [(None, made[0][1]), (50, made[50][1]), (50, made[50][1]), (3, None), (100, [1.0, None]), (150, [float("nan"), 1.0]), (200, [float("inf")]), (250, []), (300, [1.0, -1.0]), (None, [0.5])]


def test_small_stripes(spark):
    rows = rows_of(1, 400) + [(1000 + i, [0.25] * 8) for i in range(300)]
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("own") for c in ("row", "cell", "asks", "score", "weights")})
    for k, stripe, shard in ((5, 16384, 16384), (5, 37, 3), (1000, 100, 16384)):
        got = topk.top_k(frame.repartition(3), F.col("vec_id") % 50 == 0, k=k, stripe=stripe, shard=shard).select("query_id", "rank", "vec_id", "score")
        assert sorted(map(tuple, got.collect()), key=str) == brute(rows, k)


def test_few_rows(spark):
    for rows in ([], [(50, [1.0])], [(50, [1.0]), (1, [2.0])], [(1, [2.0])]):
        assert sorted(map(tuple, topk.top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 50 == 0).collect()), key=str) == brute(rows, 5)


def test_postings_sparse_and_dense():
    r = np.random.default_rng(2)
    dense = r.integers(-9, 9, (200, 6)) * (r.random((200, 6)) < np.array([0.9, 0.1, 0.5, 0.02, 0, 1]))
    postings = topk.Postings(dense.reshape(-1), np.full(200, 6))
    assert postings.of[0][0] is None and postings.of[1][0] is not None and 4 not in postings.of
    for q in dense[:20]:
        scores = postings.accumulate(q)
        assert (scores == dense @ q).all()
        assert topk.best(scores, 7).tolist() == sorted(range(200), key=lambda i: (-scores[i], i))[:7]


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    got, want = topk.query(spark, sf), con.sql(topk.ORACLE_SQL)
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())
