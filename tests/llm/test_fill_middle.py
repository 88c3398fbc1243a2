"""Fill-in-the-middle against its SQL, and ropes against plain strings."""

import hashlib
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from leafmill.llm import fill_middle as fim


def units(text):
    return re.findall(r"[A-Za-z]+|[^A-Za-z]", text)


def test_split_and_join():
    r = random.Random(3)
    for n in (0, 1, 7, 300):
        text = "".join(r.choice(["ab", "C", " ", "é", "日", "\U0001f600", "\n", "K", "_"]) for _ in range(n))
        own = units(text)
        tree = fim.rope(text, 4)
        assert (tree.units, tree.points, fim.flat(tree)) == (len(own), len(text), text)
        for rank in {0, 1, len(own) // 2, len(own)} | {r.randrange(len(own) + 1) for _ in range(20)}:
            left, right = fim.split(tree, rank)
            assert (fim.flat(left), fim.flat(right), left.units) == ("".join(own[:rank]), "".join(own[rank:]), min(rank, len(own)))
        for rank in {r.randrange(len(text) + 1) for _ in range(20)}:
            left, right = fim.split(tree, rank, "points")
            assert (fim.flat(left), fim.flat(right), left.points, right.points) == (text[:rank], text[rank:], rank, len(text) - rank)


def test_signs_beside_cuts():
    for text in ("<", "<S", "a<P", "<<M<S<P", ">S>", "P><S M>", "abc"):
        n = len(units(text))
        for a in range(n + 1):
            for b in range(a, n + 1):
                for form in (fim.PSM, fim.SPM):
                    assert fim.restored(fim.arranged(fim.rope(text), a, b, form)[0], form) == text


def brute(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    own = units(text)
    a, b = sorted((h[0] % (len(own) + 1), h[1] % (len(own) + 1)))
    prefix, middle, suffix = ("".join(x) for x in (own[:a], own[a:b], own[b:]))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return (doc_id, len(own), "plain", None, None, text)
    output = f"<S>{suffix}<P>{prefix}<M>{middle}" if h[3] % 100 < 20 else f"<P>{prefix}<S>{suffix}<M>{middle}"
    return (doc_id, len(own), "spm" if h[3] % 100 < 20 else "psm", len(prefix), len(middle), output)


def test_awkward_texts(spark, docs, none):
    more = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(["has <P> inside", "<M>", "x" * 3_000_000 + " y z", "a b " * 400_000] + [f"one {i} two" for i in range(40)])], "doc_id long, text string")
    frame = docs.unionByName(more, allowMissingColumns=True).withColumns({c: F.lit("own") for c in ("n", "form", "output", "h1")})
    want = sorted((brute(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()), key=str)
    made = fim.with_restored(fim.fill_in_middle(frame)).collect()
    assert sorted((tuple(r)[:6] for r in made), key=str) == want
    assert {r.form for r in made} == {"plain", "psm", "spm"}
    texts = sorted((str(r.doc_id), r.text or "") for r in frame.select("doc_id", "text").collect())
    assert sorted((str(r.doc_id), r.restored) for r in made) == texts
    assert fim.with_restored(fim.fill_in_middle(none)).count() == 0


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query(spark, sf):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '/root/testdata/{sf}/documents.parquet'")
    got = fim.query(spark, f"/root/testdata/{sf}")
    want = con.sql(fim.ORACLE_SQL)
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want.fetchall(), key=str)
