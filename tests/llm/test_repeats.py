import hashlib
from collections import Counter

from pyspark.sql import functions as F

from leafmill.llm import repeats
from leafmill.llm.phrases import SPAN


def brute(texts):
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + SPAN] for r in raws for i in range(len(r) - SPAN + 1))
    out = []
    for r in raws:
        gone = bytearray(len(r))
        for i in range(len(r) - SPAN + 1):
            if seen[r[i : i + SPAN]] > 1:
                gone[i : i + SPAN] = b"\1" * SPAN
        kept = bytes(b for b, g in zip(r, gone) if not g)
        out.append((len(r), sum(gone), len([p for p in bytes(gone).split(b"\0") if p]), hashlib.sha256(kept).hexdigest()))
    return out


def check(docs):
    rows = docs.collect()
    want = sorted(zip([r.doc_id for r in rows], brute([r.text for r in rows])), key=str)
    got = repeats.without_repeats(docs).collect()
    assert sorted([(r.doc_id, (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)) for r in got], key=str) == want


def test_repeats(docs):
    check(docs)


def test_crowded_triggers(docs, monkeypatch):
    monkeypatch.setattr(repeats, "GROUP", 1)
    check(docs)


def test_one_trigger_many_phrases(spark, monkeypatch):
    """Texts around one common passage, each with its own words at both sides."""
    import random

    r = random.Random(5)
    middle = "".join(r.choice("abcdefgh ") for _ in range(190))
    own = lambda k: "".join(r.choice("uvwxyz ") for _ in range(k))
    texts = [own(300) + middle + own(300) for _ in range(60)]
    texts += [texts[i][: 300 + 190 + 25] + own(200) for i in range(0, 30, 3)] + [own(200) + texts[i][290:] for i in range(1, 30, 3)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for group in (4000, 7, 1):
        monkeypatch.setattr(repeats, "GROUP", group)
        check(docs)


def test_suffix_order():
    import random

    import numpy as np

    r = random.Random(2)
    for k in range(20):
        parts = ["".join(r.choice("ab") for _ in range(250)).encode() for _ in range(3)]
        texts = [r.choice(parts)[r.randrange(30) :] + r.choice(parts) for _ in range(8)] + [b"x" * 199, b"x" * 200]
        phrase, place, shared = repeats.suffix_order(texts, np.arange(len(texts)))
        strings = [texts[p][q : q + SPAN] for p, q in zip(phrase.tolist(), place.tolist())]
        owners = {}
        for p, x in zip(phrase.tolist(), strings):
            owners.setdefault(x, set()).add(p)
        assert shared.tolist() == [len(owners[x]) > 1 for x in strings] and all(len(x) == SPAN for x in strings)


def test_long_text(spark):
    import random

    r = random.Random(9)
    long = "".join(r.choice("abcdefghij ") for _ in range((1 << 20) + 5000))
    check(spark.createDataFrame([(1, long), (2, long[500_000:500_700]), (3, "é" * 300)], "doc_id long, text string"))


def test_columns_stay(docs):
    got = repeats.without_repeats(docs, keep=True)
    assert got.columns == ["doc_id", "text", "rest", "kept", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert got.where(F.col("n_removed") == 0).where(F.coalesce("text", F.lit("")) != F.col("kept")).isEmpty()


def test_no_documents(none):
    assert repeats.without_repeats(none).count() == 0


def test_many_equal_rows(spark):
    """Null and repeated ids with one text: the spans of the text are kept once, whatever the number of copies."""
    import random

    r = random.Random(3)
    text = " ".join(r.choice(["river", "stone", "market", "winter"]) + str(r.randrange(10**6)) for _ in range(900))
    docs = spark.createDataFrame([(None, text)] * 1000 + [(7, text)] * 1000 + [(8, "own " + text[:500])], "doc_id long, text string").repartition(8)
    got = {(r.doc_id, r.n_bytes, r.n_removed, r.n_spans): r["count"] for r in repeats.without_repeats(docs).groupBy("doc_id", "n_bytes", "n_removed", "n_spans").count().collect()}
    assert got == {(None, len(text), len(text), 1): 1000, (7, len(text), len(text), 1): 1000, (8, 504, 500, 1): 1}
