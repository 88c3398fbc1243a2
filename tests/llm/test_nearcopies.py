from collections import Counter, defaultdict
from itertools import combinations

import numpy as np

from leafmill.llm import bagminhash


def bag(text):
    words = [w for w in "".join(c.lower() if c.isascii() else c for c in text or "").replace("\x0b", " ").replace("\x0c", " ").split(" ")]
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", " ".join(words))
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter()


def classes(docs):
    rows = docs.collect()
    bags = [bag(r.text) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        common = sum((bags[i] & bags[j]).values())
        if common and 10 * common >= 8 * (sum(bags[i].values()) + sum(bags[j].values()) - common):
            root[find(j)] = find(i)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(rows[i].doc_id)
    return sorted((d, min((x for x in g if x is not None), default=None), len(g)) if bags[k] else (d, d, 1) for k, g in groups.items() for d in g) if all(r.doc_id is not None for r in rows) else groups, rows, bags


def test_classes(docs):
    docs = docs.fillna(1000, ["doc_id"])
    want, _, _ = classes(docs)
    assert sorted(tuple(r)[:3] for r in bagminhash.near_duplicates(docs).collect()) == want


def test_left_over_pairs_join_classes(spark, monkeypatch):
    """A chain of texts, each close to the next only: no leader is close to all."""
    words = [f"w{i}" for i in range(300)]
    rows = [(k, " ".join(words[6 * k : 6 * k + 120])) for k in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want, _, _ = classes(docs)
    assert sorted(tuple(r)[:3] for r in bagminhash.near_duplicates(docs).collect()) == want


def test_left_over_pairs_in_salted_parts(spark, monkeypatch):
    monkeypatch.setattr(bagminhash, "PART", 2)
    words = [f"w{i}" for i in range(400)]
    rows = [(k, " ".join(words[5 * k : 5 * k + 130])) for k in range(30)] + [(100 + k, " ".join(words[:100] + [f"x{k}"] + words[100:130])) for k in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want, _, _ = classes(docs)
    assert sorted(tuple(r)[:3] for r in bagminhash.near_duplicates(docs).collect()) == want


def test_links(docs):
    docs = docs.fillna(1000, ["doc_id"])
    rows = {(r.doc_id, r.class_id): r for r in bagminhash.near_duplicates(docs).collect()}
    texts = {r.doc_id: bag(r.text) for r in docs.collect()}
    for r in rows.values():
        assert (r.link_id is None) == (r.n_links == 0) and r.n_links < r.class_size
        if r.n_links:
            a, b = texts[r.doc_id], texts[r.link_id]
            common = sum((a & b).values())
            assert 10 * common >= 8 * (sum(a.values()) + sum(b.values()) - common) and a != b
    assert rows[7, 5].n_links == 1 and rows[7, 5].link_id == 5


def test_recall(spark):
    """All pairs at 0.8 or more of the documents with ids divisible by 20 and all documents."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    found = {r.doc_id: r.class_id for r in bagminhash.near_duplicates(docs).collect()}
    bags = {r.doc_id: bag(r.text) for r in docs.collect()}
    holders = defaultdict(set)
    for i, b in bags.items():
        for g in b:
            holders[g].add(i)
    met = near = 0
    for i in (i for i in bags if i % 20 == 0 and bags[i]):
        for j in {j for g in bags[i] for j in holders[g]} - {i}:
            common = sum((bags[i] & bags[j]).values())
            if 10 * common >= 8 * (sum(bags[i].values()) + sum(bags[j].values()) - common):
                near += 1
                met += found[i] == found[j]
    assert near >= 5 and met >= 0.99 * near, (met, near)


def test_one_of_each(docs):
    kept = bagminhash.one_of_each(docs)
    assert kept.columns == docs.columns
    found = kept.collect()
    ids = [r.doc_id for r in found]
    assert ids.count(5) == 1 and not {6, 7, 8} & set(ids) and {0, 1, 2, 4, 9, 10} <= set(ids) and None in ids


def test_estimate_is_the_weighted_jaccard():
    rng = np.random.default_rng(1)
    element = rng.integers(0, 1 << 63, 300).astype(np.uint64)
    a, b = rng.integers(0, 9, 300), rng.integers(0, 9, 300)
    b = np.where(rng.random(300) < 0.7, a, b)
    hits, exact = [], np.minimum(a, b).sum() / np.maximum(a, b).sum()
    for k in range(30):
        shifted = element + np.uint64(k)
        e, o, w = (np.concatenate(x) for x in zip(*((shifted[c > 0], np.full((c > 0).sum(), i), c[c > 0]) for i, c in enumerate((a, b)))))
        sig = bagminhash.signatures(e, o, w, 2)
        hits.append((sig[0] == sig[1]).mean())
    assert abs(np.mean(hits) - exact) < 0.03


def test_no_documents(none):
    assert bagminhash.near_duplicates(none).count() == 0 and bagminhash.one_of_each(none).count() == 0


def test_texts_are_fetched_without_a_shuffle_of_all(spark, make_prose, monkeypatch):
    from leafmill.llm import bagminhash

    docs = spark.createDataFrame([(i, make_prose(i // 2, 60) + (" more" if i % 2 else "")) for i in range(40)], "doc_id long, text string")
    given, made = [], bagminhash.bags
    monkeypatch.setattr(bagminhash, "bags", lambda rows: given.append(rows._jdf.queryExecution().optimizedPlan().toString()) or made(rows))
    seen = []
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for few in (bagminhash.FEW_KEYS, 3):
            monkeypatch.setattr(bagminhash, "FEW_KEYS", few)
            given.clear()
            seen.append(sorted(map(tuple, bagminhash.near_duplicates(docs).collect())))
            assert given and all(("strategy=broadcast" in text) == (few > 3) for text in given)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert seen[0] == seen[1] and len({r[1] for r in seen[0]}) == 20


def test_small_sides_are_sent_and_give_the_same_rows(spark, monkeypatch):
    """Whatever is small is not shuffled again for each step: on many partitions the shuffles are what costs."""
    words = [f"w{i}" for i in range(400)]
    rows = [(k, " ".join(words[5 * k : 5 * k + 130])) for k in range(30)] + [(100 + k, " ".join(words[:100] + [f"x{k}"] + words[100:130])) for k in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    shuffles, made = [], bagminhash.stage

    def counted(df, tag):
        shuffles.append(df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning"))
        return made(df, tag)

    monkeypatch.setattr(bagminhash, "stage", counted)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    # all buckets are left to the last step, where the two ways to compare differ
    monkeypatch.setattr(bagminhash, "ROUNDS", 0)
    seen, sums = [], []
    try:
        for rows_sent, bytes_sent in ((bagminhash.FEW_ROWS, bagminhash.FEW_BYTES), (0, 0)):
            monkeypatch.setattr(bagminhash, "FEW_ROWS", rows_sent)
            monkeypatch.setattr(bagminhash, "FEW_BYTES", bytes_sent)
            shuffles.clear()
            seen.append(sorted(map(tuple, bagminhash.near_duplicates(docs).collect())))
            sums.append(sum(shuffles))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert seen[0] == seen[1] and sorted(r[:3] for r in seen[0]) == classes(docs)[0]
    assert sums[0] <= 0.6 * sums[1], sums
