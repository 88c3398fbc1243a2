import math
import re
import zlib
from collections import Counter

import numpy as np

from leafmill.llm import elias_fano, language, ngram, quality
from leafmill.llm.decontaminate import decontaminate


def test_elias_fano():
    rng = np.random.default_rng(3)
    for n, universe in ((0, 10), (1, 1), (1, 5), (1000, 1000), (5000, 1 << 40), (3000, 4000), (1, 1 << 62), (4000, (1 << 63) - 1), (9, 1 << 62)):
        values = np.sort(rng.integers(0, universe, n))
        s = elias_fano.Sequence(elias_fano.encode(values, universe))
        if n:
            at = rng.integers(0, n, 200)
            assert (s[at] == values[at]).all()
        probe = np.concatenate([values, rng.integers(0, universe, 200)])
        found = s.find(probe)
        assert (values[found[found >= 0]] == probe[found >= 0]).all() and (np.isin(probe, values) == (found >= 0)).all()


def test_scores(spark, docs):
    rows = docs.collect()
    up = {i: i + 32 for i in range(65, 91)}
    tokens = [re.findall(r"[^\x20\x09-\x0D]+", (r.text or "").translate(up)) + ["\n"] for r in rows]
    fold = [None if r.doc_id is None else zlib.crc32(str(r.doc_id).encode()) % 10 for r in rows]
    words, pairs = Counter(), Counter()
    for t, f in zip(tokens, fold):
        if f:
            words.update(t)
            pairs.update(zip(["\n", *t], t))
    total, distinct = sum(words.values()), len(words)
    mass = Counter()
    for (u, w), n in pairs.items():
        mass[u] += n - 0.75
    want = []
    for r, t, f in zip(rows, tokens, fold):
        p1 = lambda w: (words[w] + 0.1) / (total + 0.1 * (distinct + 1))
        back = lambda u: max(1 - mass[u] / words[u], 1e-9) if words[u] else 1
        score = sum(math.log10(((pairs[u, w] - 0.75) / words[u] if pairs[u, w] else 0) + back(u) * p1(w)) for u, w in zip(["\n", *t], t))
        want.append((r.doc_id, f == 0, len(t), sum(words[w] > 0 for w in t), total, sum(math.log10(p1(w)) for w in t), score))
    got = sorted(map(tuple, ngram.lm_scores(docs).collect()), key=lambda r: (str(r[0]), r[2]))
    for g, w in zip(got, sorted(want, key=lambda r: (str(r[0]), r[2])), strict=True):
        assert g[:5] == w[:5] and abs(g[5] - w[5]) < 1e-9 * w[2] + 1e-6 and abs(g[6] - w[6]) < 2e-4 * w[2]


def test_scores_of_pairs_seen_once(spark, tmp_path):
    texts = ["red fox runs home", "red fox sleeps", "grey owl flies home", "grey owl sleeps now", "red owl runs now"] * 2 + [f"word{i} follows word{i + 1}" for i in range(30)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    tokens = [t.split(" ") + ["\n"] for t in texts]
    words, pairs, successors = Counter(), Counter(), Counter()
    for i, t in enumerate(tokens):
        if zlib.crc32(str(i).encode()) % 10:
            words.update(t)
            pairs.update(zip(["\n", *t], t))
    successors.update(u for u, _ in pairs)
    assert 1 in pairs.values() and max(pairs.values()) > 1
    total, distinct = sum(words.values()), len(words)
    p1 = lambda w: (words[w] + 0.1) / (total + 0.1 * (distinct + 1))
    p2 = lambda u, w: (max(pairs[u, w] - 0.75, 0) + 0.75 * successors[u] * p1(w)) / words[u] if words[u] else p1(w)
    for r in ngram.query(spark, str(tmp_path)).collect():
        t = tokens[r.doc_id]
        assert abs(r.score - sum(math.log10(p2(u, w)) for u, w in zip(["\n", *t], t))) < 2e-4 * len(t)


def test_successors(spark, docs):
    trie = ngram.train(docs.select("text"))
    got = sum(len(trie.successors(c)) for c in range(trie.size))
    assert got == sum(r[2] for r in trie.level2) and (np.diff(trie.successors(3)) > 0).all()


def test_pairs_are_searched_between_pointers(spark, docs, monkeypatch):
    trie = ngram.train(docs.select("text"), min_count=1)
    following = [trie.successors(c) for c in range(trie.size)]
    context, word = np.repeat(np.arange(trie.size), list(map(len, following))), np.concatenate(following)
    assert not np.isnan(trie.pairs(context, word)[0]).any()
    absent = [(c, w) for c in range(20) for w in range(trie.size) if w not in following[c]]
    assert np.isnan(trie.pairs(*np.array(absent).T)[0]).all()

    def without_successors(uri, whole=ngram.opened):
        arrays = whole(uri)
        n = len(arrays.get("weight", ())) + 1
        return {**arrays, **{f"p_{k}": v for k, v in elias_fano.encode(np.zeros(n, np.int64), 1).items()}}

    monkeypatch.setattr(ngram, "opened", without_successors)
    assert np.isnan(trie.pairs(context, word)[0]).all()


def test_shards_that_are_read_stay_bounded(monkeypatch):
    monkeypatch.setattr(ngram, "read_arrays", lambda uri: {"a": np.zeros(1000, np.int64)})
    monkeypatch.setattr(ngram, "CACHED", 3 * 8000)
    monkeypatch.setattr(ngram, "_open", {})
    for k in range(10):
        ngram.opened(f"store://x/{k}")
        ngram.opened("store://x/0")
    assert list(ngram._open) == ["store://x/8", "store://x/9", "store://x/0"]


def test_nothing_to_learn(none, docs):
    assert ngram.lm_scores(none).count() == 0
    assert all(r.n_known == 0 and r.train_tokens == 0 for r in ngram.scores(docs.selectExpr("doc_id", "false AS held_out", "text"), ngram.train(none.select("text"))).collect())
    assert language.identify(none, language.fit(none)).count() == 0
    assert {r.lang_pred for r in language.identify(docs, language.fit(none)).collect()} == {"und"}


def test_languages(spark, docs):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = language.identify(d, language.fit(d), keep=True).where("held_out").collect()
    assert sum(r.rest.lang == r.lang_pred for r in rows) >= 0.98 * len(rows) and all(0 <= r.score <= 1 for r in rows)
    odd = {r.text: r.lang_pred for r in language.identify(docs, language.fit(d), keep=True).collect()}
    assert odd[None] == odd[""] == odd["1234 5678 ..."] == "und" and odd["one"] != "und"


def test_many_labels_and_a_long_text(spark, monkeypatch, make_prose):
    """600 labels in blocks of 100 and of 1000 give the same predictions; a text of 600 kB in small slices those of large ones."""
    import random

    r = random.Random(6)
    rows = [(i, " ".join("".join(r.choice(f"{chr(0x4E00 + 7 * (i % 600))}{chr(97 + i % 26)}e") for _ in range(5)) for _ in range(30)), f"l{i % 600:03d}") for i in range(2400)]
    rows.append((5000, "the river and the stone " * 25_000, None))
    rows += [(6000 + i, make_prose(i, 60), "en") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = []
    for block, slice_ in ((1000, 1 << 24), (100, 1 << 18)):
        monkeypatch.setattr(language, "BLOCK", block)
        monkeypatch.setattr(language, "SLICE", slice_)
        fitted = language.fit(docs)
        assert len(fitted["langs"]) == 601 and len(fitted["tables"]) == -(-601 // block)
        got.append({x.doc_id: (x.lang_pred, round(x.score, 9)) for x in language.identify(docs, fitted).collect()})
    assert got[0] == got[1] and got[0][5000][0] == "en"
    right = [got[0][i][0] == lang for i, _, lang in rows if lang and i < 2400]
    assert sum(right) / len(right) > 0.85


def test_languages_by_brute_force(spark):
    """The same rows from dictionaries of character n-grams, each document on its own."""
    texts = {"a": "Über den Fluß, 12 Häuser", "b": "the old house by THE river", "c": "日本語の家と川"}
    rows = [(i, texts[x], x) for i, x in enumerate("abcabcabcaabb")] + [(50, "Häuser am Fluß", None), (51, "川の家", None), (52, "é", None), (53, "x" * 30 + "日", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")

    def grams(text):
        t = [c.lower() if c.isascii() and c.isalpha() else " " if c.isascii() else c for c in text]
        return ["".join(t[i : i + n]).ljust(n) for i in range(len(t)) for n in (1, 2, 3, 4)]

    def bucket(gram):
        h = 0
        for c in gram:
            h = (h * 0x9E3779B97F4A7C15 + ord(c) + 1) % 2**64
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            h = (h ^ h >> shift) * factor % 2**64
        return (h ^ h >> 31) >> (64 - language.BITS)

    counts, prior = {x: Counter() for x in "abc"}, Counter()
    for i, t, x in rows:
        if x and zlib.crc32(str(i).encode()) % 4 != 2:
            counts[x].update(map(bucket, grams(t)))
            prior[x] += 1
    for r in language.identify(docs, language.fit(docs)).collect():
        text = next(t for i, t, _ in rows if i == r.doc_id)
        logs = {}
        for x in "abc":
            total = sum(counts[x].values()) + 0.1 * language.BUCKETS
            logs[x] = math.log((prior[x] + 1) / (sum(prior.values()) + 3)) + sum(math.log((counts[x][bucket(g)] + 0.1) / total) for g in grams(text))
        best = max(logs, key=logs.get)
        assert r.lang_pred == best and abs(r.score - 1 / sum(math.exp(v - logs[best]) for v in logs.values())) < 1e-3
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)


def test_training_draw(spark):
    docs = spark.range(4000).selectExpr("id AS doc_id", "concat('word ', id) AS text", "IF(id % 2 = 0, 'a', 'b') AS lang")
    few = language.fit(docs, train_docs=300)
    assert few["langs"] == ["a", "b"] and 220 < few["documents"] < 380
    assert language.fit(docs)["documents"] == docs.where(~language.held_out()).count()


def test_decontaminate(spark, docs, texts):
    from leafmill.llm import decontaminate as module

    items = [(1, " ".join(texts[5].split()[20:45])), (2, "nothing like this is anywhere in those texts at all really"), (3, "two WORDS"), (4, None), (None, texts[5]), (5, "..."), (12, "Two, words!"), (6, texts[5][500:700])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({i: i + 32 for i in range(65, 91)}))
    windows = {}
    for i, t in items:
        w = words(t)
        n = min(10, len(w))
        for k in range(len(w) - n + 1) if w and i is not None else ():
            windows.setdefault(tuple(w[k : k + n]), set()).add(i)
    want = []
    for r in docs.collect():
        w, hit, ids = words(r.text), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if own := windows.get(tuple(w[k : k + n])):
                    hit.update(range(k, k + n))
                    ids |= own
        import hashlib

        want.append((r.doc_id, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(map(str, ids))).encode()).hexdigest(), bool(hit)))
    assert sorted(map(tuple, decontaminate(docs, bench).collect()), key=str) == sorted(want, key=str)
    whole, module.IN_PLAN = module.IN_PLAN, 0  # the way for large benchmarks
    try:
        assert sorted(map(tuple, decontaminate(docs, bench).collect()), key=str) == sorted(want, key=str)
    finally:
        module.IN_PLAN = whole
    assert decontaminate(docs, bench.limit(0)).where("contaminated").isEmpty()
    assert decontaminate(docs.limit(0), bench).count() == 0
    whole, module.BROADCAST_BYTES = module.BROADCAST_BYTES, 0
    try:
        assert sorted(map(tuple, decontaminate(docs, bench).collect()), key=str) == sorted(want, key=str)
    finally:
        module.BROADCAST_BYTES = whole


def test_quality(docs, none):
    rows = quality.quality(docs).collect()
    for r, d in zip(sorted(rows, key=lambda r: (str(r.doc_id), r.n_words)), sorted(docs.collect(), key=lambda d: (str(d.doc_id), len(re.findall(r"[^\x20\x09-\x0D]+", d.text or "")))), strict=True):
        t = d.text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        runs = Counter(zip(w, w[1:], w[2:]))
        again = {k + j for k in range(len(w) - 2) if runs[tuple(w[k : k + 3])] > 1 for j in range(3)}
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(again))
        assert r.base_failed == (len(w) < 50 or 100 * len(again) > 50 * len(w)) and not (r.kept and r.base_failed)
    assert quality.quality(none).count() == 0


def test_quality_separates(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id")
    rows = quality.quality(d).join(d.select("doc_id", "quality"), "doc_id").where("NOT base_failed").collect()
    good, bad = [r.kept for r in rows if r.quality], [r.kept for r in rows if not r.quality]
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.15 * len(bad)


def test_quality_of_capitals_and_other_scripts(spark, make_prose):
    prose = make_prose
    text = prose(11, 400)
    han = " ".join("".join(chr(0x4E00 + (i * 37 + k * 11) % 900) for k in range(3 + i % 4)) for i in range(300))
    rows = [(i, prose(20 + i, 400), "en") for i in range(30)] + [(100 + i, han, "zh") for i in range(10)] + [(200, text.upper(), None), (201, " ".join(f"w{i}x" for i in range(300)), "en")]
    kept = {r.doc_id: r.kept for r in quality.quality(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert all(kept[i] for i in range(30)) and all(kept[100 + i] for i in range(10)) and not kept[201]
    words = quality.rated(quality.measures(spark.createDataFrame(rows, "doc_id long, text string, lang string"))).where("doc_id IN (0, 200)").collect()
    assert all(r.word_distance < quality.WORD_LIMIT for r in words)
