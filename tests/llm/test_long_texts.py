"""Every operator on a text beyond the slice size, beside null and empty ones."""

import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from leafmill.llm import bagminhash, decontaminate, language, ngram, quality, sentencepieces, token_counts, token_files
from leafmill.llm.common import CHUNK_BYTES


@pytest.fixture(scope="module")
def long(make_prose):
    text = make_prose(77, 220_000)
    assert len(text) > CHUNK_BYTES
    return text


@pytest.fixture(scope="module")
def rows(spark, long):
    words = long.split(" ")
    words[1000] = "changed"
    given = [(1, long, "en"), (2, " ".join(words), "en"), (3, None, "en"), (4, "", None), (5, " ".join(long.split(" ")[-30:]), "en")]
    return spark.createDataFrame(given, "doc_id long, text string, lang string").coalesce(1)


def test_pieces(rows, long):
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    coded = {r.doc_id: r for r in sentencepieces.encode_and_decode(rows).collect()}
    assert np.frombuffer(coded[1].piece_ids, np.uint32).tolist() == lib.encode(long) and coded[1].decoded == long
    assert len(coded[3].piece_ids) == len(coded[4].piece_ids) == 0


def test_tokens(spark, rows, long):
    ids = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode(long, add_special_tokens=False).ids + [0]
    got = {r.doc_id: r for r in token_files.token_files(spark, rows).collect()}
    assert (got[1].n_tokens, got[1].ids_crc32) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) and got[3].n_tokens == got[4].n_tokens == 1
    counted = {r.doc_id: r.n_tokens for r in token_counts.token_counts(rows).collect()}
    assert counted[1] == len(Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")).encode(long, add_special_tokens=False).ids) and counted[3] == counted[4] == 0


def test_scores(rows, long):
    got = {r.doc_id: r for r in ngram.lm_scores(rows).collect()}
    learned = [t or "" for i, t, _ in rows.collect() if zlib.crc32(str(i).encode()) % 10]
    words = Counter(w for t in learned for w in [*t.lower().split(), "\n"])
    total = sum(words.values())
    want = sum(math.log10((words[w] + 0.1) / (total + 0.1 * (len(words) + 1))) for w in [*long.lower().split(), "\n"])
    assert got[1].n_tokens == len(long.split()) + 1 and abs(got[1].base_score - want) < 1e-6 * abs(want) and got[1].train_tokens == total


def test_rules(spark, rows, long):
    bench = spark.createDataFrame([(9, " ".join(long.split(" ")[-30:]))], "item_id long, text string")
    assert {r.doc_id: r.contaminated for r in decontaminate.decontaminate(rows, bench).collect()} == {1: True, 2: True, 3: False, 4: False, 5: True}
    assert {r.doc_id: r.n_words for r in quality.quality(rows).collect()}[1] == len(long.split())
    assert {r.doc_id: r.lang_pred for r in language.identify(rows, language.fit(rows)).collect()} == {1: "en", 2: "en", 3: "und", 4: "und", 5: "en"}


def test_near_copies(rows):
    assert {r.doc_id: r.class_id for r in bagminhash.near_duplicates(rows).collect()} == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5}
