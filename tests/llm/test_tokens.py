import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from leafmill.llm import sentencepieces, token_counts, token_files
from leafmill.llm.common import fresh_path


def test_pack_round_trip():
    for bits in (1, 7, 16, 17, 31, 32):
        ids = np.random.default_rng(bits).integers(0, 1 << bits, 5000, dtype=np.uint64).astype(np.uint32)
        words = token_files.pack(ids, bits)
        assert (token_files.unpack(words, bits, 0, 5000) == ids).all() and (token_files.unpack(words, bits, 777, 64) == ids[777:841]).all()


def test_token_files(spark, docs):
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text or ""))
    want, start = [], 0
    for r in rows:
        ids = [*lib.encode(r.text or "", add_special_tokens=False).ids, 0]
        want.append((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = token_files.token_files(spark, docs).orderBy("start").collect()
    assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got] == want


def test_token_files_of_one_id(spark, make_prose):
    """Rows without a doc_id are shared by several tasks and stand in order of their texts."""
    docs = spark.createDataFrame([(None if i % 3 else i, make_prose(i, 40)) for i in range(300)], "doc_id long, text string")
    path = public_tokenizers.path("byte_bpe_50k.json")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        manifest = token_files.write_tokens(docs, fresh_path(spark, "t"), lambda: token_files.encoder(path), 50257)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(not m.has_key for m in manifest) > 1 and max(m.rows for m in manifest) < 150
    lib = Tokenizer.from_file(path)
    rows = sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text))
    got = token_files.read_tokens(spark, manifest).orderBy("start").collect()
    assert [(r.doc_id, r.ids) for r in got] == [(r.doc_id, np.array([*lib.encode(r.text, add_special_tokens=False).ids, 0], "<u4").tobytes()) for r in rows]


def test_token_files_small_shards(spark, docs):
    path = public_tokenizers.path("byte_bpe_50k.json")
    manifest = token_files.write_tokens(docs, fresh_path(spark, "t"), lambda: token_files.encoder(path), 50257, shard_tokens=500)
    assert len(manifest) > 5
    shard = token_files.Shard(manifest[2].uri)
    assert shard.bits == 16 and len(shard.document(0)) == shard.ends[0]
    assert token_files.read_tokens(spark, manifest).count() == docs.count()


def test_no_documents(spark, none):
    assert token_files.token_files(spark, none).count() == 0
    assert token_counts.token_counts(none).count() == 0
    assert sentencepieces.sentencepieces(none).count() == 0


def test_token_counts(docs):
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = sorted(((r.doc_id, len((r.text or "").encode()), n := len(lib.encode(r.text or "", add_special_tokens=False).ids), n > 2048) for r in docs.collect()), key=str)
    assert sorted(map(tuple, token_counts.token_counts(docs).collect()), key=str) == want


@pytest.fixture(scope="module")
def pieces():
    path = public_tokenizers.path("piece_bpe_32k.model")
    return sentencepieces.Model(path), sentencepiece.SentencePieceProcessor(model_file=path)


def test_pieces_are_the_library_s(pieces, texts):
    model, lib = pieces
    given = [t or "" for t in texts]
    assert [np.frombuffer(b, np.uint32).tolist() for b in model.encode(given)] == lib.encode(given)
    short = [t[:3000] for t in given]  # the window alone, without segments
    assert [np.frombuffer(model.segment("▁" + t.replace(" ", "▁") if t else ""), np.uint32).tolist() for t in short] == lib.encode(short)


def test_stream_keeps_a_bounded_window(pieces):
    model, _ = pieces
    runs = list(model.stream("▁" + "thereandofisation" * 500))
    assert len(runs) > 20 and max(sum(map(len, r)) for r in runs) < 64 * model.longest


def test_round_trip(docs):
    assert all(r.round_trip for r in sentencepieces.sentencepieces(docs).collect())
    coded = sentencepieces.decode_column(sentencepieces.encode_column(docs))
    assert all(r.decoded == (r.text or "") for r in coded.collect()) and coded.columns[: len(docs.columns)] == docs.columns
    once = sentencepieces.encode_and_decode(docs)
    assert sorted(map(str, once.collect())) == sorted(map(str, coded.select(*once.columns).collect()))


def test_a_chunk_is_looked_up_once_for_many_texts(make_prose):
    path = public_tokenizers.path("byte_bpe_50k.json")
    lib = Tokenizer.from_file(path)
    texts = [make_prose(i % 7, 200) for i in range(60)]
    texts += ["", " ", "\n", "a\nb", "\na", "a ", "a \n b", "a\n\nb", "a\tb", "a\t b", "x  y", "é ñ\nü", "a b c", "日本 語\n文", "<|endoftext|> a", "a<|endoftext|>", "a\r\nb", "a\x1cb", "don't we'll I'm", "퟿ \U0001f600 x"]
    encode = token_files.Encoder(path)
    asked = []

    class Memo(type(encode.memo)):
        def get(self, *key):
            asked.append(key)
            return super().get(*key)

    encode.memo = Memo()
    for _ in range(2):
        assert [np.frombuffer(b, np.uint32).tolist() for b in encode(texts)] == [e.ids for e in lib.encode_batch(texts, add_special_tokens=False)]
    assert len(asked) < sum(t.count(" ") for t in texts) / 2
