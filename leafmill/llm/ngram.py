"""Operator 3: language-model scores from an Elias-Fano n-gram trie of two levels.

Counts cover every training token.  A task counts what it reads as sorted arrays and ships them
in a few packed blocks, dealt by a hash, so that frequent words don't gather in one place.  The
trie lies in shards in the shared folder, and workers map them into memory:

* level 1: word hashes relative to their shard as a monotone Elias-Fano sequence, with counts; a
  word's id is its rank;
* level 2: for every context the ids of its successors, kept as one monotone Elias-Fano sequence
  relative to the shard's first context (context x vocabulary + word), monotone pointers to each
  context's first successor, and 16-bit codes of the smoothed log10 probability and of each
  context's back-off weight.  A pair is searched between the pointers of its context.

P(w | u) is absolute discounting of the pair count, interpolated with the additive unigram
estimate; pairs that are not in level 2 cost the back-off weight times the unigram estimate.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm.bagminhash import word_hashes
from leafmill.llm.common import fresh_path, prepare, release_shuffles, table, text_bytes, text_chunks
from leafmill.llm.elias_fano import Sequence, encode
from leafmill.llm.hashing import mix
from leafmill.llm.token_files import _fs

#: Stands for the end of a text, and for what comes before its first word.
END = np.uint64(0x5DEECE66D5DEECE6)
ALPHA = 0.1
#: Pairs seen less often are not kept; 1 keeps all.
MIN_COUNT = 1
#: Distinct words whose pairs fit in one 63-bit key; more are an error.
MOST_WORDS = 3_000_000_000
#: Bytes of shards that a worker holds where they can't be memory-mapped.
CACHED = 256 << 20
DISCOUNT = 0.75
#: Log10 values from 0 to -LOG_RANGE are stored as 16-bit codes.
LOG_RANGE = 16.0
#: Distinct keys that a task holds before it ships them.
HELD = 3_000_000
_block = pa.schema([("bucket", pa.int32()), ("block", pa.binary())])
_made = pa.schema([("bucket", pa.int32()), ("uri", pa.string()), ("distinct", pa.int64()), ("total", pa.int64())])
_MADE = "bucket int, uri string, distinct long, total long"


def quantise(log10: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(-log10 * (65535 / LOG_RANGE)), 0, 65535).astype(np.uint16)


def restore(code: np.ndarray) -> np.ndarray:
    return code.astype(np.float64) * (-LOG_RANGE / 65535)


# ---- files -------------------------------------------------------------------------------------


def write_arrays(uri: str, arrays: dict[str, np.ndarray]) -> None:
    """Named arrays, one after the other at multiples of 8 bytes, behind a text header of 4096 bytes."""
    filesystem, path = _fs(uri)
    head, at, parts = [], 4096, []
    for name, a in arrays.items():
        raw = np.ascontiguousarray(a).tobytes()
        head.append(f"{name} {a.dtype.str} {a.size} {at}")
        raw += b"\0" * (-len(raw) % 8)
        parts.append(raw)
        at += len(raw)
    with filesystem.open_output_stream(path) as out:
        out.write("\n".join(head).encode().ljust(4096))
        for raw in parts:
            out.write(raw)


def read_arrays(uri: str) -> dict[str, np.ndarray]:
    """The arrays of a file: memory-mapped in a mounted folder, read from any other store."""
    parsed = urlparse(uri)
    if parsed.scheme in ("", "file"):
        raw = np.memmap(unquote(parsed.path), np.uint8, "r")
    else:
        filesystem, path = _fs(uri)
        with filesystem.open_input_file(path) as f:
            raw = np.frombuffer(f.read_buffer(), np.uint8)
    out = {}
    for line in raw[:4096].tobytes().decode().split("\n"):
        name, kind, size, at = line.split()
        dtype = np.dtype(kind)
        out[name] = raw[int(at) : int(at) + int(size) * dtype.itemsize].view(dtype)
    return out


# ---- counting ----------------------------------------------------------------------------------


def _pack(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted keys as differences and their counts, in the fewest whole bytes that hold them."""
    gaps = np.diff(keys, prepend=np.uint64(0))
    first, gaps = gaps[:1], gaps[1:]
    wide = np.uint32 if not len(gaps) or gaps.max() < 1 << 32 else np.uint64
    count = np.uint8 if counts.max() < 256 else np.uint32 if counts.max() < 1 << 32 else np.uint64
    return bytes([np.dtype(wide).itemsize, np.dtype(count).itemsize]) + len(keys).to_bytes(6, "little") + first.tobytes() + gaps.astype(wide).tobytes() + counts.astype(count).tobytes()


def _unpack(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    wide, count, n = block[0], block[1], int.from_bytes(block[2:8], "little")
    gaps = np.frombuffer(block, f"<u{wide}", n - 1, 16).astype(np.uint64)
    keys = np.cumsum(np.concatenate([np.frombuffer(block, "<u8", 1, 8), gaps]), dtype=np.uint64)
    return keys, np.frombuffer(block, f"<u{count}", n, 16 + wide * (n - 1)).astype(np.int64)


def _add_up(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    new = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[new], np.add.reduceat(counts, new) if len(new) else counts


def _blocks(keys: np.ndarray, counts: np.ndarray, bucket: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    """Blocks of sorted ``keys`` by bucket."""
    order = np.argsort(bucket, kind="stable")
    cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
    rows = [(b, _pack(keys[order[i:j]], counts[order[i:j]])) for b, (i, j) in enumerate(zip(cuts, cuts[1:])) if j > i]
    for i in range(0, len(rows), 16):
        part = rows[i : i + 16]
        yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in part], pa.int32()), pa.array([x for _, x in part], pa.binary())], schema=_block)


def _counted(streams: Iterator[np.ndarray], bucket_of, buckets: int) -> Iterator[pa.RecordBatch]:
    """Count the keys of a task's streams and ship them whenever too many distinct ones are held."""
    parts: list[tuple[np.ndarray, np.ndarray]] = []
    held = 0
    for keys in streams:
        own, counts = np.unique(keys, return_counts=True)
        parts.append((own, counts))
        held += len(own)
        if held > HELD:
            own, counts = _add_up(np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts]))
            parts, held = [(own, counts)], len(own)
            if held > HELD // 2:
                yield from _blocks(own, counts, bucket_of(own), buckets)
                parts, held = [], 0
    if held:
        own, counts = _add_up(np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts]))
        yield from _blocks(own, counts, bucket_of(own), buckets)


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(bucket, keys, counts) of the blocks of a partition that is sorted by bucket."""
    bucket, held = None, []

    def total():
        return (bucket, *_add_up(np.concatenate([k for k, _ in held]), np.concatenate([c for _, c in held])))

    for batch in batches:
        for b, block in zip(batch.column("bucket").to_pylist(), batch.column("block")):
            if held and b != bucket:
                yield total()
                held = []
            bucket = b
            held.append(_unpack(block.as_py()))
            if len(held) >= 64:
                held = [total()[1:]]
    if held:
        yield total()


def _tokens(chunk: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all tokens, ends included; first token of each text and the end)."""
    words, first = word_hashes(*text_bytes(chunk.column("text")))
    n = len(first) - 1
    out = np.full(len(words) + n, END, np.uint64)
    out[np.arange(len(words)) + np.repeat(np.arange(n), np.diff(first))] = words
    return out, first + np.arange(n + 1)


# ---- the trie ----------------------------------------------------------------------------------


class Trie:
    """A model's shards: the files are opened when they are first needed."""

    def __init__(self, level1: list, level2: list):
        """Rows of (bucket, uri, distinct, total), in order of bucket."""
        self.level1, self.level2 = level1, level2
        self.starts = np.cumsum([0, *(r[2] for r in level1)])
        self.size, self.tokens = int(self.starts[-1]), sum(r[3] for r in level1)
        self.bounds = [level_bound(r[0], len(level2), self.size) for r in level2]

    def words(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, -1 if unknown; counts) of sorted distinct word hashes."""
        ids, counts = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64)
        bucket = word_bucket(hashes, self.level1_buckets)
        for shard, base in zip(self.level1, self.starts):
            i, j = np.searchsorted(bucket, [shard[0], shard[0] + 1])
            if i == j:
                continue
            arrays = opened(shard[1])
            at = Sequence(arrays).find(relative(hashes[i:j], shard[0], self.level1_buckets))
            ok = at >= 0
            ids[i:j] = np.where(ok, base + at, -1)
            counts[i:j] = np.where(ok, arrays["count"][at], 0)
        return ids, counts

    level1_buckets = 1

    def pairs(self, context: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(log10 P(word | context), nan where the pair is absent; log10 of the back-off weight)."""
        probability, weight = np.full(len(context), np.nan), np.zeros(len(context))
        order = np.argsort(context, kind="stable")
        ranked = context[order]
        for shard, (low, high) in zip(self.level2, self.bounds):
            i, j = np.searchsorted(ranked, [low, high])
            if i == j:
                continue
            arrays = opened(shard[1])
            own = order[i:j]
            weight[own] = restore(arrays["weight"][context[own] - low])
            known = own[word[own] >= 0]
            distinct, which = np.unique(context[known] - low, return_inverse=True)
            pointers = pointers_of(arrays)
            begin, end = pointers[distinct][which], pointers[distinct + 1][which]
            found = Sequence(arrays).find(distinct[which] * self.size + word[known], begin, end)
            hit = found >= 0
            probability[known[hit]] = restore(arrays["code"][found[hit]])
        return probability, weight

    def successors(self, context: int) -> np.ndarray:
        """Ids of the successors of one context."""
        for shard, (low, high) in zip(self.level2, self.bounds):
            if low <= context < high:
                arrays = opened(shard[1])
                pointers = pointers_of(arrays)
                a, b = pointers[np.array([context - low, context - low + 1])]
                return Sequence(arrays)[np.arange(a, b)] - (context - low) * self.size if b > a else np.zeros(0, np.int64)
        return np.zeros(0, np.int64)


def word_bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets in order of the hashes, so that shards side by side are sorted."""
    return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def relative(hashes: np.ndarray, bucket: int, buckets: int) -> np.ndarray:
    """Hashes less the smallest one that their bucket may hold."""
    return (hashes - np.uint64(-(-(bucket << 32) // buckets) << 32)).astype(np.int64)


def level_bound(bucket: int, buckets: int, size: int) -> tuple[int, int]:
    return -(-bucket * size // buckets), -(-(bucket + 1) * size // buckets)


def pointers_of(arrays: dict[str, np.ndarray]) -> Sequence:
    """Place of each context's first successor, and the end."""
    return Sequence({k[2:]: v for k, v in arrays.items() if k.startswith("p_")})


_open: dict[str, dict] = {}


def opened(uri: str) -> dict[str, np.ndarray]:
    """Arrays of a shard.  Maps stay open; of shards that had to be read, the latest CACHED bytes stay."""
    if uri in _open:
        _open[uri] = _open.pop(uri)  # the latest is the last
        return _open[uri]
    arrays = read_arrays(uri)
    mapped = urlparse(uri).scheme in ("", "file")
    size = sum(a.nbytes for a in arrays.values())
    held = 0 if mapped else size + sum(sum(a.nbytes for a in x.values()) for u, x in _open.items() if urlparse(u).scheme not in ("", "file"))
    for old in list(_open):
        if len(_open) <= 4096 and held <= CACHED:
            break
        gone = _open.pop(old)
        held -= 0 if urlparse(old).scheme in ("", "file") else sum(a.nbytes for a in gone.values())
    _open[uri] = arrays
    return arrays


def _shards(blocks: DataFrame, uri: str, buckets: int, level: int, build) -> list:
    """Merge blocks by bucket, write a shard for each, return (bucket, uri, distinct, total) in order.

    A repeated task writes under another name; only what finished tasks report is used.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, keys, counts in _gathered(batches):
            name = f"{uri}/level{level}-{bucket:05d}-{uuid.uuid4().hex}.ef"
            write_arrays(name, build(bucket, keys, counts))
            yield pa.RecordBatch.from_pylist([{"bucket": bucket, "uri": name, "distinct": len(keys), "total": int(counts.sum())}], schema=_made)

    dealt = blocks.repartition(buckets, "bucket").sortWithinPartitions("bucket")
    rows = sorted((tuple(r) for r in dealt.mapInArrow(run, _MADE).collect()))  # one row for each shard
    release_shuffles(blocks.sparkSession)
    return rows


def train(docs: DataFrame, uri: str | None = None, min_count: int = MIN_COUNT) -> Trie:
    """Count all tokens and adjacent pairs of ``docs`` (text) and write the trie."""
    spark = prepare(docs.sparkSession)
    uri = uri or fresh_path(spark, "ngram")
    filesystem, path = _fs(uri)
    filesystem.create_dir(path, recursive=True)
    buckets = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    texts = docs.select("text")

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _counted((_tokens(c)[0] for c in text_chunks(batches)), lambda k: word_bucket(k, buckets), buckets)

    def words_of(bucket: int, keys: np.ndarray, counts: np.ndarray) -> dict[str, np.ndarray]:
        return {**encode(relative(keys, bucket, buckets), (1 << 64) // buckets + (1 << 32)), "count": counts}

    level1 = _shards(texts.mapInArrow(count_words, "bucket int, block binary"), uri, buckets, 1, words_of)
    trie = Trie(level1, [])
    trie.level1_buckets = buckets
    size, tokens = trie.size, trie.tokens
    if size > MOST_WORDS:
        raise ValueError(f"{size} distinct words: pairs of more than {MOST_WORDS} don't fit in one key")

    def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def keys():
            for chunk in text_chunks(batches):
                hashes, first = _tokens(chunk)
                distinct, which = np.unique(hashes, return_inverse=True)
                ids, counts = trie.words(distinct)
                frequent = np.where(counts >= min_count, ids, -1)  # a rarer word has no frequent pair
                word, context = frequent[which], contexts(frequent[which], first, trie)
                ok = (word >= 0) & (context >= 0)
                yield (context[ok] * size + word[ok]).astype(np.uint64)

        yield from _counted(keys(), lambda k: (mix(k) % np.uint64(buckets)).astype(np.int64), buckets)

    def frequent_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, keys, counts in _gathered(batches):
            keep = counts >= min_count
            keys, counts = keys[keep], counts[keep]
            if len(keys):
                yield from _blocks(keys, counts, ((keys // np.uint64(size)) * np.uint64(buckets) // np.uint64(size)).astype(np.int64), buckets)

    def level2(bucket: int, keys: np.ndarray, counts: np.ndarray) -> dict[str, np.ndarray]:
        low, high = level_bound(bucket, buckets, size)
        context, word = (keys // np.uint64(size)).astype(np.int64), (keys % np.uint64(size)).astype(np.int64)
        of_context, of_word = counts_of(trie, np.arange(low, high)), counts_of(trie, word)
        mass = np.bincount(context - low, counts - DISCOUNT, high - low)
        weight = np.clip(1 - mass / np.maximum(of_context, 1), 1e-9, 1)
        unigram = (of_word + ALPHA) / (tokens + ALPHA * (size + 1))
        probability = (counts - DISCOUNT) / of_context[context - low] + weight[context - low] * unigram
        pointers = np.concatenate([[0], np.cumsum(np.bincount(context - low, minlength=high - low))])
        arrays = encode((context - low) * size + word, (high - low) * size)
        return {**arrays, "code": quantise(np.log10(probability)), "weight": quantise(np.log10(weight)), **{f"p_{k}": v for k, v in encode(pointers, len(keys) + 1).items()}}

    found = texts.mapInArrow(count_pairs, "bucket int, block binary").repartition(buckets, "bucket").sortWithinPartitions("bucket")
    pairs = _shards(found.mapInArrow(frequent_pairs, "bucket int, block binary"), uri, buckets, 2, level2)
    done = Trie(level1, pairs)
    done.level1_buckets = buckets
    done.bounds = [level_bound(r[0], buckets, size) for r in pairs]
    return done


def counts_of(trie: Trie, ids: np.ndarray) -> np.ndarray:
    """Counts of words by id."""
    out = np.zeros(len(ids), np.int64)
    shard = np.searchsorted(trie.starts, ids, "right") - 1
    for s in np.unique(shard).tolist():
        own = shard == s
        out[own] = opened(trie.level1[s][1])["count"][ids[own] - trie.starts[s]]
    return out


def contexts(word: np.ndarray, first: np.ndarray, trie: Trie) -> np.ndarray:
    """The word before each token; the end stands before the first."""
    before = np.append(-1, word[:-1])
    before[first[:-1]] = trie.words(np.array([END]))[0][0]
    return before


# ---- scoring -----------------------------------------------------------------------------------


def scores(docs: DataFrame, trie: Trie) -> DataFrame:
    """``docs`` (doc_id, held_out, text) with n_tokens, n_known, train_tokens, base_score, score instead of text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scale = np.log10(trie.tokens + ALPHA * (trie.size + 1))
        for chunk in text_chunks(batches):
            hashes, first = _tokens(chunk)
            distinct, which = np.unique(hashes, return_inverse=True)
            ids, counts = trie.words(distinct)
            base = (np.log10(counts + ALPHA) - scale)[which]
            word = ids[which]
            context = contexts(word, first, trie)
            pair, weight = trie.pairs(context, word)
            score = np.where(np.isnan(pair), base + weight, pair)
            per = lambda x: np.add.reduceat(x, first[:-1])  # noqa: E731  every text has its end token
            n = np.diff(first)
            columns = [chunk.column("doc_id"), chunk.column("held_out"), pa.array(n, pa.int64()), pa.array(per((word >= 0).astype(np.int64))), pa.array(np.full(len(n), trie.tokens)), pa.array(per(base)), pa.array(per(score))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return docs.select("doc_id", "held_out", "text").mapInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def lm_scores(docs: DataFrame, folds: int = 10, min_count: int = MIN_COUNT) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for each row.

    Rows whose crc32(doc_id) is no multiple of ``folds`` are learned from; a null doc_id is
    neither learned from nor held out.  A null or empty text is one end token.  Repeated rows
    count each time.  With nothing to learn from, every token is unknown.  Pairs seen fewer than
    ``min_count`` times are not kept.  A very long text is scored as one slice.
    """
    fold = F.crc32(F.col("doc_id").cast("string")) % folds
    trie = train(docs.where(fold != 0), min_count=min_count)
    return scores(docs.select("doc_id", F.coalesce(fold == 0, F.lit(False)).alias("held_out"), "text"), trie)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"))
